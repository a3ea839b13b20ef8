"""quarry: a Spark-native engine that curates, searches and evaluates text corpora."""
