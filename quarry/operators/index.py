"""Index rows: payloads of chunks with their identities, and BM25 term statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import identity, tokens, uuid5
from quarry.operators.governance import violations

NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"  # the URL namespace of RFC 4122


def payloads(docs: DataFrame, chunk_rows: DataFrame) -> DataFrame:
    """Chunks (doc_id, chunk_index, char_start, char_end, text, passage_hash...) beside their documents' columns, with point_id, passage_id and chunk_count.

    Document columns never replace a chunk's own.
    """
    n = chunk_rows.groupBy("doc_id").agg(F.count("*").alias("chunk_count"))
    own = [c for c in docs.columns if c not in chunk_rows.columns or c == "doc_id"]
    j = chunk_rows.join(docs.select(*own), "doc_id").join(n, "doc_id")
    name = F.concat_ws(":", F.col("source"), F.col("doc_id").cast("string"), F.col("chunk_index").cast("string"))
    passage = F.concat(F.lit("passage:"), identity(F.col("source"), F.col("doc_id"), F.lit(""), F.col("char_start"), F.col("char_end"), F.col("passage_hash")))
    return j.withColumn("point_id", uuid5(NAMESPACE, name)).withColumn("passage_id", passage)


def payload_violations(points: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, chunk_index, code): offsets that are no range, slices and hashes that do not fit, indexes out of range."""
    j = points.join(docs.select("doc_id", F.col("text").alias("__body")), "doc_id", "left")
    slice_ = F.expr("substring(__body, char_start + 1, char_end - char_start)")
    checks = {
        "no_document": F.col("__body").isNull(),
        "offsets": (F.col("char_start") < 0) | (F.col("char_end") <= F.col("char_start")),
        "slice": slice_ != F.col("text"),
        "hash": F.sha2("text", 256) != F.col("passage_hash"),
        "index": (F.col("chunk_index") < 0) | (F.col("chunk_index") >= F.col("chunk_count")),
    }
    return violations(j, ["doc_id", "chunk_index"], checks)


def term_stats(docs: DataFrame) -> DataFrame:
    """(term, df, tf, idf) of all terms."""
    t = docs.select("doc_id", F.explode(tokens(F.col("text"))).alias("term")).groupBy("term", "doc_id").agg(F.count("*").alias("n"))
    n = docs.agg(F.count("*").alias("docs"))
    g = t.groupBy("term").agg(F.count("*").alias("df"), F.sum("n").alias("tf"))
    return g.crossJoin(F.broadcast(n)).select("term", "df", "tf", F.round(F.log(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5)), 6).alias("idf"))
