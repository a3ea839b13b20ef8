"""Vector statistics: nearest neighbours, centroids, crosstabs, principal components and clusters."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize


def dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a, b):
    """0 for empty vectors and zero norms."""
    n = F.sqrt(dot(a, a) * dot(b, b))
    return F.when((F.size(a) == 0) | (n == 0), 0.0).otherwise(dot(a, b) / n)


def integrity(vectors: DataFrame, width: int, tolerance: float = 1e-3) -> DataFrame:
    """(vec_id, code): wrong width, values that are not finite, norm other than 1."""
    from quarry.operators.governance import violations

    v = F.col("embedding")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return violations(vectors, ["vec_id"], {"dimension": F.size(v) != width, "not_finite": bad, "not_normalised": ~bad & (F.abs(F.sqrt(dot(v, v)) - 1) > tolerance)})


def centroids(vectors: DataFrame) -> DataFrame:
    """(label, i, value): the mean of each component by label, one aggregation over exploded components."""
    e = vectors.select("label", F.posexplode("embedding").alias("i", "x"))
    return e.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("value"))


def centroid_likeness(vectors: DataFrame) -> DataFrame:
    """(a, b, cosine) of the centroids of every two labels, joined on components: labels are few, vectors are not."""
    c = centroids(vectors)
    norm = c.groupBy("label").agg(F.sqrt(F.sum(F.col("value") ** 2)).alias("norm"))
    u = c.join(norm, "label").select("label", "i", (F.col("value") / F.col("norm")).alias("v"))
    j = u.select(F.col("label").alias("a"), "i", F.col("v").alias("va")).join(u.select(F.col("label").alias("b"), "i", F.col("v").alias("vb")), "i").where("a < b")
    return j.groupBy("a", "b").agg(F.round(F.sum(F.col("va") * F.col("vb")), 5).alias("cosine"))


def crosstab(rows: DataFrame, row: str, column: str) -> DataFrame:
    """(row, column, n, share): counts and their share of the row, in long form so the number of columns has no bound."""
    c = rows.groupBy(row, column).agg(F.count("*").alias("n"))
    t = rows.groupBy(F.col(row).alias("__r")).agg(F.count("*").alias("t"))
    return c.join(t, c[row].eqNullSafe(t["__r"])).select(row, column, "n", F.round(F.col("n") / F.col("t"), 6).alias("share"))


def _features(vectors: DataFrame) -> DataFrame:
    return vectors.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


def principal_components(vectors: DataFrame, k: int = 3) -> DataFrame:
    """(vec_id, components): projections on the first k principal components."""
    v = _features(vectors)
    return PCA(k=k, inputCol="features", outputCol="p").fit(v).transform(v).select("vec_id", vector_to_array("p").alias("components"))


def explained_variance(vectors: DataFrame, k: int = 50) -> DataFrame:
    """(component, share, running): the share of the variance that each of the first k components explains, and the sum so far."""
    model = PCA(k=k, inputCol="features", outputCol="p").fit(_features(vectors))
    share = [float(x) for x in model.explainedVariance]  # k numbers
    rows = [(i, round(x, 6), round(sum(share[: i + 1]), 6)) for i, x in enumerate(share)]
    return vectors.sparkSession.createDataFrame(rows, "component int, share double, running double")


def kmeans(vectors: DataFrame, ks: list[int], seed: int = 7) -> DataFrame:
    """(k, silhouette, cost, chosen) for each number of clusters; chosen is the one of the greatest silhouette, the least k among equals.

    The features are written once and read by every fit.
    """
    v = materialize(_features(vectors).withColumn("features", vector_to_array("features")), "features").select(array_to_vector("features").alias("features"))
    rows = []
    for k in ks:
        m = KMeans(k=k, seed=seed, maxIter=10).fit(v)
        rows.append((k, float(ClusteringEvaluator().evaluate(m.transform(v))), float(m.summary.trainingCost)))
    best = max(rows, key=lambda r: (r[1], -r[0]), default=None)
    return vectors.sparkSession.createDataFrame([(*r, r is best) for r in rows], "k int, silhouette double, cost double, chosen boolean")
