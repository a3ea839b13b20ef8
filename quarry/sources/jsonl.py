"""JSON-lines sources: runs of raw items, strict ledgers, and tolerant scans that count what they skip."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_items(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON-lines path with ``source_file`` and, for lines that do not parse, ``_corrupt_record``. Blank lines are skipped."""
    lines = spark.read.text(path).where(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias("source_file"))
    parsed = lines.withColumn("j", F.from_json("value", schema + ", _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    return parsed.select("j.*", "source_file")


def read_strict(spark: SparkSession, path: str, schema: str, **expected: str) -> DataFrame:
    """Rows of a ledger: a line that does not parse fails the read, and so does a row with another value of an ``expected`` column."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    for name, value in expected.items():
        df = df.withColumn(name, F.when(F.col(name).eqNullSafe(F.lit(value)), F.col(name)).otherwise(F.raise_error(F.lit(f"{name} differs from the ledger's"))))
    return df


def read_commented(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines without blank lines and those that start with #."""
    lines = spark.read.text(path).where((F.trim("value") != "") & ~F.ltrim("value").startswith("#"))
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("j")).select("j.*")


def newest_run(items: DataFrame, key: list[str], pattern: str = r"/runs/([^/]+)/") -> DataFrame:
    """One row a key: the one of the newest run, by the run's name in the file path."""
    r = items.withColumn("run", F.regexp_extract("source_file", pattern, 1))
    w = Window.partitionBy(*key).orderBy(F.desc("run"), F.desc("source_file"))
    return r.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def primary_root(bodies: list[DataFrame], key: list[str]) -> DataFrame:
    """Union of roots in which the earlier root wins a key."""
    all_ = None
    for i, b in enumerate(bodies):
        b = b.withColumn("__root", F.lit(i))
        all_ = b if all_ is None else all_.unionByName(b, allowMissingColumns=True)
    w = Window.partitionBy(*key).orderBy("__root")
    return all_.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", "__root")


def malformed(items: DataFrame) -> DataFrame:
    """(source_file, rows, malformed): the tolerant scan's own account."""
    return items.groupBy("source_file").agg(F.count("*").alias("rows"), F.count_if(F.col("_corrupt_record").isNotNull()).alias("malformed"))


def attested_files(spark: SparkSession, path: str, digests: dict[str, str]) -> DataFrame:
    """(file, state): each file's SHA-256 against the expected one, by file name."""
    want = F.create_map(*[F.lit(x) for kv in digests.items() for x in kv]) if digests else F.create_map().cast("map<string,string>")
    f = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.sha2("content", 256).alias("sha"))
    return f.select("file", F.when(F.try_element_at(want, F.col("file")).isNull(), "unlisted").when(F.try_element_at(want, F.col("file")) == F.col("sha"), "ok").otherwise("changed").alias("state"))
