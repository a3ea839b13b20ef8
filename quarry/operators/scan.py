"""Scans that end early: files in ranges of an order, taken in growing waves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sinks import files


def write_ranges(rows: DataFrame, path: str, order: list[str], parts: int) -> None:
    """Rows in ``parts`` files, each a range of ``order`` and sorted by it; file names follow the ranges."""
    rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).write.parquet(path)


def range_files(spark: SparkSession, path: str) -> list[str]:
    p, fs = files.hadoop(spark, path)
    return sorted(str(f.getPath().toString()) for f in fs.listStatus(p) if f.getPath().getName().startswith("part-"))


def first_keys(spark: SparkSession, path: str, schema: str, key: str, order: list[str], n: int) -> tuple[DataFrame, int]:
    """((key, order) of the first ``n`` distinct non-null keys in order, files read) of what ``write_ranges`` wrote.

    One file is read, then two more, then four, until they hold ``n`` keys; later ones are never opened. Fewer keys than ``n``
    read all files and give what there is.
    """
    names, taken, wave = range_files(spark, path), 0, 1
    read = lambda k: spark.read.schema(schema).parquet(*names[:k]).where(F.col(key).isNotNull())
    while taken < len(names):
        taken, wave = min(len(names), taken + wave), 2 * wave
        if read(taken).select(key).distinct().limit(n).count() >= n:
            break
    rows = read(taken) if taken else spark.createDataFrame([], schema)
    first = rows.groupBy(key).agg(F.min(F.struct(*order)).alias("at")).orderBy("at").limit(max(n, 0))
    return first.select(key, "at.*"), taken
