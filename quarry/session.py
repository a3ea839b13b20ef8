"""Session helpers: table loading, shared scratch space, size-checked broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a narrow key table (ids and a few numbers) may be broadcast.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables of a data directory, read by Spark alone."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder serves a local master only; a cluster must name one, as its executors do not see each
    other's disks.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="quarry-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quarry/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._quarry_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete the files of a materialized table that nothing will read again."""
    jvm, path = df.sparkSession._jvm, df._quarry_path
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def broadcast_if_small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when the counted size is within ``limit`` rows; beyond it a shuffle join runs."""
    return F.broadcast(df) if rows <= limit else df
