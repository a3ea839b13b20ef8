"""Sinks: create-only publication, snapshots with quarantine, canonical JSON lines, append-only logs, keyed partitions."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.corpus import profile, split_quarantine
from quarry.sinks import files
from quarry.sinks.files import exists
from quarry.streaming.ingest import Pointers


def table_digest(df: DataFrame) -> dict:
    """{rows, digest} in one pass: the digest adds up row hashes, so it depends on the rows (with repeats) and on no order."""
    word = F.conv(F.substring(F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256), 1, 15), 16, 10).cast("decimal(38,0)")
    rows, total = df.agg(F.count("*"), F.sum(word)).first()
    return {"rows": rows, "digest": f"{int(total or 0):x}"}


def verify(spark: SparkSession, root: str, name: str) -> dict[str, str]:
    """{table: what differs from the manifest} of a published generation; empty if all is as written."""
    manifest = json.loads(files.read_text(spark, f"{root}/{name}/MANIFEST.json"))
    out = {}
    for t, want in manifest.items():
        if not exists(spark, f"{root}/{name}/{t}"):
            out[t] = "missing"
            continue
        got = table_digest(spark.read.parquet(f"{root}/{name}/{t}"))
        if got != {k: want[k] for k in ("rows", "digest")}:
            out[t] = "rows differ" if got["rows"] != want["rows"] else "digest differs"
    return out


class Alias:
    """A name for the current one of several generations. A switch checks the new generation first and appears at once; earlier ones stay for a rollback."""

    def __init__(self, spark: SparkSession, root: str, alias: str = "current"):
        self.spark, self.root = spark, root
        self.pointers = Pointers(spark, f"{root}/.{alias}")

    def current(self) -> str | None:
        return self.pointers.current().get("name")

    def switch(self, name: str, smoke=None) -> None:
        """Make ``name`` current if its tables are as their manifest says and ``smoke``(generation path), if given, does not object with a text."""
        wrong = verify(self.spark, self.root, name)
        said = smoke(f"{self.root}/{name}") if not wrong and smoke else None
        if wrong or said:
            raise ValueError(f"{name} is not fit: {wrong or said}")
        now = self.pointers.current()
        # raises if another writer has switched meanwhile
        self.pointers.put(now["batch"] + 1, {"name": name, "before": now.get("name")})

    def rollback(self) -> str:
        """Back to the generation before, which is checked like any other."""
        before = self.pointers.current().get("before")
        if not before:
            raise ValueError("there is no earlier generation")
        self.switch(before)
        return before


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, seen whole or not at all: written under another name, then renamed over what was there in one step."""
    files.write(spark, path, text)


def append_rotating(spark: SparkSession, path: str, text: str, most: int, backups: int = 3) -> None:
    """Append to a small log; one that would pass ``most`` bytes moves to ``path``.1 first, older ones one further, and the last goes."""
    old = files.read_text(spark, path) if exists(spark, path) else ""
    if old and len((old + text).encode()) > most:
        for i in range(backups, 0, -1):
            src = path if i == 1 else f"{path}.{i - 1}"
            if exists(spark, src):
                files.move(spark, src, f"{path}.{i}", over=True)
        old = ""
    write_text(spark, path, old + text)


def publish(tables: dict[str, DataFrame], root: str, name: str, unique: dict[str, list[str]] | None = None) -> dict:
    """Write an immutable generation ``root``/``name`` of Parquet tables; refuse one that exists.

    Tables go to a staging folder, which is renamed when all are complete, so a reader sees a whole generation or none. ``unique`` gives
    keys that must not repeat in a table. Returns the manifest (rows, digest and columns of each table), which is stored beside them.
    """
    spark = next(iter(tables.values())).sparkSession
    if exists(spark, f"{root}/{name}"):
        raise FileExistsError(f"generation {name} exists")
    staging, manifest = f"{root}/.staging-{uuid.uuid4().hex}", {}
    for t, df in tables.items():
        df.write.parquet(f"{staging}/{t}")
        back = spark.read.schema(df.schema).parquet(f"{staging}/{t}")
        key = (unique or {}).get(t)
        if key and not back.groupBy(*key).count().where("count > 1").isEmpty():
            files.delete(spark, staging)
            raise ValueError(f"{t}: {key} repeats")
        manifest[t] = table_digest(back) | {"columns": back.columns}
    files.write(spark, f"{staging}/MANIFEST.json", json.dumps(manifest, sort_keys=True))
    try:
        files.move(spark, staging, f"{root}/{name}")
    except files.NameTaken:
        files.delete(spark, staging)
        raise FileExistsError(f"generation {name} exists") from None
    return manifest


def snapshot(docs: DataFrame, root: str, name: str) -> dict:
    """Publish clean documents, quarantine with reasons and the profile by source."""
    clean, bad = split_quarantine(docs)
    return publish({"documents": clean, "quarantine": bad, "profile": profile(docs)}, root, name)


def write_jsonl(rows: DataFrame, path: str, order: list[str]) -> None:
    """Canonical JSON lines: sorted keys, nulls kept, rows in order over the files of one folder."""
    line = F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"})
    rows.repartitionByRange(*order).sortWithinPartitions(*order).select(line.alias("value")).write.text(path)


def append_log(rows: DataFrame, path: str, scores: list[str] = (), maps: list[str] = ()) -> None:
    """Append JSON rows; scores rounded to 4 places, empty map entries dropped."""
    for s in scores:
        rows = rows.withColumn(s, F.round(s, 4))
    for m in maps:
        rows = rows.withColumn(m, F.map_filter(m, lambda k, v: v.isNotNull() & (v != "")))
    rows.write.mode("append").json(path)


def replace_partitions(rows: DataFrame, path: str, by: str) -> None:
    """Overwrite only the partitions that ``rows`` has."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def update_flags(rows: DataFrame, flags: DataFrame, key: list[str], name: str, true_only: bool = True) -> DataFrame:
    """``rows`` with a column set from (key, value); by default only trues are taken."""
    f = flags.groupBy(*key).agg(F.bool_or("value").alias("__v"))
    new = F.when(F.col("__v"), True).otherwise(F.col(name)) if true_only else F.coalesce("__v", name)
    return rows.join(f, key, "left").withColumn(name, new).drop("__v")
