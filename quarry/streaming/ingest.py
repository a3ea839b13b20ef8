"""Incremental ingestion: file streams, change detection, keyed upserts, retries, dead letters and seen-before filters.

State lives in the target folder. A batch writes its files beside the current ones and becomes visible as a whole by one
small pointer file, which is written under another name and renamed. Whatever a crash leaves behind is not pointed to, and
the batch that is tried again writes it anew.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import content_hash
from quarry.session import materialize, release, shared_dir
from quarry.sinks import files
from quarry.streaming.merge import RATIO, MergeTable


class Pointers:
    """Numbered, immutable pointer files of a folder: the one with the greatest number is current."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.writer = spark, f"{path.rstrip('/')}/pointers", uuid.uuid4().hex

    def numbers(self) -> list[int]:
        p, fs = files.hadoop(self.spark, self.path)
        if not fs.exists(p):
            return []
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(p) if f.getPath().getName().isdigit())

    def at(self, number: int) -> dict:
        return json.loads(files.read_text(self.spark, f"{self.path}/{number}"))

    def current(self) -> dict:
        """The current pointer; {"batch": -1} before the first."""
        done = self.numbers()
        return self.at(done[-1]) if done else {"batch": -1}

    def put(self, number: int, content: dict) -> None:
        """Make ``content`` current: written whole under another name, then renamed.

        A pointer is written once: if another writer has put this number, ``files.NameTaken`` is raised and nothing changes.
        Only the same writer's very same content, a repeat after a lost answer, passes.
        """
        whole = content | {"batch": number, "writer": self.writer}
        try:
            files.write(self.spark, f"{self.path}/{number}", json.dumps(whole), over=False)
        except files.NameTaken:
            if self.at(number) != whole:
                raise


def detect_changes(batch: DataFrame, current: DataFrame, key: list[str]) -> DataFrame:
    """``batch`` with ``change``: added, updated or unchanged against the hash that ``current`` has."""
    c = current.select(*[F.col(k).alias(f"__{k}") for k in key], F.col("hash").alias("__hash"), F.lit(True).alias("__old"))
    on = F.lit(True)
    for k in key:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    change = F.when(F.col("__old").isNull(), "added").when(F.col("__hash").eqNullSafe(F.col("hash")), "unchanged").otherwise("updated")
    return batch.join(c, on, "left").withColumn("change", change).drop("__hash", "__old", *[f"__{k}" for k in key])


DOCS = "doc_id long, text string, hash string"
RETRIES = "doc_id long, text string, hash string, attempts int, reason string"
LOG = "batch long, change string, n long"
MAX_ATTEMPTS = 5


class Ingest:
    """Upserts micro-batches of (doc_id, text) into the documents under ``root``.

    ``check`` gives a reason why a row cannot be taken now (null: it can). Such rows wait and come again with every batch, until
    they pass or have failed ``MAX_ATTEMPTS`` times and are dead. The last row of a key in a batch wins, by its hash where
    nothing else orders them; null ids are one key. A batch may be repeated, after a crash at any point: until its pointer is there, readers and
    the repeat see the batch before. Documents are a ``MergeTable``: a batch writes its own rows, and a new base only at that
    table's ratio. Waiting and dead rows and counters of each batch are folders of their own, which its pointer names. A batch
    of the same number from another writer raises an error.
    """

    def __init__(self, spark: SparkSession, root: str, check: Callable[[DataFrame], DataFrame] | None = None, ratio: float = RATIO):
        self.spark, self.root, self.check = spark, root.rstrip("/"), check
        self.pointers = Pointers(spark, root)
        self.table = MergeTable(spark, f"{self.root}/documents", ["doc_id"], DOCS, ratio=ratio)

    def _read(self, paths: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _named(self, what: str) -> list[str]:
        """Folders that the pointers of all batches name."""
        if not self.pointers.numbers():
            return []
        rows = self.spark.read.schema(f"{what} string").json(f"{self.pointers.path}/[0-9]*").where(f"{what} is not null").collect()  # a name a batch
        return [f"{self.root}/{what}/{r[0]}" for r in rows]

    def version(self) -> int:
        return self.pointers.current()["batch"]

    def documents(self) -> DataFrame:
        return self.table.read(self.pointers.current().get("documents", {}))

    def retries(self) -> DataFrame:
        name = self.pointers.current().get("retries")
        return self._read([f"{self.root}/retries/{name}"] if name else [], RETRIES)

    def dead(self) -> DataFrame:
        return self._read(self._named("dead"), RETRIES)

    def log(self) -> DataFrame:
        """Counters of the batches that are done."""
        return self._read(self._named("log"), LOG)

    def batch(self, df: DataFrame, number: int) -> None:
        before = self.pointers.current()
        if before["batch"] >= number:  # done before a restart
            return
        rows = df.select("doc_id", "text", content_hash(F.col("text")).alias("hash"), F.lit(0).alias("attempts"))
        waiting = self.retries().select("doc_id", "text", "hash", "attempts", F.lit(0).alias("new"))
        both = rows.withColumn("new", F.lit(1)).unionByName(waiting)  # one read of the batch, which replaces what waits under its keys
        todo = both.groupBy("doc_id").agg(F.max_by(F.struct("text", "hash", "attempts"), F.struct("new", "hash")).alias("r")).select("doc_id", "r.*")
        todo = materialize(todo, "todo")
        old = self.table.read(before.get("documents", {}), todo, todo.count())
        known = detect_changes(todo, old, ["doc_id"])
        checked = materialize(self.check(known) if self.check else known.withColumn("reason", F.lit(None).cast("string")), "checked")
        new = checked.where("reason is null and change <> 'unchanged'").select("doc_id", "text", "hash")
        bad = checked.where("reason is not null").withColumn("attempts", F.col("attempts") + 1).select("doc_id", "text", "hash", "attempts", "reason")
        name = f"v{number}-{uuid.uuid4().hex}"
        put = lambda d, what: d.write.parquet(f"{self.root}/{what}/{name}")
        dead = bad.where(F.col("attempts") >= MAX_ATTEMPTS)
        died = not dead.isEmpty()
        if died:
            put(dead, "dead")
        put(bad.where(F.col("attempts") < MAX_ATTEMPTS), "retries")
        counts = checked.groupBy(F.when(F.col("reason").isNull(), F.col("change")).otherwise("failed").alias("change")).agg(F.count("*").alias("n"))
        put(counts.select(F.lit(number).cast("long").alias("batch"), "change", "n"), "log")
        documents = self.table.stage(before.get("documents", {}), number, new)
        self.pointers.put(number, {"documents": documents, "retries": name, "log": name, "dead": name if died else None})
        release(todo)
        release(checked)

    def run(self, stream: DataFrame, checkpoint: str, **trigger):
        """Start the query; by default it takes what is there and ends. ``processingTime="5 seconds"`` keeps watching."""
        w = stream.writeStream.foreachBatch(lambda df, n: self.batch(df, n)).option("checkpointLocation", checkpoint)
        return w.trigger(**(trigger or {"availableNow": True})).start()


def keep_watching(start: Callable[[], object], stop: Callable[[], bool], wait: Callable[[float], None] = time.sleep, pause: float = 5.0, most: float = 60.0) -> int:
    """Drain again and again until ``stop``: ``start`` begins a query that ends by itself. After a failure the pause doubles, up to ``most``; a success resets it.

    Returns the number of failures. A batch that failed is taken up again from the checkpoint.
    """
    failures, now = 0, pause
    while not stop():
        try:
            start().awaitTermination()
            now = pause
        except Exception:  # noqa: BLE001  whatever a source or sink throws is tried again later
            failures += 1
            now = min(most, 2 * now)
        if not stop():
            wait(now)
    return failures


def file_stream(spark: SparkSession, path: str, schema: str, fmt: str = "json", files: int = 1) -> DataFrame:
    """A stream over immutable files that land in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(fmt).load(path)


def unseen(rows: DataFrame, seen: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key is not in ``seen``; a row with a null in its key is never dropped."""
    return rows.join(seen.select(*key).distinct(), key, "left_anti")


def merge_seen(old: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert of (key, outcome, last_success, content_hash, at): the newest outcome; an incomplete one keeps the earlier success and hash.

    ``old`` is what earlier merges gave; of ``new`` only successful rows count as a success.
    """
    all_ = old.withColumn("__ok", F.lit(True)).unionByName(new.withColumn("__ok", F.col("outcome") == "success"))
    at, kept = F.when(F.col("__ok"), F.col("last_success")), F.when(F.col("__ok"), F.col("content_hash"))
    return all_.groupBy("key").agg(F.max_by("outcome", "at").alias("outcome"), F.max(at).alias("last_success"), F.max_by(kept, at).alias("content_hash"), F.max("at").alias("at"))


def distinct_stream(stream: DataFrame, key: list[str], time: str, delay: str) -> DataFrame:
    """Each key once within the watermark: state is dropped as it passes."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def windowed_counts(stream: DataFrame, time: str, width: str, delay: str, *by: str, slide: str | None = None) -> DataFrame:
    """Event-time windows: counts and sums, late rows dropped after ``delay``."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    g = stream.withWatermark(time, delay).groupBy(w, *by).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return g.select(F.col("window.start").alias("start"), *by, "n", "total")


def run_to_table(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a bounded stream to its end into Parquet files under the shared folder, and read them.

    In ``append`` mode each row is written once. In ``complete`` mode every micro-batch gives the whole result; the last one stands.
    """
    root = f"{shared_dir(stream.sparkSession)}/quarry/stream-{uuid.uuid4().hex}"
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    if mode == "append":
        w.format("parquet").option("path", f"{root}/rows").start().awaitTermination()
    else:
        w.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{root}/rows")).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/rows")
