"""Live progress of streams: a row a micro-batch, written while the query runs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from quarry.sinks import files

SCHEMA = "query string, run string, batch long, at timestamp, rows long, per_second double, took_ms long"


class ProgressLog(StreamingQueryListener):
    """Writes a small file under ``root`` for each micro-batch of every query of the session, and one when a query ends.

    A name is written once, so a batch that is told twice counts once. ``spark.streams.addListener(ProgressLog(spark, root))``.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _put(self, name: str, row: dict) -> None:
        try:
            files.write(self.spark, f"{self.root}/{name}.json", json.dumps(row), over=False)
        except files.NameTaken:
            pass

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        per = p.processedRowsPerSecond
        row = {"query": str(p.id), "run": str(p.runId), "batch": p.batchId, "at": p.timestamp, "rows": p.numInputRows, "per_second": per if per == per else None, "took_ms": p.batchDuration}
        self._put(f"{p.runId}-{p.batchId}", row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._put(f"{event.runId}-end", {"query": str(event.id), "run": str(event.runId), "batch": None})

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).json(f"{self.root}/*.json")

    def ended(self, run: str) -> bool:
        return files.exists(self.spark, f"{self.root}/{run}-end.json")

    def rates(self) -> DataFrame:
        """(query, batches, rows, per_minute): rows per minute of the time spent in batches; null where none was."""
        b = self.read().where("batch is not null")
        return b.groupBy("query").agg(F.count("*").alias("batches"), F.sum("rows").alias("rows"), F.round(F.try_divide(F.sum("rows") * 60_000, F.sum("took_ms")), 3).alias("per_minute"))
