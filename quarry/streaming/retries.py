"""Retries in the state store: attempts, back-off and dead letters a key, with timers that say when a key is due again."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

MAX_ATTEMPTS = 5
PAUSE_MS = 60_000  # before the second attempt; it doubles with each further one
OUTPUT = "key long, kind string, status string, attempts int, due timestamp, seq long"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Retries(StatefulProcessor):
    """State of a key: attempts since its last success, its status (done, waiting, dead), when it is due, and rows seen."""

    def __init__(self, most: int, pause_ms: int):
        self.most, self.pause = most, pause_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("retries", "attempts int, status string, due long, seq long")

    def _row(self, key, kind: str, attempts: int, status: str, due: int | None, seq: int) -> pd.DataFrame:
        at = pd.Timestamp(due, unit="ms") if due is not None and due >= 0 else pd.NaT
        return pd.DataFrame({"key": [key[0]], "kind": [kind], "status": [status], "attempts": pd.array([attempts], "int32"), "due": pd.Series([at], dtype="datetime64[ns]"), "seq": [seq]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        attempts, status, due, seq = self.state.get() if self.state.exists() else (0, "done", -1, 0)
        old = due
        batch = pd.concat(list(rows)).sort_values(["at", "id"], kind="stable")  # a key's rows of one micro-batch
        for at, ok in zip(batch["at"], batch["ok"], strict=True):
            seq += 1
            if status == "dead":
                continue
            if ok:
                attempts, status, due = 0, "done", -1
            elif attempts + 1 >= self.most:
                attempts, status, due = attempts + 1, "dead", -1
            else:
                attempts, status = attempts + 1, "waiting"
                due = int(at.timestamp() * 1000) + self.pause * 2 ** (attempts - 1)
        if due != old:
            if old >= 0:
                self.handle.deleteTimer(old)
            if due >= 0:
                self.handle.registerTimer(due)
        self.state.update((attempts, status, due, seq))
        yield self._row(key, "state", attempts, status, due, seq)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        attempts, status, due, seq = self.state.get()
        if status == "waiting" and due <= expiredTimerInfo.getExpiryTimeInMs():
            yield self._row(key, "retry", attempts, status, due, seq)

    def close(self) -> None:
        pass


def track_retries(stream: DataFrame, delay: str = "1 minute", most: int = MAX_ATTEMPTS, pause_ms: int = PAUSE_MS) -> DataFrame:
    """A stream of (key long, id long, at timestamp, ok boolean), attempts at a key -> a stream of ``OUTPUT`` in update mode.

    A failure makes a key wait, twice as long each time, until a success clears it or ``most`` failures in a row make it dead, which it
    stays. After each micro-batch a row of kind ``state`` a key; when the watermark passes the time at which a waiting key is due, one
    of kind ``retry``. A key's rows of a micro-batch are taken in order of ``at``, then ``id``; null keys are left out. State and
    timers are in RocksDB and survive a restart from the checkpoint.
    """
    rows = stream.where(F.col("key").isNotNull()).select("key", "id", "at", F.coalesce("ok", F.lit(False)).alias("ok")).withWatermark("at", delay)
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return rows.groupBy("key").transformWithStateInPandas(statefulProcessor=Retries(most, pause_ms), outputStructType=OUTPUT, outputMode="Update", timeMode="EventTime")


def last_states(rows: DataFrame) -> DataFrame:
    """The current state of every key, from all that ``track_retries`` has given."""
    last = rows.where("kind = 'state'").groupBy("key").agg(F.max_by(F.struct("status", "attempts", "due"), "seq").alias("s"))
    return last.select("key", "s.*")
