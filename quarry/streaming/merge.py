"""A keyed table that batches add to and readers merge: deltas, delete keys, cut tails, compaction at a stated ratio."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.corpus import latest_per_key
from quarry.session import broadcast_if_small

RATIO = 0.5  # rows of deltas to rows of the base beyond which a batch compacts
LEAST, MOST = 4, 64  # deltas before the ratio counts, deltas that compact whatever the ratio


def same_key(key: list[str], prefix: str = "__k_") -> Column:
    """Null-safe equality of ``key`` with the columns of the same names under ``prefix``."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in key])


def key_columns(df: DataFrame, key: list[str], prefix: str = "__k_") -> DataFrame:
    return df.select(*[F.col(k).alias(prefix + k) for k in key]).distinct()


class MergeTable:
    """Rows of ``schema`` by ``key`` under ``root``; null is a key like any other.

    The state (a small dict: names and row counts of files) is the caller's to keep, in one pointer with whatever else a batch
    changes. A batch writes its own rows only, so bytes written follow the batch and not the table; a reader takes the last
    version of the keys that deltas name, and the rest of the base as it is. When deltas have ``ratio`` of the base's rows (and are
    ``LEAST`` or more), or are ``MOST``, the batch writes a new base: over time a row is rewritten about 1 + 1 / ratio times.
    Names are new each time, so what a crash leaves is never read.

    ``tail``: the part of the key that numbers a group's rows; ``tails`` (the rest of the key, ``count``) then cuts the rows
    from ``count`` on that were written up to that batch.
    """

    def __init__(self, spark: SparkSession, root: str, key: list[str], schema: str, tail: str | None = None, ratio: float = RATIO):
        self.spark, self.root, self.key, self.schema, self.tail, self.ratio = spark, root.rstrip("/"), key, schema, tail, ratio
        self.group = [k for k in key if k != tail]

    def _files(self, names: list[str], more: str = "seq long, gone boolean") -> DataFrame:
        schema = f"{self.schema}, {more}"
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{n}" for n in names]) if names else self.spark.createDataFrame([], schema)

    def _merged(self, state: dict, keys: DataFrame | None = None, n: int | None = None) -> DataFrame:
        base, delta = self._files([state["base"]] if state.get("base") else []), self._files([d["name"] for d in state.get("deltas", [])])
        rows = sum(d["rows"] for d in state.get("deltas", []))
        if keys is not None:  # (only the keys asked for are read further)
            asked = broadcast_if_small(key_columns(keys, self.key), keys.count() if n is None else n)
            base, delta = base.join(asked, same_key(self.key), "left_semi"), delta.join(asked, same_key(self.key), "left_semi")
        if rows:
            touched = broadcast_if_small(key_columns(delta, self.key), rows)
            rest = [c for c in base.columns if c not in self.key]
            moved = base.join(touched, same_key(self.key), "left_semi").unionByName(delta)
            moved = moved.groupBy(*self.key).agg(F.max_by(F.struct(*rest), "seq").alias("r")).select(*self.key, "r.*").where("not gone")
            base = base.join(touched, same_key(self.key), "left_anti").unionByName(moved)
        if state.get("tails"):
            t = self.spark.read.parquet(*[f"{self.root}/{x['name']}" for x in state["tails"]])
            cut = t.groupBy(*[F.col(g).alias(f"__k_{g}") for g in self.group]).agg(F.collect_list(F.struct("seq", "count")).alias("__cuts"))  # a cut a delta at most
            cut = broadcast_if_small(cut, sum(x["rows"] for x in state["tails"]))
            row, index = F.col("seq"), F.col(self.tail)
            base = base.join(cut, same_key(self.group), "left").where(~F.coalesce(F.exists("__cuts", lambda c: (c["seq"] >= row) & (index >= c["count"])), F.lit(False))).select(*base.columns)
        return base

    def read(self, state: dict, keys: DataFrame | None = None, n: int | None = None) -> DataFrame:
        """The table of a state; with ``keys`` (n of them, if known) only their rows."""
        return self._merged(state, keys, n).drop("seq", "gone")

    def _write(self, df: DataFrame, name: str) -> int:
        df.write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}").count()  # from the files' footers

    def stage(self, state: dict, number: int, upserts: DataFrame | None = None, gone: DataFrame | None = None, tails: DataFrame | None = None) -> dict:
        """The state after a batch, whose files are written; nothing is visible until the caller points to it.

        Of repeated keys in ``upserts`` the greatest row stays, so repeating a batch changes nothing; a key in both ``upserts``
        and ``gone`` stays. Batches come in rising ``number``.
        """
        new = dict(state) | {"deltas": list(state.get("deltas", [])), "tails": list(state.get("tails", []))}
        seq, parts = F.lit(number).cast("long").alias("seq"), []
        names = [f.name for f in self._files([]).schema.fields]
        if upserts is not None:
            last = latest_per_key(upserts.select(*names[:-2]), self.key, [])
            parts.append(last.select("*", seq, F.lit(False).alias("gone")))
        if gone is not None:
            dead = gone.select(*self.key).distinct()
            dead = dead.join(key_columns(upserts, self.key), same_key(self.key), "left_anti") if upserts is not None else dead
            kinds = {f.name: f.dataType for f in self._files([]).schema.fields}
            parts.append(dead.select(*[F.col(c) if c in self.key else F.lit(None).cast(kinds[c]).alias(c) for c in names[:-2]], seq, F.lit(True).alias("gone")))
        if parts:
            name = f"delta-{number}-{uuid.uuid4().hex}"
            if rows := self._write(reduce(DataFrame.unionByName, parts), name):
                new["deltas"].append({"name": name, "rows": rows})
        if tails is not None:
            name = f"tail-{number}-{uuid.uuid4().hex}"
            if rows := self._write(tails.groupBy(*self.group).agg(F.min("count").alias("count")).withColumn("seq", seq), name):
                new["tails"].append({"name": name, "rows": rows})
        grown, files = sum(d["rows"] for d in new["deltas"]), len(new["deltas"]) + len(new["tails"])
        if files >= MOST or (files >= LEAST and grown >= self.ratio * new.get("rows", 0)):
            name = f"base-{number}-{uuid.uuid4().hex}"
            new = {"base": name, "rows": self._write(self._merged(new), name), "deltas": [], "tails": []}
        return new
