"""Integrity, coverage, freshness and retention: ledgers against rows, each defect a code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def codes(checks: dict[str, Column]) -> Column:
    """The names of the checks that hold, in their order; null conditions do not hold."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), name) for name, c in checks.items()]))


DEALT = 500_000  # rows for which one more task takes part, so that a task's memory does not grow with the table


def violations(rows: DataFrame, keys: list[str], checks: dict[str, Column]) -> DataFrame:
    """(keys, code): a row for each check that holds of a row."""
    return rows.select(*keys, F.explode(codes(checks)).alias("code"))


def first_reason(checks: dict[str, Column], otherwise: str) -> Column:
    """The name of the first check that holds."""
    return reduce(lambda out, nc: F.when(F.coalesce(nc[1], F.lit(False)), nc[0]).otherwise(out), reversed(checks.items()), F.lit(otherwise))


def ledger_join(expected: DataFrame, observed: DataFrame, key: list[str], index: str) -> DataFrame:
    """(key, code): expected (key, chunk_count, excluded) against observed rows with a 0-based index."""
    seen = observed.groupBy(*key).agg(F.count("*").alias("n"), F.count_distinct(index).alias("u"), F.min(index).alias("lo"), F.max(index).alias("hi"))
    j = expected.join(seen, key, "left")
    n = F.coalesce("n", F.lit(0))
    checks = {
        "missing_document": ~F.col("excluded") & (n == 0),
        "chunk_count_mismatch": ~F.col("excluded") & (n > 0) & (n != F.col("chunk_count")),
        "non_contiguous": ~F.col("excluded") & (n > 0) & ((F.col("lo") != 0) | (F.col("hi") != n - 1) | (F.col("u") != n)),
        "excluded_has_points": F.col("excluded") & (n > 0),
    }
    return violations(j, key, checks)


def orphans(observed: DataFrame, expected: DataFrame, key: list[str]) -> DataFrame:
    """Keys of observed rows that the ledger does not have."""
    return observed.select(*key).distinct().join(expected.select(*key), key, "left_anti")


def sample_probe(samples: DataFrame, expected: DataFrame, observed: DataFrame, key: list[str], value: str) -> DataFrame:
    """(key, code) of samples (key, value): unknown to the ledger, not observed, or observed with another value."""
    j = samples.join(expected.select(*key).distinct().withColumn("__e", F.lit(True)), key, "left")
    j = j.join(observed.select(*key, F.col(value).alias("__o")), key, "left")
    checks = {"unknown_document": F.col("__e").isNull(), "sample_missing": F.col("__e").isNotNull() & F.col("__o").isNull(), "sample_mismatch": F.col("__o") != F.col(value)}
    return violations(j, key, checks)


def coverage(universe: DataFrame, have: DataFrame, excused: DataFrame, key: list[str], by: str) -> DataFrame:
    """Per group: size, covered, missing (universe less have less excused) and extra (have less universe), in one full join."""
    u = universe.select(by, *key).distinct().withColumn("__u", F.lit(1))
    h = have.select(by, *key).distinct().withColumn("__h", F.lit(1))
    x = excused.select(by, *key).distinct().withColumn("__x", F.lit(1))
    j = u.join(h, [by, *key], "full_outer").join(x, [by, *key], "left")
    has = lambda c: F.col(c).isNotNull()
    return j.groupBy(by).agg(
        F.count_if(has("__u")).alias("universe"),
        F.count_if(has("__u") & has("__h")).alias("covered"),
        F.count_if(has("__u") & ~has("__h") & has("__x")).alias("excused"),
        F.count_if(has("__u") & ~has("__h") & ~has("__x")).alias("missing"),
        F.count_if(has("__h") & ~has("__u")).alias("extra"),
    )


def delta_completeness(chunks: DataFrame, key: list[str], index: str, version: str) -> DataFrame:
    """Documents whose chunks, of the version that chunk 0 has, are not exactly 0..n-1, or that have other versions beside it."""
    at, version_ = F.col(index), F.col(version)
    parts = max(int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")), chunks.count() // DEALT)
    r = chunks.select(*key, version_.alias("__v"), at.alias("__i")).repartition(parts, *key)  # one shuffle for all three groupings
    r = r.groupBy(*key, "__v", "__i").agg(F.count("*").alias("n"))
    r = r.groupBy(*key, "__v").agg(F.sum("n").alias("n"), F.count("__i").alias("u"), F.max("__i").alias("hi"), F.coalesce(F.bool_or(F.col("__i") == 0), F.lit(False)).alias("first"))
    known = F.col("__v").isNotNull()
    r = r.groupBy(*key).agg(F.sum(F.when(known, F.col("n"))).alias("all"), F.max(F.when(known & F.col("first"), F.struct("__v", "n", "u", "hi"))).alias("own"))
    g = r.select(*key, "own.n", "own.u", "own.hi", (F.col("all") - F.col("own.n")).alias("other"), F.col("own.__v").alias("v"))
    return violations(g, key, {"no_first_chunk": F.col("v").isNull(), "incomplete": (F.col("u") != F.col("n")) | (F.col("hi") != F.col("n") - 1), "stale_version": F.col("other") > 0})


def newest_matching(candidates: DataFrame, indexed: DataFrame, key: list[str], run: str) -> DataFrame:
    """Per key the newest run whose hash equals the indexed one, else the newest run, marked."""
    j = candidates.join(indexed.select(*key, F.col("hash").alias("__want")), key, "left").withColumn("matched", F.coalesce(F.col("hash") == F.col("__want"), F.lit(False)))
    w = Window.partitionBy(*key).orderBy(F.desc("matched"), F.desc(run))
    return j.withColumn("__n", F.row_number().over(w)).where("__n = 1").select(*key, run, "matched")


def freshness(inventory: DataFrame, observed: DataFrame, slas: DataFrame, now, by: str = "source") -> DataFrame:
    """(source, code): inventory (source, total, complete), observed (source, last_seen, errors) and SLAs (source, max_age_hours,
    min_basis_points) in full joins; coverage compares integers."""
    j = slas.join(inventory, by, "full_outer").join(observed, by, "full_outer")
    checks = {
        "no_sla": F.col("max_age_hours").isNull(),
        "no_inventory": F.col("total").isNull(),
        "no_observation": F.col("last_seen").isNull(),
        "stale": F.col("last_seen") < now - F.make_dt_interval(F.lit(0), F.col("max_age_hours").cast("int")),
        "coverage": F.col("complete") * 10_000 < F.col("total") * F.col("min_basis_points"),
        "errors": F.col("errors") > 0,
    }
    return violations(j, [by], checks)


def retention(runs: DataFrame, now, days: Column) -> DataFrame:
    """(run columns, verdict): the first reason to keep a run, else prune. runs: protected, ok, finished, covered."""
    checks = {
        "protected": F.col("protected"),
        "missing": F.col("finished").isNull(),
        "failed": ~F.col("ok"),
        "future": F.col("finished") > now,
        "not_covered": ~F.col("covered"),
        "too_young": F.col("finished") > now - F.make_dt_interval(days.cast("int")),
    }
    return runs.withColumn("verdict", first_reason(checks, "prune"))


def field_diff(expected: DataFrame, actual: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, expected, actual) where two tables of the same columns differ, nulls equal; rows of one side only show every field."""
    long = lambda d, name: d.select(key, F.explode(F.map_from_arrays(F.array(*map(F.lit, fields)), F.array(*[F.col(f).cast("string") for f in fields]))).alias("field", name))
    j = long(expected, "expected").join(long(actual, "actual"), [key, "field"], "full_outer")
    return j.where(~F.col("expected").eqNullSafe(F.col("actual")))


def pagination(pages: DataFrame, max_duplicate_rate: float = 0.2) -> DataFrame:
    """Per scope over pages (scope, page, ids, advertised_total, terminal): unique and repeated ids and failure codes."""
    ids = pages.select("scope", F.explode("ids").alias("id")).groupBy("scope").agg(F.count("*").alias("seen"), F.count_distinct("id").alias("unique"))
    p = pages.groupBy("scope").agg(F.count("*").alias("pages"), F.max("page").alias("last"), F.count_distinct("advertised_total").alias("totals"), F.max_by("advertised_total", "page").alias("total"), F.count_if(F.size("ids") == 0).alias("empty"), F.max_by("terminal", "page").alias("terminal"))
    j = p.join(ids, "scope", "left").na.fill(0, ["seen", "unique"])
    checks = {"total_drift": F.col("totals") > 1, "count_mismatch": F.col("unique") != F.col("total"), "early_empty": (F.col("empty") > 0) & (F.col("unique") < F.col("total")), "no_terminal": ~F.col("terminal"), "duplicate_rate": (F.col("seen") - F.col("unique")) > max_duplicate_rate * F.col("seen")}
    return j.select("scope", "pages", "seen", "unique", F.array_join(codes(checks), ",").alias("codes"))


def split_leakage(rows: DataFrame, key: str, split: str) -> DataFrame:
    """Keys that occur in more than one split."""
    return rows.groupBy(key).agg(F.count_distinct(split).alias("splits")).where("splits > 1")


def set_hash(rows: DataFrame, by: str, member: str) -> DataFrame:
    """(by, members, digest): an order-free digest of each group's distinct members.

    Members are hashed one by one and the digests added, so a group is never gathered into one list.
    """
    d = rows.select(by, member).distinct()
    part = lambda i: F.sum(F.conv(F.substring(F.sha2(F.col(member).cast("string"), 256), i * 8 + 1, 8), 16, 10).cast("decimal(38,0)"))
    return d.groupBy(by).agg(F.count("*").alias("members"), F.concat_ws("-", *[part(i).cast("string") for i in range(4)]).alias("digest"))


def filters(**f) -> Column | None:
    """Conjunction of the given conditions: name=value is equality, name__in membership, name__from / name__to closed bounds,
    name__text all words. None or nothing given: no condition."""
    out = []
    for k, v in f.items():
        if v is None:
            continue
        name, _, how = k.partition("__")
        c = F.col(name)
        out.append({"": lambda c, v: c == v, "in": lambda c, v: c.isin(*v), "from": lambda c, v: c >= v, "to": lambda c, v: c <= v, "text": lambda c, v: reduce(lambda a, b: a & b, [F.array_contains(F.split(F.lower(c), r"[^\p{L}\p{N}_]+"), w) for w in v.lower().split()])}[how](c, v))
    return reduce(lambda a, b: a & b, out) if out else None


#: The filters of a search by name; ``columns`` of ``named_filter`` says which column each reads.
EXACT = ("source", "language", "document_type", "court", "document_id", "document_number", "registration_code", "article_id", "clause_id", "status")
NAMED = (*EXACT, "is_consolidated", "parties", "contains", "date_from", "date_to", "as_of")


def named_filter(given: dict, columns: dict[str, str] | None = None) -> tuple[Column | None, str | None]:
    """(condition, words that the text must have) of a search's named filters; unknown names raise an error, null and empty ones ask for nothing.

    ``EXACT`` ones and ``is_consolidated`` are equalities, ``parties`` must have all words, ``date`` lies between ``date_from`` and
    ``date_to``, both included, and ``as_of`` between effective_from, included, and effective_to, not included; a null
    effective_to is open. ``columns`` maps names to columns where they differ.
    """
    if unknown := set(given) - set(NAMED):
        raise ValueError(f"unknown filters: {sorted(unknown)}")
    at = lambda name: F.col((columns or {}).get(name, name))
    want = {k: v for k, v in given.items() if v is not None and v != ""}
    out = [at(n) == F.lit(want[n]) for n in (*EXACT, "is_consolidated") if n in want]
    if "parties" in want:
        words = F.split(F.lower(at("parties")), r"[^\p{L}\p{N}_]+")
        out += [F.array_contains(words, w) for w in str(want["parties"]).lower().split()]
    moment = lambda c: c.cast("timestamp")
    if "date_from" in want:
        out.append(moment(at("date")) >= moment(F.lit(want["date_from"])))
    if "date_to" in want:
        out.append(moment(at("date")) <= moment(F.lit(want["date_to"])))
    if "as_of" in want:
        t = moment(F.lit(want["as_of"]))
        out.append((moment(at("effective_from")) <= t) & (at("effective_to").isNull() | (moment(at("effective_to")) > t)))
    return (reduce(lambda a, b: a & b, out) if out else None), want.get("contains")


def browse(rows: DataFrame, order: list[Column], offset: int, limit: int) -> DataFrame:
    """One page of a listing in a total order: a top-k of offset + limit rows a task, not a full sort."""
    return rows.orderBy(*order).limit(offset + limit).offset(offset)
