"""Sequence packing as a cutting-stock problem solved by column generation.

Documents are tokenized and cut into full pieces of the sequence length and a remainder, which is cut once more at a
multiple of ``GRID``: lengths on a grid fit each other, and the short tails fill what is left. The histogram of
piece lengths (a fixed number of them, at every corpus size) is the demand of a linear program over patterns;
a knapsack dynamic program prices new patterns. Rounded patterns and the few pieces left over (packed best fit,
longest first) give a plan of runs, and the plan is joined to the pieces ranked within their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import materialize

SIZE = 1024
END = 0
GRID = 64  # remainders are cut at a multiple of this; 1 leaves them whole
RANK_ROWS = 4_000  # pieces of one length that a single task ranks

_loaded: dict = {}


def encoder(json_path: str, ranks_path: str):
    """text -> uint32 ids, equal to those of the ``tokenizers`` file at ``json_path``.

    The ranks file holds the same vocabulary for the faster library. A text that contains the string of a special
    token, or one that the faster library refuses (its pattern gives up on about a million white-space characters in
    a row), goes to the ``tokenizers`` library itself.
    """
    key = json_path, ranks_path
    if key not in _loaded:
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        slow = Tokenizer.from_file(json_path)
        special = [t.content for t in slow.get_added_tokens_decoder().values()]
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

        def encode(text: str) -> np.ndarray:
            if not any(s in text for s in special):
                try:
                    return fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
                except ValueError:
                    pass
            return np.array(slow.encode(text, add_special_tokens=False).ids, dtype="<u4")

        _loaded[key] = encode
    return _loaded[key]


def cuts(n: int, size: int = SIZE, grid: int = GRID) -> list[tuple[int, int]]:
    """(from, to) of the pieces of n ids: full ones, the part of the remainder that lies on the grid, and the tail."""
    tail = n % size % grid
    ends = sorted({0, *range(size, n + 1, size), n - tail, n})
    return list(zip(ends, ends[1:], strict=False))


def token_pieces(docs: DataFrame, json_path: str, ranks_path: str, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, with_ids: bool = False, grid: int = GRID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): each document's ids and a closing id 0, cut every ``size`` ids and once
    more at the last multiple of ``grid`` in the remainder.

    A null text is empty: its one piece is the closing id. Repeated rows and null ids stay rows of their own.
    """
    kind = dict(docs.dtypes)[doc_id]
    fields = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<long>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(json_path, ranks_path)
        for batch in batches:
            who, start, length, crc, tokens, kept = [], [], [], [], [], []
            for i, t in enumerate(batch.column(1)):
                ids = np.append(encode(t.as_py() or ""), np.uint32(END)).astype("<u4", copy=False)
                for at, end in cuts(len(ids), size, grid):
                    piece = ids[at:end]
                    who.append(i)
                    start.append(at)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    tokens.append(len(ids))
                    if with_ids:
                        kept.append(piece.astype("int64"))
            cols = [batch.column(0).take(pa.array(who, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, tokens))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                cols.append(pa.array(kept, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(cut, fields)


def best_pattern(value: np.ndarray, lengths: np.ndarray, size: int) -> tuple[float, dict[int, int]]:
    """Unbounded knapsack: the most valuable multiset of lengths that fits in ``size``, as {index: copies}."""
    best, last = np.zeros(size + 1), np.full(size + 1, -1)
    upto = np.searchsorted(lengths, np.arange(size + 1), side="right")
    for c in range(1, size + 1):
        best[c], last[c] = best[c - 1], -1
        if k := upto[c]:
            v = best[c - lengths[:k]] + value[:k]
            j = int(v.argmax())
            if v[j] > best[c] + 1e-12:
                best[c], last[c] = v[j], j
    took: dict[int, int] = {}
    c = size
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            j = int(last[c])
            took[j] = took.get(j, 0) + 1
            c -= int(lengths[j])
    return float(best[size]), took


def solve_patterns(demand: dict[int, int], size: int = SIZE, gap: float = 2e-4, rounds: int = 3000) -> list[tuple[float, dict[int, int]]]:
    """Column generation for min sum x with sum a x >= demand: [(x, {length: copies})].

    A revised simplex with an explicit inverse. It ends when no pattern prices in, or when the objective is within
    ``gap`` of a lower bound (material or Farley's).
    """
    lengths = np.array(sorted(demand))
    need = np.array([demand[int(n)] for n in lengths], dtype=float)
    m = len(lengths)
    if not m:
        return []
    copies = size // lengths
    columns = [{i: int(copies[i])} for i in range(m)]
    inverse, x, dual = np.diag(1.0 / copies), need / copies, 1.0 / copies
    at = {int(n): i for i, n in enumerate(lengths)}
    for i, n in enumerate(lengths):  # the first basis pairs each length with its complement; the rest stands alone
        j = at.get(size - int(n))
        if j is None or j <= i:
            continue
        more, less = (i, j) if need[i] >= need[j] else (j, i)
        k = copies[more]
        columns[less] = {i: 1, j: 1}
        inverse[less, less], inverse[more, less] = 1.0, -1.0 / k
        x[less], x[more] = need[less], (need[more] - need[less]) / k
        dual[less] = 1 - dual[more]
    bound = (lengths * need).sum() / size
    for _ in range(rounds):
        value, took = best_pattern(np.maximum(dual, 0), lengths, size)
        total = x.sum()
        bound = max(bound, total / max(value, 1.0))
        if value <= 1 + 1e-9 or total <= bound * (1 + gap):
            break
        col = np.zeros(m)
        for i, k in took.items():
            col[i] = k
        d = inverse @ col
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        r = int(ratio.argmin())
        if not np.isfinite(ratio[r]):
            break
        step = ratio[r]
        reduced = 1 - dual @ col
        pivot = inverse[r] / d[r]
        dual = dual + reduced * pivot
        x = np.maximum(x - step * d, 0)
        x[r] = step
        inverse -= np.outer(d, pivot)
        inverse[r] = pivot
        columns[r] = took
    return [(float(v), {int(lengths[i]): k for i, k in c.items()}) for v, c in zip(x, columns, strict=True) if v > 1e-9]


def plan_sequences(demand: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, from, to, copies, offset, first sequence) that place every rank of every length.

    Ranks from..to of a length fill consecutive sequences, ``copies`` in each, from ``offset`` on.
    """
    left = {n: c for n, c in demand.items() if n < size and c}
    used: dict[int, int] = {}
    runs, seq = [], 0

    def put(pattern: dict[int, int], times: int) -> None:
        nonlocal seq
        offset = 0
        for n in sorted(pattern, reverse=True):
            k, at = pattern[n], used.get(n, 0)
            runs.append((n, at, at + k * times, k, offset, seq))
            used[n], left[n], offset = at + k * times, left[n] - k * times, offset + k * n
        seq += times

    if full := demand.get(size, 0):
        runs.append((size, 0, full, 1, 0, 0))
        seq = full
    for x, pattern in sorted(solve_patterns(left, size), key=lambda p: -p[0]):
        if times := min(int(x + 1e-6), *(left[n] // k for n, k in pattern.items())):
            put(pattern, times)
    # What rounding leaves: best fit, longest first. bins[room] holds the open sequences with that much room.
    bins: list[list[dict[int, int]]] = [[] for _ in range(size + 1)]
    for n in sorted((n for n, c in left.items() if c), reverse=True):
        room = n
        for _ in range(left[n]):
            room = next((r for r in range(room, size) if bins[r]), size)
            b = bins[room].pop() if room < size else {}
            b[n] = b.get(n, 0) + 1
            bins[room - n].append(b)
            room = n
    same: dict[tuple, int] = {}
    for b in (b for row in bins for b in row):
        key = tuple(sorted(b.items()))
        same[key] = same.get(key, 0) + 1
    for key, times in sorted(same.items()):
        put(dict(key), times)
    return runs


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """``pieces`` (columns doc_id, start, length, ids_crc32 and any others) with ``sequence_id`` and ``offset``.

    Every piece lies in exactly one sequence; offsets are gapless from 0. Pieces of equal length are ranked in
    buckets of about ``RANK_ROWS`` rows, so a length that a third of the pieces share is spread over many tasks. A
    piece's number in the written table takes part in its bucket, so equal pieces are spread too. Only the length histogram reaches the driver. Empty input, empty result.
    Lengths outside 1..size are refused; columns that have the two names already are replaced.
    """
    spark = pieces.sparkSession
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    pieces = materialize(pieces.select(*columns).withColumn("__m", F.monotonically_increasing_id()), "pieces")
    demand = {int(r[0]): int(r[1]) for r in pieces.groupBy("length").count().collect()}  # at most size rows
    if any(not 1 <= n <= size for n in demand):
        raise ValueError(f"piece lengths must be in 1..{size}")
    runs = plan_sequences(demand, size)
    share = spark.createDataFrame([(n, -(-c // RANK_ROWS)) for n, c in demand.items()], "__n long, __buckets long")
    plan = spark.createDataFrame(runs, "__len long, __from long, __to long, __k long, __off long, __seq long")
    rows = pieces.join(F.broadcast(share), F.col("length") == F.col("__n"))
    rows = rows.withColumn("__b", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "__m"), "__buckets")).drop("__n", "__buckets")
    before = rows.groupBy("length", "__b").count()
    w = Window.partitionBy("length").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select(F.col("length").alias("__l"), F.col("__b").alias("__c"), F.coalesce(F.sum("count").over(w), F.lit(0)).alias("__before"))
    rows = rows.withColumn("__r", F.row_number().over(Window.partitionBy("length", "__b").orderBy("doc_id", "start", "ids_crc32", "__m")) - 1)
    rows = rows.join(before, (F.col("length") == F.col("__l")) & (F.col("__b") == F.col("__c"))).withColumn("__r", F.col("__r") + F.col("__before"))
    rows = rows.join(F.broadcast(plan), (F.col("length") == F.col("__len")) & (F.col("__r") >= F.col("__from")) & (F.col("__r") < F.col("__to")))
    i = F.col("__r") - F.col("__from")
    k = F.col("__k")
    rows = rows.withColumn("sequence_id", F.col("__seq") + F.floor(i / k)).withColumn("offset", F.col("__off") + (i % k) * F.col("length"))
    return rows.select(*columns, "sequence_id", "offset")
