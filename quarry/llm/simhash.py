"""SimHash fingerprints and a Hamming-radius search over permuted block tables."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.components import connected_components
from quarry.session import materialize

BITS = 256
PART = 2_048  # rows of a bucket in one part
AT_ONCE = 1 << 18  # comparisons made, and pairs handed on, in one go
COMPARED, TASKS = 1e8, 4_096  # comparisons for which one more task is planned, and the most tasks
WORDS_KEPT = 500_000  # term hashes a worker remembers before it starts afresh; a speed bound only


class Fingerprinter:
    """Weighted term hashes vote on signed bits. Terms are words and pairs of neighbouring words.

    A term weighs 1 + ln(tf); pairs weigh ``pair_weight`` times that, because words alone are shared by all texts of
    a language. Ties give bit 0, so a text without words has the zero fingerprint.
    """

    def __init__(self, bits: int = BITS, pair_weight: float = 2.0):
        if bits % 64:
            raise ValueError("bits must be a multiple of 64")
        self.bits, self.pair_weight = bits, pair_weight
        self.known: dict[bytes, int] = {}
        self.mult = np.array([xxhash.xxh3_64_intdigest(f"bit{i}".encode()) | 1 for i in range(bits // 64)], dtype=np.uint64)
        self.base = (np.arange(bits // 8) * 256).astype(np.int32)
        self.signs = 2.0 * np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1) - 1

    def _hash(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > WORDS_KEPT:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))

    @staticmethod
    def _mix(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))

    def _votes(self, terms: np.ndarray, weight: float) -> np.ndarray:
        terms, tf = np.unique(terms, return_counts=True)
        w = (weight * (1 + np.log(tf)))
        n = self.bits // 8
        sums = np.zeros(n * 256)
        for at in range(0, len(terms), 4096):  # weights by byte of the hash and its value, then by bit
            h = self._mix(terms[at : at + 4096, None] * self.mult[None, :])
            where = h.view(np.uint8).reshape(len(h), n) + self.base[None, :]
            sums += np.bincount(where.ravel(), np.repeat(w[at : at + 4096], n), n * 256)
        return (sums.reshape(n, 256) @ self.signs).ravel()

    def __call__(self, text: str) -> bytes:
        words = text.encode().lower().split()
        if not words:
            return bytes(self.bits // 8)
        h = self._hash(words)
        votes = self._votes(h, 1.0)
        if len(h) > 1:
            votes += self._votes(self._mix(h[:-1] * np.uint64(3) + h[1:]), self.pair_weight)
        return np.packbits(votes > 1e-6).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """0 to 1: the estimated cosine of the weighted term vectors, from the share of equal bits."""
    n = len(a) * 8
    differ = (int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_count()
    return max(0.0, float(np.cos(np.pi * differ / n)))


def fingerprints(docs: DataFrame, bits: int = BITS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint): a hex string of ``bits`` / 4 digits for each row. Null text is empty text. No shuffle."""
    kind = dict(docs.dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Fingerprinter(bits)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([f(t.as_py() or "").hex() for t in b.column(1)], pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, f"doc_id {kind}, fingerprint string")


def even_blocks(ones: np.ndarray, total: int, blocks: int) -> np.ndarray:
    """(blocks, words): masks that cut the bits into runs of about equal entropy, given in how many of ``total`` fingerprints each bit is 1."""
    p = np.clip(ones / max(1, total), 1e-12, 1 - 1e-12)
    h = -(p * np.log2(p) + (1 - p) * np.log2(1 - p))
    before = np.cumsum(h) - h / 2
    block = np.minimum((before / h.sum() * blocks).astype(np.int64), blocks - 1)
    bits = block[None, :] == np.arange(blocks)[:, None]
    return np.packbits(bits, axis=1).view(np.uint64)


def _words(fingerprints: pa.Array, bits: int) -> np.ndarray:
    return np.frombuffer(bytes.fromhex("".join(fingerprints.to_pylist())), np.uint64).reshape(len(fingerprints), bits // 64)


def near_fingerprints(fps: DataFrame, radius: int, bits: int = BITS, spare: int = 1) -> tuple[DataFrame, DataFrame]:
    """All pairs of different fingerprints within ``radius`` bits: (pairs a, b, distance; members doc_id, fingerprint).

    A fingerprint is cut into radius + 1 + ``spare`` blocks of bits. Two within the radius agree on 1 + ``spare`` whole
    blocks at least, so one table for each choice of so many blocks finds them all. Blocks are cut where the bits that tell
    the given fingerprints apart fall evenly: a bit that all share makes no bucket smaller. Equal fingerprints are one row
    in the tables. A bucket (the rows of one table with one block key) is compared in pairs of parts of about ``PART`` rows,
    each pair of parts in one go. A pair comes out of the first table that its blocks agree in, and of no other, so no
    bucket is gathered, no two that are farther apart are emitted and none is emitted twice. Null fingerprints are left out
    of the pairs. Documents join to the pairs through the members.
    """
    blocks = radius + 1 + spare
    if blocks > bits // 4:
        raise ValueError("radius too large for the fingerprint")
    one = materialize(fps.where("fingerprint is not null").select("fingerprint").distinct(), "fingerprints")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ones = np.unpackbits(_words(b.column(0), bits).view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, bits)), pa.array(np.concatenate([[b.num_rows], ones]))], ["bit", "n"])

    seen = dict(one.mapInArrow(count, "bit long, n long").groupBy("bit").agg(F.sum("n")).collect())  # a row a bit, and the total as bit -1
    cut = even_blocks(np.array([seen.get(i, 0) for i in range(bits)]), seen.get(-1, 0), blocks)
    masks = np.array([np.bitwise_or.reduce(cut[list(chosen)]) for chosen in itertools.combinations(range(blocks), 1 + spare)])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = _words(b.column(0), bits)
            for t, mask in enumerate(masks):
                key = np.full(len(fp), t, np.uint64)
                for w in range(fp.shape[1]):
                    key = Fingerprinter._mix(key * np.uint64(3) + (fp[:, w] & mask[w]))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), t, np.int32)), pa.array(key.view(np.int64)), b.column(0)], ["t", "key", "fingerprint"])

    rows = one.mapInArrow(spread, "t int, key long, fingerprint string")
    met = rows.groupBy("t", "key").count().where("count > 1")
    met = materialize(met.select(F.col("t").alias("__t"), F.col("key").alias("__key"), "count", F.ceil(F.col("count") / PART).cast("int").alias("parts")), "met")
    work = met.agg(F.sum(F.col("count").cast("double") * F.col("count"))).first()[0] or 0
    rows = rows.join(met, (F.col("t") == F.col("__t")) & (F.col("key") == F.col("__key"))).withColumn("part", F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(F.least("part", j).alias("i"), F.greatest("part", j).alias("j")))
    rows = rows.select("t", "key", "part", "fingerprint", F.explode(pair).alias("at")).select("t", "key", "at.i", "at.j", "part", "fingerprint")
    least = int(one.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(int(min(TASKS, max(least, work / COMPARED))), "t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j", "part", "fingerprint")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            t = pa.concat_batches([held, b]) if held is not None else b
            key = np.column_stack([t.column(k).to_numpy() for k in range(4)])
            starts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1]) if len(key) else np.zeros(0, np.int64)
            if len(starts):
                yield from near(t.slice(0, int(starts[-1])), starts)
                held = t.slice(int(starts[-1]))
        if held is not None:
            yield from near(held, np.array([0, held.num_rows]))

    def first_met(fp: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the pairs' own table is the first whose blocks agree."""
        x, own = fp[i] ^ fp[j], table[i]
        agree = lambda t: ~(x & masks[t]).any(axis=1)
        ok = agree(own)
        for t in range(int(own.max(initial=0))):
            ok &= ~(agree(t) & (own > t))
        return ok

    def near(t: pa.RecordBatch, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        fp, table = _words(t.column(5), bits), t.column(0).to_numpy()
        part, lo = t.column(4).to_numpy(), t.column(2).to_numpy()
        left, right, far, size = [], [], [], 0

        def out() -> pa.RecordBatch:
            i, j, d = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (left, right, far))
            ok = np.flatnonzero(first_met(fp, table, i, j))
            left.clear(), right.clear(), far.clear()
            return pa.RecordBatch.from_arrays([t.column(5).take(pa.array(i[ok])), t.column(5).take(pa.array(j[ok])), pa.array(d[ok])], ["x", "y", "distance"])

        for a, z in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            same = part[a] == part[z - 1]
            n = z - a if same else int((part[a:z] == lo[a:z]).sum())
            at = a if same else a + n
            step = max(1, AT_ONCE // max(1, z - at))
            for k in range(a, a + n, step):
                stop, first = min(k + step, a + n), k if same else at
                d = sum(np.bitwise_count(fp[k:stop, None, w] ^ fp[None, first:z, w]).astype(np.uint16) for w in range(fp.shape[1]))
                x, y = np.nonzero(d <= radius)
                if same:
                    x, y = x[after := y > x], y[after]
                left.append(k + x), right.append(first + y), far.append(d[x, y])
                size += len(x)
                if size > AT_ONCE:
                    yield out()
                    size = 0
        yield out()

    pairs = rows.mapInArrow(compare, "x string, y string, distance long").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "distance")
    return pairs, fps.select("doc_id", "fingerprint")


def linked_classes(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, class, links) of every member: the least fingerprint reachable by pairs, and how many others are paired with its own."""
    pairs = materialize(pairs, "near")
    ends = pairs.select("a").union(pairs.select("b")).groupBy("a").agg(F.count("*").alias("__links"))
    least = connected_components(pairs)
    out = members.join(ends.withColumnRenamed("a", "__f"), F.col("fingerprint") == F.col("__f"), "left").join(least, F.col("fingerprint") == F.col("node"), "left")
    return out.select("doc_id", "fingerprint", F.coalesce("component", "fingerprint").alias("class"), F.coalesce("__links", F.lit(0)).alias("links"))


def _edited(own: str, following: str) -> str:
    half = len(own) // 2
    return own[: len(own) - half] + following[:half]


RESULT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _compared(f: Fingerprinter, own: str, fp: bytes, following: str, next_fp: bytes) -> tuple:
    edited = _edited(own, following)
    fe = f(edited)
    return len(own), hashlib.sha256(edited.encode()).hexdigest(), fp.hex(), fe.hex(), likeness(fp, fe), likeness(fp, next_fp)


def edited_likeness(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """Fingerprints of each text and of an edited form of it, beside its neighbour's.

    The order is descending doc_id (nulls last, equal ids by a hash of the text); the next of the last is the first.
    The edited text keeps the first n - floor(n / 2) code points and takes as many as it lost (or all) from the start of
    the next text. Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Null
    text is empty; a single document is its own next; no documents give no rows. Texts move once, in a range
    partitioning; a task streams its sorted rows and holds two of them. The rows at the edges of the ranges
    (two a task) are written beside the results and matched in a second, small step.
    """
    kind = dict(docs.dtypes)["doc_id"]
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    src = src.repartitionByRange(*order).sortWithinPartitions(*order)
    result = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def batch_of(ids: list, rows: list[tuple], pid: int, edge: str | None, texts: list, id_type: pa.DataType) -> pa.RecordBatch:
        cols = [pa.array(ids, id_type), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))]
        n = len(ids)
        return pa.RecordBatch.from_arrays([*cols, pa.array([edge] * n, pa.string()), pa.array([pid] * n, pa.int64()), pa.array(texts, pa.string())], [*RESULT, "edge", "pid", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        f, held, pid = Fingerprinter(bits), None, TaskContext.get().partitionId()
        id_type = None
        for b in batches:
            id_type = b.column(0).type
            ids, rows = [], []
            for who, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                text = text.as_py()
                fp = f(text)
                if held is None:
                    yield batch_of([who], [(0, "", fp.hex(), "", 0.0, 0.0)], pid, "first", [text], id_type)
                else:
                    ids.append(held[0])
                    rows.append(_compared(f, held[1], held[2], text, fp))
                held = who, text, fp
            yield batch_of(ids, rows, pid, None, [None] * len(ids), id_type)
        if held is not None:
            yield batch_of([held[0]], [(0, "", held[2].hex(), "", 0.0, 0.0)], pid, "last", [held[1]], id_type)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Fingerprinter(bits)
        for b in batches:
            rows = [_compared(f, own, bytes.fromhex(fp), nxt, bytes.fromhex(nfp)) for own, fp, nxt, nfp in zip(*(b.column(i).to_pylist() for i in range(1, 5)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], RESULT)

    out = materialize(src.mapInArrow(run, result + ", edge string, pid long, text string"), "edited")
    edges = out.where("edge is not null")
    # two rows a task: the follower of each range is the next one that has rows, the first one after the last
    places = edges.where("edge = 'first'").select("pid")
    w = Window.orderBy("pid")
    places = places.withColumn("to", F.coalesce(F.lead("pid").over(w), F.min("pid").over(Window.partitionBy())))
    last = edges.where("edge = 'last'").select("doc_id", F.col("text").alias("own"), "fingerprint", "pid").join(places, "pid")
    first = edges.where("edge = 'first'").select(F.col("text").alias("nxt"), F.col("fingerprint").alias("nfp"), F.col("pid").alias("to"))
    closed = last.join(first, "to").select("doc_id", "own", "fingerprint", "nxt", "nfp").mapInArrow(close, result)
    return out.where("edge is null").select(*RESULT).union(closed)
