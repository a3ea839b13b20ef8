"""Phrases whose words keep together, mined over compressed position bitmaps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import materialize, release

LEAST = 30
TOP = 2_000
#: Tokens a task holds before it passes a shard on, bytes of text cut at once, and tokens whose phrases one task sums.
SHARD_TOKENS, SLICE, SUM_TOKENS = 1_500_000, 1 << 20, 1_000_000
#: Bitmap bytes that are extended at once (a batch of prefixes goes to full depth before the next).
BATCH = 250_000

_LOWER_AND_CUT = bytes(0x2E if c in b".,;:!?\x0a\x0b\x0c\x0d" else c + 32 if 65 <= c <= 90 else c for c in range(256))


def pieces_of(text: bytes) -> Iterator[list[bytes]]:
    """Words in order, lower-cased, with b"." at each end of a piece; long texts in slices that end where a piece ends."""
    text, at = text.translate(_LOWER_AND_CUT), 0
    while at < len(text):
        end = text.find(b".", at + SLICE)
        end = len(text) if end < 0 else end + 1
        yield text[at:end].replace(b".", b" . ").split()
        at = end


def pack(a: np.ndarray) -> bytes:
    """An integer array, its bytes regrouped by significance and compressed."""
    wide = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize)
    return pa.compress(np.ascontiguousarray(wide.T).tobytes(), codec="zstd", asbytes=True)


def unpack(b: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(pa.decompress(b, n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, n).T).view(kind).ravel()


class _Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return len(self) - 1


def shards_of(docs: DataFrame) -> DataFrame:
    """(shard, lang, n, length, seq, words, counts): runs of pieces of one language, at most about SHARD_TOKENS words each.

    ``seq`` has the shard's own word numbers in order, 0 where a piece ends. A shard never cuts a piece, so no phrase is lost.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, made = TaskContext.get().partitionId(), {}, 0

        def flush(lang: str) -> pa.RecordBatch:
            nonlocal made
            vocabulary, seqs, _ = held.pop(lang)
            seq = np.concatenate(seqs)
            counts = np.bincount(seq, minlength=len(vocabulary))
            made += 1
            words = list(vocabulary)[1:]
            return pa.record_batch(
                {"shard": pa.array([(part << 32) + made], pa.int64()), "lang": [lang], "n": pa.array([int(counts[1:].sum())], pa.int64()), "length": pa.array([len(seq)], pa.int64()), "seq": pa.array([pack(seq)], pa.binary()),
                 "words": pa.array([[w.decode() for w in words]], pa.list_(pa.string())), "counts": pa.array([counts[1:]], pa.list_(pa.int64()))})

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                for words in pieces_of(text) if text else ():
                    if lang not in held:
                        held[lang] = [_Vocabulary({b".": 0}), [], 0]
                    h = held[lang]
                    seq = np.fromiter(map(h[0].__getitem__, words), np.int32, len(words))
                    h[1] += [seq, np.zeros(1, np.int32)]
                    h[2] += len(seq) + 1
                    if sum(x[2] for x in held.values()) >= SHARD_TOKENS:
                        yield flush(max(held, key=lambda k: held[k][2]))
        for lang in list(held):
            yield flush(lang)

    kind = "shard long, lang string, n long, length long, seq binary, words array<string>, counts array<long>"
    lang, text = F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text")
    return docs.select(lang, text).mapInArrow(run, kind)


# ---- bitmaps: a set of positions is its non-zero bytes and their places; (item, place, bits) of all items, by place


def bitmaps(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position bitmaps of all items of ``seq``; negative entries are in none."""
    at = np.flatnonzero(seq >= 0)
    item, place, bit = seq[at].astype(np.int64), at >> 3, np.left_shift(1, at & 7).astype(np.uint8)
    order = np.argsort(place << 31 | item, kind="stable")
    item, place, bit = item[order], place[order], bit[order]
    new = np.flatnonzero(np.r_[True, (item[1:] != item[:-1]) | (place[1:] != place[:-1])]) if len(item) else np.zeros(0, int)
    return item[new], place[new], np.bitwise_or.reduceat(bit, new) if len(new) else bit


def extend(left: tuple, right: tuple, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Left bitmaps shifted by one position, ANDed with all right bitmaps: (left item, right item, place, bits), non-zero ones.

    ``starts``: where each place begins in ``right``.
    """
    item, place, bits = left
    over = bits >= 128
    item, place, bits = np.r_[item, item[over]], np.r_[place, place[over] + 1], np.r_[np.left_shift(bits, 1), np.ones(over.sum(), np.uint8)]
    some = bits > 0
    item, place, bits = item[some], place[some], bits[some]
    many = starts[place + 1] - starts[place]
    li = np.repeat(np.arange(len(item)), many)
    ri = np.arange(many.sum()) + np.repeat(starts[place] - (np.cumsum(many) - many), many)
    both = bits[li] & right[2][ri]
    hit = np.flatnonzero(both)
    li, ri = li[hit], ri[hit]
    return item[li], right[0][ri], place[li], both[hit]


def starts_of(places: np.ndarray, length: int) -> np.ndarray:
    return np.searchsorted(places, np.arange((length >> 3) + 4))


def counted(key: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, their popcounts, index of each row's key)."""
    keys, index = np.unique(key, return_inverse=True)
    return keys, np.bincount(index, weights=np.bitwise_count(bits), minlength=len(keys)).astype(np.int64), index


def word_pairs(seq: np.ndarray, v: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word * v + second word, place, bits) of all pairs of neighbours: bits mark the second word's position."""
    words = bitmaps(seq)
    starts, out = starts_of(words[1], len(seq)), []
    for i in range(0, len(words[0]), BATCH):
        a, b, place, bits = extend(tuple(x[i : i + BATCH] for x in words), words, starts)
        out.append((a * v + b, place, bits))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8))


def spread(*keys: np.ndarray, ranges: int) -> np.ndarray:
    """A range for each phrase, by a multiplicative hash."""
    h = np.zeros(len(keys[0]), np.uint64)
    for k in keys:
        h = (h ^ k.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return ((h >> np.uint64(20)) % np.uint64(ranges)).astype(np.int64)


_ASKED = "shard long, lang string, range long, size int, n long, hi binary, lo binary, counts binary"


def asked(shard: int, lang: str, size: int, hi: np.ndarray, lo: np.ndarray | None, counts: np.ndarray, ranges: int) -> list[tuple]:
    """A shard's phrases of ``size`` words with their counts, by range; in each, by (hi, lo)."""
    at = spread(*([hi] if lo is None else [hi, lo]), ranges=ranges)
    order = np.lexsort((hi, at) if lo is None else (lo, hi, at))
    edges, out = np.searchsorted(at[order], np.arange(ranges + 1)), []
    for r in np.flatnonzero(np.diff(edges)):
        o = order[edges[r] : edges[r + 1]]
        out.append((shard, lang, int(r), size, len(o), pack(np.diff(hi[o], prepend=0)), None if lo is None else pack(lo[o]), pack(counts[o])))
    return out


def _table(rows: list[tuple], kind: pa.Schema) -> pa.Table:
    return pa.table([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), kind, strict=True)] if rows else [pa.array([], f.type) for f in kind], schema=kind)


ASKED = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("range", pa.int64()), ("size", pa.int32()), ("n", pa.int64()), ("hi", pa.binary()), ("lo", pa.binary()), ("counts", pa.binary())])
SUMMED = pa.schema([("shard", pa.int64()), ("range", pa.int64()), ("kept", pa.binary()), ("lang", pa.string()), ("ids", pa.list_(pa.int64())), ("a", pa.int64())])


def sum_range(table: pa.Table, v: int, least: int) -> pa.Table:
    """Popcounts of one range summed over shards: frequent phrases, and for each shard which of its pairs are frequent."""
    rows, out = table.to_pylist(), []
    for size in sorted({r["size"] for r in rows}):
        own = [r for r in rows if r["size"] == size]
        ends = np.cumsum([r["n"] for r in own])
        hi = np.concatenate([np.cumsum(unpack(r["hi"], r["n"], np.int64)) for r in own])
        lo = np.concatenate([unpack(r["lo"], r["n"], np.int64) for r in own]) if size > 2 else np.zeros(len(hi), np.int64)
        counts = np.concatenate([unpack(r["counts"], r["n"], np.int64) for r in own])
        order = np.lexsort((lo, hi))
        h, l = hi[order], lo[order]
        new = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (l[1:] != l[:-1])])
        total = np.add.reduceat(counts[order], new)
        first = order[new]
        lang = np.array([r["lang"] for r in own], object)[np.searchsorted(ends, first, side="right")]  # a word belongs to one language
        for i in np.flatnonzero(total >= least):
            a, b = divmod(int(h[new[i]]), v)
            out.append((None, None, None, lang[i], [a, b] + ([] if size == 2 else [int(l[new[i]])] if size == 3 else list(divmod(int(l[new[i]]), v))), int(total[i])))
        if size == 2:
            kept = np.empty(len(hi), bool)
            kept[order] = np.repeat(total >= least, np.diff(np.r_[new, len(hi)]))
            out += [(r["shard"], r["range"], np.packbits(k).tobytes(), None, None, None) for r, k in zip(own, np.split(kept, ends[:-1]), strict=True)]
    return _table(out, SUMMED)


def longer_phrases(seq: np.ndarray, v: int, ranges: int, kept: dict[int, bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(size, first pair, rest, counts) of the shard's phrases of 3 and 4 words all of whose pairs are frequent.

    Prefixes go to full depth in batches: the bitmap of a phrase, shifted, AND the bitmaps of the pairs that its last word begins.
    """
    key, place, bits = word_pairs(seq, v)
    pairs, _, index = counted(key, bits)
    at = spread(pairs, ranges=ranges)
    order = np.lexsort((pairs, at))  # as asked() had them
    edges, frequent = np.searchsorted(at[order], np.arange(ranges + 1)), np.zeros(len(pairs), bool)
    for r, b in kept.items():
        n = edges[r + 1] - edges[r]
        frequent[order[edges[r] : edges[r + 1]]] = np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool)
    some = np.flatnonzero(frequent[index])
    item, place, bits = index[some], place[some], bits[some]
    order = np.lexsort((place, item))
    by_item = item[order], place[order], bits[order]
    order = np.argsort(place, kind="stable")
    right = item[order], place[order], bits[order]
    starts, many = starts_of(right[1], len(seq)), len(pairs)
    i = 0
    while i < len(item):
        j = min(i + BATCH, len(item))
        j = int(np.searchsorted(by_item[0], by_item[0][j - 1], side="right"))  # all of a prefix's bitmap
        a, b, at3, bits3 = extend(tuple(x[i:j] for x in by_item), right, starts)
        three, n3, in3 = counted(a * many + b, bits3)
        first, second = three // many, three % many
        yield 3, pairs[first], pairs[second] % v, n3
        a, b, _, bits4 = extend((in3, at3, bits3), right, starts)
        four, n4, _ = counted(a * many + b, bits4)
        yield 4, pairs[first[four // many]], pairs[four % many], n4
        i = j


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words: id, lang, word, a), (phrases: lang, ids, a, of 2 to 4 words) and (totals: lang, n), with all counts of ``least`` or more.

    Shards of the corpus (of one language each) are written once. Three steps, each summed over shards before the next prunes
    by it: words; pairs of frequent words; longer phrases of frequent pairs. A shard asks about its own phrases only and is
    answered with a bit for each, so nothing is broadcast, and what a task holds is a shard or a range of phrases, both of
    bounded size however large the input.
    """
    shards = materialize(shards_of(docs), "shards")
    totals = materialize(shards.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    ranges = max(1, -(-(shards.agg(F.sum("n")).first()[0] or 0) // SUM_TOKENS))
    own = shards.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("p", "x")).select("shard", "lang", (F.col("p") + 1).alias("i"), F.col("x.words").alias("word"), F.col("x.counts").alias("c"))
    row = F.monotonically_increasing_id()
    sums = own.groupBy("lang", "word").agg(F.sum("c").alias("a")).where(F.col("a") >= least)
    sums = materialize(sums.withColumn("at", F.spark_partition_id()).withColumn("row", row), "words")
    parts = (sums.agg(F.max("at")).first()[0] or 0) + 1
    words = sums.select((F.col("row").bitwiseAND((1 << 33) - 1) * parts + F.col("at")).alias("id"), "lang", "word", "a")
    v = (words.agg(F.max("id")).first()[0] or 0) + 1
    if v >= 1 << 31:
        raise ValueError("more than 2^31 frequent words")
    told = own.join(words.select("lang", "word", "id"), ["lang", "word"]).select(F.col("shard").alias("of"), "i", "id")

    def pairs(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for r in left.to_pylist():
            seq = unpack(r["seq"], r["length"], np.int32)
            own = np.full(int(seq.max(initial=0)) + 1, -1, np.int64)
            own[right.column("i").to_numpy()] = right.column("id").to_numpy()
            seq = own[seq].astype(np.int32)
            key, _, bits = word_pairs(seq, v)
            keys, counts, _ = counted(key, bits)
            out += [(r["shard"], r["lang"], -1, 1, len(seq), pack(seq), None, None), *asked(r["shard"], r["lang"], 2, keys, None, counts, ranges)]
        return _table(out, ASKED)

    step = shards.select("shard", "lang", "length", "seq").groupBy("shard").cogroup(told.groupBy("of")).applyInArrow(pairs, _ASKED)
    step = materialize(step, "pairs")
    release(shards)
    summed = "shard long, range long, kept binary, lang string, ids array<long>, a long"
    answers = materialize(step.where("size = 2").groupBy("range").applyInArrow(lambda t: sum_range(t, v, least), summed), "answers")

    def longer(left: pa.Table, right: pa.Table) -> pa.Table:
        kept, out = dict(zip(right.column("range").to_pylist(), right.column("kept").to_pylist(), strict=True)), []
        for r in left.to_pylist():
            for size, hi, lo, counts in longer_phrases(unpack(r["hi"], r["n"], np.int32), v, ranges, kept):
                out += asked(r["shard"], r["lang"], size, hi, lo, counts, ranges)
        return _table(out, ASKED)

    seqs = step.where("size = 1").select("shard", "lang", "n", "hi")
    grown = seqs.groupBy("shard").cogroup(answers.where("kept is not null").select("shard", "range", "kept").groupBy("shard")).applyInArrow(longer, _ASKED)
    more = materialize(grown.groupBy("range").applyInArrow(lambda t: sum_range(t, v, least), summed), "longer")
    phrases = answers.where("ids is not null").select("lang", "ids", "a").unionByName(more.select("lang", "ids", "a"))
    return words, phrases, totals


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to 4 words that occur ``least`` times or more.

    ``docs`` (lang, text). A phrase's score is that of its weakest cut, floor(2000000 a / (l + r)) with the counts of both
    parts (ties: the earliest cut); phrases that lie in a longer one with 80 % of their count or more are left out. Null
    languages are ``und``, null and empty texts have no words, repeated rows count as often as they occur, other columns are
    not read; a table without phrases gives an empty result. Order: score and count descending, phrase by UTF-8 bytes.
    """
    words, phrases, totals = frequent_phrases(docs, least)
    known = words.select(F.array("id").alias("ids"), "a").unionByName(phrases.select("ids", "a"))
    size = F.size("ids")
    cuts = phrases.select("lang", "ids", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("ids", 1, F.col("k")).alias("head"), F.slice("ids", F.col("k") + 1, size - F.col("k")).alias("tail"))
    heads, tails = known.select(F.col("ids").alias("head"), F.col("a").alias("l")), known.select(F.col("ids").alias("tail"), F.col("a").alias("r"))
    score = F.expr("(2000000BD * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))").cast("long")
    scored = cuts.join(heads, "head").join(tails, "tail").groupBy("lang", "ids", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("x"))
    inner = F.expr("flatten(transform(sequence(2, size(ids) - 1), m -> transform(sequence(1, size(ids) - m + 1), i -> slice(ids, i, m))))")
    within = phrases.where(size > 2).select(F.explode(inner).alias("ids"), F.col("a").alias("longer")).groupBy("ids").agg(F.max("longer").alias("longer"))
    enough = F.coalesce(F.col("longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * 80, F.lit(False))
    left = scored.join(within, "ids", "left").where(~enough).select("lang", "ids", "a", "x.score", "x.l", "x.r")
    # the best of parts of a language first: only those need their words
    best = [F.desc("score"), F.desc("a")]
    part = F.pmod(F.xxhash64("ids"), F.lit(64))
    near = left.withColumn("part", part).withColumn("at", F.rank().over(Window.partitionBy("lang", "part").orderBy(*best))).where(F.col("at") <= top).drop("part", "at")
    near = materialize(near, "near")
    names = near.select("ids", F.posexplode("ids").alias("p", "id")).join(words.select("id", "word"), "id").groupBy("ids").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    named = near.join(names, "ids").join(F.broadcast(totals) if totals.count() <= 100_000 else totals, "lang")
    order = [*best, "phrase"]
    first = named.withColumn("at", F.row_number().over(Window.partitionBy("lang", F.pmod(F.xxhash64("ids"), F.lit(64))).orderBy(*order))).where(F.col("at") <= top)
    out = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
