import random
import re
from collections import Counter

import numpy as np
import pytest

from quarry.llm import collocations as C


def brute(rows, least, top):
    """All phrases of 1 to 4 words, one occurrence at a time."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            f.update((lang or "und", tuple(w[i : i + k])) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    out = {}
    for (lang, g), a in f.items():
        if len(g) == 1 or a < least:
            continue
        score, k = min((2000000 * a // (f[lang, g[:k]] + f[lang, g[k:]]), k) for k in range(1, len(g)))
        longer = [x for (q, h), x in f.items() if q == lang and len(h) > len(g) and x >= least and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))]
        if not any(100 * x >= 80 * a for x in longer):
            out.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, v in out.items() for i, (s, a, p, l, r) in enumerate(sorted(v)[:top]))


def corpus(seed, docs=120):
    rnd = random.Random(seed)
    vocabulary = ["the", "The", "of", "a\x01", "a", "ça", "été", "x\x0by", "new", "york", "city", "\x00", "日本", "a|b"]
    fixed = ["new york city hall", "the the the the the", "a a\x01 a", "of the new york"]
    text = lambda: "".join(rnd.choice([*vocabulary, *fixed]) + rnd.choice([" ", "  ", "\t", " ", " ", ". ", ",", "\n", "?!"]) for _ in range(rnd.randrange(0, 120)))
    return [(rnd.choice(["en", "en", "fr", None]), text()) for _ in range(docs)] + [("en", None), ("en", ""), (None, "."), ("zz", "once only"), ("fr", " \t ")]


@pytest.mark.parametrize("shard", [3_000_000, 200])
def test_equals_brute_force(spark, monkeypatch, shard):
    """Also with many small shards, slices and batches: counts are summed over all of them."""
    if shard < 1000:
        for name, value in (("SHARD_TOKENS", shard), ("SLICE", 64), ("BATCH", 20), ("SUM_TOKENS", 500)):
            monkeypatch.setattr(C, name, value)
    rows = corpus(4)
    df = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], "lang string, text string, n int, shard string").repartition(3)
    for least, top in ((5, 2000), (30, 40)):
        assert sorted(map(tuple, C.collocations(df, least, top).collect())) == brute(rows, least, top)


def test_bitmaps_shift_and_popcount():
    rng = np.random.default_rng(0)
    for size in (0, 1, 7, 8, 9, 64, 500):
        seq = rng.integers(-1, 5, size)
        key, place, bits = C.word_pairs(seq, 5)
        keys, counts, _ = C.counted(key, bits)
        want = Counter(int(a * 5 + b) for a, b in zip(seq, seq[1:]) if a >= 0 and b >= 0)
        assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == want
        positions = Counter((k, 8 * p + b) for k, p, x in zip(key.tolist(), place.tolist(), bits.tolist(), strict=True) for b in range(8) if x >> b & 1)
        assert set(positions.values()) <= {1} and (bits > 0).all()


def test_packed_arrays():
    for kind in (np.int32, np.int64):
        for a in (np.zeros(0, kind), np.arange(-5, 1000, dtype=kind) * 1_000_003):
            assert (C.unpack(C.pack(a), len(a), kind) == a).all()


def test_empty_long_and_repeated(spark):
    kind = "lang string, text string"
    assert C.collocations(spark.createDataFrame([], kind)).count() == 0
    assert C.collocations(spark.createDataFrame([(None, None), ("en", "one two")], kind)).count() == 0
    long = "ab cd " * 400_000
    out = [tuple(r) for r in C.collocations(spark.createDataFrame([("en", long), ("en", "ab cd")], kind)).collect()]
    assert sorted(out) == brute([("en", long), ("en", "ab cd")], 30, 2000)
    same = [("en", "ab cd. ef")] * 40
    assert sorted(map(tuple, C.collocations(spark.createDataFrame(same, kind)).collect())) == [("en", 1, "ab cd", 40, 40, 40, 120, 1_000_000)]
