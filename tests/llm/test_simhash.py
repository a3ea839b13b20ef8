import hashlib
import math
import random
from collections import Counter

import numpy as np
import xxhash

from quarry.llm import simhash
from quarry.llm.simhash import Fingerprinter, edited_likeness, fingerprints, likeness, near_fingerprints


def slow_fingerprint(text, bits=256, pair_weight=2.0):
    """Bit by bit, from the definition."""
    M = 2**64 - 1

    def mix(x):
        x = ((x ^ (x >> 33)) * 0xFF51AFD7ED558CCD) & M
        x = ((x ^ (x >> 33)) * 0xC4CEB9FE1A85EC53) & M
        return x ^ (x >> 33)

    words = [xxhash.xxh3_64_intdigest(w) for w in text.encode().lower().split()]
    votes = [0.0] * bits
    for terms, weight in ((words, 1.0), ([mix((a * 3 + b) & M) for a, b in zip(words, words[1:])], pair_weight)):
        for t, tf in Counter(terms).items():
            for i in range(bits // 64):
                h = mix(t * (xxhash.xxh3_64_intdigest(f"bit{i}".encode()) | 1) & M)
                raw = h.to_bytes(8, "little")
                for b in range(64):
                    votes[i * 64 + b] += weight * (1 + math.log(tf)) * (1 if raw[b // 8] >> (7 - b % 8) & 1 else -1)
    return bytes(sum((votes[i * 8 + j] > 1e-6) << (7 - j) for j in range(8)) for i in range(bits // 8))


def test_votes_against_definition():
    rnd = random.Random(1)
    f = Fingerprinter()
    for n in (0, 1, 2, 40, 300):
        t = " ".join(rnd.choice(["A", "b", "cc", "é"]) + str(rnd.randrange(20)) for _ in range(n))
        assert f(t) == slow_fingerprint(t)
    assert f("") == bytes(32) and f(" X y") == f("x  Y")


def test_all_pairs_within_radius(spark):
    rnd = random.Random(2)
    base = [rnd.getrandbits(64) for _ in range(12)]
    fps = []
    for b in base:
        for _ in range(15):
            x = b
            for i in rnd.sample(range(64), rnd.randrange(0, 7)):
                x ^= 1 << i
            fps.append(f"{x:016x}")
    rows = [(i, x) for i, x in enumerate(fps)] + [(900, fps[0]), (901, None)]
    pairs, members = near_fingerprints(spark.createDataFrame(rows, "doc_id long, fingerprint string"), 3, 64)
    got = {(r.a, r.b): r.distance for r in pairs.collect()}
    u = sorted(set(fps))
    want = {(a, b): d for i, a in enumerate(u) for b in u[i + 1 :] if (d := (int(a, 16) ^ int(b, 16)).bit_count()) <= 3}
    assert got == want and len(want) > 10 and members.count() == len(rows)


def test_crowded_buckets_and_classes(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PART", 7)
    keys = [f"{x:016x}" for x in range(120)]
    pairs, members = near_fingerprints(spark.createDataFrame([(i, x) for i, x in enumerate(keys + keys[:3])] + [(500, "f" * 16)], "doc_id long, fingerprint string"), 2, 64)
    want = {(a, b): d for i, a in enumerate(keys) for b in keys[i + 1 :] if (d := (int(a, 16) ^ int(b, 16)).bit_count()) <= 2}
    assert {(r.a, r.b): r.distance for r in pairs.collect()} == want
    got = {r.doc_id: r for r in simhash.linked_classes(pairs, members).collect()}
    assert len(got) == 124 and got[500].links == 0 and got[500]["class"] == "f" * 16
    assert all(got[i]["class"] == keys[0] and got[i].links == sum(keys[i] in p for p in want) for i in range(120)) and got[121].links == got[1].links


def brute(rows):
    f = Fingerprinter()
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for k, (i, t) in enumerate(rows):
        t, n = t or "", rows[(k + 1) % len(rows)][1] or ""
        h = len(t) // 2
        e = t[: len(t) - h] + n[:h]
        out[i] = (len(t), hashlib.sha256(e.encode()).hexdigest(), f(t).hex(), f(e).hex(), likeness(f(t), f(e)), likeness(f(t), f(n)))
    return out


def test_edited_likeness(spark):
    rnd = random.Random(3)
    word = lambda: rnd.choice(["é", "the", "🙂", "of"]) + str(rnd.randrange(99))
    rows = [(i * 3, " ".join(word() for _ in range(rnd.randrange(0, 80)))) for i in range(90)] + [(5, None), (None, "last one here"), (-4, "x" * 50_000)]
    df = spark.createDataFrame([(t, i, 0) for i, t in rows], "text string, doc_id long, edge int")
    got = {r.doc_id: tuple(r)[1:] for r in edited_likeness(df).collect()}
    assert got == brute(rows)
    one = edited_likeness(spark.createDataFrame([(1, "only text")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert edited_likeness(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    same = edited_likeness(spark.createDataFrame([(7, "a b c")] * 20 + [(None, None)] * 5, "doc_id long, text string"))
    assert same.count() == 25


def test_equal_texts_equal_fingerprints(spark):
    got = fingerprints(spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, None)], "doc_id long, text string")).collect()
    assert got[0].fingerprint == got[1].fingerprint and got[2].fingerprint == "0" * 64


def test_bits_that_all_share_make_no_common_bucket(spark):
    keys = spark.range(20_000).selectExpr("id as doc_id", "lpad(lower(hex(id)), 16, '0') as fingerprint")
    ones = np.array([sum(i >> (63 - b) & 1 for i in range(20_000)) for b in range(64)])
    masks = simhash.even_blocks(ones, 20_000, 4)
    assert np.bitwise_or.reduce(masks) == 2**64 - 1 and all(not int(a[0]) & int(b[0]) for i, a in enumerate(masks) for b in masks[i + 1 :])
    fp = np.frombuffer(b"".join(i.to_bytes(8, "big") for i in range(20_000)), np.uint64)
    crowd = [np.unique(fp & (a[0] | b[0]), return_counts=True)[1].max() for i, a in enumerate(masks) for b in masks[i + 1 :]]
    assert max(crowd) <= 512, "a bucket of whole blocks held all keys"
    pairs = near_fingerprints(keys, 2, 64)[0]
    want = sum((i ^ x < i) for i in range(20_000) for x in [1 << a | 1 << b for a in range(15) for b in range(a, 15)])
    assert pairs.count() == want == pairs.select("a", "b").distinct().count()
