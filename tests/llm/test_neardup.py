import random
import re

import numpy as np

from quarry.llm.neardup import Shingler, depth_for, keep_one_of_each, least_equal, near_duplicates, region_depths
from quarry.session import table


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, percent):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    inv = {}
    for i in ids:
        for s in sets[i]:
            inv.setdefault(s, []).append(i)
    pairs = {(a, b) for v in inv.values() for k, b in enumerate(v) for a in v[:k]}
    for a, b in pairs:
        n = len(sets[a] & sets[b])
        if 100 * n >= percent * len(sets[a] | sets[b]):
            p, q = sorted((find(a), find(b)))
            parent[q] = p
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def cloud(rnd, n, words, edits):
    base = [f"w{rnd.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randrange(0, edits + 1)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_shingler_counts_sets():
    s = Shingler()
    for t in ("a b c d e f g a b c d e", "A B c", "", " \n", "x", "É é É é É É é É é É"):
        assert len(s(t.encode())) == len(shingles(t))
    assert np.array_equal(s(b"A b  c\td e"), s(b"a B c d\ne"))


def test_depth():
    assert depth_for(85) == 8 and depth_for(80) == 6


def test_depth_adapts_to_the_region():
    # five rows share 6 words (crowded at 3), of which three share 7 and two of those all 8; then a pair that shares 6
    assert region_depths(np.array([0, 6, 6, 7, 8, 0, 6, 2]), 8, 3).tolist() == [0, 0, 7, 7, 7, 6, 6, 0]
    assert region_depths(np.array([0, 8, 8, 8, 8]), 8, 3).tolist() == [8] * 5
    assert 185 < least_equal(85) < 192


def test_boilerplate_loses_no_link(spark):
    """1,000 texts over one boilerplate that makes every pair alike by more than half; half of the texts have a true link."""
    rnd = random.Random(11)
    boiler = [f"b{k}" for k in range(70)]
    rows = []
    for k in range(500):
        own = [f"x{rnd.randrange(10**7)}" for _ in range(30)]
        cut = list(own)
        cut[rnd.randrange(30)] = "changed"
        rows += [(2 * k, " ".join(boiler + own)), (2 * k + 1, " ".join(boiler + (cut if k % 2 else rnd.sample(own, 30))))]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85).collect()}
    assert got == brute(rows, 85)


def test_equals_brute_force(spark):
    rnd = random.Random(8)
    texts = cloud(rnd, 300, 120, 8) + cloud(rnd, 40, 60, 3) + cloud(rnd, 200, 400, 5)
    texts += [" ".join(f"u{rnd.randrange(9000)}" for _ in range(rnd.randrange(0, 90))) for _ in range(200)]
    texts += [None, "", " \t ", "one two", "One  TWO", "one two three"] + [texts[5]] * 50 + ["long " + " ".join(f"l{i}" for i in range(40_000))] * 2
    order = list(range(len(texts)))
    rnd.shuffle(order)
    rows = [(i * 7 - 100, texts[k]) for i, k in enumerate(order)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, component string")
    for percent in (85, 80):
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, percent).collect()}
        assert got == brute(rows, percent)


def test_test_table(spark, sf):
    d = table(spark, sf, "documents")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(d, 85).collect()}
    assert got == brute([(r.doc_id, r.text) for r in d.collect()], 85)


def test_repeated_ids_nulls_and_empty(spark):
    a, b = "a b c d e f g h", "p q r s t u v w"
    rows = [(1, a), (1, a), (2, b), (1, b), (None, a), (None, None), (3, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.component_id, r.kept) for r in near_duplicates(df).collect())
    assert got == sorted([("1", 1, True)] * 3 + [("2", 1, False), ("None", None, True), ("None", None, True), ("3", 3, True)])
    kept = keep_one_of_each(df)
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "None", "None"]
    assert near_duplicates(df.limit(0)).count() == 0 and keep_one_of_each(df.limit(0)).count() == 0
