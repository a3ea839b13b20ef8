import random
import re

from quarry.llm.decontam import decontaminate, find_contamination


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def brute(docs, items):
    out = {}
    for j, it in items:
        w = words(it)
        k = min(5, len(w))
        if not k:
            continue
        s = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
        for i, d in docs:
            v = words(d)
            shared = len(s & {tuple(v[x : x + k]) for x in range(len(v) - k + 1)})
            if shared * 100 >= 80 * len(s) and shared / len(s) > out.get((i, j), (0, 0, 0))[2]:
                out[i, j] = (len(s), shared, shared / len(s))
    return out


def fixture():
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(80)] + ["é", "Straße"]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, text(rnd.randrange(1, 60))) for i in range(30)] + [(90, None), (91, ""), (92, "!!"), (3, text(20)), (93, "short one"), (94, text(30)), (94, text(30))]
    docs = []
    for i in range(120):
        t = text(rnd.randrange(0, 200))
        if i % 3 == 0:
            w = words(rnd.choice(items)[1])
            if i % 2 and len(w) > 12:
                w[rnd.randrange(len(w))] = "changed"
            t = t + ", " + "  ".join(w).upper() + " . " + text(50)
        docs.append((i if i % 40 else None, t))
    return docs + [(500, None), (501, ""), (502, text(30_000) + " " + items[8][1]), docs[3]], items


def test_equals_brute_force(spark):
    docs, items = fixture()
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, item_id string, hits int")
    b = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, hash string")
    got = {(r.doc_id, r.item_id): (r.n_shingles, r.shared, r.containment) for r in find_contamination(d, b).collect()}
    want = brute(docs, items)
    assert {k: v[2] for k, v in got.items()} == {k: v[2] for k, v in want.items()} and len(want) > 20
    clean = decontaminate(d, b)
    bad = {k[0] for k in want}
    assert clean.columns == d.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(r[0]) for r in docs if r[0] not in bad)


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    item = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert find_contamination(none, item).count() == 0
    some = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert find_contamination(some, item.where("item_id > 5")).count() == 0
    assert decontaminate(some, item.where("item_id > 5")).count() == 1 and decontaminate(some, item).count() == 0
