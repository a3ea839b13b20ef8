import time

from pyspark.sql import functions as F

from quarry.llm.registry import op4_toxicity
from quarry.llm.toxicity import Lexicon, beginnings, fold, keep_clean, learn_lexicon, score_toxicity, terms_of
from quarry.session import table


def test_folding():
    assert fold("1D10T, Ïdíot; іdіоt​ — ｉｄｉｏｔ") == " idiot idiot idiot idiot "
    assert fold("1oser foo|s 𝐥𝐨𝐬𝐞𝐫 ⓛⓞⓢⓔⓡ f00l! id!ot a!") == fold("loser foois loser loser fool idiot a")
    assert fold("") == fold(" .,") == "  "


def brute_weight(lx, text):
    words = fold(text).split()
    total = 0.0
    line = " ".join(words)
    for i, w in enumerate(words):
        start = len(" ".join(words[:i])) + (i > 0)
        spared = any(line.startswith(e, at) and at <= start < at + len(e) and (" " + line + " ")[at] == " " and (line + " ")[at + len(e)] == " " for e in (fold(x).strip() for x in lx.exceptions) for at in range(len(line)))
        if not spared:
            total += max((v for t, v in lx.weights.items() if (w + " ").startswith(fold(t).strip() + " " * t.endswith(" "))), default=0.0)
    return total


def test_matching_against_brute_force():
    lx = Lexicon({"idio": 2.0, "idiot ": 3.0, "trash": 2.5, "lose": 1.0, "loser": 1.5}, ("trash can", "can trash", "clown fish"))
    for t in ("Idiot idiots 1diotic!", "the trash can, trash", "trash-can trashcan", "losers lose", "", "xidiot", "clown fish trash can trash can"):
        assert abs(lx.weight(t)[0] - brute_weight(lx, t)) < 1e-9, t
    assert lx.weight("an 1d10t")[0] == 3.0 and lx.weight("trash can")[0] == 0.0


def test_many_exceptions_in_a_long_text_take_linear_time():
    lx = Lexicon({"trash": 2.0}, ("trash can",))
    began = time.perf_counter()
    assert lx.weight("trash can " * 100_000 + "trash")[0] == 2.0 and time.perf_counter() - began < 20


def test_long_words_have_terms_at_every_length():
    assert beginnings(6) == [3, 4, 5] and beginnings(2) == [] and beginnings(10**6)[-1] > 7 * 10**5
    assert terms_of("x" * 30)["x" * 30 + " "] == 1


def test_exceptions_are_learned(spark):
    rows = [(i, f"you total idiot number w{i}", 1) for i in range(40)] + [(100 + i, f"the village idiot box stood w{i}", 0) for i in range(6)] + [(200 + i, f"a fine day w{i}", 0) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lx = learn_lexicon(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert "viiiage idiot" in lx.exceptions and not any("totai" in e for e in lx.exceptions)
    assert lx.weight("the village idiot box")[0] == 0.0 < lx.weight("you total idiot")[0]


def test_longer_texts_dilute():
    lx = Lexicon({"idio": 2.0}, coef=(-4.0, 1.0, 2.0))
    short, long = "you idiot", "you idiot " + "fine words " * 400
    assert lx.score(*lx.weight(short)) > lx.score(*lx.weight(long)) > lx.score(*lx.weight("fine words"))


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    rows = op4_toxicity(spark, sf).where("held_out").join(table(spark, sf, "labels"), "doc_id").select("score", "predicted", "toxic").collect()
    pos, neg = [r.score for r in rows if r.toxic == 1], [r.score for r in rows if r.toxic == 0]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / len(pos) / len(neg)
    assert auc > 0.94
    assert sum(r.predicted for r in rows if r.toxic == 1) / len(pos) > 0.85
    assert sum(r.predicted for r in rows if r.toxic == 0) / len(neg) < 0.03


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "a"), (None, "", "b"), (2, "idiot " * 30_000, "c"), (2, "idiot " * 30_000, "c")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (2, 7)], "doc_id long, toxic int")
    lx = learn_lexicon(docs, labels)
    assert lx.weights == {}
    out = score_toxicity(docs.drop("score"), lx).collect()
    assert len(out) == 4 and all(0 <= r.score <= 1 for r in out)
    hard = Lexicon({"idio": 3.0}, coef=(-4.0, 2.0, 1.0))
    kept = keep_clean(docs, hard)
    assert kept.columns == docs.columns and sorted(r.score for r in kept.collect()) == ["a", "b"]
    assert score_toxicity(docs.select("doc_id", "text").limit(0), hard).count() == 0
    assert score_toxicity(docs.select(F.col("doc_id"), "text"), Lexicon({})).count() == 4


def test_the_sample_bound_is_kept(spark):
    rows = [(i, f"you idiot w{i}" if i % 4 == 0 else f"a fine day w{i}", int(i % 4 == 0)) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    few = learn_lexicon(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), sample_rows=300)
    assert few.weight("such an idiot")[0] > 0 == few.weight("a fine day")[0] and few.weights == learn_lexicon(docs.select("doc_id", "text").repartition(7), docs.select("doc_id", "toxic"), sample_rows=300).weights
