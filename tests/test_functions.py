import datetime

from pyspark.sql import functions as F

from quarry.functions import chunking as K
from quarry.functions import parse as P
from quarry.functions.html import html_to_markdown

BODY = "intro words here\n\n# First\n\nPara one. " + "word " * 40 + "\n\n## Second ##\n\nმუხლი 5. title\n1. clause one\nმუხლი 6\nlast\n\nthe end"


def test_sections_and_offsets():
    rows = K.chunks(BODY, budget=20, overlap=4, least=3)
    assert all(BODY[r[3] : r[4]] == r[6] and r[5] <= 20 for r in rows)
    assert [r[0] for r in rows] == list(range(len(rows)))
    paths = [r[1] for r in rows]
    assert paths[0] == [] and ["First"] in paths and ["First", "Second", "მუხლი 5. title"] in paths
    assert {r[2] for r in rows} == {None, "5", "6"}


def test_every_word_is_covered_and_overlaps_fit():
    text = ". ".join(f"s{i} " + " ".join(f"w{i}x{j}" for j in range(9)) for i in range(60))
    for budget, overlap, least in ((25, 5, 3), (512, 80, 64), (7, 3, 1), (1, 0, 1)):
        rows = K.chunks(text, budget, overlap, least)
        at = 0
        for r in rows:
            assert not text[at : r[3]].strip() and r[5] <= budget
            if r[0]:
                assert len(text[r[3] : at].split()) <= overlap
            at = max(at, r[4])
        assert not text[at:].strip()
    assert K.chunks(None) == [] and K.chunks(" \n ") == [] and len(K.chunks("x" * 2000)) == 1


def test_small_tail_is_folded_and_pluggable_cost():
    rows = K.chunks("a b c d\n\ne", budget=5, overlap=0, least=2)
    assert [r[6] for r in rows] == ["a b c d\n\ne"]
    assert all(r[5] <= 6 for r in K.chunks("aa bbb cccc dd", budget=6, overlap=0, least=0, cost=len))


def test_reassembly(spark):
    texts = {1: " ".join(f"w{i}" for i in range(1500)), 2: "short", 3: BODY}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = K.reassemble(K.chunk_documents(df)).orderBy("doc_id", "piece_index").collect()
    whole = {}
    for r in rows:
        whole[r.doc_id] = whole.get(r.doc_id, "") + r.piece
    assert whole[1].split() == texts[1].split() and whole[2] == "short"


def test_dates(spark):
    given = ["2020-04-27", "2024-06-03 08:00:07", "08/04/2026", "31-02-2020", "26 მარტის 2026", "2024-02-30", "none", "", None]
    got = [r.d for r in spark.createDataFrame([(x,) for x in given], "t string").select(P.parse_date(F.col("t")).alias("d")).collect()]
    D = datetime.date
    assert got == [D(2020, 4, 27), D(2024, 6, 3), D(2026, 4, 8), None, D(2026, 3, 26), None, None, None, None]
    r = spark.createDataFrame([("/Date(1588260918000)/", "01.02.2024", "[]", '"{\\"a\\":1}"')], "a string, b string, c string, j string").select(P.dotnet_date(F.col("a")), P.parse_day_first(F.col("b")), P.dotnet_date(F.col("c")), P.double_json(F.col("j"), "struct<a:int>")["a"]).first()
    assert tuple(r) == (D(2020, 4, 30), D(2024, 2, 1), None, 1)


def test_citations(spark):
    given = {
        "240140000.05.001.102038": ("registration_code", "240140000.05.001.102038"),
        "x 330100116001532776": ("document_number", "330100116001532776"),
        "011746498351723": ("registration_code", "011746498351723"),
        "AR111390": ("document_number", "AR111390"),
        "ბრძანება №71": ("document_number", "71"),
        "№71": None,
        "საქმე 1გ/620-17": ("case_number", "1გ/620-17"),
        "კანონი №17-ე მუხლი": None,
        "the ruling AB-12/2019": ("case_number", "AB-12/2019"),
        "plain question": None,
    }
    df = spark.createDataFrame([(k,) for k in given], "q string")
    got = {r.q: (tuple(r.c) if r.c else None) for r in df.select("q", P.citation(F.col("q")).alias("c")).collect()}
    assert got == given


def test_html():
    h = "<html><head><title>t</title></head><body><nav>no</nav><h1>A &amp; B</h1><p>x<sup>2</sup> <b>bold</b><br>y</p><ul><li>one<li>two</ul><a href='/p?q'>in</a><a href='#t'>jump</a><table><tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c|d</td></tr></table><table><tr><td>only</td></tr></table><script>bad()</script>"
    m = html_to_markdown(h, "http://h.org/z/")
    assert m.startswith("no\n\n# A & B") and "x² **bold**\ny" in m and "- one\n- two" in m and "[in](http://h.org/p?q)jump" in m
    assert "| a | b |\n| --- | --- |\n| a | c\\|d |" in m and "only" in m and "bad" not in m
    assert html_to_markdown(None) == "" and html_to_markdown("<p>") == ""
    assert html_to_markdown("<html><head><title>t</title><meta charset=x><body><p>seen") == "seen"  # the head is not closed
    assert html_to_markdown("<form><p>gone<div>gone</form><p>kept") == "kept" and html_to_markdown("<head><style>x</style></head>a<script>b</script>c") == "ac"
    page = '<table id="DOCUMENT:1;HEADER:1;_Content"><tr><td><b>Law</b> on x</td></tr></table><table id="DOCUMENT:1;CHAPTER:1;_Title"><tr><td>One</td></tr></table>'
    page += '<table id="DOCUMENT:1;CHAPTER:1;ARTICLE:2;_Content"><tr><td><p>body</p><table><tr><td>1</td><td>2</td></tr></table></td></tr></table>'
    assert html_to_markdown(page) == "# Law on x\n\n## One\n\nbody\n\n| 1 | 2 |\n| --- | --- |"


def test_sections_by_their_ids_and_what_is_dropped():
    from quarry.functions.html import parsed, section_of

    known = {
        "DOCUMENT:1;ENCLOSURE:1;CHAPTER:1;_Title": ("heading", 3), "HEADER:1;_Content": ("heading", 1), "DOCUMENT:1;HEADER:1;_Title": ("block", 0), "DOCUMENT:1;ENCLOSURE:1;HEADER:1;_Title": ("heading", 2),
        "DOCUMENT:1;ARTICLE:4;_Title": ("heading", 2), "DOCUMENT:1;ARTICLE:4;_Content": ("block", 0), "POINT:1;_Title": ("heading", 2), "ENCLOSURE:1;HEADER:1;_Content": ("block", 0), "BOOK;" * 9 + "_Title": ("heading", 6), "t1": None, "": None,
    }
    assert {k: section_of(k) for k in known} == known
    assert html_to_markdown("<nav><a href='#x'>m</a><p>kept") == "m\n\nkept"
    assert html_to_markdown("<article><header><h1>T</h1></header><div class='a hide'>gone<div>too</div></div>kept") == "# T\n\nkept"
    assert parsed("<p>a<![foo[x]]>") == ("", "AssertionError: unknown status keyword 'foo' in marked section")
