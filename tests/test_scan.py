from quarry.operators.lint import joint_report
from quarry.operators.scan import first_keys, range_files, write_ranges


def test_early_stop_reads_few_files_and_gives_the_first_keys(spark, tmp_path):
    rows = [(i % 7 if i < 50 else i, i) for i in range(400)] + [(None, -1)]
    df, path = spark.createDataFrame(rows, "k int, i int"), str(tmp_path / "r")
    write_ranges(df, path, ["i"], 8)
    assert len(range_files(spark, path)) == 8
    order = sorted({k: min(i for q, i in rows if q == k) for k, _ in rows if k is not None}.items(), key=lambda x: x[1])
    for n, most in ((3, 1), (7, 1), (40, 3), (10_000, 8)):
        out, read = first_keys(spark, path, "k int, i int", "k", ["i"], n)
        assert [tuple(r) for r in out.collect()] == order[:n] and read <= most
    assert first_keys(spark, path, "k int, i int", "k", ["i"], 0)[0].count() == 0


def test_a_joint_report_names_audits_without_findings(spark):
    bad = spark.createDataFrame([("a",), ("a",), ("b",)], "code string")
    assert {tuple(r) for r in joint_report({"one": bad, "two": bad.limit(0)}).collect()} == {("one", "a", 2), ("one", "b", 1), ("two", "ok", None)}
