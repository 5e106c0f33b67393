"""Outputs that were cut: ragged CSV lines, header checks, offenders, stream sinks."""

from pyspark.sql import functions as F

from telemetra.jobs import streaming_jobs
from telemetra.operators import quality as Q
from telemetra.sources import files as A

TEXT = "\ufeffk;name; v \n1;aa;1,5\n2;bb\n3;cc;2;9\n;;\n\n4;\"d;\"\"d\";x\n"


def test_ragged_lines_go_to_rejects(spark, tmp_path):
    (tmp_path / "a.csv").write_text(TEXT, encoding="utf-8")
    df, report = A.read_csv_tolerant(spark, str(tmp_path), ["k", "name", "w"], numeric=["v"], upper=["name"])
    assert sorted(map(tuple, df.collect())) == [("1", "AA", 1.5), ("4", 'D;"D', None)]
    assert df.columns == ["k", "name", "v"] and df.count() == 2
    assert sorted(r.line for r in report["rejects"].collect()) == ["2;bb", "3;cc;2;9"]
    assert report["missing"] == ["w"] and report["extra"] == ["v"] and not report["empty_header"]


def test_header_checks(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,a,,b\n1,2,3,4\n", encoding="utf-8")
    df, report = A.read_csv_tolerant(spark, str(tmp_path), ["a", "b"])
    assert report["duplicate_header"] == ["a"] and report["empty_header"] and report["missing"] == []
    assert df.columns == ["a0", "a1", "_c2", "b"] and tuple(df.first()) == ("1", "2", "3", "4")
    (tmp_path / "a.csv").write_text("")
    df, report = A.read_csv_tolerant(spark, str(tmp_path), ["a"])
    assert df.columns == [] and df.count() == 0 and report["missing"] == ["a"]


def test_offender_table(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2), ("z", 1), ("x", None), (None, 3), ("ok", 0)], "c string, b int")
    checks = {"c": F.when(F.col("c") != "ok", F.col("c")), "b": F.when(~F.col("b").isin(0, 1), F.col("b"))}
    assert sorted(map(tuple, Q.offender_table(df, checks).collect())) == [
        ("b", "2", 1), ("b", "3", 1), ("c", "x", 2), ("c", "y", 1), ("c", "z", 1)]


def test_scoring_sinks_hold_whole_rows(spark, monkeypatch):
    kept, plain = [], streaming_jobs.S.SplitSink

    class Kept(plain):
        def __init__(self, *args):
            super().__init__(*args)
            kept.append(self)

    monkeypatch.setattr(streaming_jobs.S, "SplitSink", Kept)
    rows = {(r["sink"], r["prediction"]): r["rows"] for r in
            streaming_jobs.s5_scoring_lineitem(spark, "/root/testdata/sf0.001").collect()}
    scored, held = (kept[0].result(spark, n) for n in ("scored", "quarantine"))
    assert {"l_orderkey", "l_linenumber", "prediction"} <= set(scored.columns) and "violations" in held.columns
    total = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert scored.count() + held.count() == total == sum(rows.values())


def test_split_sink_replays_replace(spark, tmp_path):
    sink = streaming_jobs.S.SplitSink(str(tmp_path), {"odd": lambda b: b.where("id % 2 = 1"), "even": lambda b: b.where("id % 2 = 0")})
    for batch_id, n in ((0, 4), (1, 7), (1, 7)):
        sink(spark.range(n), batch_id)
    assert sink.result(spark, "odd").count() == 5 and sink.result(spark, "even").count() == 6
