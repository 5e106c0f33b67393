"""Saved models, streams of several batches, the full report, held-out comparison."""

import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemetra.operators import drift
from telemetra.operators import ensemble as G
from telemetra.operators import evaluate as E
from telemetra.operators import features as D
from telemetra.operators import monitor as M
from telemetra.operators import profile as P
from telemetra.sources import files as A
from telemetra.sources import models
from telemetra.streaming import stream as S


# -- saved models -----------------------------------------------------------------------

def test_versions_are_whole_and_numbered(spark, tmp_path):
    folder = str(tmp_path)
    a = spark.createDataFrame([(1, 2.0)], "k int, v double")
    assert models.versions(spark, "m", folder) == []
    with pytest.raises(KeyError):
        models.load_model(spark, "m", folder=folder)
    assert models.save_model(spark, "m", {"t": a, "u": a}, folder) == 1
    assert models.save_model(spark, "m", {"t": a.withColumn("v", F.lit(3.0))}, folder) == 2
    assert models.load_model(spark, "m", folder=folder)["t"].first()["v"] == 3.0
    old = models.load_model(spark, "m", 1, folder)
    assert sorted(old) == ["t", "u"] and old["t"].first()["v"] == 2.0
    with pytest.raises(KeyError):
        models.load_model(spark, "m", 7, folder)
    (tmp_path / "m" / "half" / "t").mkdir(parents=True)           # a fit that died publishes nothing
    assert models.versions(spark, "m", folder) == [1, 2]


def test_forest_and_categories_survive_saving(spark, tmp_path):
    from telemetra.operators.detect import iforest

    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(200, 3)))], "id long, vec array<double>")
    forest = iforest.fit_forest(df, "id", "vec", n_trees=10, max_samples=64)
    models.save_model(spark, "f", {"nodes": spark.createDataFrame(forest, iforest.NODE_SCHEMA)}, str(tmp_path))
    back = models.load_model(spark, "f", folder=str(tmp_path))["nodes"].toPandas()
    assert set(back["sample"]) == {64}
    x, y = (iforest.score_forest(df, "id", "vec", f).toPandas().sort_values("id").iforest_score for f in (forest, back))
    assert np.allclose(x, y)


def test_more_categories_than_columns(spark):
    df = spark.range(3000).select("id", F.concat(F.lit("c"), F.col("id").cast("string")).alias("kind"))
    cats = D.fit_one_hot(df, "kind")
    out = D.apply_one_hot(df.unionByName(spark.createDataFrame([(9999, "new")], "id long, kind string")), "kind", cats)
    names = sorted(f"c{i}" for i in range(3000))
    got = {r["id"]: r["kind_position"] for r in out.collect()}
    assert got[9999] is None and all(names[got[i]] == f"c{i}" for i in (0, 17, 2999)) and len(got) == 3001
    assert D.fit_one_hot(df.limit(0), "kind") == []


# -- streams ----------------------------------------------------------------------------

START = datetime.datetime(2024, 5, 1)


def _requests(spark, n=900, seed=4):
    rng = np.random.default_rng(seed)
    rows = [(i, START + datetime.timedelta(minutes=float(m)), "ab"[i % 2], 500 if i % 7 == 0 else 200,
             None if i % 31 == 0 else float(v))
            for i, (m, v) in enumerate(zip(np.sort(rng.uniform(0, 60 * 70, n)), rng.lognormal(3, 1, n)))]
    return spark.createDataFrame(rows, "request_id long, timestamp timestamp, path string, status_code int, latency_ms double")


def _delivered(spark, df, tmp_path, slices):
    sliced = df.withColumn("slice", slices)
    folder = S.arrival_files(sliced, "slice", str(tmp_path / "arrival"))
    return S.read_stream(spark, folder, sliced.drop("slice").schema, file_glob="slice-*.parquet", max_files_per_trigger=1)


def test_late_rows_of_every_batch(spark, tmp_path):
    df = _requests(spark).withColumn("slice", F.when(F.col("request_id") % 10 == 3, F.col("request_id") / 300 + 2)
                                     .otherwise(F.col("request_id") / 300).cast("int"))
    rows = sorted((r.slice, r.request_id, r.timestamp) for r in df.collect())
    stream = _delivered(spark, df, tmp_path, F.col("slice"))
    _, audit = S.run_available_now(S.dedup_requests(stream, ["request_id"]), "late")
    got = {r.batch_id: (r.input_rows, r.late_rows) for r in S.late_rows(audit).collect()}
    assert sum(n for n, _ in got.values()) == 900 and len(got) >= 3
    # a batch drops what lies behind the watermark that the batch before it had
    want = {}
    for b in sorted({s for s, _, _ in rows}):
        seen = [t for s, _, t in rows if s < b - 1]
        mark = max(seen) - datetime.timedelta(hours=1) if seen else None
        if mark:
            mark = mark.replace(microsecond=mark.microsecond // 1000 * 1000)
        own = [t for s, _, t in rows if s == b]
        want[b] = (len(own), sum(t <= mark for t in own) if mark else 0)
    assert got == want and sum(late for _, late in want.values()) > 0


def test_window_psi_equals_the_batch_form_and_replays(spark, tmp_path):
    df = _requests(spark)
    profile = drift.numeric_profile(df.where(F.col("request_id") < 400), ["latency_ms", "request_id"])
    slices = (F.col("request_id") / 300).cast("int")
    stream = _delivered(spark, df, tmp_path, slices)
    sink = S.WindowPsi(profile, str(tmp_path / "psi"))
    S.run_batches(S.column_bin_counts(stream, profile, ["latency_ms", "request_id"], "timestamp", "6 hours"), "psi", sink)
    got = {(r.window_start, r.column_name): (r.psi, r.current_count) for r in sink.result(spark).collect()}
    keyed = df.withColumn("window_start", F.window("timestamp", "6 hours")["start"])
    want = {(r.window_start, r.column_name): (r.psi, r.current_count)
            for r in drift.psi(keyed, profile, ["latency_ms", "request_id"], keys=["window_start"]).collect()}
    assert len(got) >= 16 and all(math.isclose(got[k][0], want[k][0], rel_tol=1e-9) and got[k][1] == want[k][1] for k in got)
    batch = spark.createDataFrame([(START, "latency_ms", 0, 5)], "window_start timestamp, column_name string, bin int, n long")
    again = S.WindowPsi(profile, str(tmp_path / "again"))
    assert again.result(spark).count() == 0
    for _ in range(2):
        again(batch, 3)
    assert again.result(spark).count() == 1


def test_sliding_windows_from_panes(spark, tmp_path):
    df = _requests(spark)
    panes, audit = S.run_available_now(S.endpoint_panes(_delivered(spark, df, tmp_path, F.lit(0))), "panes")
    mark = S.last_watermark(audit)
    rows = df.collect()
    for r in S.sliding_windows(panes, mark).collect():
        own = [x for x in rows if r.window_start <= x.timestamp < r.window_end and x.path == r.path]
        lat = sorted(x.latency_ms for x in own if x.latency_ms is not None)
        assert r.requests == len(own) and r.errors == sum(x.status_code >= 400 for x in own)
        assert math.isclose(r.latency_mean_ms, sum(lat) / len(lat), rel_tol=1e-9)
        exact = lat[math.floor(0.95 * (len(lat) - 1))]
        assert abs(r.latency_p95_ms - exact) <= 1.0001 * S.ACCURACY * exact
    plan = S.endpoint_panes(df)._jdf.queryExecution().toString()
    assert "Expand" not in plan
    odd = spark.createDataFrame([(START, "a", 200, v) for v in (-5.0, 0.0, 7.0, float("nan"), None)],
                                "timestamp timestamp, path string, status_code int, latency_ms double")
    one = S.sliding_windows(S.endpoint_panes(odd), quantile=0.0).first()
    assert one.requests == 5 and abs(one.latency_p95_ms + 5) <= 0.05


# -- reports ----------------------------------------------------------------------------

def _report(spark, latency, path, labels=True, rows=60):
    n = max(rows, 1)
    events = spark.createDataFrame(
        [(str(i), START + datetime.timedelta(minutes=i), 500 if i % 5 == 0 else 200, float(latency(i)), 1,
          {"x": str(latency(i)), "p": path(i)}, int(latency(i) >= 100), float(latency(i))) for i in range(n)],
        "request_id string, timestamp timestamp, status_code int, latency_ms double, instance_count int, "
        "features map<string,string>, prediction int, anomaly_score double").where(F.lit(rows > 0))
    old = spark.createDataFrame([(float(i % 50), "ab"[i % 2]) for i in range(500)], "x double, p string")
    num, cat = drift.numeric_profile(old, ["x"]), drift.categorical_profile(old, ["p"])
    ref = spark.createDataFrame([(0.01, 25.0, 14.0)], "predicted_anomaly_rate double, mean double, standard_deviation double")
    known = spark.createDataFrame([(str(i), int(i % 2 == 0)) for i in range(0, 40)], "request_id string, y int") if labels else None
    return M.full_report(events, events, "timestamp", M.latest(events, "timestamp"), num, cat, ["x", "gone"], ["p"], ref, known)


def test_report_alerts_of_all_monitors_and_decision(spark):
    rows = _report(spark, lambda i: 150 + i, lambda i: "c").collect()
    alerts = {(r.category, r.metric) for r in rows if r.kind == "alert"}
    assert alerts >= {("system", "error_rate"), ("system", "availability"), ("data", "psi"), ("data", "js_divergence"),
                      ("data", "missing_column"), ("model", "anomaly_rate_difference"), ("model", "score_mean_shift")}
    assert all(r.message and r.recommended_action for r in rows if r.kind == "alert" and r.metric != "rows")
    status = {r.category: r.status for r in rows if r.kind == "status"}
    assert status == {"system": "critical", "data": "critical", "model": "critical", "overall": "critical"}
    perf = {r.metric: r.value for r in rows if r.category == "performance"}
    assert perf["labelled_rows"] == 40 and perf["recall"] == 1.0 and perf["precision"] == 0.5
    decision = [r for r in rows if r.kind == "decision"]
    assert len(decision) == 1 and decision[0].status == "continue_monitoring" and decision[0].value == 1.0
    none = _report(spark, lambda i: 150 + i, lambda i: "c", labels=False).where("kind = 'decision'").first()
    assert none.status == "investigate_drift" and none.value is None


def test_report_on_an_empty_window(spark):
    rows = _report(spark, lambda i: 1, lambda i: "a", rows=0).collect()
    assert {r.category: r.status for r in rows if r.kind == "status"} == {
        "system": "no_data", "data": "no_data", "model": "no_data", "overall": "no_data"}


def test_nan_scores_leave_the_model_status_alone(spark):
    ref = spark.createDataFrame([(0.0, 0.0, 1.0)], "predicted_anomaly_rate double, mean double, standard_deviation double")
    cur = spark.createDataFrame([(1, 10.0)] * 40 + [(0, float("nan"))], "p int, s double")
    row = M.model_monitor(cur, "p", "s", ref).first()
    assert row["score_mean"] == 10.0 and row["score_shift_status"] == "critical"
    assert M.score_summary(cur, "s").first()["count"] == 40


# -- evaluation -------------------------------------------------------------------------

def _scored(n=600, seed=3):
    rng = np.random.default_rng(seed)
    y = (rng.uniform(size=n) < 0.2).astype(int)
    return [(i, "m" if i % 3 else "k", int(t), float(round(s + 1.5 * t, 1)), "validation" if i % 2 else "test")
            for i, (t, s) in enumerate(zip(y, rng.normal(size=n)))]


def test_held_out_thresholds_come_from_the_other_half(spark):
    rows = _scored()
    df = spark.createDataFrame(rows, "id int, model string, y int, score double, split string")
    out = {r.model: r for r in E.held_out_comparison(df, "y", "score", "split", ["model"]).collect()}
    for model, r in out.items():
        val = [(y, s) for _, m, y, s, h in rows if m == model and h == "validation"]
        test = [(y, s) for _, m, y, s, h in rows if m == model and h == "test"]

        def point(t):
            tp, fp = sum(y for y, s in val if s >= t), sum(1 - y for y, s in val if s >= t)
            return tp / (tp + fp), -fp / sum(1 - y for y, _ in val), tp / sum(y for y, _ in val), -t

        best = max((point(t) for t in {s for _, s in val} if point(t)[2] >= 0.7))
        assert r.threshold == -best[3] and r.test_samples == len(test)
        assert r.tp == sum(y for y, s in test if s >= r.threshold) and r.fp == sum(1 - y for y, s in test if s >= r.threshold)
    assert sum(r.best for r in out.values()) == 1
    never = E.held_out_comparison(df.withColumn("y", F.lit(0)), "y", "score", "split", ["model"]).first()
    assert never.threshold is None and never.tp == never.fp == 0


def test_audit_finds_stale_and_missing_predictions(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 0.2, 0), ("b", 0.4, 1), ("b", 0.9, None), ("b", 0.1, 0)], "v string, s double, p int")
    got = {r.v: (r.rows, r.inconsistent, r.consistent) for r in E.audit_predictions(df, "s", "p", 0.5, ["v"]).collect()}
    assert got == {"a": (2, 0, True), "b": (3, 2, False)}


def test_curves_have_their_end_points(spark):
    t = E.score_table(spark.createDataFrame([(1, 0.9), (0, 0.5), (1, 0.1)], "y int, s double"), "y", "s")
    assert (None, 0.0, 0.0) in [tuple(r) for r in E.roc_points(t).collect()]
    assert (None, 1.0, 0.0) in [tuple(r) for r in E.pr_points(t).collect()]
    assert E.roc_points(t.limit(0)).count() == 0


def test_gate_search_equals_each_gate_alone(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.uniform() < 0.3), round(float(a), 2), round(float(b), 2)) for i, (a, b) in enumerate(rng.uniform(size=(400, 2)))]
    df = spark.createDataFrame(rows, "id int, y int, a double, b double")
    gates = [0.9, 0.2, 0.5]
    found = {round(r.gate, 2): r for r in G.gate_search(df, "y", "a", "b", gates).collect()}
    for g in gates:
        alone = E.evaluate_grouped(df.withColumn("k", F.lit(1)).withColumn("s", G.cascade("a", "b", g)), "y", "s", ["k"]).first()
        r = found[g]
        assert math.isclose(r.pr_auc, alone.pr_auc) and r.threshold == alone.threshold and math.isclose(r.precision, alone.precision)
        assert math.isclose(r.reach, sum(y for _, y, a, _ in rows if a >= g) / sum(y for _, y, _, _ in rows))
        assert r.reach >= 0.7 or r.threshold == 0.0
    best = G.best_gate(G.gate_search(df, "y", "a", "b", gates)).first()
    assert best.pr_auc == max(r.pr_auc for r in found.values())
    assert G.best_gate(G.gate_search(df.withColumn("y", F.lit(0)), "y", "a", "b", gates)).count() == 0


def test_percentile_rank_with_hot_scores_and_nulls(spark):
    values = [1.0] * 3000 + [float(i) for i in range(2, 500)] + [None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, s double")
    got = {r.id: r.p for r in G.percentile_rank(df, "s", "p").collect()}
    assert len(got) == len(values) and got[len(values) - 1] is None
    assert math.isclose(got[0], (3001 / 2) / 3498) and math.isclose(got[3497], 1.0)


# -- profile and sources ----------------------------------------------------------------

def test_counts_below_many_thresholds(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=2000).round(2)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "x double").repartition(5)
    asked = [*rng.normal(size=50).round(2).tolist(), 0.0, 0.0, -9.0, 9.0]
    total, *below = drift.counts_below(df, "x", asked)
    assert total == 2000 and below == [int((x < t).sum()) for t in asked]
    assert "Sort" not in df._jdf.queryExecution().toString()


def test_sketches_merge_within_their_error(spark):
    df = spark.range(40000).select((F.col("id") % 9000).alias("a"), F.col("id").alias("b"), (F.col("id") % 3).cast("int").alias("k"),
                                   F.when(F.col("id") % 2 == 0, F.lit(1.5)).alias("c"))
    got = {r.column_name: r.estimate for r in P.merged_cardinality(P.cardinality_sketches(df, ["k"])).collect()}
    exact = {r.column_name: r.distinct_values for r in P.cardinality(df.drop("k")).collect()}
    assert exact == {"a": 9000, "b": 40000, "c": 2}
    assert all(abs(got[c] - n) <= 4 * 1.04 / 2 ** (P.SKETCH_LG / 2) * n + 1 for c, n in exact.items())
    assert "Expand" not in P.cardinality(df)._jdf.queryExecution().toString()


def test_histogram_has_empty_bins_and_markers(spark):
    df = spark.createDataFrame([(0.0, 5.0), (1.0, 5.0), (10.0, 5.0)], "x double, c double")
    rows = P.histogram(df, ["x", "c"], 10).collect()
    x = sorted((r.bin, r["count"], r.marker) for r in rows if r.column_name == "x")
    assert [n for _, n, _ in x] == [1, 1, 0, 0, 0, 0, 0, 0, 0, 1] and x[1][2] == "median" and x[3][2] == "mean"
    assert [(r.bin, r["count"], r.marker) for r in rows if r.column_name == "c"] == [(0, 3, "mean+median")]


def test_damaged_and_missing_logs(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": "1", "v": 2}\n\n{"k": 3, "v"\n[1]\n   \n{"k": {"z": 1}}\nnull\n')
    rows, counts = A.read_jsonl_tolerant(spark, str(tmp_path / "a.jsonl"), ["k", "v"])
    assert sorted(map(tuple, rows.collect()), key=repr) == [("1", "2"), ('{"z":1}', None)]
    assert tuple(counts.first()) == (5, 3)
    rows, counts = A.read_jsonl_tolerant(spark, str(tmp_path / "none.jsonl"), ["k"])
    assert rows.count() == 0 and rows.columns == ["k"] and tuple(counts.first()) == (0, 0)


def test_log_days_reports_and_ingest_checks(spark, tmp_path):
    day = lambda d: datetime.datetime(2024, 3, d, 12)
    df = spark.createDataFrame([("a", day(1)), ("b", day(2)), ("c", day(3))], "k string, timestamp timestamp")
    path = str(tmp_path / "log")
    A.append_log(df.where("k <> 'c'"), path)
    A.append_log(df.where("k = 'c'"), path)
    got = A.read_log(spark, path, "k string, timestamp timestamp", since=datetime.date(2024, 3, 2))
    assert sorted(r.k for r in got.collect()) == ["b", "c"] and A.read_log(spark, path + "x", "k string").count() == 0
    assert A.report_row(df.select("k")).first()[0] == '[{"k":"a"},{"k":"b"},{"k":"c"}]'
    gone = A.ingest_checks(df, 3, 2, "target").first()
    assert not gone["target_present"] and gone["rows_ok"] and gone["class"] is None
    empty = A.ingest_checks(df.limit(0), 3, 2, "k").first()
    assert empty["target_present"] and not empty["rows_ok"] and empty["class"] is None


def test_one_class_svm_needs_few_passes(spark):
    from telemetra.operators.detect import ocsvm

    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(size=(400, 4)), np.full((1, 4), 9.0)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    model = ocsvm.RffOneClass(4, 0.25, nu=0.05, n_features=512).fit(df, "vec")
    assert model.passes <= 15
    scored = model.score(df, "id", "vec").toPandas().set_index("id")
    assert scored.ocsvm_score.idxmax() == 400 and 0.01 <= scored.prediction.mean() <= 0.12
    with pytest.raises(ValueError):
        ocsvm.RffOneClass(4, 0.25).fit(df.limit(0), "vec")
