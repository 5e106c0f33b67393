"""Closed-form monitoring cases (FIXTURES.md section 2) and drift invariants."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemetra.operators import drift, monitor as M, profile as P


def _profile(spark, edges, props, col="x"):
    return spark.createDataFrame([(col, [float(e) for e in edges], [float(p) for p in props], 1.0)],
                                 "column_name string, bin_edges array<double>, "
                                 "bin_proportions array<double>, standard_deviation double")


def _psi(spark, values, edges, props):
    cur = spark.createDataFrame([(float(v),) for v in values], "x double")
    return drift.psi(cur, _profile(spark, edges, props), ["x"]).first()["psi"]


def test_psi_identical_is_zero(spark):
    assert abs(_psi(spark, range(10), [2, 4, 6, 8], [0.2] * 5)) < 1e-12


def test_psi_constant_shift_is_critical(spark):
    assert _psi(spark, [100.0] * 100, [2, 4, 6, 8], [0.2] * 5) > 0.2


def test_psi_empty_bins_count(spark):
    # all current values in one bin: the four empty bins must still contribute
    p = _psi(spark, [0.0] * 10, [2, 4, 6, 8], [0.2] * 5)
    a = np.array([1, 1e-6, 1e-6, 1e-6, 1e-6]); a = a / a.sum()
    e = np.full(5, 0.2)
    assert math.isclose(p, float(np.sum((a - e) * np.log(a / e))), rel_tol=1e-12)


def _js(spark, ref_props, values):
    prof = spark.createDataFrame([("t", k, float(v)) for k, v in ref_props.items()],
                                 "column_name string, category string, proportion double")
    cur = spark.createDataFrame([(v,) for v in values], "t string")
    return drift.js_divergence(cur, prof, ["t"]).first()["js_divergence"]


def test_js_identical_and_skewed(spark):
    ref = {"L": 0.5, "M": 0.3, "H": 0.2}
    assert abs(_js(spark, ref, ["L"] * 5 + ["M"] * 3 + ["H"] * 2)) < 1e-12
    assert _js(spark, ref, ["L"] + ["M"] + ["H"] * 8) > 0.1


def test_js_published_shares(spark):
    ref = {"H": 0.10251851851851852, "L": 0.5918518518518519, "M": 0.30562962962962964}
    values = ["H"] * 114 + ["L"] * 601 + ["M"] * 285
    assert math.isclose(_js(spark, ref, values), 0.000349995966252503, rel_tol=1e-9)


def test_system_metrics_two_events(spark):
    ev = spark.createDataFrame(
        [("2024-01-01 00:00:00", "/predict", 200, 100.0, 1),
         ("2024-01-01 00:01:00", "/predict", 422, 120.0, None)],
        "timestamp string, path string, status_code int, latency_ms double, instance_count int"
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    r = M.system_metrics(ev).first()
    assert r["request_count"] == 2 and r["processed_instances"] == 1
    assert r["error_rate"] == 0.5 and r["availability"] == 1.0
    assert r["status"] == "critical"
    al = M.alerts(M.system_metric_rows(M.system_metrics(ev))).collect()
    assert [a["metric"] for a in al] == ["error_rate"]


def test_data_monitor_insufficient(spark):
    cur = spark.createDataFrame([({"x": "1.0"},)], "features map<string,string>")
    prof = _profile(spark, [2, 4], [0.3, 0.4, 0.3])
    cat = spark.createDataFrame([], "column_name string, category string, proportion double")
    out = M.data_monitor(cur, "features", prof, cat, ["x"], []).collect()
    assert len(out) == 1 and out[0]["status"] == "insufficient_data"


def test_data_monitor_missing_column_is_critical(spark):
    rows = [({"x": str(float(i % 7))},) for i in range(40)]
    cur = spark.createDataFrame(rows, "features map<string,string>")
    prof = spark.createDataFrame([("x", [2.0, 4.0], [0.3, 0.3, 0.4], 1.0),
                                  ("y", [1.0], [0.5, 0.5], 1.0)],
                                 "column_name string, bin_edges array<double>, "
                                 "bin_proportions array<double>, standard_deviation double")
    cat = spark.createDataFrame([], "column_name string, category string, proportion double")
    out = {(r["metric"], r["subject"]): r["status"]
           for r in M.data_monitor(cur, "features", prof, cat, ["x", "y"], []).collect()}
    assert out[("missing_column", "y")] == "critical"
    assert out[("rows", "production")] == "critical"


def test_model_monitor_stable(spark):
    rows = [(1 if i < 3 else 0, -1.0 if i % 2 == 0 else 1.0) for i in range(30)]
    cur = spark.createDataFrame(rows, "prediction int, anomaly_score double")
    ref = spark.createDataFrame([(0.1, 0.0, 1.0)],
                                "predicted_anomaly_rate double, mean double, standard_deviation double")
    r = M.model_monitor(cur, "prediction", "anomaly_score", ref).first()
    assert r["status"] == "stable"
    assert math.isclose(r["anomaly_rate"], 0.1) and r["anomaly_rate_absolute_difference"] < 1e-12


@pytest.mark.parametrize("status,perf,decision", [
    ("stable", None, "continue_monitoring"),
    ("critical", None, "investigate_drift"),
    ("critical", 0.6792 * 0.9 + 0.01, "continue_monitoring"),
    ("critical", 0.6792 * 0.9 - 0.01, "evaluate_retraining"),
    ("critical", 0.6792 * (1 - 0.10), "evaluate_retraining"),
])
def test_retraining_decision(spark, status, perf, decision):
    df = spark.createDataFrame([(status, perf)], "data_status string, perf double")
    r = M.retraining_decision(df, "data_status", "perf").first()
    assert r["decision"] == decision
    assert math.isclose(r["performance_threshold"], 0.61128)
    assert r["automatic_retraining"] is False


def test_shift_psi_monotone_and_zero(spark):
    rng = np.random.default_rng(42)
    edges = np.linspace(-2.4, 2.4, 9)
    vals = np.concatenate([rng.uniform(lo, hi, 200) for lo, hi in
                           zip(np.r_[-3, edges], np.r_[edges, 3])])
    cur = spark.createDataFrame([(float(v),) for v in vals], "x double")
    prof = _profile(spark, edges, [0.1] * 10)
    s = drift.shift_psi(cur, prof, "x", std=float(np.std(vals, ddof=1))).orderBy("factor_id").toPandas()
    assert len(s) == 400
    assert s["psi"].iloc[-1] > s["psi"].iloc[0]
    w = drift.pick_shift(spark.createDataFrame(s), 0.1, 0.2, 0.15).first()
    c = drift.pick_shift(spark.createDataFrame(s), 0.2, None, 0.30).first()
    assert 0.1 <= w["psi"] < 0.2 <= c["psi"] and w["factor"] < c["factor"]
    # brute force for a few factors
    for i in (0, 57, 399):
        f = s["factor"][i]
        shifted = vals + np.std(vals, ddof=1) * f
        counts = np.histogram(shifted, np.r_[-np.inf, edges, np.inf])[0]
        a = np.clip(counts / counts.sum(), 1e-6, None); a = a / a.sum()
        e = np.full(10, 0.1)
        assert math.isclose(s["psi"][i], float(np.sum((a - e) * np.log(a / e))), rel_tol=1e-9)


def test_system_metrics_read_text_codes_and_skip_nan(spark):
    rows = [("2024-01-01 00:00:00", "500.0", 10.0), ("2024-01-01 00:10:00", "200", float("nan")),
            ("2024-01-01 00:20:00", "NaN", 30.0), ("2024-01-01 00:30:00", None, None)]
    log = (spark.createDataFrame(rows, "timestamp string, status_code string, latency_ms double")
           .selectExpr("cast(timestamp as timestamp) timestamp", "status_code", "latency_ms", "1 instance_count"))
    r = M.system_metrics(log).first()
    assert (r["request_count"], r["error_count"], r["availability"]) == (4, 1, 0.25)
    assert r["latency_mean_ms"] == 20.0 and abs(r["latency_p95_ms"] - 29.0) < 1e-9
    none = M.system_metrics(M.trailing_window(log, "timestamp", "2020-01-01 00:00:00")).collect()
    assert len(none) == 1 and none[0]["request_count"] == 0 and none[0]["error_rate"] is None
    assert {none[0][c] for c in none[0].asDict() if c.endswith("status")} == {"no_data"}
    within = M.trailing_window(log, "timestamp", "2024-01-01 00:10:00", hours=1)
    assert within.count() == 2


def test_nan_is_no_outlier_and_breaks_no_correlation(spark):
    nan = float("nan")
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(20)] + [(nan, 1.0), (3.0, nan), (None, 5.0)],
                               "a double, b double")
    assert {r["column_name"]: r["outliers"] for r in P.iqr_outliers(df, ["a", "b"]).collect()} == {"a": 0, "b": 0}
    bounds = P.iqr_bounds(df, ["a", "b"])
    assert P.outlier_flag(df, ["a", "b"], bounds).where("any_outlier").count() == 0
    assert abs(P.correlations(df, ["a", "b"]).first()["pearson"] - 1.0) < 1e-12
