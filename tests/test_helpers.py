"""Small operators that no registered query exercises on its own: severities,
worst-of, grid expansion, prediction log, schema contract, role checks."""

import pytest
from pyspark.sql import functions as F

from telemetra.functions.exprs import severity_higher, severity_lower
from telemetra.operators import evaluate as E
from telemetra.operators import monitor as M
from telemetra.operators import profile as P
from telemetra.operators import quality as Q


def test_severity_higher_and_lower_edges(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.25,), (0.3,), (float("nan"),), (None,)], "v double")
    hi = [r[0] for r in df.select(severity_higher("v", 0.2, 0.3)).collect()]
    assert hi == ["stable", "warning", "warning", "critical", "stable", "stable"]
    lo = [r[0] for r in df.select(severity_lower("v", 0.25, 0.2)).collect()]
    # strict: exactly at a limit is not below it
    assert lo == ["critical", "warning", "stable", "stable", "stable", "stable"]


def test_worst_status_order_ties_and_empty(spark):
    rows = [(0, "stable"), (1, "no_data"), (2, "warning"), (3, "critical"), (4, "warning")]
    df = spark.createDataFrame(rows, "pos int, status string")
    assert M.worst_status(df, order="pos").first()["status"] == "critical"
    ties = spark.createDataFrame([(1, "no_data"), (0, "stable"), (2, "insufficient_data")],
                                 "pos int, status string")
    assert M.worst_status(ties, order="pos").first()["status"] == "stable"      # first wins
    empty = spark.createDataFrame([], "pos int, status string")
    assert M.worst_status(empty).first()["status"] == "no_data"
    grouped = spark.createDataFrame([("a", 0, "warning"), ("a", 1, "stable"), ("b", 0, "stable")],
                                    "k string, pos int, status string")
    got = {r["k"]: r["status"] for r in M.worst_status(grouped, ["k"], order="pos").collect()}
    assert got == {"a": "warning", "b": "stable"}


def test_expand_grid_is_product_order(spark):
    g = E.expand_grid(spark, {"k": [20, 40], "c": [0.03, 0.05, 0.06]}).orderBy("config_id")
    rows = [(r["config_id"], r["k"], r["c"]) for r in g.collect()]
    assert rows == [(0, "20", "0.03"), (1, "20", "0.05"), (2, "20", "0.06"),
                    (3, "40", "0.03"), (4, "40", "0.05"), (5, "40", "0.06")]


def test_prediction_log_one_event_per_row(spark):
    scored = spark.createDataFrame([(1.0, 2.0, 1, 0.9), (3.0, 4.0, 0, 0.1)],
                                   "a double, b double, prediction int, anomaly_score double")
    log = M.prediction_log(scored, ["a", "b"], F.lit("req-1"), F.lit("2024-01-01 00:00:00"),
                           "/predict/batch", "lof", "1")
    rows = log.orderBy("anomaly_score").collect()
    assert [r["anomaly"] for r in rows] == [False, True]
    assert rows[1]["features"]["a"] == 1.0 and rows[1]["request_id"] == "req-1"


def test_schema_contract_order_and_kind(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "id bigint, t double, kind string")
    out = {r["position"]: r for r in Q.schema_contract(
        df, [("id", "integer"), ("kind", "string"), ("t", "float")]).collect()}
    assert out[0]["name_ok"] and out[0]["kind_ok"]
    assert not out[1]["name_ok"] and out[1]["actual_kind"] == "float"


def test_roles_time_columns_and_units(spark):
    P.check_roles(["a", "b"], ["id"], ["target"])
    with pytest.raises(ValueError):
        P.check_roles(["a", "id"], ["id"], ["target"])
    df = spark.createDataFrame([(1, "2024-01-01", 300.0)], "udi int, event_time string, air double")
    assert P.time_like_columns(df) == ["event_time"]
    assert abs(df.select(P.kelvin_to_celsius("air")).first()[0] - 26.85) < 1e-9


def test_written_tables_are_released(spark, tmp_path):
    import os

    from telemetra.session import cut_lineage, release_tables

    release_tables(spark)
    df = cut_lineage(spark.range(5))
    folder = df.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    folder = "/" + folder.lstrip("/")
    assert df.count() == 5 and os.path.isdir(folder)
    assert release_tables(spark) == 1 and not os.path.exists(folder) and release_tables(spark) == 0
