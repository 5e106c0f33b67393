"""Registered feature-engineering queries: D1-D11 over lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.jobs.common import SPLIT_TS, lineitem
from telemetra.operators import features as D

ROLES = D.Roles(type_col="l_returnflag", air="l_discount", process="l_tax",
                speed="l_extendedprice", torque="l_quantity", wear="l_linenumber",
                target="target", modes=["mode_returned", "mode_accepted"],
                row_id=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def telemetry(spark, sf_dir):
    li = lineitem(spark, sf_dir)
    return li.select(
        "*",
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("target"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("mode_returned"),
        F.when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("mode_accepted"),
        F.when(F.col("l_shipdate") < F.lit(SPLIT_TS).cast("timestamp"), "reference")
        .otherwise("current").alias("period"))


def FIT():
    return F.col("period") == "reference"


def d1_label_repair_lineitem(spark, sf_dir):
    t = telemetry(spark, sf_dir)
    fixed = D.repair_labels(t.withColumnRenamed("target", "_t0").withColumn("target", F.col("_t0")),
                            ROLES)
    return fixed.groupBy(F.col("_t0").alias("target_before"), F.col("target").alias("target_after")
                         ).agg(F.count(F.lit(1)).alias("rows"))


def d2_d4_engineered_lineitem(spark, sf_dir):
    t = D.engineer(telemetry(spark, sf_dir), ROLES)
    return D.select_features(t, ROLES, "engineered", keep=["l_orderkey", "l_partkey", "l_suppkey"])


def d6_split_shares_lineitem(spark, sf_dir):
    s = D.stratified_split(telemetry(spark, sf_dir), KEYS + ["l_shipdate"], "target", seed=42, exact=True)
    return s.groupBy("split", "target").agg(F.count(F.lit(1)).alias("rows"))


def d8_robust_scale_lineitem(spark, sf_dir):
    t = D.engineer(telemetry(spark, sf_dir), ROLES)
    fit = D.fit_rows(t.where(FIT()), "target", "semi_supervised")
    numeric = [c for c in ROLES.feature_sets()["engineered"] if c != ROLES.type_col]
    return D.fit_robust_scaler(fit, numeric)


def d9_one_hot_lineitem(spark, sf_dir):
    t = telemetry(spark, sf_dir)
    cats = D.fit_one_hot(D.fit_rows(t.where(FIT()), "target"), "l_returnflag")
    enc = D.apply_one_hot(t.where(~FIT()), "l_returnflag", cats, prefix="type")
    cols = [f"type_{c}" for c in cats]
    return enc.groupBy(*cols).agg(F.count(F.lit(1)).alias("rows"))


def d10_preprocess_lineitem(spark, sf_dir):
    t = telemetry(spark, sf_dir)
    out, _, _ = D.preprocess(t, ROLES, "engineered_only", FIT(), "semi_supervised",
                             keep=["period", "target"])
    feats = [c for c in out.columns if c not in ("period", "target")]
    return out.groupBy("period", "target").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.avg(F.col(c)).alias(f"avg_{c.replace(' ', '_')}") for c in feats])


def d11_split_inputs_lineitem(spark, sf_dir):
    """Every row's raw inputs beside its split and its scaled features."""
    t = telemetry(spark, sf_dir)
    out, _, _ = D.preprocess(t, ROLES, "base", FIT(), "semi_supervised",
                             keep=["l_orderkey", "l_partkey", "l_suppkey", "period"], raw="raw_")
    return out


QUERIES = {
    "d1_label_repair_lineitem": d1_label_repair_lineitem,
    "d2_d4_engineered_lineitem": d2_d4_engineered_lineitem,
    "d6_split_shares_lineitem": d6_split_shares_lineitem,
    "d8_robust_scale_lineitem": d8_robust_scale_lineitem,
    "d9_one_hot_lineitem": d9_one_hot_lineitem,
    "d10_preprocess_lineitem": d10_preprocess_lineitem,
    "d11_split_inputs_lineitem": d11_split_inputs_lineitem,
}

# ------------------------------------------------------------------ oracle SQL
_T = """(SELECT *, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS target,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS mode_returned,
  CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS mode_accepted,
  CASE WHEN l_shipdate < TIMESTAMP '1999-01-01' THEN 'reference' ELSE 'current' END AS period,
  l_tax - l_discount AS "Temperature difference",
  l_quantity * (2 * pi() * l_extendedprice / 60) AS "Power",
  l_quantity * l_linenumber AS "Torque_ToolWear_Product" FROM lineitem)"""
_ENG = ["l_discount", "l_tax", "l_extendedprice", "l_quantity", "l_linenumber",
        "Temperature difference", "Power", "Torque_ToolWear_Product"]
_BASE = ["l_discount", "l_tax", "l_extendedprice", "l_quantity", "l_linenumber"]
_ENG_ONLY = ["Temperature difference", "Power", "Torque_ToolWear_Product"]


def _scaler_sql(cols):
    q = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, quantile_cont(CAST(\"{c}\" AS DOUBLE), [0.25, 0.5, 0.75]) AS q "
        f"FROM {_T} WHERE period = 'reference' AND target = 0" for c in cols)
    return (f"SELECT column_name, q[2] AS center, CASE WHEN q[3] - q[1] = 0 THEN 1.0 "
            f"ELSE q[3] - q[1] END AS scale FROM ({q})")


SQL = {
    "d1_label_repair_lineitem": f"""SELECT target AS target_before,
  CASE WHEN target = 0 AND greatest(mode_returned, mode_accepted) = 1 THEN 1 ELSE target END AS target_after,
  count(*) AS rows FROM {_T} GROUP BY ALL""",
    "d2_d4_engineered_lineitem": "SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, "
    + ", ".join(f'"{c}"' for c in _ENG) + f" FROM {_T}",
    "d6_split_shares_lineitem": f"""WITH h AS (SELECT target, CAST('0x' || substr(md5(concat_ws('|', """
    + ", ".join(f"CAST({c} AS VARCHAR)" for c in (*KEYS, "l_shipdate")) + f""", '42')), 1, 12) AS BIGINT) / {float(16 ** 12)!r} AS x FROM {_T}),
q AS (SELECT target, quantile_cont(x, [0.7, 0.85]) AS q FROM h GROUP BY target)
SELECT CASE WHEN x <= q.q[1] THEN 'train' WHEN x <= q.q[2] THEN 'validation' ELSE 'test' END AS split, h.target, count(*) AS rows
  FROM h JOIN q USING (target) GROUP BY ALL""",
    "d8_robust_scale_lineitem": _scaler_sql(_ENG),
    "d9_one_hot_lineitem": f"""WITH c AS (SELECT DISTINCT l_returnflag FROM {_T} WHERE period = 'reference' AND target = 0)
SELECT CAST(l_returnflag = 'A' AND 'A' IN (SELECT * FROM c) AS DOUBLE) AS type_A,
       CAST(l_returnflag = 'N' AND 'N' IN (SELECT * FROM c) AS DOUBLE) AS type_N,
       CAST(l_returnflag = 'R' AND 'R' IN (SELECT * FROM c) AS DOUBLE) AS type_R,
       count(*) AS rows FROM {_T} WHERE period = 'current' GROUP BY ALL""",
    "d10_preprocess_lineitem": f"""WITH p AS ({_scaler_sql(_ENG_ONLY)})
SELECT period, target, count(*) AS rows, """
    + ", ".join(f"avg((\"{c}\" - (SELECT center FROM p WHERE column_name = '{c}')) "
                f"/ (SELECT scale FROM p WHERE column_name = '{c}')) AS avg_{c.replace(' ', '_')}"
                for c in _ENG_ONLY)
    + ", avg(CAST(l_returnflag = 'A' AS DOUBLE)) AS avg_l_returnflag_A"
    + ", avg(CAST(l_returnflag = 'N' AS DOUBLE)) AS avg_l_returnflag_N"
    + ", avg(CAST(l_returnflag = 'R' AS DOUBLE)) AS avg_l_returnflag_R"
    + f" FROM {_T} GROUP BY period, target",
    "d11_split_inputs_lineitem": f"""WITH p AS ({_scaler_sql(_BASE)})
SELECT l_orderkey, l_partkey, l_suppkey, period, l_returnflag AS raw_l_returnflag, """
    + ", ".join(f"{c} AS raw_{c}, (CAST({c} AS DOUBLE) - (SELECT center FROM p WHERE column_name = '{c}')) "
                f"/ (SELECT scale FROM p WHERE column_name = '{c}') AS {c}" for c in _BASE)
    + "".join(f", CAST(l_returnflag = '{v}' AS DOUBLE) AS l_returnflag_{v}" for v in "ANR")
    + f" FROM {_T}",
}
