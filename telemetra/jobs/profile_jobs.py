"""Registered profiling queries: C1-C14 over lineitem (and events for C14)."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from telemetra.jobs.common import MEASURES, lineitem
from telemetra.operators import profile as P
from telemetra.session import cut_lineage
from telemetra.sources.tables import table


def _li_labeled(spark, sf_dir):
    return lineitem(spark, sf_dir).withColumn(
        "target", F.when(F.col("l_linestatus") == "O", 1).otherwise(0))


def c1_columns_lineitem(spark, sf_dir):
    return P.column_info(lineitem(spark, sf_dir))


def c3_frequency_lineitem(spark, sf_dir):
    return P.frequencies(lineitem(spark, sf_dir), "l_returnflag")


def c4_summary_lineitem(spark, sf_dir):
    return P.summary(lineitem(spark, sf_dir), MEASURES)


def c5_cardinality_lineitem(spark, sf_dir):
    return P.cardinality(lineitem(spark, sf_dir))


def c5_cardinality_sketch_lineitem(spark, sf_dir):
    """Sketches of every column and ship year, merged: whether the estimate is within
    four standard errors of the distinct count."""
    li = lineitem(spark, sf_dir)
    batches = cut_lineage(P.cardinality_sketches(li.withColumn("batch_id", F.year("l_shipdate")), ["batch_id"]))
    both = P.merged_cardinality(batches).join(P.cardinality(li), "column_name")
    bound = 4 * 1.04 / 2 ** (P.SKETCH_LG / 2) * F.col("distinct_values") + 1
    return both.select("column_name", "rows", "distinct_values",
                       (F.abs(F.col("estimate") - F.col("distinct_values")) <= bound).alias("within_bound"))


def c8_extremes_events(spark, sf_dir):
    """Error rate of the events outside and inside each column's own fences."""
    ev = table(spark, sf_dir, "events").select(
        "value", F.col("user_id").cast("double").alias("user_id"), (F.col("event_type") == "error").cast("int").alias("failed"))
    return P.extreme_rates(ev, ["value", "user_id"], "failed", P.iqr_bounds(ev, ["value", "user_id"]))


def c6_skew_lineitem(spark, sf_dir):
    return P.skewness(lineitem(spark, sf_dir), MEASURES)


def c7_iqr_lineitem(spark, sf_dir):
    return P.iqr_outliers(lineitem(spark, sf_dir), MEASURES)


def c8_outlier_vs_label_lineitem(spark, sf_dir):
    li = _li_labeled(spark, sf_dir)
    flagged = P.outlier_flag(li, MEASURES, P.iqr_bounds(li, MEASURES))
    return P.rate_by(flagged, "any_outlier", "target")


def c9_class_share_lineitem(spark, sf_dir):
    return P.class_share(_li_labeled(spark, sf_dir), "target")


def c10_corr_lineitem(spark, sf_dir):
    return P.correlations(lineitem(spark, sf_dir), MEASURES)


def c11_rate_by_type_lineitem(spark, sf_dir):
    return P.rate_by(_li_labeled(spark, sf_dir), "l_returnflag", "target")


def c12_histogram_lineitem(spark, sf_dir):
    return P.histogram(lineitem(spark, sf_dir), MEASURES, 30).withColumn("mean", F.round("mean", 4))


def c13_box_lineitem(spark, sf_dir):
    return P.box_stats(_li_labeled(spark, sf_dir), MEASURES, "target")


def c14_transform_skew_events(spark, sf_dir):
    return P.transform_skewness(table(spark, sf_dir, "events"), "value")


QUERIES = {
    "c1_columns_lineitem": c1_columns_lineitem,
    "c3_frequency_lineitem": c3_frequency_lineitem,
    "c4_summary_lineitem": c4_summary_lineitem,
    "c5_cardinality_lineitem": c5_cardinality_lineitem,
    "c5_cardinality_sketch_lineitem": c5_cardinality_sketch_lineitem,
    "c6_skew_lineitem": c6_skew_lineitem,
    "c7_iqr_lineitem": c7_iqr_lineitem,
    "c8_outlier_vs_label_lineitem": c8_outlier_vs_label_lineitem,
    "c8_extremes_events": c8_extremes_events,
    "c9_class_share_lineitem": c9_class_share_lineitem,
    "c10_corr_lineitem": c10_corr_lineitem,
    "c11_rate_by_type_lineitem": c11_rate_by_type_lineitem,
    "c12_histogram_lineitem": c12_histogram_lineitem,
    "c13_box_lineitem": c13_box_lineitem,
    "c14_transform_skew_events": c14_transform_skew_events,
}

# ------------------------------------------------------------------ oracle SQL
_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_KIND = ("CASE any_value(typeof({c})) WHEN 'BIGINT' THEN 'integer' WHEN 'INTEGER' THEN 'integer' "
         "WHEN 'DOUBLE' THEN 'float' WHEN 'TIMESTAMP' THEN 'timestamp' ELSE 'string' END")
_M = ", ".join(MEASURES)
_LONG = (f"(SELECT column_name, CAST(x AS DOUBLE) AS x FROM (UNPIVOT (SELECT {_M} FROM lineitem) "
         f"ON {_M} INTO NAME column_name VALUE x))")
_LONG_T = (f"(SELECT target, column_name, CAST(x AS DOUBLE) AS x FROM (UNPIVOT (SELECT "
           f"CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS target, {_M} FROM lineitem) "
           f"ON {_M} INTO NAME column_name VALUE x))")
_BOUNDS = f"""(SELECT column_name, q[1] AS q1, q[2] AS median, q[3] AS q3,
    q[1] - 1.5 * (q[3] - q[1]) AS lower, q[3] + 1.5 * (q[3] - q[1]) AS upper
  FROM (SELECT column_name, quantile_cont(x, [0.25, 0.5, 0.75]) AS q FROM {_LONG} GROUP BY column_name))"""
_LAMBDAS = [round(-2 + 0.1 * i, 1) for i in range(41)]
_PAIRS = list(itertools.combinations(MEASURES, 2))

SQL = {
    "c1_columns_lineitem": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS non_null, {_KIND.format(c=c)} AS kind FROM lineitem"
        for c in _LI_COLS),
    "c3_frequency_lineitem": "SELECT l_returnflag, count(*) AS count FROM lineitem GROUP BY l_returnflag",
    "c4_summary_lineitem": f"""SELECT column_name, min(x) AS minimum, max(x) AS maximum, avg(x) AS mean,
  quantile_cont(x, 0.5) AS median FROM {_LONG} GROUP BY column_name""",
    "c5_cardinality_lineitem": "WITH a AS (SELECT count(*) AS n, "
    + ", ".join(f"count(DISTINCT {c}) + max(CAST({c} IS NULL AS INTEGER)) AS {c}" for c in _LI_COLS)
    + " FROM lineitem) "
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS distinct_values, "
                         f"round({c} / n * 100, 2) AS pct_unique, {c} = n AS is_unique_id FROM a"
                         for c in _LI_COLS),
    "c6_skew_lineitem": f"""SELECT column_name, skewness(x) AS skewness,
  CASE WHEN abs(skewness(x)) < 0.5 THEN 'low' WHEN abs(skewness(x)) < 1 THEN 'moderate' ELSE 'high' END AS level
  FROM {_LONG} GROUP BY column_name""",
    "c7_iqr_lineitem": f"""SELECT l.column_name, b.lower, b.upper,
  count_if(l.x < b.lower OR l.x > b.upper) AS outliers,
  round(count_if(l.x < b.lower OR l.x > b.upper) * 100.0 / count(*), 2) AS outlier_pct
  FROM {_LONG} l JOIN {_BOUNDS} b USING (column_name) GROUP BY l.column_name, b.lower, b.upper""",
    "c8_outlier_vs_label_lineitem": f"""WITH b AS {_BOUNDS},
f AS (SELECT CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS target, ("""
    + " OR ".join(f"coalesce({c} < (SELECT lower FROM b WHERE column_name = '{c}') "
                  f"OR {c} > (SELECT upper FROM b WHERE column_name = '{c}'), false)" for c in MEASURES)
    + """) AS any_outlier FROM lineitem)
SELECT any_outlier, count(*) AS rows, sum(target) AS failures, round(avg(target) * 100, 2) AS failure_rate_pct
  FROM f GROUP BY any_outlier""",
    "c9_class_share_lineitem": """SELECT target, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct
  FROM (SELECT CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS target FROM lineitem) GROUP BY target""",
    "c10_corr_lineitem": " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({a}, {b}) AS pearson, "
        f"abs(corr({a}, {b})) >= 0.8 AS strong FROM lineitem" for a, b in _PAIRS),
    "c11_rate_by_type_lineitem": """SELECT l_returnflag, count(*) AS rows, sum(target) AS failures,
  round(avg(target) * 100, 2) AS failure_rate_pct
  FROM (SELECT *, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS target FROM lineitem) GROUP BY l_returnflag""",
    "c5_cardinality_sketch_lineitem": "WITH a AS (SELECT count(*) AS n, "
    + ", ".join(f"count(DISTINCT {c}) + max(CAST({c} IS NULL AS INTEGER)) AS {c}" for c in _LI_COLS)
    + " FROM lineitem) "
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, n AS rows, {c} AS distinct_values, true AS within_bound FROM a"
                         for c in _LI_COLS),
    "c8_extremes_events": """WITH l AS (SELECT CAST(event_type = 'error' AS INTEGER) AS failed, column_name, x FROM (UNPIVOT
    (SELECT event_type, CAST(value AS DOUBLE) AS value, CAST(user_id AS DOUBLE) AS user_id FROM events)
    ON value, user_id INTO NAME column_name VALUE x)),
b AS (SELECT column_name, q[1] - 1.5 * (q[2] - q[1]) AS lower, q[2] + 1.5 * (q[2] - q[1]) AS upper
  FROM (SELECT column_name, quantile_cont(x, [0.25, 0.75]) AS q FROM l GROUP BY column_name))
SELECT column_name, x < lower OR x > upper AS extreme, count(*) AS rows, sum(failed) AS failures,
  round(avg(failed) * 100, 2) AS failure_rate_pct FROM l JOIN b USING (column_name) GROUP BY ALL""",
    "c12_histogram_lineitem": f"""WITH l AS {_LONG},
m AS (SELECT column_name, min(x) AS lo, max(x) AS hi, avg(x) AS mean, quantile_cont(x, 0.5) AS median FROM l GROUP BY column_name),
b AS (SELECT l.column_name, CAST(CASE WHEN m.hi = m.lo THEN 0
        ELSE least(floor((l.x - m.lo) * 30 / (m.hi - m.lo)), 29) END AS INTEGER) AS bin, count(*) AS count
      FROM l JOIN m USING (column_name) GROUP BY ALL),
e AS (SELECT *, unnest(range(0, CASE WHEN hi = lo THEN 1 ELSE 30 END)) AS bin,
  CASE WHEN hi = lo THEN 0 ELSE least(floor((mean - lo) * 30 / (hi - lo)), 29) END AS at_mean,
  CASE WHEN hi = lo THEN 0 ELSE least(floor((median - lo) * 30 / (hi - lo)), 29) END AS at_median FROM m)
SELECT e.column_name, CAST(e.bin AS INTEGER) AS bin, lo + e.bin * ((hi - lo) / 30) AS lower, lo + (e.bin + 1) * ((hi - lo) / 30) AS upper,
  coalesce(count, 0) AS count, round(mean, 4) AS mean, median, concat_ws('+', CASE WHEN e.bin = at_mean THEN 'mean' END,
  CASE WHEN e.bin = at_median THEN 'median' END) AS marker
  FROM e LEFT JOIN b ON b.column_name = e.column_name AND b.bin = e.bin""",
    "c13_box_lineitem": f"""WITH l AS {_LONG_T},
q AS (SELECT target, column_name, quantile_cont(x, [0.25, 0.5, 0.75]) AS q FROM l GROUP BY ALL),
b AS (SELECT target, column_name, q[1] AS q1, q[2] AS median, q[3] AS q3,
        q[1] - 1.5 * (q[3] - q[1]) AS lower, q[3] + 1.5 * (q[3] - q[1]) AS upper FROM q)
SELECT target, column_name, q1, median, q3,
  min(CASE WHEN x >= lower AND x <= upper THEN x END) AS whisker_low,
  max(CASE WHEN x >= lower AND x <= upper THEN x END) AS whisker_high,
  count_if(NOT (x >= lower AND x <= upper)) AS outliers
  FROM l JOIN b USING (target, column_name) GROUP BY target, column_name, q1, median, q3""",
    "c14_transform_skew_events": f"""WITH v AS (SELECT CAST(value AS DOUBLE) AS x FROM events WHERE value IS NOT NULL),
s AS (SELECT skewness(x) AS raw, skewness(ln(1 + x)) AS log1p, skewness(sqrt(x)) AS sq FROM v),
g AS (SELECT lam, CASE WHEN lam = 0 THEN ln(x) ELSE (pow(x, lam) - 1) / lam END AS y, x
        FROM v, (SELECT unnest({_LAMBDAS}::DOUBLE[]) AS lam) WHERE x > 0),
p AS (SELECT lam, (lam - 1) * sum(ln(x)) - count(*) / 2.0 * ln(var_pop(y)) AS llf, skewness(y) AS sk
        FROM g GROUP BY lam),
best AS (SELECT * FROM p ORDER BY llf DESC, lam LIMIT 1)
SELECT 'raw' AS transform, raw AS skewness, CAST(NULL AS DOUBLE) AS lambda FROM s
UNION ALL SELECT 'log1p', log1p, NULL FROM s
UNION ALL SELECT 'sqrt', sq, NULL FROM s
UNION ALL SELECT 'boxcox', sk, lam FROM best""",
}
