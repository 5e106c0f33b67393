"""Registered drift queries: H1, H2, H11, H12, H17, H18."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra import config
from telemetra.functions.exprs import severity_higher
from telemetra.jobs.common import (MEASURES, SQL_CUR, SQL_REF, current_period, lineitem,
                                   reference_period, sql_edges, sql_unpivot)
from telemetra.operators import drift
from telemetra.sources.tables import table

PSI_W, PSI_C = config.DATA_LIMITS["psi_warning"], config.DATA_LIMITS["psi_critical"]
JS_W, JS_C = config.DATA_LIMITS["js_warning"], config.DATA_LIMITS["js_critical"]
CATEGORICAL = ["l_returnflag", "l_linestatus"]


def h1_profile_lineitem(spark, sf_dir):
    ref = reference_period(lineitem(spark, sf_dir))
    prof = drift.numeric_profile(ref, MEASURES)
    bins = drift.profile_bins(prof)
    return bins.join(prof.drop("bin_edges", "bin_proportions"), "column_name")


def h2_categorical_profile_lineitem(spark, sf_dir):
    ref = reference_period(lineitem(spark, sf_dir))
    return drift.categorical_profile(ref, CATEGORICAL)


def h11_psi_lineitem(spark, sf_dir):
    li = lineitem(spark, sf_dir)
    prof = drift.numeric_profile(reference_period(li), MEASURES)
    out = drift.psi(current_period(li), prof, MEASURES)
    return out.withColumn("status", severity_higher("psi", PSI_W, PSI_C))


def h12_js_lineitem(spark, sf_dir):
    li = lineitem(spark, sf_dir)
    prof = drift.categorical_profile(reference_period(li), CATEGORICAL)
    out = drift.js_divergence(current_period(li), prof, CATEGORICAL)
    return out.withColumn("status", severity_higher("js_divergence", JS_W, JS_C))


def _orders_split(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate")
    return o.where(year < 1998), o.where(year >= 1998).withColumn("batch_id", year)


def h17_drift_by_batch_orders(spark, sf_dir):
    ref, cur = _orders_split(spark, sf_dir)
    prof = drift.numeric_profile(ref, ["o_totalprice"])
    out = drift.psi(cur, prof, ["o_totalprice"], keys=["batch_id"])
    return out.withColumn("status", severity_higher("psi", PSI_W, PSI_C))


def h18_shift_sensitivity_orders(spark, sf_dir):
    ref, cur = _orders_split(spark, sf_dir)
    prof = drift.numeric_profile(ref, ["o_totalprice"])
    out = drift.shift_psi(cur, prof, "o_totalprice")
    return out.withColumn("status", severity_higher("psi", PSI_W, PSI_C))


def h18_pick_shift_orders(spark, sf_dir):
    """Shift factors that give a warning (target 0.15) and a critical (0.30)
    PSI, as the drift simulator picks them."""
    shifts = h18_shift_sensitivity_orders(spark, sf_dir)
    warn = drift.pick_shift(shifts, 0.1, 0.2, 0.15).withColumn("level", F.lit("warning"))
    crit = drift.pick_shift(shifts, 0.2, None, 0.30).withColumn("level", F.lit("critical"))
    return warn.unionByName(crit)


QUERIES = {
    "h1_profile_lineitem": h1_profile_lineitem,
    "h2_categorical_profile_lineitem": h2_categorical_profile_lineitem,
    "h11_psi_lineitem": h11_psi_lineitem,
    "h12_js_lineitem": h12_js_lineitem,
    "h17_drift_by_batch_orders": h17_drift_by_batch_orders,
    "h18_shift_sensitivity_orders": h18_shift_sensitivity_orders,
    "h18_pick_shift_orders": h18_pick_shift_orders,
}

# ------------------------------------------------------------------ oracle SQL
_REF_LONG = sql_unpivot(SQL_REF, MEASURES)
_CUR_LONG = sql_unpivot(SQL_CUR, MEASURES)


def _sql_profile_ctes(ref_long: str, keys: str = "column_name") -> str:
    """CTEs e (keys, edges), rp (keys, bin, proportion, edges)."""
    return f"""
rl AS {ref_long},
e AS {sql_edges('rl', keys)},
rb AS (SELECT {', '.join('rl.' + k.strip() for k in keys.split(','))},
              len(list_filter(e.edges, lambda z: z <= rl.x)) AS bin, count(*) AS n
         FROM rl JOIN e USING ({keys}) GROUP BY ALL),
ab AS (SELECT {keys}, edges, unnest(range(0, len(edges) + 1)) AS bin FROM e),
rp AS (SELECT ab.*, coalesce(rb.n, 0) / sum(coalesce(rb.n, 0)) OVER (PARTITION BY {keys}) AS proportion
         FROM ab LEFT JOIN rb USING ({keys}, bin))"""


def _sql_psi(cur_long: str, gk: str, status_w: float = PSI_W, status_c: float = PSI_C,
             extra_group: str = "") -> str:
    """Expects CTE rp; cur_long has (extra keys, column_name, x)."""
    eg = f"{extra_group}, " if extra_group else ""
    egc = f"cl.{extra_group}, " if extra_group else ""
    return f"""
cl AS {cur_long},
cb AS (SELECT {egc}cl.column_name, len(list_filter(e.edges, lambda z: z <= cl.x)) AS bin, count(*) AS n
         FROM cl JOIN e USING (column_name) GROUP BY ALL),
grp AS (SELECT DISTINCT {eg}column_name FROM cb),
g AS (SELECT grp.*, rp.bin, rp.proportion, coalesce(cb.n, 0) AS n
        FROM grp JOIN rp USING (column_name) LEFT JOIN cb USING ({eg}column_name, bin)),
t AS (SELECT *, greatest(n / sum(n) OVER (PARTITION BY {gk}), 1e-6) AS a0,
             greatest(proportion, 1e-6) AS e0 FROM g),
t2 AS (SELECT *, a0 / sum(a0) OVER (PARTITION BY {gk}) AS a,
              e0 / sum(e0) OVER (PARTITION BY {gk}) AS ee FROM t),
psi AS (SELECT {gk}, sum((a - ee) * ln(a / ee)) AS psi, CAST(sum(n) AS BIGINT) AS current_count
          FROM t2 GROUP BY {gk})
SELECT *, CASE WHEN psi >= {status_c} THEN 'critical' WHEN psi >= {status_w} THEN 'warning'
               ELSE 'stable' END AS status FROM psi"""


_ORD_REF = "(SELECT * FROM orders WHERE year(o_orderdate) < 1998)"
_ORD_CUR = "(SELECT *, year(o_orderdate) AS batch_id FROM orders WHERE year(o_orderdate) >= 1998)"
_ORD_REF_LONG = sql_unpivot(_ORD_REF, ["o_totalprice"])
_ORD_CUR_LONG = (f"(SELECT batch_id, 'o_totalprice' AS column_name, CAST(o_totalprice AS DOUBLE) AS x "
                 f"FROM {_ORD_CUR} WHERE o_totalprice IS NOT NULL)")

_SHIFT_SQL = f"""WITH {_sql_profile_ctes(_ORD_REF_LONG)},
sd AS (SELECT stddev_pop(x) AS s FROM rl),
f AS (SELECT i AS factor_id,
             CASE WHEN i = 399 THEN 2.0 ELSE 0.01 + i * ((2.0 - 0.01) / 399) END AS factor
        FROM range(0, 400) r(i)),
cur AS (SELECT CAST(o_totalprice AS DOUBLE) AS v FROM {_ORD_CUR} WHERE o_totalprice IS NOT NULL),
sh AS (SELECT f.factor_id, f.factor, cur.v + sd.s * f.factor AS x FROM f, cur, sd),
cb AS (SELECT sh.factor_id, len(list_filter(e.edges, lambda z: z <= sh.x)) AS bin, count(*) AS n
         FROM sh, e GROUP BY ALL),
g AS (SELECT f.factor_id, f.factor, rp.bin, rp.proportion, coalesce(cb.n, 0) AS n
        FROM f CROSS JOIN rp LEFT JOIN cb ON cb.factor_id = f.factor_id AND cb.bin = rp.bin),
t AS (SELECT *, greatest(n / sum(n) OVER (PARTITION BY factor_id), 1e-6) AS a0,
             greatest(proportion, 1e-6) AS e0 FROM g),
t2 AS (SELECT *, a0 / sum(a0) OVER (PARTITION BY factor_id) AS a,
              e0 / sum(e0) OVER (PARTITION BY factor_id) AS ee FROM t),
psi AS (SELECT factor_id, factor, sum((a - ee) * ln(a / ee)) AS psi FROM t2 GROUP BY factor_id, factor)"""

SQL = {
    "h1_profile_lineitem": f"""WITH {_sql_profile_ctes(_REF_LONG)},
st AS (SELECT column_name, count(*) AS count, min(x) AS minimum, max(x) AS maximum,
              avg(x) AS mean, stddev_pop(x) AS standard_deviation FROM rl GROUP BY column_name)
SELECT rp.column_name, CAST(rp.bin AS INTEGER) AS bin,
       CASE WHEN rp.bin > 0 THEN rp.edges[rp.bin] END AS lower_edge,
       CASE WHEN rp.bin < len(rp.edges) THEN rp.edges[rp.bin + 1] END AS upper_edge,
       rp.proportion, st.count, st.minimum, st.maximum, st.mean, st.standard_deviation
  FROM rp JOIN st USING (column_name)""",

    "h2_categorical_profile_lineitem": f"""WITH u AS (
  UNPIVOT (SELECT coalesce(CAST(l_returnflag AS VARCHAR), 'None') AS l_returnflag,
                  coalesce(CAST(l_linestatus AS VARCHAR), 'None') AS l_linestatus FROM {SQL_REF})
  ON l_returnflag, l_linestatus INTO NAME column_name VALUE category),
c AS (SELECT column_name, category, count(*) AS count FROM u GROUP BY ALL)
SELECT *, count / sum(count) OVER (PARTITION BY column_name) AS proportion FROM c""",

    "h11_psi_lineitem": f"WITH {_sql_profile_ctes(_REF_LONG)}," + _sql_psi(_CUR_LONG, "column_name"),

    "h12_js_lineitem": f"""WITH ru AS (
  UNPIVOT (SELECT coalesce(CAST(l_returnflag AS VARCHAR), 'None') AS l_returnflag,
                  coalesce(CAST(l_linestatus AS VARCHAR), 'None') AS l_linestatus FROM {SQL_REF})
  ON l_returnflag, l_linestatus INTO NAME column_name VALUE category),
cu AS (
  UNPIVOT (SELECT coalesce(CAST(l_returnflag AS VARCHAR), 'None') AS l_returnflag,
                  coalesce(CAST(l_linestatus AS VARCHAR), 'None') AS l_linestatus FROM {SQL_CUR})
  ON l_returnflag, l_linestatus INTO NAME column_name VALUE category),
rc AS (SELECT column_name, category, count(*) / sum(count(*)) OVER (PARTITION BY column_name) AS p
         FROM ru GROUP BY column_name, category),
cc AS (SELECT column_name, category, count(*) AS n FROM cu GROUP BY ALL),
b AS (SELECT coalesce(rc.column_name, cc.column_name) AS column_name,
             coalesce(rc.p, 0) AS p, coalesce(cc.n, 0) AS n
        FROM rc FULL OUTER JOIN cc ON rc.column_name = cc.column_name AND rc.category = cc.category),
t AS (SELECT column_name, p / sum(p) OVER (PARTITION BY column_name) AS e,
             n / sum(n) OVER (PARTITION BY column_name) AS a FROM b),
j AS (SELECT column_name,
             0.5 * (sum(CASE WHEN e > 0 THEN e * ln(e / ((e + a) / 2)) ELSE 0 END)
                  + sum(CASE WHEN a > 0 THEN a * ln(a / ((e + a) / 2)) ELSE 0 END)) AS js_divergence
        FROM t GROUP BY column_name)
SELECT *, CASE WHEN js_divergence >= {JS_C} THEN 'critical' WHEN js_divergence >= {JS_W} THEN 'warning'
               ELSE 'stable' END AS status FROM j""",

    "h17_drift_by_batch_orders": f"WITH {_sql_profile_ctes(_ORD_REF_LONG)},"
    + _sql_psi(_ORD_CUR_LONG, "batch_id, column_name", extra_group="batch_id"),

    "h18_shift_sensitivity_orders": _SHIFT_SQL + f"""
SELECT *, CASE WHEN psi >= {PSI_C} THEN 'critical' WHEN psi >= {PSI_W} THEN 'warning'
               ELSE 'stable' END AS status FROM psi""",

    "h18_pick_shift_orders": _SHIFT_SQL + f""",
s AS (SELECT *, CASE WHEN psi >= {PSI_C} THEN 'critical' WHEN psi >= {PSI_W} THEN 'warning'
                     ELSE 'stable' END AS status FROM psi),
w AS (SELECT *, 'warning' AS level FROM s WHERE psi >= 0.1 AND psi < 0.2
        ORDER BY abs(psi - 0.15), factor_id LIMIT 1),
c AS (SELECT *, 'critical' AS level FROM s WHERE psi >= 0.2 ORDER BY abs(psi - 0.30), factor_id LIMIT 1)
SELECT * FROM w UNION ALL SELECT * FROM c""",
}
