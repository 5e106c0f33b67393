"""Registered monitoring queries: H3-H10, H13-H16, E7.

Request log = ``events``: ``event_type`` is the endpoint path, ``value`` the
latency in ms, 'error' events answer 500, 'signup' events 422, the rest 200;
the instance count is the ``k`` field of the JSON ``props``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra import config
from telemetra.functions.exprs import rank_status, status_rank
from telemetra.jobs import drift_jobs
from telemetra.jobs.common import (MEASURES, SQL_CUR, SQL_REF, SQL_SCORED, current_period,
                                   lineitem, reference_period, scored_labels, sql_unpivot)
from telemetra.operators import drift
from telemetra.operators import evaluate as E
from telemetra.operators import monitor as M
from telemetra.sources.tables import table

THRESHOLD = 3000.0
SPLIT_EVENTS = "2024-01-15"


def request_log(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("ts").alias("timestamp"), F.col("event_id").cast("string").alias("request_id"),
        F.col("event_type").alias("path"),
        F.when(F.col("event_type") == "error", 500).when(F.col("event_type") == "signup", 422)
        .otherwise(200).alias("status_code"),
        F.col("value").alias("latency_ms"),
        F.get_json_object("props", "$.k").try_cast("int").alias("instance_count"))


def h4_window_events(spark, sf_dir):
    log = request_log(spark, sf_dir)
    as_of = M.latest(log, "timestamp")                 # one value
    w = M.trailing_window(log, "timestamp", as_of)
    return w.agg(F.count(F.lit(1)).alias("events"), F.min("timestamp").alias("first_ts"),
                 F.max("timestamp").alias("last_ts"), F.lit(as_of).cast(log.schema["timestamp"].dataType).alias("as_of"))


def h9_system_events(spark, sf_dir):
    return M.system_metrics(request_log(spark, sf_dir))


def h10_endpoints_events(spark, sf_dir):
    return M.endpoint_metrics(request_log(spark, sf_dir))


def h8_alerts_events(spark, sf_dir):
    return M.alerts(M.system_metric_rows(M.system_metrics(request_log(spark, sf_dir))))


def _scored_with_pred(spark, sf_dir):
    return E.apply_threshold(scored_labels(spark, sf_dir), "score", THRESHOLD)


def h3_model_reference_documents(spark, sf_dir):
    return M.model_reference(_scored_with_pred(spark, sf_dir), "y", "prediction", "score")


def e7_score_summary_documents(spark, sf_dir):
    return M.score_summary(scored_labels(spark, sf_dir), "score")


def _feature_events(df):
    """Production inputs as a dynamic-key map, as prediction events carry them: the third
    lines come without a tax, the fourth with text for the discount, and none with the
    weight."""
    kv = []
    for c in MEASURES + ["l_returnflag"]:
        value = F.col(c).cast("string")
        if c == "l_tax":
            value = F.when(F.col("l_linenumber") != 3, value)
        elif c == "l_discount":
            value = F.when(F.col("l_linenumber") == 4, "none").otherwise(value)
        kv += [F.lit(c), value]
    return df.select(F.create_map(*kv).alias("features"))


def h13_data_monitor_lineitem(spark, sf_dir):
    li = lineitem(spark, sf_dir)
    ref = reference_period(li)
    num = drift.numeric_profile(ref, MEASURES)
    cat = drift.categorical_profile(ref, ["l_returnflag"])
    return M.data_monitor(_feature_events(current_period(li)), "features", num, cat,
                          [*MEASURES, "l_weight"], ["l_returnflag"])


def _model_events(spark, sf_dir):
    log = request_log(spark, sf_dir)
    return log.select("timestamp", (F.col("latency_ms") >= 90).cast("int").alias("prediction"),
                      F.col("latency_ms").alias("anomaly_score"))


def h14_model_monitor_events(spark, sf_dir):
    ev = _model_events(spark, sf_dir)
    split = F.lit(SPLIT_EVENTS).cast("timestamp")
    ref = ev.where(F.col("timestamp") < split).agg(
        F.avg(F.col("prediction").cast("double")).alias("predicted_anomaly_rate"),
        F.avg("anomaly_score").alias("mean"), F.stddev_pop("anomaly_score").alias("standard_deviation"))
    return M.model_monitor(ev.where(F.col("timestamp") >= split), "prediction", "anomaly_score", ref)


def h15_decision_orders(spark, sf_dir):
    """Decision per yearly batch: the batch's worst drift status (H17) and the
    recall of a fixed rule on that year's lineitem as current performance."""
    status = drift_jobs.h17_drift_by_batch_orders(spark, sf_dir).select(
        "batch_id", F.col("status").alias("data_status"))
    li = lineitem(spark, sf_dir).select(
        F.year("l_shipdate").alias("batch_id"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("y"),
        (F.col("l_discount") >= 0.05).cast("int").alias("pred"))
    perf = E.confusion(li, "y", "pred", ["batch_id"]).select(
        "batch_id", F.col("recall").alias("current_performance"))
    return M.retraining_decision(status.join(perf, "batch_id", "left"), "data_status",
                                 "current_performance")


REPORT_THRESHOLD = 40.0


def h16_report_events(spark, sf_dir):
    """Full report on the last 24 hours of the request log against the log before:
    system, data (latency and endpoint as inputs) and model monitors, performance against
    the labels that came in (errors), alerts, statuses and the retraining decision."""
    log = request_log(spark, sf_dir)
    as_of = M.latest(log, "timestamp")
    kv = [F.lit("latency_ms"), F.col("latency_ms").cast("string"), F.lit("path"), F.col("path")]
    events = log.select("timestamp", "request_id", "path", "latency_ms", F.create_map(*kv).alias("features"),
                        (F.col("latency_ms") >= REPORT_THRESHOLD).cast("int").alias("prediction"),
                        F.col("latency_ms").alias("anomaly_score"))
    before = events.where(F.col("timestamp") < F.lit(as_of).cast(log.schema["timestamp"].dataType) - F.expr("INTERVAL 24 HOURS"))
    num = drift.numeric_profile(before, ["latency_ms"])
    cat = drift.categorical_profile(before, ["path"])
    ref = before.agg(F.avg(F.col("prediction").cast("double")).alias("predicted_anomaly_rate"),
                     F.avg("anomaly_score").alias("mean"), F.stddev_pop("anomaly_score").alias("standard_deviation"))
    labels = log.select("request_id", (F.col("path") == "error").cast("int").alias("y"))
    return M.full_report(log, events, "timestamp", as_of, num, cat, ["latency_ms"], ["path"], ref, labels)


QUERIES = {
    "h4_window_events": h4_window_events,
    "h9_system_events": h9_system_events,
    "h10_endpoints_events": h10_endpoints_events,
    "h8_alerts_events": h8_alerts_events,
    "h3_model_reference_documents": h3_model_reference_documents,
    "e7_score_summary_documents": e7_score_summary_documents,
    "h13_data_monitor_lineitem": h13_data_monitor_lineitem,
    "h14_model_monitor_events": h14_model_monitor_events,
    "h15_decision_orders": h15_decision_orders,
    "h16_report_events": h16_report_events,
}

# ------------------------------------------------------------------ oracle SQL
L = config.SYSTEM_LIMITS
_LOG = """(SELECT ts AS timestamp, event_type AS path,
  CASE WHEN event_type = 'error' THEN 500 WHEN event_type = 'signup' THEN 422 ELSE 200 END AS code,
  CAST(value AS DOUBLE) AS lat,
  coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS inst FROM events)"""


def _sev_hi(v, w, c):
    return f"CASE WHEN {v} >= {c} THEN 'critical' WHEN {v} >= {w} THEN 'warning' ELSE 'stable' END"


def _sev_lo(v, w, c):
    return f"CASE WHEN {v} < {c} THEN 'critical' WHEN {v} < {w} THEN 'warning' ELSE 'stable' END"


def _rank(s):
    return f"(CASE {s} WHEN 'critical' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END)"


def _sys(log: str) -> str:
    return f"""(SELECT *, {_sev_hi('error_rate', L['max_error_rate_warning'], L['max_error_rate_critical'])} AS error_rate_status,
  {_sev_lo('availability', L['min_availability_warning'], L['min_availability_critical'])} AS availability_status,
  {_sev_hi('latency_p95_ms', L['max_p95_latency_ms_warning'], L['max_p95_latency_ms_critical'])} AS latency_status
  FROM (SELECT request_count, processed_instances, error_count, error_count / request_count AS error_rate,
    avail / request_count AS availability, latency_mean_ms, latency_p95_ms,
    request_count / CASE WHEN nts >= 2 THEN greatest((epoch_us(t1) - epoch_us(t0)) / 6e7, 1.0) ELSE 1.0 END
      AS throughput_requests_per_minute
  FROM (SELECT count(*) AS request_count, CAST(sum(inst) AS BIGINT) AS processed_instances,
    count_if(code >= 400) AS error_count, count_if(code < 500) AS avail, avg(lat) AS latency_mean_ms,
    quantile_cont(lat, 0.95) AS latency_p95_ms, min(timestamp) AS t0, max(timestamp) AS t1,
    count(timestamp) AS nts FROM {log})))"""


_SYS = _sys(_LOG)
_SYS_FULL = f"""(SELECT *, CASE greatest({_rank('error_rate_status')}, {_rank('availability_status')},
  {_rank('latency_status')}) WHEN 2 THEN 'critical' WHEN 1 THEN 'warning' ELSE 'stable' END AS status
  FROM {_SYS})"""

_SCORED_P = f"(SELECT *, CAST(score >= {THRESHOLD} AS INTEGER) AS prediction FROM {SQL_SCORED})"
_SUMMARY = """SELECT avg(score) AS mean, stddev_pop(score) AS standard_deviation, min(score) AS minimum,
  max(score) AS maximum, count(score) AS count, quantile_cont(score, 0.05) AS p05,
  quantile_cont(score, 0.5) AS median, quantile_cont(score, 0.95) AS p95, quantile_cont(score, 0.97) AS p97,
  quantile_cont(score, 0.99) AS p99"""

_D = config.DATA_LIMITS


def _psi_js(ref_long: str, cur_long: str, ref_cat: str, cur_cat: str) -> str:
    """CTEs psi (column_name, psi) and js (js) of the current against the reference rows."""
    return f"""{drift_jobs._sql_profile_ctes(ref_long)},
cl AS {cur_long},
cb AS (SELECT cl.column_name, len(list_filter(e.edges, lambda z: z <= cl.x)) AS bin, count(*) AS n
         FROM cl JOIN e USING (column_name) GROUP BY ALL),
g AS (SELECT rp.column_name, rp.bin, rp.proportion, coalesce(cb.n, 0) AS n
        FROM rp LEFT JOIN cb USING (column_name, bin)),
t AS (SELECT *, greatest(n / sum(n) OVER (PARTITION BY column_name), 1e-6) AS a0,
             greatest(proportion, 1e-6) AS e0 FROM g),
t2 AS (SELECT *, a0 / sum(a0) OVER (PARTITION BY column_name) AS a,
              e0 / sum(e0) OVER (PARTITION BY column_name) AS ee FROM t),
psi AS (SELECT column_name, sum((a - ee) * ln(a / ee)) AS psi FROM t2 GROUP BY column_name),
rc AS (SELECT category, count(*) / sum(count(*)) OVER () AS p FROM {ref_cat} GROUP BY category),
cc AS (SELECT category, count(*) AS n FROM {cur_cat} GROUP BY category),
jb AS (SELECT coalesce(rc.p, 0) AS p, coalesce(cc.n, 0) AS n FROM rc FULL OUTER JOIN cc USING (category)),
jt AS (SELECT p / sum(p) OVER () AS e, n / sum(n) OVER () AS a FROM jb),
js AS (SELECT 0.5 * (sum(CASE WHEN e > 0 THEN e * ln(e / ((e + a) / 2)) ELSE 0 END)
                   + sum(CASE WHEN a > 0 THEN a * ln(a / ((e + a) / 2)) ELSE 0 END)) AS js FROM jt)"""


_PSI_ROW = f"""SELECT 'data' AS category, 'psi' AS metric, column_name AS subject, psi AS value,
        '{_D['psi_critical']}' AS threshold, {_sev_hi('psi', _D['psi_warning'], _D['psi_critical'])} AS status FROM psi"""


def _js_row(subject: str) -> str:
    return f"""SELECT 'data' AS category, 'js_divergence' AS metric, '{subject}' AS subject, js AS value,
        '{_D['js_critical']}' AS threshold, {_sev_hi('js', _D['js_warning'], _D['js_critical'])} AS status FROM js"""


_CUR_IN = f"""(SELECT * REPLACE (CASE WHEN l_linenumber <> 3 THEN l_tax END AS l_tax,
  CASE WHEN l_linenumber <> 4 THEN l_discount END AS l_discount) FROM {SQL_CUR})"""
_H13 = f"""WITH {_psi_js(sql_unpivot(SQL_REF, MEASURES), sql_unpivot(_CUR_IN, MEASURES),
    f"(SELECT l_returnflag AS category FROM {SQL_REF})", f"(SELECT l_returnflag AS category FROM {SQL_CUR})")},
m AS ({_PSI_ROW} UNION ALL {_js_row('l_returnflag')}
""" + "".join(f"""  UNION ALL SELECT 'data', 'missing_rate', '{c}', avg(CAST({c} IS NULL AS INTEGER)), NULL, 'stable' FROM {_CUR_IN}
  UNION ALL SELECT 'data', 'production_mean', '{c}', avg({c}), NULL, 'stable' FROM {_CUR_IN}
  UNION ALL SELECT 'data', 'reference_mean', '{c}', avg({c}), NULL, 'stable' FROM {SQL_REF}
""" for c in MEASURES) + f"""  UNION ALL SELECT 'data', 'missing_column', 'l_weight', NULL, 'column_required', 'critical')
SELECT * FROM m UNION ALL
SELECT 'data', 'rows', 'production', (SELECT count(*) FROM {SQL_CUR}), '30',
  CASE max({_rank('status')}) WHEN 2 THEN 'critical' WHEN 1 THEN 'warning' ELSE 'stable' END FROM m"""

_MD = config.MODEL_LIMITS
_H14 = f"""WITH ev AS (SELECT ts, CAST(value >= 90 AS INTEGER) AS p, CAST(value AS DOUBLE) AS s FROM events),
ref AS (SELECT avg(p) AS reference_anomaly_rate, avg(s) AS reference_score_mean, stddev_pop(s) AS rsd
          FROM ev WHERE ts < TIMESTAMP '{SPLIT_EVENTS}'),
cur AS (SELECT count(*) AS production_rows, count_if(p = 1) AS anomaly_count, count_if(p = 0) AS normal_count,
          avg(p) AS anomaly_rate, avg(s) AS score_mean, stddev_pop(s) AS score_standard_deviation,
          min(s) AS score_minimum, max(s) AS score_maximum, quantile_cont(s, 0.5) AS score_median,
          quantile_cont(s, 0.95) AS score_p95 FROM ev WHERE ts >= TIMESTAMP '{SPLIT_EVENTS}'),
o AS (SELECT cur.*, ref.reference_anomaly_rate, ref.reference_score_mean,
        abs(anomaly_rate - reference_anomaly_rate) AS anomaly_rate_absolute_difference,
        CASE WHEN rsd > 0 THEN abs(score_mean - reference_score_mean) / rsd ELSE 0.0 END
          AS mean_shift_standard_deviations FROM cur, ref),
o2 AS (SELECT *, {_sev_hi('anomaly_rate_absolute_difference', _MD['anomaly_rate_difference_warning'], _MD['anomaly_rate_difference_critical'])} AS anomaly_rate_status,
  {_sev_hi('mean_shift_standard_deviations', _MD['score_mean_shift_warning'], _MD['score_mean_shift_critical'])} AS score_shift_status FROM o)
SELECT *, CASE WHEN production_rows = 0 THEN 'no_data' WHEN production_rows < 30 THEN 'insufficient_data'
  ELSE CASE greatest({_rank('anomaly_rate_status')}, {_rank('score_shift_status')}) WHEN 2 THEN 'critical'
  WHEN 1 THEN 'warning' ELSE 'stable' END END AS status FROM o2"""

_R = config.RETRAINING
_LIMIT = float(_R["reference_performance"]) * (1 - float(_R["maximum_relative_drop"]))
_ALERT_TEXT = "(VALUES " + ", ".join(
    "('{}', '{}', '{}', '{}')".format(c, m, msg.replace("'", "''"), act.replace("'", "''"))
    for (c, m), (msg, act) in M.ALERT_TEXT.items()) + ") t(category, metric, message, recommended_action)"
_WIN = f"(SELECT l.* FROM {_LOG} l WHERE timestamp >= (SELECT max(ts) FROM events) - INTERVAL 24 HOURS)"
_OLD = f"(SELECT l.* FROM {_LOG} l WHERE timestamp < (SELECT max(ts) FROM events) - INTERVAL 24 HOURS)"
_LAT = "(SELECT 'latency_ms' AS column_name, lat AS x FROM {} WHERE lat IS NOT NULL AND NOT isnan(lat))"
_H16 = f"""WITH {_psi_js(_LAT.format(_OLD), _LAT.format(_WIN), f"(SELECT path AS category FROM {_OLD})",
                         f"(SELECT path AS category FROM {_WIN})")},
s AS {_sys(_WIN)},
mo AS (SELECT abs(a.r - b.r) AS diff, CASE WHEN b.sd > 0 THEN abs(a.m - b.m) / b.sd ELSE 0.0 END AS shift, a.n FROM
  (SELECT avg(CAST(lat >= {REPORT_THRESHOLD} AS INTEGER)) AS r, avg(lat) AS m, count(*) AS n FROM {_WIN}) a,
  (SELECT avg(CAST(lat >= {REPORT_THRESHOLD} AS INTEGER)) AS r, avg(lat) AS m, stddev_pop(lat) AS sd FROM {_OLD}) b),
ms AS (SELECT *, {_sev_hi('diff', _MD['anomaly_rate_difference_warning'], _MD['anomaly_rate_difference_critical'])} AS ds,
  {_sev_hi('shift', _MD['score_mean_shift_warning'], _MD['score_mean_shift_critical'])} AS ss FROM mo),
cf AS (SELECT count_if(path = 'error' AND lat >= {REPORT_THRESHOLD}) AS tp, count_if(path = 'error' AND lat < {REPORT_THRESHOLD}) AS fn,
  count_if(path <> 'error' AND lat >= {REPORT_THRESHOLD}) AS fp, count_if(path <> 'error' AND lat < {REPORT_THRESHOLD}) AS tn FROM {_WIN}),
d0 AS ({_PSI_ROW} UNION ALL {_js_row('path')}
  UNION ALL SELECT 'data', 'missing_rate', 'latency_ms', avg(CAST(lat IS NULL AS INTEGER)), NULL, 'stable' FROM {_WIN}
  UNION ALL SELECT 'data', 'production_mean', 'latency_ms', avg(lat), NULL, 'stable' FROM {_WIN}
  UNION ALL SELECT 'data', 'reference_mean', 'latency_ms', avg(lat), NULL, 'stable' FROM {_OLD}),
m AS (SELECT * FROM d0
  UNION ALL SELECT 'data', 'rows', 'production', (SELECT n FROM mo), '30',
    CASE max({_rank('status')}) WHEN 2 THEN 'critical' WHEN 1 THEN 'warning' ELSE 'stable' END FROM d0
  UNION ALL SELECT 'system', 'error_rate', 'service', error_rate, '{float(L['max_error_rate_critical'])}', error_rate_status FROM s
  UNION ALL SELECT 'system', 'availability', 'service', availability, '{float(L['min_availability_warning'])}', availability_status FROM s
  UNION ALL SELECT 'system', 'latency_p95_ms', 'service', latency_p95_ms, '{float(L['max_p95_latency_ms_critical'])}', latency_status FROM s
  UNION ALL SELECT 'model', 'anomaly_rate_difference', 'production', diff, '{_MD['anomaly_rate_difference_critical']}', ds FROM ms
  UNION ALL SELECT 'model', 'score_mean_shift', 'production', shift, '{_MD['score_mean_shift_critical']}', ss FROM ms
  UNION ALL SELECT 'model', 'rows', 'production', n, '30',
    CASE greatest({_rank('ds')}, {_rank('ss')}) WHEN 2 THEN 'critical' WHEN 1 THEN 'warning' ELSE 'stable' END FROM ms
  UNION ALL SELECT 'performance', 'labelled_rows', 'labelled', tp + fn + fp + tn, NULL, 'stable' FROM cf
  UNION ALL SELECT 'performance', 'precision', 'labelled', CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, NULL, 'stable' FROM cf
  UNION ALL SELECT 'performance', 'recall', 'labelled', CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END, NULL, 'stable' FROM cf
  UNION ALL SELECT 'performance', 'false_positive_rate', 'labelled', CASE WHEN fp + tn = 0 THEN 0 ELSE fp / (fp + tn) END, NULL, 'stable' FROM cf
  UNION ALL SELECT 'performance', 'f1_score', 'labelled', CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, NULL, 'stable' FROM cf),
st AS (SELECT 'system' AS category, CASE greatest({_rank('error_rate_status')}, {_rank('availability_status')}, {_rank('latency_status')})
    WHEN 2 THEN 'critical' WHEN 1 THEN 'warning' ELSE 'stable' END AS status FROM s
  UNION ALL SELECT category, status FROM m WHERE metric = 'rows'),
sa AS (SELECT * FROM st UNION ALL SELECT 'overall', CASE max({_rank('status')}) WHEN 2 THEN 'critical' WHEN 1 THEN 'warning'
  ELSE 'stable' END FROM st),
dc AS (SELECT (SELECT status FROM st WHERE category = 'data') AS ds, (SELECT value FROM m WHERE metric = 'recall') AS v)
SELECT 'metric' AS kind, *, CAST(NULL AS VARCHAR) AS message, CAST(NULL AS VARCHAR) AS recommended_action FROM m
UNION ALL SELECT 'alert', m.*, t.message, t.recommended_action FROM m LEFT JOIN {_ALERT_TEXT} USING (category, metric)
  WHERE m.status IN ('warning', 'critical')
UNION ALL SELECT 'status', category, NULL, NULL, NULL, NULL, status, NULL, NULL FROM sa
UNION ALL SELECT 'decision', 'retraining', 'recall', NULL, v, '{_LIMIT}', CASE WHEN ds <> 'critical' THEN 'continue_monitoring'
  WHEN v IS NULL THEN 'investigate_drift' WHEN v <= {_LIMIT} THEN 'evaluate_retraining' ELSE 'continue_monitoring' END, NULL, NULL FROM dc"""
_H17 = drift_jobs.SQL["h17_drift_by_batch_orders"]

SQL = {
    "h4_window_events": """WITH m AS (SELECT max(ts) AS as_of FROM events)
SELECT count(*) AS events, min(ts) AS first_ts, max(ts) AS last_ts, max(m.as_of) AS as_of
  FROM events, m WHERE ts >= m.as_of - INTERVAL 24 HOURS""",
    "h9_system_events": f"SELECT * FROM {_SYS_FULL}",
    "h10_endpoints_events": f"""SELECT path, count(*) AS request_count, avg(CAST(code >= 400 AS DOUBLE)) AS error_rate,
  avg(lat) AS latency_mean_ms, quantile_cont(lat, 0.95) AS latency_p95_ms FROM {_LOG}
  WHERE path IS NOT NULL GROUP BY path""",
    "h8_alerts_events": f"""WITH s AS {_SYS},
m AS (SELECT 'system' AS category, 'error_rate' AS metric, 'service' AS subject, error_rate AS value,
        '{float(L['max_error_rate_critical'])}' AS threshold, error_rate_status AS severity FROM s
  UNION ALL SELECT 'system', 'availability', 'service', availability, '{float(L['min_availability_warning'])}',
        availability_status FROM s
  UNION ALL SELECT 'system', 'latency_p95_ms', 'service', latency_p95_ms,
        '{float(L['max_p95_latency_ms_critical'])}', latency_status FROM s),
t AS (SELECT * FROM (VALUES """ + ", ".join(
        "('{}', '{}', '{}', '{}')".format(c, m, msg.replace("'", "''"), act.replace("'", "''"))
        for (c, m), (msg, act) in M.ALERT_TEXT.items()) + """) t(category, metric, message, recommended_action))
SELECT m.category, m.metric, m.subject, m.severity, m.value, m.threshold, t.message, t.recommended_action
  FROM m LEFT JOIN t USING (category, metric) WHERE m.severity IN ('warning', 'critical')""",
    "h3_model_reference_documents": f"""SELECT count(*) AS row_count, avg(CAST(y AS DOUBLE)) AS observed_failure_rate,
  avg(CAST(prediction AS DOUBLE)) AS predicted_anomaly_rate,
  avg(CASE WHEN y = 0 THEN CAST(prediction AS DOUBLE) END) AS false_positive_rate,
  {_SUMMARY.replace('SELECT ', '')} FROM {_SCORED_P}""",
    "e7_score_summary_documents": f"{_SUMMARY} FROM {SQL_SCORED}",
    "h13_data_monitor_lineitem": _H13,
    "h16_report_events": _H16,
    "h14_model_monitor_events": _H14,
    "h15_decision_orders": f"""WITH st AS ({_H17}),
li AS (SELECT year(l_shipdate) AS batch_id, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS y,
         CAST(l_discount >= 0.05 AS INTEGER) AS pred FROM lineitem),
pf AS (SELECT batch_id, CASE WHEN count_if(y = 1) = 0 THEN 0
         ELSE count_if(y = 1 AND pred = 1) / count_if(y = 1) END AS current_performance FROM li GROUP BY batch_id),
b AS (SELECT st.batch_id, st.status AS data_status, pf.current_performance FROM st LEFT JOIN pf USING (batch_id))
SELECT *, CAST({_LIMIT} AS DOUBLE) AS performance_threshold,
  CASE WHEN data_status <> 'critical' THEN 'continue_monitoring'
       WHEN current_performance IS NULL THEN 'investigate_drift'
       WHEN current_performance <= {_LIMIT} THEN 'evaluate_retraining' ELSE 'continue_monitoring' END AS decision,
  (CASE WHEN data_status <> 'critical' THEN 'continue_monitoring'
       WHEN current_performance IS NULL THEN 'investigate_drift'
       WHEN current_performance <= {_LIMIT} THEN 'evaluate_retraining' ELSE 'continue_monitoring' END)
    = 'evaluate_retraining' AS recommended,
  false AS automatic_retraining FROM b""",
}
