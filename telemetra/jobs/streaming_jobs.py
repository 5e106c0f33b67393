"""Registered streaming queries: S1-S5.

Each drains a file-source stream over the table's folder with an
``availableNow`` trigger into a checkpointed parquet sink and returns the sink
as a DataFrame.  Append mode emits a window once the watermark (max event
time - delay) passes its end, so the oracle keeps exactly those windows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.functions.exprs import severity_higher
from telemetra.jobs.common import MEASURES, SQL_REF, reference_period, sql_unpivot
from telemetra.jobs.drift_jobs import PSI_C, PSI_W, _sql_profile_ctes
from telemetra.operators import drift
from telemetra.operators import features as D
from telemetra.operators import quality as Q
from telemetra.session import cut_lineage
from telemetra.sources.tables import table
from telemetra.streaming import stream as S


def _event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    st = S.read_stream(spark, sf_dir, schema, file_glob="events.parquet")
    return st.select(
        F.col("ts").cast("timestamp").alias("timestamp"), "user_id",
        F.col("event_type").alias("path"),
        F.when(F.col("event_type") == "error", 500).when(F.col("event_type") == "signup", 422)
        .otherwise(200).alias("status_code"),
        F.col("value").alias("latency_ms"))


def s1_windows_events(spark, sf_dir):
    """Hourly panes from the stream, 24 of them to a sliding window; p95 from the merged
    buckets, within 1 % of the value at its rank."""
    panes, audit = S.run_available_now(S.endpoint_panes(_event_stream(spark, sf_dir)), "s1")
    return S.sliding_windows(panes, S.last_watermark(audit))


def s2_bin_counts_events(spark, sf_dir):
    """Hourly counts of latency per reference bin (profile = events before
    2024-01-15), ready for a per-window PSI."""
    ev = table(spark, sf_dir, "events")
    ref = ev.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp")).select(
        F.col("value").alias("latency_ms"))
    prof = drift.numeric_profile(ref, ["latency_ms"])
    counts = S.windowed_bin_counts(_event_stream(spark, sf_dir), prof, "latency_ms", "timestamp")
    out, _ = S.run_available_now(counts, "s2")
    return out


S2_COLUMNS = ["latency_ms", "user_id"]


def s2_window_psi_events(spark, sf_dir):
    """PSI and severity per closed hour and column against the events before
    2024-01-15."""
    ev = table(spark, sf_dir, "events")
    ref = ev.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp")).select(
        F.col("value").alias("latency_ms"), "user_id")
    prof = drift.numeric_profile(ref, S2_COLUMNS)
    sink = S.WindowPsi(prof, S.scratch_location(spark, "s2_psi"))
    S.run_batches(S.column_bin_counts(_event_stream(spark, sf_dir), prof, S2_COLUMNS, "timestamp"), "s2_psi", sink)
    return sink.result(spark).withColumn("status", severity_higher("psi", PSI_W, PSI_C))


def s4_late_events(spark, sf_dir):
    """Rows behind the watermark in every micro-batch: events are delivered ``value``
    minutes times ten after they happened, in slices of five days of arrival, and
    de-duplicated within a watermark of one hour."""
    ev = table(spark, sf_dir, "events")
    arrival = F.unix_micros(F.col("ts").cast("timestamp")) + (F.coalesce("value", F.lit(0.0)) * 600_000_000).cast("long")
    sliced = ev.select("event_id", F.col("ts").cast("timestamp").alias("timestamp"),
                       F.floor(arrival / (5 * 86_400_000_000)).alias("slice"))
    folder = S.arrival_files(sliced, "slice", S.scratch_location(spark, "s4_arrival"))
    st = S.read_stream(spark, folder, sliced.drop("slice").schema, file_glob="slice-*.parquet", max_files_per_trigger=1)
    _, audit = S.run_available_now(S.dedup_requests(st, ["event_id"]), "s4")
    return S.late_rows(audit)


def s3_dedup_events(spark, sf_dir):
    """One row per (user, endpoint, minute): retried deliveries dropped."""
    st = _event_stream(spark, sf_dir).withColumn(
        "minute", F.date_trunc("minute", F.col("timestamp")))
    out, _ = S.run_available_now(
        S.dedup_requests(st, ["user_id", "path", "minute"]), "s3")
    return out.select("user_id", "path", "minute")


def s5_scoring_lineitem(spark, sf_dir):
    """Streaming scoring: contract check, quarantine of violating rows, robust
    z-scores with frozen parameters (fitted on the reference period) and a
    flag when any |z| exceeds 3.  The sinks hold the whole rows (scaled measures and
    flag; given values and violations) and are read back and counted."""
    li = table(spark, sf_dir, "lineitem")
    params = cut_lineage(D.fit_robust_scaler(reference_period(li), MEASURES))
    st = S.read_stream(spark, sf_dir, li.schema, file_glob="lineitem.parquet")
    checked = Q.contract_violations(st, "l_returnflag", ["A", "N"], ["l_quantity", "l_extendedprice"],
                                    ["l_discount", "l_tax"])
    flag = F.greatest(*[F.abs(F.col(c)) for c in MEASURES]) > 3

    def scored(batch):
        valid, _ = S.split_contract(batch)
        return D.apply_robust_scaler(valid, params, MEASURES).withColumn("prediction", flag.cast("int"))

    sink = S.SplitSink(S.scratch_location(spark, "s5_sinks"), {"scored": scored, "quarantine": lambda batch: S.split_contract(batch)[1]})
    S.run_batches(checked.drop("valid"), "s5", sink)
    return (sink.result(spark, "scored").groupBy(F.lit("scored").alias("sink"), "prediction").agg(F.count(F.lit(1)).alias("rows"))
            .unionByName(sink.result(spark, "quarantine").groupBy(
                F.lit("quarantine").alias("sink"), F.lit(None).cast("int").alias("prediction"))
                .agg(F.count(F.lit(1)).alias("rows"))))


QUERIES = {
    "s1_windows_events": s1_windows_events,
    "s2_bin_counts_events": s2_bin_counts_events,
    "s2_window_psi_events": s2_window_psi_events,
    "s3_dedup_events": s3_dedup_events,
    "s4_late_events": s4_late_events,
    "s5_scoring_lineitem": s5_scoring_lineitem,
}

_EV = """(SELECT ts, user_id, event_type AS path,
  CASE WHEN event_type = 'error' THEN 500 WHEN event_type = 'signup' THEN 422 ELSE 200 END AS code,
  CAST(value AS DOUBLE) AS lat FROM events)"""

_G = (1 + S.ACCURACY) / (1 - S.ACCURACY)
_S2_EVENTS = "(SELECT ts, CAST(value AS DOUBLE) AS latency_ms, CAST(user_id AS DOUBLE) AS user_id FROM events)"
_S2_REF = sql_unpivot(f"(SELECT * FROM {_S2_EVENTS} WHERE ts < TIMESTAMP '2024-01-15')", S2_COLUMNS)

SQL = {
    "s2_window_psi_events": f"""WITH {_sql_profile_ctes(_S2_REF)},
ev AS (SELECT date_trunc('hour', ts) AS window_start, column_name, x FROM (UNPIVOT {_S2_EVENTS}
    ON {', '.join(S2_COLUMNS)} INTO NAME column_name VALUE x) WHERE NOT isnan(x)),
lim AS (SELECT max(ts) - INTERVAL 10 MINUTES AS wm FROM events),
cb AS (SELECT window_start, ev.column_name, len(list_filter(e.edges, lambda z: z <= ev.x)) AS bin, count(*) AS n
  FROM ev JOIN e USING (column_name), lim WHERE window_start + INTERVAL 1 HOUR <= lim.wm GROUP BY ALL),
g AS (SELECT k.window_start, rp.column_name, rp.bin, rp.proportion, coalesce(cb.n, 0) AS n
  FROM (SELECT DISTINCT window_start, column_name FROM cb) k JOIN rp USING (column_name)
  LEFT JOIN cb ON cb.window_start = k.window_start AND cb.column_name = rp.column_name AND cb.bin = rp.bin),
t AS (SELECT *, greatest(n / sum(n) OVER own, 1e-6) AS a0, greatest(proportion, 1e-6) AS e0 FROM g
  WINDOW own AS (PARTITION BY window_start, column_name)),
t2 AS (SELECT *, a0 / sum(a0) OVER own AS a, e0 / sum(e0) OVER own AS ee FROM t
  WINDOW own AS (PARTITION BY window_start, column_name)),
p AS (SELECT window_start, column_name, sum((a - ee) * ln(a / ee)) AS psi, CAST(sum(n) AS BIGINT) AS current_count
  FROM t2 GROUP BY ALL)
SELECT *, CASE WHEN psi >= {PSI_C} THEN 'critical' WHEN psi >= {PSI_W} THEN 'warning' ELSE 'stable' END AS status FROM p""",
    "s1_windows_events": f"""WITH e AS {_EV},
w AS (SELECT e.*, date_trunc('hour', ts) - to_hours(k) AS window_start,
    CASE WHEN lat = 0 THEN 0.0 ELSE sign(lat) * 2 * pow({_G}, ceil(ln(abs(lat)) / ln({_G}))) / ({_G} + 1) END AS bucket
  FROM e, range(0, 24) r(k)),
lim AS (SELECT max(ts) - INTERVAL 10 MINUTES AS wm FROM e),
b AS (SELECT window_start, path, bucket, count(lat) AS n FROM w WHERE lat IS NOT NULL AND NOT isnan(lat) GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY window_start, path ORDER BY bucket) AS upto,
    sum(n) OVER (PARTITION BY window_start, path) AS total FROM b),
p AS (SELECT window_start, path, min(bucket) AS p95 FROM c WHERE upto > 0.95 * (total - 1) GROUP BY ALL),
a AS (SELECT window_start, path, count(*) AS requests, count_if(code >= 400) AS errors, avg(lat) AS mean
  FROM w GROUP BY window_start, path)
SELECT window_start, window_start + INTERVAL 24 HOURS AS window_end, path, requests, errors, mean AS latency_mean_ms,
  p95 AS latency_p95_ms FROM a LEFT JOIN p USING (window_start, path), lim WHERE window_start + INTERVAL 24 HOURS <= lim.wm""",
    "s2_bin_counts_events": """WITH rl AS (SELECT CAST(value AS DOUBLE) AS x FROM events
    WHERE ts < TIMESTAMP '2024-01-15' AND value IS NOT NULL AND NOT isnan(value)),
e AS (SELECT qs[2:len(qs)-1] AS edges FROM (SELECT list_sort(list_distinct(quantile_cont(x,
    [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS qs FROM rl)),
lim AS (SELECT max(ts) - INTERVAL 10 MINUTES AS wm FROM events)
SELECT date_trunc('hour', ts) AS window_start,
  CAST(len(list_filter(e.edges, lambda z: z <= CAST(value AS DOUBLE))) AS INTEGER) AS bin, count(*) AS n
  FROM events, e, lim WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= lim.wm GROUP BY ALL""",
    # a micro-batch drops what lies behind the watermark that the batch before it had
    "s4_late_events": """WITH e AS (SELECT ts, dense_rank() OVER (ORDER BY floor((epoch_us(ts)
    + CAST(trunc(coalesce(value, 0) * 600000000) AS BIGINT)) / 432000000000)) - 1 AS batch_id FROM events),
b AS (SELECT batch_id, count(*) AS input_rows, max(ts) AS top FROM e GROUP BY batch_id),
w AS (SELECT batch_id, input_rows, date_trunc('milliseconds', max(top) OVER (ORDER BY batch_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING)) - INTERVAL 1 HOUR AS mark FROM b)
SELECT batch_id, any_value(input_rows) AS input_rows, count_if(coalesce(ts <= mark, false)) AS late_rows
  FROM e JOIN w USING (batch_id) GROUP BY batch_id""",
    "s3_dedup_events": f"""SELECT DISTINCT user_id, path, date_trunc('minute', ts) AS minute FROM {_EV}""",
    "s5_scoring_lineitem": f"""WITH p AS (SELECT column_name, q[2] AS c, CASE WHEN q[3] - q[1] = 0 THEN 1.0 ELSE q[3] - q[1] END AS s
  FROM (SELECT column_name, quantile_cont(x, [0.25, 0.5, 0.75]) AS q FROM (UNPIVOT (SELECT {', '.join(MEASURES)} FROM {SQL_REF})
    ON {', '.join(MEASURES)} INTO NAME column_name VALUE x) GROUP BY column_name)),
v AS (SELECT *, (l_returnflag IS NULL OR l_returnflag NOT IN ('A', 'N') OR l_quantity IS NULL OR l_quantity <= 0
    OR l_extendedprice IS NULL OR l_extendedprice <= 0 OR l_discount IS NULL OR l_discount < 0
    OR l_tax IS NULL OR l_tax < 0) AS bad FROM lineitem),
z AS (SELECT CAST(greatest(""" + ", ".join(
        f"abs((CAST({c} AS DOUBLE) - (SELECT c FROM p WHERE column_name = '{c}')) / (SELECT s FROM p WHERE column_name = '{c}'))"
        for c in MEASURES) + """) > 3 AS INTEGER) AS prediction FROM v WHERE NOT bad)
SELECT 'scored' AS sink, prediction, count(*) AS rows FROM z GROUP BY prediction
UNION ALL SELECT 'quarantine', CAST(NULL AS INTEGER), count(*) FROM v WHERE bad""",
}
