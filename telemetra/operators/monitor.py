"""Monitoring H3-H10, H13-H16.

The reference keeps a mutable alert list; here every monitor produces rows of
one metric table ``(category, metric, subject, value, threshold, status)``;
alerts, the worst-of status and the retraining decision are derived from it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra import config
from telemetra.functions.exprs import (present_double, rank_status, severity_higher,
                                       severity_lower, status_rank)
from telemetra.operators import drift
from telemetra.plans.hscan import exact_quantiles
from telemetra.session import cut_lineage

METRIC_SCHEMA = ("category string, metric string, subject string, value double, "
                 "threshold string, status string")


# ------------------------------------------------------------------ H4 ----
def latest(df: DataFrame, ts: str):
    """The last parsable timestamp (one value, for ``as_of``); None on an empty log."""
    return df.agg(F.max(_instant(df, ts))).first()[0]


def _instant(df: DataFrame, ts: str) -> Column:
    return F.expr(f"try_to_timestamp(`{ts}`)") if dict(df.dtypes)[ts] == "string" else F.col(ts)


def trailing_window(df: DataFrame, ts: str, as_of, hours: int = config.WINDOW_HOURS) -> DataFrame:
    """Events with a parsable timestamp inside [as_of - hours, as_of].  ``as_of`` is a
    parameter (text, datetime or Column), never the wall clock, so a re-run gives the same
    answer; as a literal its bounds reach the scan.  None keeps nothing."""
    t = _instant(df, ts)
    if as_of is None:
        return df.where(F.lit(False))
    hi = as_of if isinstance(as_of, Column) else F.lit(as_of)
    hi = hi.cast(df.schema[ts].dataType if dict(df.dtypes)[ts] != "string" else "timestamp")
    return df.where(t.isNotNull() & (t >= hi - F.expr(f"INTERVAL {int(hours)} HOURS")) & (t <= hi))


# ------------------------------------------------------------------ H9 ----
def system_metrics(events: DataFrame, ts: str = "timestamp", status: str = "status_code",
                   latency: str = "latency_ms", instances: str = "instance_count",
                   limits: dict = config.SYSTEM_LIMITS) -> DataFrame:
    """One row: request_count, processed_instances, error_count, error_rate,
    availability, latency_mean_ms, latency_p95_ms, throughput per minute and
    the three severities plus their worst.  Status codes are read as numbers
    ("500.0" is 500); NULL, NaN and other text count in neither errors nor
    availability, and such latencies in neither mean nor p95; NULL instances
    count 0.  Without events the row has NULL rates and every status is
    ``no_data``."""
    code = present_double(status)
    lat = present_double(latency)
    base = events.select(F.col(ts).alias("_ts"), code.alias("_code"), lat.alias("_lat"),
                         F.coalesce(F.col(instances).try_cast("long"), F.lit(0)).alias("_inst"))
    agg = base.agg(
        F.count(F.lit(1)).alias("request_count"), F.sum("_inst").alias("processed_instances"),
        F.count_if(F.col("_code") >= 400).alias("error_count"),
        F.count_if(F.col("_code") < 500).alias("_avail"), F.avg("_lat").alias("latency_mean_ms"),
        F.min("_ts").alias("_t0"), F.max("_ts").alias("_t1"), F.count("_ts").alias("_nts"))
    p95 = exact_quantiles(base.select(F.col("_lat").alias("x")), [], "x", [0.95]).agg(
        F.max("q").alias("latency_p95_ms"))
    minutes = F.when(F.col("_nts") >= 2, F.greatest(
        (F.unix_micros(F.col("_t1").cast("timestamp"))
         - F.unix_micros(F.col("_t0").cast("timestamp"))) / 6e7, F.lit(1.0))).otherwise(1.0)
    out = agg.crossJoin(p95).select(
        "request_count", "processed_instances", "error_count",
        F.try_divide("error_count", "request_count").alias("error_rate"),
        F.try_divide("_avail", "request_count").alias("availability"),
        "latency_mean_ms", "latency_p95_ms",
        (F.col("request_count") / minutes).alias("throughput_requests_per_minute"))
    out = (out.withColumn("error_rate_status", severity_higher(
        "error_rate", limits["max_error_rate_warning"], limits["max_error_rate_critical"]))
        .withColumn("availability_status", severity_lower(
            "availability", limits["min_availability_warning"], limits["min_availability_critical"]))
        .withColumn("latency_status", severity_higher(
            "latency_p95_ms", limits["max_p95_latency_ms_warning"],
            limits["max_p95_latency_ms_critical"])))
    worst = F.greatest(*[status_rank(c) for c in
                         ("error_rate_status", "availability_status", "latency_status")])
    out = out.withColumn("status", rank_status(worst))
    return out.withColumns({c: F.when(F.col("request_count") == 0, "no_data").otherwise(F.col(c))
                            for c in out.columns if c.endswith("status")})


def system_metric_rows(sysm: DataFrame, limits: dict = config.SYSTEM_LIMITS) -> DataFrame:
    """The system row as metric-table rows.  The reported threshold is the
    critical limit, except availability which reports its warning limit."""
    rows = [("error_rate", "error_rate_status", limits["max_error_rate_critical"]),
            ("availability", "availability_status", limits["min_availability_warning"]),
            ("latency_p95_ms", "latency_status", limits["max_p95_latency_ms_critical"])]
    return sysm.select(F.explode(F.array(*[
        F.struct(F.lit("system").alias("category"), F.lit(m).alias("metric"),
                 F.lit("service").alias("subject"), F.col(m).cast("double").alias("value"),
                 F.lit(str(float(t))).alias("threshold"), F.col(s).alias("status"))
        for m, s, t in rows])).alias("r")).select("r.*")


# ------------------------------------------------------------------ H10 ---
def endpoint_metrics(events: DataFrame, path: str = "path", status: str = "status_code",
                     latency: str = "latency_ms") -> DataFrame:
    """Per endpoint: request_count, error_rate, latency mean and exact p95;
    NULL paths dropped."""
    e = events.where(F.col(path).isNotNull()).select(
        F.col(path).alias("path"), present_double(status).alias("_code"),
        present_double(latency).alias("x"))
    g = e.groupBy("path").agg(
        F.count(F.lit(1)).alias("request_count"),
        F.avg(F.when(F.col("_code").isNotNull(), (F.col("_code") >= 400).cast("double")))
        .alias("error_rate"),
        F.avg("x").alias("latency_mean_ms"))
    p = exact_quantiles(e.select("path", "x"), ["path"], "x", [0.95]).select(
        "path", F.col("q").alias("latency_p95_ms"))
    return g.join(p, "path", "left")


# ------------------------------------------------------------------ H7/H8 -
def worst_status(metrics: DataFrame, keys: Sequence[str] = (), order: str | None = None
                 ) -> DataFrame:
    """H7: worst of the statuses -- no_data, insufficient and stable rank 0,
    warning 1, critical 2; among equal ranks the first (smallest ``order``,
    else the status text) wins; no statuses at all -> no_data."""
    tie = F.col(order) if order else F.col("status")
    g = metrics.groupBy(*keys).agg(
        F.min_by("status", F.struct((-status_rank("status")).alias("_r"), tie.alias("_t")))
        .alias("status"))
    return g.select(*keys, F.coalesce(F.col("status"), F.lit("no_data")).alias("status"))


ALERT_TEXT = {
    ("system", "error_rate"): ("error_rate over limit", "look up the failing endpoints by status code"),
    ("system", "availability"): ("availability under target", "look up the 5xx responses of the window"),
    ("system", "latency_p95_ms"): ("latency_p95_ms over limit", "compare latency by endpoint and batch size"),
    ("data", "psi"): ("PSI over limit", "compare the subject with its reference bins"),
    ("data", "js_divergence"): ("JS divergence over limit", "compare the subject with its reference shares"),
    ("data", "missing_column"): ("column absent", "stop the load and ask for the column"),
    ("model", "anomaly_rate_difference"): ("anomaly rate off its reference", "check the inputs, then the threshold"),
    ("model", "score_mean_shift"): ("mean score off its reference", "check the inputs, then the model"),
}


def alerts(metrics: DataFrame) -> DataFrame:
    """H8: warning/critical rows with message and action (tiny broadcast table)."""
    spark = metrics.sparkSession
    text = spark.createDataFrame([(c, m, msg, act) for (c, m), (msg, act) in ALERT_TEXT.items()],
                                 "category string, metric string, message string, "
                                 "recommended_action string")
    return (metrics.where(F.col("status").isin("warning", "critical"))
            .join(F.broadcast(text), ["category", "metric"], "left")
            .select("category", "metric", "subject", F.col("status").alias("severity"), "value",
                    "threshold", "message", "recommended_action"))


# ------------------------------------------------------------------ H13 ---
def data_monitor(current: DataFrame, features: str, num_profile: DataFrame,
                 cat_profile: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                 minimum_rows: int = config.MINIMUM_ROWS_FOR_DRIFT,
                 limits: dict = config.DATA_LIMITS) -> DataFrame:
    """Metric rows for drift of production inputs held in a ``features`` map
    column (dynamic keys).  A column is missing when its key is absent from
    every row.  Rows: psi / js_divergence / missing_column per column plus
    'rows' with the overall status (no_data, insufficient_data, worst-of).
    Also carries missing_rate, production_mean and reference_mean of the numbers (NULL
    and text that is no number count as missing)."""
    spark = current.sparkSession
    fm = F.col(features)
    cols = list(numeric) + list(categorical)
    # one pass: row count and key presence (they choose the plan) plus the
    # missing rate and production mean of every numeric input
    num_v = {c: fm[c].try_cast("double") for c in numeric}
    one = current.agg(F.count(F.lit(1)).alias("n"),
                      *[F.count_if(F.map_contains_key(fm, c)).alias(f"has_{i}")
                        for i, c in enumerate(cols)],
                      *[F.avg(F.when(v.isNull() | F.isnan(v), 1.0).otherwise(0.0)).alias(f"mr_{j}")
                        for j, v in enumerate(num_v.values())],
                      *[F.avg(F.nanvl(v, F.lit(None).cast("double"))).alias(f"pm_{j}") for j, v in enumerate(num_v.values())])
    stats = one.first()        # one row: bounded
    n = stats["n"]
    if n == 0 or n < minimum_rows:
        status = "no_data" if n == 0 else "insufficient_data"
        return spark.createDataFrame(
            [("data", "rows", "production", float(n), str(minimum_rows), status)], METRIC_SCHEMA)
    present = [c for i, c in enumerate(cols) if stats[f"has_{i}"] > 0]
    missing = [c for c in cols if c not in present]
    flat = current.select(*[fm[c].alias(c) for c in present])
    nums = [c for c in numeric if c in present]
    cats = [c for c in categorical if c in present]
    parts = []
    if nums:
        numf = flat.select(*[F.col(c).try_cast("double").alias(c) for c in nums])
        p = drift.psi(numf, num_profile, nums)
        pos = {c: j for j, c in enumerate(numeric)}
        parts.append(p.select(
            F.lit("data").alias("category"), F.lit("psi").alias("metric"),
            F.col("column_name").alias("subject"), F.col("psi").alias("value"),
            F.lit(str(limits["psi_critical"])).alias("threshold"),
            severity_higher("psi", limits["psi_warning"], limits["psi_critical"]).alias("status")))
        parts.append(spark.createDataFrame(
            [("data", k, c, None if stats[f"{pfx}_{pos[c]}"] is None
              else float(stats[f"{pfx}_{pos[c]}"]), None, "stable")
             for c in nums for k, pfx in (("missing_rate", "mr"), ("production_mean", "pm"))],
            METRIC_SCHEMA))
    if nums and "mean" in num_profile.columns:
        parts.append(num_profile.where(F.col("column_name").isin(nums)).select(
            F.lit("data").alias("category"), F.lit("reference_mean").alias("metric"),
            F.col("column_name").alias("subject"), F.col("mean").alias("value"),
            F.lit(None).cast("string").alias("threshold"), F.lit("stable").alias("status")))
    if cats:
        j = drift.js_divergence(flat.select(*cats), cat_profile, cats)
        parts.append(j.select(
            F.lit("data").alias("category"), F.lit("js_divergence").alias("metric"),
            F.col("column_name").alias("subject"), F.col("js_divergence").alias("value"),
            F.lit(str(limits["js_critical"])).alias("threshold"),
            severity_higher("js_divergence", limits["js_warning"], limits["js_critical"])
            .alias("status")))
    if missing:
        parts.append(spark.createDataFrame(
            [("data", "missing_column", c, None, "column_required", "critical") for c in missing],
            METRIC_SCHEMA))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = cut_lineage(out)
    overall = worst_status(out).select(
        F.lit("data").alias("category"), F.lit("rows").alias("metric"),
        F.lit("production").alias("subject"), F.lit(float(n)).alias("value"),
        F.lit(str(minimum_rows)).alias("threshold"), "status")
    return out.unionByName(overall)


# ------------------------------------------------------------------ H3/H14 -
SUMMARY_QUANTILES = {0.05: "p05", 0.5: "median", 0.95: "p95", 0.97: "p97", 0.99: "p99"}


def score_summary(df: DataFrame, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean, population std, min, p05, median, p95, p97, p99, max and count of
    the scores that are numbers (NULL and NaN are left out)."""
    rows = df.select(*keys, present_double(score).alias("x"))
    g = rows.groupBy(*keys).agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("standard_deviation"),
                                F.min("x").alias("minimum"), F.max("x").alias("maximum"), F.count("x").alias("count"))
    q = exact_quantiles(rows, list(keys), "x", list(SUMMARY_QUANTILES))
    piv = q.groupBy(*keys).agg(*[F.max(F.when(F.col("p") == p, F.col("q"))).alias(n) for p, n in SUMMARY_QUANTILES.items()])
    return g.join(piv, list(keys), "left") if keys else g.crossJoin(piv)


def model_reference(df: DataFrame, y: str, pred: str, score: str) -> DataFrame:
    """H3: observed failure rate, predicted anomaly rate, FPR on label 0 and
    the score summary, one row."""
    rates = df.agg(F.count(F.lit(1)).alias("row_count"),
                   F.avg(present_double(y)).alias("observed_failure_rate"),
                   F.avg(present_double(pred)).alias("predicted_anomaly_rate"),
                   F.avg(F.when(F.col(y) == 0, present_double(pred))).alias("false_positive_rate"))
    return rates.crossJoin(score_summary(df, score))


def model_monitor(current: DataFrame, pred: str, score: str, reference: DataFrame,
                  minimum_rows: int = config.MINIMUM_ROWS_FOR_DRIFT,
                  limits: dict = config.MODEL_LIMITS) -> DataFrame:
    """One row of anomaly-rate and score-shift metrics against a
    reference row (predicted_anomaly_rate, mean, standard_deviation).  Predictions and
    scores that are NULL, NaN or no number count in no rate and no mean."""
    p = present_double(pred)
    s = present_double(score)
    cur = current.select(p.alias("_p"), s.alias("_s"))
    g = cur.agg(F.count(F.lit(1)).alias("production_rows"),
                F.count_if(F.col("_p") == 1).alias("anomaly_count"),
                F.count_if(F.col("_p") == 0).alias("normal_count"),
                F.avg("_p").alias("anomaly_rate"), F.avg("_s").alias("score_mean"),
                F.stddev_pop("_s").alias("score_standard_deviation"),
                F.min("_s").alias("score_minimum"), F.max("_s").alias("score_maximum"))
    q = exact_quantiles(cur.select(F.col("_s").alias("x")), [], "x", [0.5, 0.95]).agg(
        F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("score_median"),
        F.max(F.when(F.col("p") == 0.95, F.col("q"))).alias("score_p95"))
    ref = reference.select(F.col("predicted_anomaly_rate").alias("reference_anomaly_rate"),
                           F.col("mean").alias("reference_score_mean"),
                           F.col("standard_deviation").alias("_rsd"))
    out = g.crossJoin(q).crossJoin(ref)
    diff = F.abs(F.col("anomaly_rate") - F.col("reference_anomaly_rate"))
    shift = F.when(F.col("_rsd") > 0, F.abs(F.col("score_mean") - F.col("reference_score_mean"))
                   / F.col("_rsd")).otherwise(0.0)
    out = (out.withColumn("anomaly_rate_absolute_difference", diff)
           .withColumn("mean_shift_standard_deviations", shift).drop("_rsd")
           .withColumn("anomaly_rate_status", severity_higher(
               "anomaly_rate_absolute_difference", limits["anomaly_rate_difference_warning"],
               limits["anomaly_rate_difference_critical"]))
           .withColumn("score_shift_status", severity_higher(
               "mean_shift_standard_deviations", limits["score_mean_shift_warning"],
               limits["score_mean_shift_critical"])))
    status = rank_status(F.greatest(status_rank("anomaly_rate_status"),
                                    status_rank("score_shift_status")))
    n = F.col("production_rows")
    return out.withColumn("status", F.when(n == 0, "no_data")
                          .when(n < minimum_rows, "insufficient_data").otherwise(status))


def model_metric_rows(model: DataFrame, limits: dict = config.MODEL_LIMITS) -> DataFrame:
    """The model row as metric-table rows (thresholds: the critical limits), and its
    status over all; without enough rows only that."""
    own = lambda metric, value, threshold, status: F.struct(
        F.lit("model").alias("category"), F.lit(metric).alias("metric"), F.lit("production").alias("subject"),
        F.col(value).cast("double").alias("value"), F.lit(str(threshold)).alias("threshold"), F.col(status).alias("status"))
    judged = F.array(
        own("anomaly_rate_difference", "anomaly_rate_absolute_difference", limits["anomaly_rate_difference_critical"], "anomaly_rate_status"),
        own("score_mean_shift", "mean_shift_standard_deviations", limits["score_mean_shift_critical"], "score_shift_status"))
    overall = F.array(own("rows", "production_rows", config.MINIMUM_ROWS_FOR_DRIFT, "status"))
    rows = F.when(F.col("status").isin("no_data", "insufficient_data"), overall).otherwise(F.concat(judged, overall))
    return model.select(F.explode(rows).alias("r")).select("r.*")


def labelled_performance(predictions: DataFrame, labels: DataFrame, key: str, pred: str, y: str) -> DataFrame:
    """Confusion metrics of the predictions whose label has come in (joined on
    ``key``), one row; without any, recall is NULL."""
    from telemetra.operators.evaluate import confusion

    both = predictions.select(key, F.col(pred).alias("_p")).join(labels.select(key, F.col(y).alias("_y")), key)
    out = confusion(both, "_y", "_p")
    known = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return out.withColumn("labelled_rows", known).withColumn(
        "recall", F.when(F.col("tp") + F.col("fn") > 0, F.col("recall")))


REPORT_SCHEMA = f"kind string, {METRIC_SCHEMA}, message string, recommended_action string"


def full_report(requests: DataFrame, predictions: DataFrame, ts: str, as_of, num_profile: DataFrame,
                cat_profile: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                model_ref: DataFrame, labels: DataFrame | None = None, key: str = "request_id", y: str = "y",
                hours: int = config.WINDOW_HOURS) -> DataFrame:
    """The report over the trailing window of both logs, as one table of kind

    * ``metric``: every row of the system, data and model monitors and, with ``labels``,
      the labelled performance;
    * ``alert``: the warning and critical ones with message and action;
    * ``status``: each monitor's status and the worst of them (category ``overall``);
    * ``decision``: the retraining decision (status), from the data status and the
      labelled recall.

    ``requests`` has status_code, latency_ms, instance_count; ``predictions`` the map
    column features, prediction and anomaly_score.  Each window is read once and
    written."""
    win = cut_lineage(trailing_window(requests, ts, as_of, hours))
    pred = cut_lineage(trailing_window(predictions, ts, as_of, hours))
    system = cut_lineage(system_metrics(win, ts))
    data = data_monitor(pred, "features", num_profile, cat_profile, numeric, categorical)
    model = model_metric_rows(model_monitor(pred, "prediction", "anomaly_score", model_ref))
    parts = [system_metric_rows(system), data, model]
    if labels is not None:
        perf = labelled_performance(pred, labels, key, "prediction", y)
        parts.append(perf.select(F.explode(F.array(*[
            F.struct(F.lit("performance").alias("category"), F.lit(m).alias("metric"), F.lit("labelled").alias("subject"),
                     F.col(m).cast("double").alias("value"), F.lit(None).cast("string").alias("threshold"),
                     F.lit("stable").alias("status"))
            for m in ("labelled_rows", "precision", "recall", "false_positive_rate", "f1_score")])).alias("r")).select("r.*"))
    metrics = parts[0]
    for part in parts[1:]:
        metrics = metrics.unionByName(part)
    metrics = cut_lineage(metrics)
    # each monitor's own status: the system row's, the ``rows`` metric's of the others
    own = (system.select(F.lit("system").alias("category"), "status")
           .unionByName(metrics.where("metric = 'rows'").select("category", "status")))
    order = F.when(F.col("category") == "system", 0).when(F.col("category") == "data", 1).otherwise(2)
    worst = worst_status(own.withColumn("_o", order), order="_o").select(F.lit("overall").alias("category"), "status")
    statuses = own.unionByName(worst)
    recall = metrics.where("category = 'performance' AND metric = 'recall'").agg(F.max("value").alias("_recall"))
    state = own.where("category = 'data'").select(F.col("status").alias("_data")).crossJoin(recall)
    decision = retraining_decision(state, "_data", "_recall")
    none = F.lit(None)
    row = lambda kind, df, **c: df.select(
        F.lit(kind).alias("kind"), *[c.get(n, none).cast(t).alias(n) for n, t in (
            ("category", "string"), ("metric", "string"), ("subject", "string"), ("value", "double"), ("threshold", "string"),
            ("status", "string"), ("message", "string"), ("recommended_action", "string"))])
    named = {n: F.col(n) for n in ("category", "metric", "subject", "value", "threshold")}
    return (row("metric", metrics, **named, status=F.col("status"))
            .unionByName(row("alert", alerts(metrics), **named, status=F.col("severity"), message=F.col("message"),
                             recommended_action=F.col("recommended_action")))
            .unionByName(row("status", statuses, category=F.col("category"), status=F.col("status")))
            .unionByName(row("decision", decision, category=F.lit("retraining"), metric=F.lit("recall"), value=F.col("_recall"),
                             threshold=F.col("performance_threshold").cast("string"), status=F.col("decision"))))


# ------------------------------------------------------------------ H15 ---
def retraining_decision(df: DataFrame, data_status: str, performance: str | None,
                        policy: dict = config.RETRAINING) -> DataFrame:
    """Not critical -> continue_monitoring; critical without a
    performance value -> investigate_drift; performance <= ref*(1-drop) ->
    evaluate_retraining; else continue_monitoring.  Never automatic."""
    limit = float(policy["reference_performance"]) * (1 - float(policy["maximum_relative_drop"]))
    perf = F.col(performance) if performance else F.lit(None).cast("double")
    st = F.col(data_status)
    decision = (F.when(st != "critical", "continue_monitoring")
                .when(perf.isNull(), "investigate_drift")
                .when(perf <= F.lit(limit), "evaluate_retraining")
                .otherwise("continue_monitoring"))
    return (df.withColumn("performance_threshold", F.lit(limit))
            .withColumn("decision", decision)
            .withColumn("recommended", F.col("decision") == "evaluate_retraining")
            .withColumn("automatic_retraining", F.lit(False)))


def prediction_log(scored: DataFrame, inputs: Sequence[str], request_id: Column, ts: Column,
                   endpoint: str, model_name: str, model_version: str) -> DataFrame:
    """One prediction event per scored row -- inputs and outputs come from
    the same row, so the reference's length-mismatch case cannot occur."""
    return scored.select(
        ts.cast("string").alias("timestamp"), request_id.alias("request_id"),
        F.lit(endpoint).alias("endpoint"), F.lit(model_name).alias("model_name"),
        F.lit(model_version).alias("model_version"),
        F.struct(*[F.col(c) for c in inputs]).alias("features"),
        F.col("prediction").cast("int").alias("prediction"),
        (F.col("prediction") == 1).alias("anomaly"),
        F.col("anomaly_score").cast("double").alias("anomaly_score"))
