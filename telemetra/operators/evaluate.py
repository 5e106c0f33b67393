"""Score evaluation F1-F15.

Every curve metric starts from the scores collapsed to distinct values with
positive/negative counts per (keys, score); a descending prefix sum over that
table gives tp/fp at each threshold ``score >= t``.  ROC-AUC, average
precision, the threshold sweep, ROC and PR points are all read from it, so
the cost is one shuffle of distinct scores instead of one pass per threshold.
``keys`` evaluates many configurations (models, weights, gates) in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetra import config
from telemetra.functions.exprs import present_double, safe_div
from telemetra.plans.hscan import prefix_sums
from telemetra.session import cut_lineage


def confusion(df: DataFrame, y: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    """F1 + F2: tn, fp, fn, tp and the derived metrics (0 when undefined)."""
    yc, pc = F.col(y), F.col(pred)
    g = df.groupBy(*keys).agg(
        F.count_if((yc == 0) & (pc == 0)).alias("tn"), F.count_if((yc == 0) & (pc == 1)).alias("fp"),
        F.count_if((yc == 1) & (pc == 0)).alias("fn"), F.count_if((yc == 1) & (pc == 1)).alias("tp"))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    precision = safe_div(tp, tp + fp)
    recall = safe_div(tp, tp + fn)
    spec = safe_div(tn, tn + fp)
    return g.select(
        *keys, "tn", "fp", "fn", "tp",
        safe_div(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        precision.alias("precision"), recall.alias("recall"),
        safe_div(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        spec.alias("specificity"), safe_div(fp, fp + tn).alias("false_positive_rate"),
        F.sqrt(recall * spec).alias("g_mean"))


def score_table(df: DataFrame, y: str, score: str, keys: Sequence[str] = (),
                weight: str | None = None) -> DataFrame:
    """(keys, score, pos, neg, tp, fp, P, N): distinct scores with cumulative
    counts of rows at or above each score; rows without a score (NULL, NaN) are left out.
    ``weight`` is a row multiplicity column."""
    w = F.col(weight) if weight else F.lit(1)
    g = (df.where(present_double(score).isNotNull())
         .groupBy(*keys, F.col(score).alias("score"))
         .agg(F.sum((F.col(y) * w).cast("long")).alias("pos"),
              F.sum(((1 - F.col(y)) * w).cast("long")).alias("neg")))
    s = prefix_sums(g, keys, "score", ["pos", "neg"], descending=True)
    return s.select(*keys, "score", "pos", "neg", F.col("cum_pos").alias("tp"),
                    F.col("cum_neg").alias("fp"), F.col("total_pos").alias("P"),
                    F.col("total_neg").alias("N"))


def threshold_sweep(table: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """F8: metrics of ``score >= t`` for every distinct score t."""
    tp, fp, P, N = F.col("tp"), F.col("fp"), F.col("P"), F.col("N")
    return table.select(
        *keys, F.col("score").alias("threshold"),
        safe_div(tp, tp + fp).alias("precision"), safe_div(tp, P).alias("recall"),
        safe_div(fp, N).alias("false_positive_rate"),
        tp.alias("true_positives"), fp.alias("false_positives"),
        (N - fp).alias("true_negatives"), (P - tp).alias("false_negatives"),
        (tp + fp).alias("predicted_anomalies"),
        ((tp + fp) / (P + N)).alias("predicted_anomaly_rate"))


def curve_metrics(table: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """F3 + F4: ROC-AUC (mid-ranks for ties) and average precision
    sum_t (pos_t / P) * precision(t)."""
    n = F.col("P") + F.col("N")
    below = n - F.col("tp") - F.col("fp")                     # rows with a smaller score
    midrank = below + (F.col("pos") + F.col("neg") + 1) / 2.0
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    g = table.groupBy(*keys).agg(
        F.sum(F.col("pos") * midrank).alias("_rs"), F.max("P").alias("_P"), F.max("N").alias("_N"),
        F.sum(F.col("pos") * prec).alias("_ap"))
    P, N = F.col("_P"), F.col("_N")
    return g.select(*keys,
                    F.when((P > 0) & (N > 0), (F.col("_rs") - P * (P + 1) / 2) / (P * N))
                    .alias("roc_auc"),
                    F.when(P > 0, F.col("_ap") / P).alias("pr_auc"))


def _ends(table: DataFrame, keys: Sequence[str], **values) -> DataFrame:
    """One more point per curve, above the highest score (threshold NULL)."""
    groups = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 0")
    return groups.select(*keys, F.lit(None).cast("double").alias("threshold"),
                         *[F.lit(v).alias(k) for k, v in values.items()])


def roc_points(table: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, and the start (0, 0) where
    nothing is flagged (threshold NULL)."""
    points = table.select(*keys, F.col("score").cast("double").alias("threshold"),
                          safe_div(F.col("fp"), F.col("N")).alias("fpr"),
                          safe_div(F.col("tp"), F.col("P")).alias("tpr"))
    return points.unionByName(_ends(table, keys, fpr=0.0, tpr=0.0))


def pr_points(table: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(threshold, precision, recall) at every distinct score, and the closing point
    (precision 1, recall 0; threshold NULL)."""
    points = table.select(*keys, F.col("score").cast("double").alias("threshold"),
                          (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                          safe_div(F.col("tp"), F.col("P")).alias("recall"))
    return points.unionByName(_ends(table, keys, precision=1.0, recall=0.0))


def pick_threshold(sweep: DataFrame, min_recall: float = config.MIN_RECALL,
                   keys: Sequence[str] = ()) -> DataFrame:
    """among thresholds with recall >= min_recall, the highest precision,
    then lowest FPR, then highest recall, then the smallest threshold.  Per
    keys a ``max_by`` over a struct: one aggregate, no sort."""
    cand = sweep.where(F.col("recall") >= min_recall)
    order = F.struct(F.col("precision"), -F.col("false_positive_rate"), F.col("recall"),
                     -F.col("threshold"))
    if not keys:
        return cand.orderBy(F.col("precision").desc(), F.col("false_positive_rate"),
                            F.col("recall").desc(), F.col("threshold")).limit(1)
    best = cand.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in cand.columns if c not in keys]),
                                            order).alias("b"))
    return best.select(*keys, "b.*")


def predicted_rate(df: DataFrame, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    """predicted anomalies and their rate."""
    return df.groupBy(*keys).agg(F.sum(F.col(pred)).alias("predicted_anomalies"),
                                 F.avg(F.col(pred)).alias("predicted_anomaly_rate"))


def apply_threshold(df: DataFrame, score: str, threshold: float | str,
                    pred: str = "prediction") -> DataFrame:
    """Inclusive cut ``score >= threshold`` (a number or a column)."""
    thr = F.col(threshold) if isinstance(threshold, str) else F.lit(float(threshold))
    return df.withColumn(pred, (F.col(score) >= thr).cast("int"))


def evaluate_grouped(df: DataFrame, y: str, score: str, keys: Sequence[str],
                     min_recall: float = config.MIN_RECALL, weight: str | None = None) -> DataFrame:
    """Per configuration the curve metrics plus the operating point
    chosen by F9 (recall floor)."""
    t = score_table(df, y, score, keys, weight)
    curve = curve_metrics(t, keys)
    pick = pick_threshold(threshold_sweep(t, keys), min_recall, keys).select(
        *keys, "threshold", "precision", "recall", "false_positive_rate")
    return curve.join(pick, list(keys), "left")


def held_out_comparison(df: DataFrame, y: str, score: str, split: str, keys: Sequence[str],
                        min_recall: float = config.MIN_RECALL) -> DataFrame:
    """candidates (``keys``) compared on rows that chose nothing.  Each candidate's
    threshold is picked by F9 on the rows of split ``validation`` and frozen; the rows of
    split ``test`` are flagged with it and give the confusion metrics, curve metrics,
    flagged share and score distribution.  ``best`` marks the first by (pr_auc, recall).
    A candidate without a threshold that reaches the recall flags nothing (threshold
    NULL)."""
    from telemetra.operators.monitor import score_summary

    rows = cut_lineage(df.select(*keys, F.col(y).alias("y"), F.col(score).cast("double").alias("score"),
                                 F.col(split).alias("split")))
    sweep = threshold_sweep(score_table(rows.where("split = 'validation'"), "y", "score", keys), keys)
    frozen = cut_lineage(pick_threshold(sweep, min_recall, keys).select(*keys, "threshold"))
    test = rows.where("split = 'test'").join(F.broadcast(frozen), list(keys), "left")
    test = cut_lineage(test.withColumn("prediction", F.coalesce((F.col("score") >= F.col("threshold")).cast("int"), F.lit(0))))
    out = (confusion(test, "y", "prediction", keys).join(frozen, list(keys), "left")
           .join(curve_metrics(score_table(test, "y", "score", keys), keys), list(keys))
           .join(predicted_rate(test, "prediction", keys), list(keys))
           .join(score_summary(test, "score", keys).withColumnRenamed("count", "test_samples"), list(keys)))
    order = Window.orderBy(F.col("pr_auc").desc_nulls_last(), F.col("recall").desc(), *keys)   # one row per candidate
    return cut_lineage(out).withColumn("best", F.row_number().over(order) == 1)


def best_per_group(runs: DataFrame, group: Sequence[str], order: Sequence[str],
                   tiebreak: str) -> DataFrame:
    """best run per group by ``order`` (desc), first run wins ties."""
    key = F.struct(*[F.col(c) for c in order], -F.col(tiebreak))
    best = runs.groupBy(*group).agg(F.max_by(F.struct(*[c for c in runs.columns if c not in group]),
                                             key).alias("b"))
    return best.select(*group, "b.*")


def audit_predictions(df: DataFrame, score: str, pred: str, threshold: float | str,
                      keys: Sequence[str] = ()) -> DataFrame:
    """a stored prediction must equal ``score >= threshold`` under the threshold in
    force; per ``keys`` rows, flagged rows, inconsistent rows, and whether all agree.  A
    stored NULL is inconsistent."""
    thr = F.col(threshold) if isinstance(threshold, str) else F.lit(float(threshold))
    expect = (F.col(score) >= thr).cast("int")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(pred) == 1).alias("predicted_anomalies"),
        F.count_if(~F.col(pred).eqNullSafe(expect)).alias("inconsistent")).withColumn(
        "consistent", F.col("inconsistent") == 0)


def find_run(runs: DataFrame, exact: dict, numeric: dict | None = None,
             required: Sequence[str] = (), start_col: str = "start_time") -> DataFrame:
    """newest run whose string params match exactly, numeric params within
    1e-9 (relative or absolute), and that has every required param."""
    cond = F.lit(True)
    for k, v in exact.items():
        cond = cond & (F.col("params")[k] == F.lit(str(v)))
    for k, v in (numeric or {}).items():
        a = F.col("params")[k].try_cast("double")
        b = F.lit(float(v))
        cond = cond & (F.abs(a - b) <= F.greatest(F.lit(1e-9) * F.greatest(F.abs(a), F.abs(b)),
                                                   F.lit(1e-9)))
    for k in required:
        cond = cond & F.col("params")[k].isNotNull()
    return runs.where(cond).orderBy(F.col(start_col).desc()).limit(1)


def expand_grid(spark, params: dict) -> DataFrame:
    """every combination of the hyper-parameter lists as a table with a
    ``config_id`` (cross join of tiny per-parameter tables); detectors then take
    ``config_id`` as a grouping key so one job scores many configurations."""
    out, cid = None, F.lit(0)
    for j, (name, values) in enumerate(params.items()):
        col = spark.createDataFrame([(str(v), i) for i, v in enumerate(values)],
                                    f"`{name}` string, _i{j} int")
        out = col if out is None else out.crossJoin(col)
        cid = cid * F.lit(len(values)) + F.col(f"_i{j}")   # mixed radix: product order
    return out.withColumn("config_id", cid.cast("int")).drop(
        *[f"_i{j}" for j in range(len(params))])
