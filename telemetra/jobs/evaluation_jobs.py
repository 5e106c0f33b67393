"""Registered evaluation and ensemble queries: F1-F15, G1-G9.

Labels: ``labels.toxic``; scores: document length (``score``) and mean word
length (``score2``), joined on ``doc_id``.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from telemetra import config
from telemetra.jobs.common import SQL_SCORED, scored_labels
from telemetra.operators import ensemble as G
from telemetra.operators import evaluate as E
from telemetra.session import cut_lineage
from telemetra.sources.tables import table

THRESHOLD = 3000.0


def f1_f2_metrics(spark, sf_dir):
    s = E.apply_threshold(scored_labels(spark, sf_dir), "score", THRESHOLD)
    return E.confusion(s, "y", "prediction")


def _two_models(spark, sf_dir):
    s = scored_labels(spark, sf_dir)
    return (s.select("doc_id", "y", F.lit("length").alias("model"), F.col("score"))
            .unionByName(s.select("doc_id", "y", F.lit("word_length").alias("model"),
                                  F.col("score2").alias("score"))))


def f3_f4_curve_metrics(spark, sf_dir):
    t = E.score_table(_two_models(spark, sf_dir), "y", "score", ["model"])
    return E.curve_metrics(t, ["model"])


def f5_roc_points(spark, sf_dir):
    return E.roc_points(E.score_table(scored_labels(spark, sf_dir), "y", "score"))


def f6_pr_points(spark, sf_dir):
    return E.pr_points(E.score_table(scored_labels(spark, sf_dir), "y", "score"))


def f7_predicted_rate(spark, sf_dir):
    s = E.apply_threshold(scored_labels(spark, sf_dir), "score", THRESHOLD)
    return E.predicted_rate(s, "prediction")


def f8_sweep(spark, sf_dir):
    return E.threshold_sweep(E.score_table(scored_labels(spark, sf_dir), "y", "score"))


def f9_pick_threshold(spark, sf_dir):
    return E.pick_threshold(f8_sweep(spark, sf_dir), config.MIN_RECALL)


def _runs(spark, sf_dir):
    """Four runs: two algorithms x two approaches (score orientation)."""
    s = scored_labels(spark, sf_dir)
    parts = []
    for run_id, (alg, col, appr, sign) in enumerate([
            ("length", "score", "raw", 1.0), ("length", "score", "reversed", -1.0),
            ("word_length", "score2", "raw", 1.0), ("word_length", "score2", "reversed", -1.0)]):
        parts.append(s.select(F.lit(run_id).alias("run_id"), F.lit(alg).alias("algorithm"),
                              F.lit(appr).alias("approach"), "y",
                              (F.col(col) * sign).alias("score")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _run_table(spark, sf_dir):
    return cut_lineage(E.evaluate_grouped(_runs(spark, sf_dir), "y", "score",
                              ["run_id", "algorithm", "approach"]))


def f11_best_run(spark, sf_dir):
    return E.best_per_group(_run_table(spark, sf_dir), ["algorithm"], ["pr_auc", "recall"], "run_id")


def f12_best_overall(spark, sf_dir):
    return _run_table(spark, sf_dir).orderBy(F.col("pr_auc").desc(), F.col("run_id")).limit(1)


def _split():
    """Validation or test by the first digit of the id's MD5: fixed, and no property of
    the row."""
    return F.when(F.md5(F.col("doc_id").cast("string")) < "8", "validation").otherwise("test")


def f13_candidates(spark, sf_dir):
    """Held-out comparison: each model's threshold is picked on the validation half,
    frozen, and judged on the test half."""
    return E.held_out_comparison(_two_models(spark, sf_dir).withColumn("split", _split()), "y", "score", "split", ["model"])


STORED = {"v1": 3000.0, "v2": 2500.0}


def f14_audit(spark, sf_dir):
    """Audit of stored predictions: the labelled documents were scored and stored by two
    model versions (the second, with a lower threshold, for quality 1); the
    audit reads the stored table back and holds it against the threshold now in force."""
    s = scored_labels(spark, sf_dir).join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    version = F.when(F.col("quality") >= 1, "v2").otherwise("v1")
    used = F.when(F.col("quality") >= 1, STORED["v2"]).otherwise(STORED["v1"])
    stored = cut_lineage(s.select("doc_id", version.alias("model_version"), "score",
                                  (F.col("score") >= used).cast("int").alias("prediction")))
    return E.audit_predictions(stored, "score", "prediction", STORED["v1"], ["model_version"])


def f15_find_run(spark, sf_dir):
    runs = _run_table(spark, sf_dir).select(
        "run_id", "pr_auc",
        F.create_map(F.lit("algorithm"), F.col("algorithm"), F.lit("approach"), F.col("approach"),
                     F.lit("sign"), F.when(F.col("approach") == "raw", F.lit("1.0"))
                     .otherwise(F.lit("-1.0"))).alias("params"),
        F.col("run_id").alias("start_time"))
    return E.find_run(runs, {"algorithm": "word_length"}, {"sign": -1.0}, ["approach"]).select(
        "run_id", "pr_auc", "start_time")


# ----------------------------------------------------------------- ensembles
def _minmax(spark, sf_dir):
    """Both scores on their min-max scale, from one written scan."""
    s = cut_lineage(scored_labels(spark, sf_dir))
    s = G.apply_minmax(s, "score", G.fit_minmax(s, "score"), "mm_a")
    return G.apply_minmax(s, "score2", G.fit_minmax(s, "score2"), "mm_b")


def _ranked(spark, sf_dir):
    s = cut_lineage(scored_labels(spark, sf_dir))
    return G.percentile_rank(G.percentile_rank(s, "score", "pr_a"), "score2", "pr_b")


def _normalized(spark, sf_dir):
    s = cut_lineage(_minmax(spark, sf_dir))
    return cut_lineage(G.percentile_rank(G.percentile_rank(s, "score", "pr_a"), "score2", "pr_b"))


def g1_g2_minmax(spark, sf_dir):
    return _minmax(spark, sf_dir).select("doc_id", "y", "mm_a", "mm_b")


def g3_percentile_rank(spark, sf_dir):
    return _ranked(spark, sf_dir).select("doc_id", "y", "pr_a", "pr_b")


def _fixed_configs(n, spark):
    """14 weighted + 2 minimum configurations as one long table (config, y, score)."""
    w = G.weight_grid(spark, config.ENSEMBLE_WEIGHTS)
    weighted = (n.crossJoin(F.broadcast(w))
                .select("y", F.explode(F.array(
                    F.struct(F.concat(F.lit("weighted_minmax_"), F.col("weight_id").cast("string"))
                             .alias("config"), G.weighted("mm_a", "mm_b", "w_a", "w_b").alias("score")),
                    F.struct(F.concat(F.lit("weighted_rank_"), F.col("weight_id").cast("string"))
                             .alias("config"), G.weighted("pr_a", "pr_b", "w_a", "w_b").alias("score")),
                )).alias("c")).select("y", "c.config", "c.score"))
    others = n.select("y", F.explode(F.array(
        F.struct(F.lit("minimum_minmax").alias("config"), G.minimum("mm_a", "mm_b").alias("score")),
        F.struct(F.lit("minimum_rank").alias("config"), G.minimum("pr_a", "pr_b").alias("score")),
    )).alias("c")).select("y", "c.config", "c.score")
    return weighted.unionByName(others)


def _searched_cascades(n):
    """Both cascade orders, each under its best gate."""
    parts = [G.best_gate(G.gate_search(n, "y", a, b, config.CASCADE_GATES)).withColumn("config", F.lit(name))
             for name, a, b in (("cascade_a_b", "pr_a", "pr_b"), ("cascade_b_a", "pr_b", "pr_a"))]
    return parts[0].unionByName(parts[1])


def g4_weighted_grid(spark, sf_dir):
    n = _minmax(spark, sf_dir)
    w = G.weight_grid(spark, config.ENSEMBLE_WEIGHTS)
    long = n.crossJoin(F.broadcast(w)).select(
        "weight_id", "w_a", "w_b", "y", G.weighted("mm_a", "mm_b", "w_a", "w_b").alias("score"))
    return E.evaluate_grouped(long, "y", "score", ["weight_id", "w_a", "w_b"])


def g5_minimum(spark, sf_dir):
    n = _ranked(spark, sf_dir).select("doc_id", "y", G.minimum("pr_a", "pr_b").alias("score"))
    return E.curve_metrics(E.score_table(n, "y", "score"))


def g6_cascade(spark, sf_dir):
    return _ranked(spark, sf_dir).select(
        "doc_id", "y", G.cascade("pr_a", "pr_b", 0.5).alias("cascade_a_b"),
        G.cascade("pr_b", "pr_a", 0.5).alias("cascade_b_a"))


def g7_gate_search(spark, sf_dir):
    """The best gate of both cascade orders."""
    return _searched_cascades(cut_lineage(_ranked(spark, sf_dir)))


def g8_ensemble_experiment(spark, sf_dir):
    """18 runs: 14 weighted, 2 minimum, 2 cascades under their searched gates; the
    winner by (pr_auc, recall)."""
    n = _normalized(spark, sf_dir)
    fixed = E.evaluate_grouped(_fixed_configs(n, spark), "y", "score", ["config"])
    runs = cut_lineage(fixed.withColumn("gate", F.lit(None).cast("double")).unionByName(
        _searched_cascades(n).select(*fixed.columns, "gate")))
    order = Window.orderBy(F.col("pr_auc").desc(), F.col("recall").desc_nulls_last(), "config")     # 18 rows
    return runs.withColumn("best", F.row_number().over(order) == 1)


def g9_operational(spark, sf_dir):
    s = scored_labels(spark, sf_dir)
    out = G.operational_score(s, "score", "score2", G.fit_minmax(s, "score"),
                              G.fit_minmax(s, "score2"), 0.6, 0.4, 0.5)
    return out.select("doc_id", "anomaly_score", "prediction")


QUERIES = {
    "f1_f2_metrics": f1_f2_metrics,
    "f3_f4_curve_metrics": f3_f4_curve_metrics,
    "f5_roc_points": f5_roc_points,
    "f6_pr_points": f6_pr_points,
    "f7_predicted_rate": f7_predicted_rate,
    "f8_sweep": f8_sweep,
    "f9_pick_threshold": f9_pick_threshold,
    "f11_best_run": f11_best_run,
    "f12_best_overall": f12_best_overall,
    "f13_candidates": f13_candidates,
    "f14_audit": f14_audit,
    "f15_find_run": f15_find_run,
    "g1_g2_minmax": g1_g2_minmax,
    "g3_percentile_rank": g3_percentile_rank,
    "g4_weighted_grid": g4_weighted_grid,
    "g5_minimum": g5_minimum,
    "g6_cascade": g6_cascade,
    "g7_gate_search": g7_gate_search,
    "g8_ensemble_experiment": g8_ensemble_experiment,
    "g9_operational": g9_operational,
}

# ------------------------------------------------------------------ oracle SQL
S = SQL_SCORED


def _ct(src: str, keys: str = "") -> str:
    """score table CTE body over src (keys..., y, score)."""
    kp = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    return f"""(SELECT *, sum(pos) OVER ({part} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
       sum(neg) OVER ({part} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
       sum(pos) OVER ({part}) AS "P", sum(neg) OVER ({part}) AS "N"
  FROM (SELECT {kp}score, sum(y) AS pos, sum(1 - y) AS neg FROM {src} WHERE score IS NOT NULL
        GROUP BY {kp}score))"""


def _curve(ct: str, keys: str = "") -> str:
    kp = f"{keys}, " if keys else ""
    gb = f"GROUP BY {keys}" if keys else ""
    return f"""(SELECT {kp}CASE WHEN max("P") > 0 AND max("N") > 0 THEN
    (sum(pos * (("P" + "N" - tp - fp) + (pos + neg + 1) / 2.0)) - max("P") * (max("P") + 1) / 2.0)
    / (max("P") * max("N")) END AS roc_auc,
  CASE WHEN max("P") > 0 THEN sum(pos * (tp / (tp + fp))) / max("P") END AS pr_auc
  FROM {ct} {gb})"""


def _sweep(ct: str, keys: str = "") -> str:
    kp = f"{keys}, " if keys else ""
    return f"""(SELECT {kp}score AS threshold,
  CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
  CASE WHEN "P" = 0 THEN 0 ELSE tp / "P" END AS recall,
  CASE WHEN "N" = 0 THEN 0 ELSE fp / "N" END AS false_positive_rate,
  CAST(tp AS BIGINT) AS true_positives, CAST(fp AS BIGINT) AS false_positives,
  CAST("N" - fp AS BIGINT) AS true_negatives, CAST("P" - tp AS BIGINT) AS false_negatives,
  CAST(tp + fp AS BIGINT) AS predicted_anomalies, (tp + fp) / ("P" + "N") AS predicted_anomaly_rate
  FROM {ct})"""


def _pick(sweep: str, keys: str) -> str:
    """per keys: best of recall >= 0.7 by precision desc, fpr asc, recall desc, threshold asc."""
    return f"""(SELECT {keys}, threshold, precision, recall, false_positive_rate FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY precision DESC, false_positive_rate,
         recall DESC, threshold) AS rn FROM {sweep} WHERE recall >= 0.7) WHERE rn = 1)"""


def _grouped(src: str, keys: str) -> str:
    ct = _ct(src, keys)
    return f"""(SELECT c.*, p.threshold, p.precision, p.recall, p.false_positive_rate
  FROM {_curve(ct, keys)} c LEFT JOIN {_pick(_sweep(ct, keys), keys)} p USING ({keys}))"""


_TWO = f"""(SELECT doc_id, y, 'length' AS model, score FROM {S}
  UNION ALL SELECT doc_id, y, 'word_length' AS model, score2 AS score FROM {S})"""
_RUNS = f"""(SELECT 0 AS run_id, 'length' AS algorithm, 'raw' AS approach, y, score FROM {S}
  UNION ALL SELECT 1, 'length', 'reversed', y, -score FROM {S}
  UNION ALL SELECT 2, 'word_length', 'raw', y, score2 FROM {S}
  UNION ALL SELECT 3, 'word_length', 'reversed', y, -score2 FROM {S})"""
_RUN_TABLE = _grouped(_RUNS, "run_id, algorithm, approach")
_MM = f"""(SELECT s.*, (score - mn_a) / ((CASE WHEN mx_a = mn_a THEN mn_a + 1.0 ELSE mx_a END) - mn_a) AS mm_a,
    (score2 - mn_b) / ((CASE WHEN mx_b = mn_b THEN mn_b + 1.0 ELSE mx_b END) - mn_b) AS mm_b,
    (rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0) / count(*) OVER () AS pr_a,
    (rank() OVER (ORDER BY score2) + (count(*) OVER (PARTITION BY score2) - 1) / 2.0) / count(*) OVER () AS pr_b
  FROM {S} s, (SELECT min(score) mn_a, max(score) mx_a, min(score2) mn_b, max(score2) mx_b FROM {S}))"""
_W = "(VALUES " + ", ".join(f"({i}, {a}::DOUBLE, {b}::DOUBLE)" for i, (a, b) in
                             enumerate(config.ENSEMBLE_WEIGHTS)) + ") w(weight_id, w_a, w_b)"
_GATES = "(VALUES " + ", ".join(f"({i}, {g}::DOUBLE)" for i, g in enumerate(config.CASCADE_GATES)) + \
    ") gt(gate_id, gate)"
_CONFIGS = f"""(SELECT 'weighted_minmax_' || weight_id AS config, y, w_a * mm_a + w_b * mm_b AS score FROM {_MM}, {_W}
  UNION ALL SELECT 'weighted_rank_' || weight_id, y, w_a * pr_a + w_b * pr_b FROM {_MM}, {_W}
  UNION ALL SELECT 'minimum_minmax', y, least(mm_a, mm_b) FROM {_MM}
  UNION ALL SELECT 'minimum_rank', y, least(pr_a, pr_b) FROM {_MM})"""
_ORDERS = [("cascade_a_b", "pr_a", "pr_b"), ("cascade_b_a", "pr_b", "pr_a")]


def _searched(name: str, first: str, second: str) -> str:
    """A cascade order under its best gate, with the share of positives that pass."""
    src = f"(SELECT gate_id, gate, y, CASE WHEN {first} >= gate THEN {second} ELSE 0.0 END AS score FROM {_MM}, {_GATES})"
    reach = (f"(SELECT gate_id, count_if(y = 1 AND {first} >= gate) / nullif(count_if(y = 1), 0) AS reach "
             f"FROM {_MM}, {_GATES} GROUP BY gate_id)")
    return (f"SELECT e.*, reach, '{name}' AS config FROM {_grouped(src, 'gate_id, gate')} e JOIN {reach} USING (gate_id) "
            "WHERE threshold IS NOT NULL ORDER BY pr_auc DESC, precision DESC, false_positive_rate, recall DESC, gate_id LIMIT 1")


SQL = {
    "f1_f2_metrics": f"""WITH c AS (SELECT count_if(y = 0 AND score < {THRESHOLD}) AS tn,
  count_if(y = 0 AND score >= {THRESHOLD}) AS fp, count_if(y = 1 AND score < {THRESHOLD}) AS fn,
  count_if(y = 1 AND score >= {THRESHOLD}) AS tp FROM {S})
SELECT tn, fp, fn, tp, (tp + tn) / (tp + tn + fp + fn) AS accuracy,
  CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1_score,
  CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp) END AS specificity,
  CASE WHEN fp + tn = 0 THEN 0 ELSE fp / (fp + tn) END AS false_positive_rate,
  sqrt((CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END)
       * (CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp) END)) AS g_mean FROM c""",
    "f3_f4_curve_metrics": "SELECT * FROM " + _curve(_ct(_TWO, "model"), "model"),
    "f5_roc_points": f"""SELECT score AS threshold, CASE WHEN "N" = 0 THEN 0 ELSE fp / "N" END AS fpr,
  CASE WHEN "P" = 0 THEN 0 ELSE tp / "P" END AS tpr FROM {_ct(S)}
UNION ALL SELECT CAST(NULL AS DOUBLE), 0.0, 0.0 WHERE EXISTS (SELECT 1 FROM {S})""",
    "f6_pr_points": f"""SELECT score AS threshold, tp / (tp + fp) AS precision,
  CASE WHEN "P" = 0 THEN 0 ELSE tp / "P" END AS recall FROM {_ct(S)}
UNION ALL SELECT CAST(NULL AS DOUBLE), 1.0, 0.0 WHERE EXISTS (SELECT 1 FROM {S})""",
    "f7_predicted_rate": f"""SELECT sum(CAST(score >= {THRESHOLD} AS INTEGER)) AS predicted_anomalies,
  avg(CAST(score >= {THRESHOLD} AS INTEGER)) AS predicted_anomaly_rate FROM {S}""",
    "f8_sweep": "SELECT * FROM " + _sweep(_ct(S)),
    "f9_pick_threshold": f"""SELECT * FROM {_sweep(_ct(S))} WHERE recall >= 0.7
  ORDER BY precision DESC, false_positive_rate, recall DESC, threshold LIMIT 1""",
    "f11_best_run": f"""SELECT algorithm, run_id, approach, roc_auc, pr_auc, threshold, precision, recall,
  false_positive_rate FROM (SELECT *, row_number() OVER (PARTITION BY algorithm
  ORDER BY pr_auc DESC NULLS LAST, recall DESC NULLS LAST, run_id) AS rn FROM {_RUN_TABLE}) WHERE rn = 1""",
    "f12_best_overall": f"SELECT * FROM {_RUN_TABLE} ORDER BY pr_auc DESC, run_id LIMIT 1",
    "f13_candidates": f"""WITH r AS (SELECT *, md5(CAST(doc_id AS VARCHAR)) < '8' AS val FROM {_TWO}),
v AS (SELECT model, y, score FROM r WHERE val),
fz AS (SELECT model, threshold FROM {_pick(_sweep(_ct('v', 'model'), 'model'), 'model')}),
t AS (SELECT r.model, y, score, coalesce(CAST(score >= threshold AS INTEGER), 0) AS prediction
  FROM r LEFT JOIN fz USING (model) WHERE NOT val),
c AS (SELECT model, count_if(y = 0 AND prediction = 0) AS tn, count_if(y = 0 AND prediction = 1) AS fp,
  count_if(y = 1 AND prediction = 0) AS fn, count_if(y = 1 AND prediction = 1) AS tp,
  sum(prediction) AS predicted_anomalies, avg(prediction) AS predicted_anomaly_rate,
  avg(score) AS mean, stddev_pop(score) AS standard_deviation, min(score) AS minimum, max(score) AS maximum,
  count(score) AS test_samples, quantile_cont(score, 0.05) AS p05, quantile_cont(score, 0.5) AS median,
  quantile_cont(score, 0.95) AS p95, quantile_cont(score, 0.97) AS p97, quantile_cont(score, 0.99) AS p99
  FROM t GROUP BY model),
m AS (SELECT c.*, threshold, roc_auc, pr_auc, (tp + tn) / (tp + tn + fp + fn) AS accuracy,
  CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1_score,
  CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp) END AS specificity,
  CASE WHEN fp + tn = 0 THEN 0 ELSE fp / (fp + tn) END AS false_positive_rate
  FROM c LEFT JOIN fz USING (model) JOIN {_curve(_ct('t', 'model'), 'model')} USING (model))
SELECT *, sqrt(recall * specificity) AS g_mean,
  row_number() OVER (ORDER BY pr_auc DESC NULLS LAST, recall DESC, model) = 1 AS best FROM m""",
    "f14_audit": f"""WITH s AS (SELECT s.*, CASE WHEN quality >= 1 THEN 'v2' ELSE 'v1' END AS model_version,
    CASE WHEN quality >= 1 THEN {STORED['v2']} ELSE {STORED['v1']} END AS used
  FROM {S} s JOIN labels l USING (doc_id))
SELECT model_version, count(*) AS rows, count_if(score >= used) AS predicted_anomalies,
  count_if((score >= used) <> (score >= {STORED['v1']})) AS inconsistent,
  count_if((score >= used) <> (score >= {STORED['v1']})) = 0 AS consistent FROM s GROUP BY model_version""",
    "f15_find_run": f"""SELECT run_id, pr_auc, run_id AS start_time FROM {_RUN_TABLE}
  WHERE algorithm = 'word_length' AND approach = 'reversed' ORDER BY run_id DESC LIMIT 1""",
    "g1_g2_minmax": f"SELECT doc_id, y, mm_a, mm_b FROM {_MM}",
    "g3_percentile_rank": f"SELECT doc_id, y, pr_a, pr_b FROM {_MM}",
    "g4_weighted_grid": "SELECT * FROM " + _grouped(
        f"(SELECT weight_id, w_a, w_b, y, w_a * mm_a + w_b * mm_b AS score FROM {_MM}, {_W})",
        "weight_id, w_a, w_b"),
    "g5_minimum": "SELECT * FROM " + _curve(_ct(f"(SELECT y, least(pr_a, pr_b) AS score FROM {_MM})")),
    "g6_cascade": f"""SELECT doc_id, y, CASE WHEN pr_a >= 0.5 THEN pr_b ELSE 0.0 END AS cascade_a_b,
  CASE WHEN pr_b >= 0.5 THEN pr_a ELSE 0.0 END AS cascade_b_a FROM {_MM}""",
    "g7_gate_search": " UNION ALL ".join(f"(SELECT * FROM ({_searched(*o)}))" for o in _ORDERS),
    "g8_ensemble_experiment": f"""WITH r AS (SELECT *, CAST(NULL AS DOUBLE) AS gate FROM {_grouped(_CONFIGS, "config")}
  UNION ALL BY NAME """ + " UNION ALL BY NAME ".join(
        f"(SELECT * EXCLUDE (gate_id, reach) FROM ({_searched(*o)}))" for o in _ORDERS) + """)
SELECT *, row_number() OVER (ORDER BY pr_auc DESC, recall DESC NULLS LAST, config) = 1 AS best FROM r""",
    "g9_operational": f"""SELECT doc_id, 0.6 * mm_a + 0.4 * mm_b AS anomaly_score,
  CAST(0.6 * mm_a + 0.4 * mm_b >= 0.5 AS INTEGER) AS prediction FROM {_MM}""",
}
