"""Registered detector queries: E1-E10.

The telemetry rows are ``lineitem``'s four measurements; the reference
period (ship date < 1999) is the training set, the rest is scored.  Rows with
equal measurement vectors get equal scores, so scoring works on the distinct
vectors with their multiplicity (``rows``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.jobs.common import (MEASURES, SQL_CUR, SQL_REF, current_period, lineitem, reference_period,
                                   sql_unpivot)
from telemetra.operators.detect import ecod as ECOD
from telemetra.jobs.common import SQL_SCORED
from telemetra.operators import ensemble as G
from telemetra.operators import features as D
from telemetra.operators import monitor as M
from telemetra.operators.detect import iforest as IF
from telemetra.operators.detect import lof as LOF
from telemetra.operators.detect import ocsvm as SVM
from telemetra.plans.hscan import exact_quantiles
from telemetra.session import cut_lineage
from telemetra.sources import models
from telemetra.sources.tables import table

CONTAMINATION = 0.03


def _vectors(df):
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in MEASURES])
    return df.groupBy(*MEASURES).agg(F.count(F.lit(1)).alias("rows")).withColumn("vec_key", key)


def e1_ecod_lineitem(spark, sf_dir):
    li = lineitem(spark, sf_dir)
    train = reference_period(li).select(*MEASURES)
    cur = cut_lineage(_vectors(current_period(li)))
    fitted = cut_lineage(ECOD.value_table(train, MEASURES))
    alone = ECOD.score_rows(train, MEASURES, ECOD.ecdf(fitted)).select("ecod_score")
    thr = exact_quantiles(alone, [], "ecod_score", [1 - CONTAMINATION]).select(F.col("q").alias("threshold"))
    both = fitted.unionByName(ECOD.value_table(cur, MEASURES, "rows")).groupBy("column_name", "x").agg(
        F.sum("cnt").alias("cnt"))
    out = ECOD.ecod_predict(ECOD.score_rows(cur, MEASURES, ECOD.ecdf(both)), thr)
    return out.select(*MEASURES, "rows", "ecod_score", "threshold", "prediction")


def e1_ecod_new_lineitem(spark, sf_dir):
    """Current rows by the training ECDF alone, under the frozen training threshold.  A
    value outside the training range has an infinite score: null here, and flagged."""
    li = lineitem(spark, sf_dir)
    train = reference_period(li).select(*MEASURES)
    model = ECOD.ecdf(ECOD.value_table(train, MEASURES))
    thr = exact_quantiles(ECOD.score_rows(train, MEASURES, model).select("ecod_score"), [], "ecod_score",
                          [1 - CONTAMINATION]).select(F.col("q").alias("threshold"))
    rows = current_period(li).select("l_orderkey", "l_linenumber", *MEASURES)
    out = ECOD.ecod_predict(ECOD.score_rows(rows, MEASURES, model), thr)
    beyond = F.col("ecod_score") == F.lit(float("inf"))
    return out.select(*rows.columns, F.when(~beyond, F.col("ecod_score")).alias("ecod_score"),
                      beyond.alias("out_of_range"), "threshold", "prediction")


MODEL = "ecod_lineitem"


def _parameters(spark, sf_dir):
    """Scaler, categories, ECDF, min-max and ensemble parameters of the reference
    period."""
    train = reference_period(lineitem(spark, sf_dir)).select(*MEASURES, "l_returnflag")
    scaler = cut_lineage(D.fit_robust_scaler(train, MEASURES))
    scaled = cut_lineage(D.apply_robust_scaler(train, scaler, MEASURES))
    model = ECOD.ecdf(ECOD.value_table(scaled, MEASURES))
    scores = cut_lineage(_two_scores(scaled, model))
    ranges = [scores.agg(F.min(c).alias("min"), F.max(c).alias("max")).select(
        F.lit(c).alias("score"), "min", F.when(F.col("max") == F.col("min"), F.col("min") + 1.0).otherwise(F.col("max")).alias("max"))
        for c in ("ecod_score", "reach")]
    return {"scaler": scaler, "categories": D.fit_categories(train, "l_returnflag"), "ecdf": model,
            "minmax": ranges[0].unionByName(ranges[1]),
            "ensemble": spark.createDataFrame([(0.6, 0.4, 0.5)], "weight_ecod double, weight_reach double, threshold double")}


def _two_scores(scaled, model):
    """The ECOD score and the largest scaled distance of a row."""
    reach = F.greatest(*[F.coalesce(F.abs(F.col(c)), F.lit(0.0)) for c in MEASURES])
    return ECOD.score_rows(scaled, MEASURES, model).withColumn("reach", reach)


def d10_fit_saved_lineitem(spark, sf_dir):
    """Fit on the reference period, publish the parameters as the next version, and
    return what a reader of that version finds (the ECDF by its rows and counts)."""
    version = models.save_model(spark, MODEL, _parameters(spark, sf_dir))
    kept = models.load_model(spark, MODEL, version)
    rows = kept["scaler"].select(F.lit("scaler").alias("parameter"), F.col("column_name").alias("name"),
                                 F.col("center").alias("a"), F.col("scale").alias("b"))
    rows = rows.unionByName(kept["categories"].select(
        F.lit("category").alias("parameter"), F.col("category").alias("name"), F.col("position").cast("double").alias("a"),
        F.lit(None).cast("double").alias("b")))
    rows = rows.unionByName(kept["minmax"].select(F.lit("minmax").alias("parameter"), F.col("score").alias("name"),
                                                  F.col("min").alias("a"), F.col("max").alias("b")))
    rows = rows.unionByName(kept["ecdf"].groupBy("column_name").agg(F.count(F.lit(1)).alias("v"), F.sum("cnt").alias("n")).select(
        F.lit("ecdf").alias("parameter"), F.col("column_name").alias("name"), F.col("v").cast("double").alias("a"),
        F.col("n").cast("double").alias("b")))
    return rows.unionByName(kept["ensemble"].select(F.lit("ensemble").alias("parameter"), F.lit("weights").alias("name"),
                                                    F.col("weight_ecod").alias("a"), F.col("weight_reach").alias("b")))


def g9_score_saved_lineitem(spark, sf_dir):
    """Score the current period with a saved version alone, nothing fitted: scale,
    encode, two scores, frozen min-max, weights and threshold.  (A version is published
    first where this application has none.)"""
    if not models.versions(spark, f"{MODEL}_scored"):
        models.save_model(spark, f"{MODEL}_scored", _parameters(spark, sf_dir))
    kept = models.load_model(spark, f"{MODEL}_scored")
    rows = current_period(lineitem(spark, sf_dir)).select("l_orderkey", "l_linenumber", "l_returnflag", *MEASURES)
    scaled = D.apply_one_hot(D.apply_robust_scaler(rows, kept["scaler"], MEASURES), "l_returnflag", kept["categories"], "type")
    scored = _two_scores(scaled, kept["ecdf"])
    for c in ("ecod_score", "reach"):
        scored = G.apply_minmax(scored, c, kept["minmax"].where(F.col("score") == c), f"n_{c}")
    beyond = F.col("ecod_score") == F.lit(float("inf"))
    score = F.col("weight_ecod") * F.col("n_ecod_score") + F.col("weight_reach") * F.col("n_reach")
    return (scored.crossJoin(F.broadcast(kept["ensemble"]))
            .select("l_orderkey", "l_linenumber", "type_position", F.when(~beyond, score).alias("anomaly_score"),
                    (score >= F.col("threshold")).cast("int").alias("prediction")))


LOF_K = 20
LOF_CONTAMINATION = 0.05


def _embeddings(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))


def e3_lof_embeddings(spark, sf_dir):
    fitted = LOF.lof_fit(_embeddings(spark, sf_dir), k=LOF_K)
    out = LOF.lof_predict(fitted, LOF.lof_offset(fitted, LOF_CONTAMINATION))
    return out.select(F.col("id").alias("vec_id"), "kdist", "lrd", "lof", "prediction")


def e2_iforest_embeddings(spark, sf_dir):
    emb = _embeddings(spark, sf_dir)
    forest = IF.fit_forest(emb, "id", "vec", n_trees=100, max_samples=256, seed=42)
    scores = IF.score_forest(emb, "id", "vec", forest)
    thr = IF.iforest_threshold(scores, 0.05)
    return (scores.crossJoin(F.broadcast(thr))
            .withColumn("prediction", (F.col("iforest_score") > F.col("threshold")).cast("int"))
            .select(F.col("id").alias("vec_id"), "iforest_score", "prediction"))


def e6_gamma_embeddings(spark, sf_dir):
    return SVM.gamma_scale(_embeddings(spark, sf_dir), "vec", 64)


def e4_ocsvm_embeddings(spark, sf_dir):
    emb = _embeddings(spark, sf_dir)
    gamma = SVM.gamma_scale(emb, "vec", 64).first()["gamma_scale"]   # one number
    model = SVM.RffOneClass(64, gamma, nu=0.05, seed=42).fit(emb, "vec")
    return model.score(emb, "id", "vec").withColumnRenamed("id", "vec_id")


def _documents_scored(spark, sf_dir):
    """The operational ensemble (frozen min-max of document length and mean
    word length, weights 0.6/0.4, inclusive threshold 0.5) over every document."""
    d = table(spark, sf_dir, "documents")
    words = F.length("text") - F.length(F.regexp_replace("text", " ", "")) + 1
    s = d.select("doc_id", "source", F.col("n_chars").cast("double").alias("score"),
                 (F.col("n_chars").cast("double") / words).alias("score2"))
    return G.operational_score(s, "score", "score2", G.fit_minmax(s, "score"),
                               G.fit_minmax(s, "score2"), 0.6, 0.4, 0.5)


def e9_batch_totals_documents(spark, sf_dir):
    """Batch scoring totals per batch (the document source)."""
    return (_documents_scored(spark, sf_dir).groupBy(F.col("source").alias("batch_id"))
            .agg(F.count(F.lit(1)).alias("instance_count"),
                 F.sum("prediction").alias("anomaly_count"))
            .withColumn("normal_count", F.col("instance_count") - F.col("anomaly_count"))
            .withColumn("model_name", F.lit("weighted_ensemble"))
            .withColumn("model_version", F.lit("1")))


LOG_TIME = "2024-01-01 00:00:00"


def h19_prediction_log_documents(spark, sf_dir):
    """One prediction event per scored document of the operational
    ensemble -- one request per batch (the document source), the row's inputs
    and outputs together."""
    s = _documents_scored(spark, sf_dir)
    log = M.prediction_log(s, ["doc_id", "score", "score2"],
                           F.concat(F.lit("batch-"), F.col("source")),
                           F.lit(LOG_TIME).cast("timestamp"), "/predict/batch",
                           "weighted_ensemble", "1")
    return log.select("timestamp", "request_id", "endpoint", "model_name", "model_version",
                      "features.*", "prediction", "anomaly", "anomaly_score")


def e10_worklist_documents(spark, sf_dir):
    """Anomaly worklist: every flagged document by score."""
    return (_documents_scored(spark, sf_dir).where(F.col("prediction") == 1)
            .orderBy(F.col("anomaly_score").desc(), F.col("doc_id"))
            .select("doc_id", "source", "anomaly_score"))


QUERIES = {
    "e1_ecod_lineitem": e1_ecod_lineitem,
    "e1_ecod_new_lineitem": e1_ecod_new_lineitem,
    "d10_fit_saved_lineitem": d10_fit_saved_lineitem,
    "g9_score_saved_lineitem": g9_score_saved_lineitem,
    "e2_iforest_embeddings": e2_iforest_embeddings,
    "e3_lof_embeddings": e3_lof_embeddings,
    "e4_ocsvm_embeddings": e4_ocsvm_embeddings,
    "e6_gamma_embeddings": e6_gamma_embeddings,
    "e9_batch_totals_documents": e9_batch_totals_documents,
    "e10_worklist_documents": e10_worklist_documents,
    "h19_prediction_log_documents": h19_prediction_log_documents,
}

# ------------------------------------------------------------------ oracle SQL
_M = ", ".join(MEASURES)
_ALIAS = ", ".join(f"{c} AS v_{c}" for c in MEASURES)
_VCOLS = ", ".join(f"v_{c}" for c in MEASURES)


def _tails(dist_rows: str, name: str) -> str:
    """CTE pieces giving {name}(column_name, x, l, r, sg) from a row source."""
    return f"""{name}_l AS (SELECT column_name, CAST(x AS DOUBLE) AS x FROM (UNPIVOT (SELECT {_M} FROM {dist_rows})
    ON {_M} INTO NAME column_name VALUE x)),
{name}_c AS (SELECT column_name, x, count(*) AS cnt FROM {name}_l GROUP BY column_name, x),
{name}_t AS (SELECT column_name, x, cnt,
    sum(cnt) OVER (PARTITION BY column_name ORDER BY x ROWS UNBOUNDED PRECEDING) AS cum,
    sum(cnt) OVER (PARTITION BY column_name) AS n FROM {name}_c),
{name}_s AS (SELECT column_name, sign(skewness(x)) AS sg FROM {name}_l GROUP BY column_name),
{name} AS (SELECT t.column_name, t.x, t.cum / t.n AS l, (t.n - t.cum + t.cnt) / t.n AS r, s.sg
    FROM {name}_t t JOIN {name}_s s USING (column_name))"""


def _score(vectors: str, tails: str, name: str) -> str:
    return f"""{name}_u AS (SELECT * FROM (UNPIVOT (SELECT {_ALIAS}, {_M}, rows FROM {vectors})
    ON {_M} INTO NAME column_name VALUE x)),
{name} AS (SELECT {_VCOLS}, any_value(rows) AS rows, sum(greatest(-ln(t.l), -ln(t.r),
    CASE WHEN t.sg > 0 THEN -ln(t.r) WHEN t.sg < 0 THEN -ln(t.l) ELSE -ln(t.l) - ln(t.r) END)) AS ecod_score
    FROM {name}_u u JOIN {tails} t ON t.column_name = u.column_name AND t.x = CAST(u.x AS DOUBLE)
    GROUP BY {_VCOLS})"""


SQL = {
    "e1_ecod_lineitem": f"""WITH tr AS (SELECT {_M} FROM {SQL_REF}), cu AS (SELECT {_M} FROM {SQL_CUR}),
trv AS (SELECT {_M}, count(*) AS rows FROM tr GROUP BY {_M}),
cuv AS (SELECT {_M}, count(*) AS rows FROM cu GROUP BY {_M}),
{_tails('tr', 'ttrain')},
{_tails('(SELECT * FROM tr UNION ALL SELECT * FROM cu)', 'tunion')},
{_score('trv', 'ttrain', 'strain')},
{_score('cuv', 'tunion', 'scur')},
thr AS (SELECT quantile_cont(ecod_score, {1 - CONTAMINATION}) AS threshold
    FROM strain JOIN tr ON """ + " AND ".join(f"strain.v_{c} = tr.{c}" for c in MEASURES) + f"""),
o AS (SELECT * FROM scur, thr)
SELECT """ + ", ".join(f"v_{c} AS {c}" for c in MEASURES) + """, rows, ecod_score, threshold,
  CAST(ecod_score > threshold AS INTEGER) AS prediction FROM o""",
}

_NEW = []
for _c in MEASURES:
    _NEW.append(f"""b_{_c} AS (SELECT CAST({_c} AS DOUBLE) AS x, count(*) AS cnt FROM {SQL_REF} WHERE {_c} IS NOT NULL GROUP BY 1),
t_{_c} AS (SELECT x, sum(cnt) OVER (ORDER BY x) AS cum, sum(cnt) OVER () AS n FROM b_{_c}),
v_{_c} AS (SELECT v, l / n AS lt, r / n AS rt FROM (
  SELECT d.v, coalesce((SELECT max(cum) FROM t_{_c} WHERE x <= d.v), 0) AS l,
         (SELECT max(n) FROM t_{_c}) - coalesce((SELECT max(cum) FROM t_{_c} WHERE x < d.v), 0) AS r,
         (SELECT max(n) FROM t_{_c}) AS n
  FROM (SELECT DISTINCT CAST({_c} AS DOUBLE) AS v FROM lineitem WHERE {_c} IS NOT NULL) d)),
o_{_c} AS (SELECT v, CASE WHEN lt = 0 OR rt = 0 THEN CAST('inf' AS DOUBLE) ELSE greatest(-ln(lt), -ln(rt),
    CASE WHEN sg > 0 THEN -ln(rt) WHEN sg < 0 THEN -ln(lt) ELSE -ln(lt) - ln(rt) END) END AS o
  FROM v_{_c}, (SELECT sign(skewness(CAST({_c} AS DOUBLE))) AS sg FROM {SQL_REF}))""")
_SUM = " + ".join(f"coalesce(o_{c}.o, 0)" for c in MEASURES)
_JOINS = " ".join(f"LEFT JOIN o_{c} ON o_{c}.v = CAST(li.{c} AS DOUBLE)" for c in MEASURES)
SQL["e1_ecod_new_lineitem"] = "WITH " + ",\n".join(_NEW) + f""",
thr AS (SELECT quantile_cont({_SUM}, {1 - CONTAMINATION}) AS threshold FROM {SQL_REF} li {_JOINS}),
s AS (SELECT li.l_orderkey, li.l_linenumber, {", ".join(f"li.{c}" for c in MEASURES)}, {_SUM} AS o
  FROM {SQL_CUR} li {_JOINS})
SELECT l_orderkey, l_linenumber, {_M}, CASE WHEN NOT isinf(o) THEN o END AS ecod_score, isinf(o) AS out_of_range,
  threshold, CAST(o > threshold AS INTEGER) AS prediction FROM s, thr"""

# scaled measures have the ECDF ranks of the raw ones, but for the skew's sign (scales
# are positive), so the raw tails serve
_PAR = ("""par AS (SELECT column_name, q[2] AS center, CASE WHEN q[3] - q[1] = 0 THEN 1.0 ELSE q[3] - q[1] END AS scale
  FROM (SELECT column_name, quantile_cont(x, [0.25, 0.5, 0.75]) AS q FROM """ + sql_unpivot(SQL_REF, MEASURES)
        + " GROUP BY column_name))")
_REACH = "greatest(" + ", ".join(
    f"coalesce(abs((CAST(li.{c} AS DOUBLE) - (SELECT center FROM par WHERE column_name = '{c}')) "
    f"/ (SELECT scale FROM par WHERE column_name = '{c}')), 0)" for c in MEASURES) + ")"
_FIT = "WITH " + ",\n".join(_NEW) + f""",
{_PAR},
tr AS (SELECT {_SUM} AS ecod_score, {_REACH} AS reach FROM {SQL_REF} li {_JOINS}),
mm AS (SELECT min(ecod_score) AS e0, max(ecod_score) AS e1, min(reach) AS r0, max(reach) AS r1 FROM tr),
cat AS (SELECT l_returnflag AS category, row_number() OVER (ORDER BY l_returnflag) - 1 AS position
  FROM (SELECT DISTINCT l_returnflag FROM {SQL_REF}))"""
SQL["d10_fit_saved_lineitem"] = _FIT + f"""
SELECT 'scaler' AS parameter, column_name AS name, center AS a, scale AS b FROM par
UNION ALL SELECT 'category', category, position, NULL FROM cat
UNION ALL SELECT 'minmax', 'ecod_score', e0, e1 FROM mm UNION ALL SELECT 'minmax', 'reach', r0, r1 FROM mm
UNION ALL SELECT 'ensemble', 'weights', 0.6, 0.4
""" + "".join(f"UNION ALL SELECT 'ecdf', '{c}', count(DISTINCT {c}), count({c}) FROM {SQL_REF}\n" for c in MEASURES)
SQL["g9_score_saved_lineitem"] = _FIT + f""",
s AS (SELECT li.l_orderkey, li.l_linenumber, position AS type_position, {_SUM} AS o,
  0.6 * (({_SUM}) - e0) / (e1 - e0) + 0.4 * ({_REACH} - r0) / (r1 - r0) AS score
  FROM {SQL_CUR} li {_JOINS} LEFT JOIN cat ON category = l_returnflag, mm)
SELECT l_orderkey, l_linenumber, type_position, CASE WHEN NOT isinf(o) THEN score END AS anomaly_score,
  CAST(score >= 0.5 AS INTEGER) AS prediction FROM s"""

SQL["e3_lof_embeddings"] = """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT a.vec_id AS q, b.vec_id AS r, list_distance(a.v, b.v) AS dist
        FROM e a JOIN e b ON a.vec_id <> b.vec_id),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY dist, r) AS rn FROM d)
        WHERE rn <= {k}),
kd AS (SELECT q AS id, max(dist) AS kdist FROM nn GROUP BY q),
lrd AS (SELECT nn.q AS id, 1.0 / (avg(greatest(kd.kdist, nn.dist)) + 1e-10) AS lrd
          FROM nn JOIN kd ON kd.id = nn.r GROUP BY nn.q),
lof AS (SELECT nn.q AS vec_id, avg(l2.lrd) / any_value(l1.lrd) AS lof, any_value(l1.lrd) AS lrd
          FROM nn JOIN lrd l2 ON l2.id = nn.r JOIN lrd l1 ON l1.id = nn.q GROUP BY nn.q),
off AS (SELECT quantile_cont(-lof, {c}) AS offset FROM lof)
SELECT lof.vec_id, kd.kdist, lof.lrd, lof.lof, CAST(-lof.lof < off.offset AS INTEGER) AS prediction
  FROM lof JOIN kd ON kd.id = lof.vec_id, off""".format(k=LOF_K, c=LOF_CONTAMINATION)

_DOCS = """(SELECT doc_id, source, 0.6 * ((score - mn_a) / ((CASE WHEN mx_a = mn_a THEN mn_a + 1.0 ELSE mx_a END) - mn_a))
      + 0.4 * ((score2 - mn_b) / ((CASE WHEN mx_b = mn_b THEN mn_b + 1.0 ELSE mx_b END) - mn_b)) AS anomaly_score
  FROM (SELECT doc_id, source, CAST(n_chars AS DOUBLE) AS score,
          CAST(n_chars AS DOUBLE) / (length(text) - length(replace(text, ' ', '')) + 1) AS score2 FROM documents) s,
       (SELECT min(CAST(n_chars AS DOUBLE)) mn_a, max(CAST(n_chars AS DOUBLE)) mx_a,
               min(CAST(n_chars AS DOUBLE) / (length(text) - length(replace(text, ' ', '')) + 1)) mn_b,
               max(CAST(n_chars AS DOUBLE) / (length(text) - length(replace(text, ' ', '')) + 1)) mx_b
          FROM documents) p)"""
SQL["e6_gamma_embeddings"] = """SELECT var_pop(CAST(v AS DOUBLE)) AS variance,
  1.0 / (64 * var_pop(CAST(v AS DOUBLE))) AS gamma_scale, 1.0 / 64 AS gamma_auto
  FROM (SELECT unnest(embedding) AS v FROM embeddings)"""
SQL["e9_batch_totals_documents"] = f"""SELECT source AS batch_id, count(*) AS instance_count,
  CAST(sum(CAST(anomaly_score >= 0.5 AS INTEGER)) AS BIGINT) AS anomaly_count,
  count(*) - CAST(sum(CAST(anomaly_score >= 0.5 AS INTEGER)) AS BIGINT) AS normal_count,
  'weighted_ensemble' AS model_name, '1' AS model_version FROM {_DOCS} GROUP BY source"""
SQL["e10_worklist_documents"] = f"""SELECT doc_id, source, anomaly_score FROM {_DOCS}
  WHERE anomaly_score >= 0.5 ORDER BY anomaly_score DESC, doc_id"""
SQL["h19_prediction_log_documents"] = f"""SELECT '{LOG_TIME}' AS timestamp,
  'batch-' || d.source AS request_id, '/predict/batch' AS endpoint,
  'weighted_ensemble' AS model_name, '1' AS model_version, d.doc_id, s.score, s.score2,
  CAST(d.anomaly_score >= 0.5 AS INTEGER) AS prediction, d.anomaly_score >= 0.5 AS anomaly,
  d.anomaly_score
  FROM {_DOCS} d JOIN (SELECT doc_id, CAST(n_chars AS DOUBLE) AS score,
          CAST(n_chars AS DOUBLE) / (length(text) - length(replace(text, ' ', '')) + 1) AS score2
        FROM documents) s ON d.doc_id = s.doc_id"""
