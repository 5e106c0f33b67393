"""Registered LOF queries on new rows: E3 novelty mode, the k list, and the recall of
the approximate neighbour index; isolation forest and one-class SVM scoring by frozen
parameters.

A customer is one row of six numbers (account balance, nation, and count, sum, mean and
maximum of the orders' prices), robust-scaled with the training parameters.  The market
segment MACHINERY is the new batch; the detector is fitted on all other customers.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.operators import features as D
from telemetra.operators.detect import iforest as IF
from telemetra.operators.detect import lof as LOF
from telemetra.operators.detect import ocsvm as SVM
from telemetra.plans.knn import Boxes, Leaves, recall_lists
from telemetra.session import cut_lineage, release
from telemetra.sources.tables import table

COLUMNS = ["balance", "nation", "orders", "spent", "mean_price", "top_price"]
NEW = "MACHINERY"
KS = [20, 30, 40, 50, 60, 80, 100]
CONTAMINATION = 0.05
#: Customers whose neighbour lists are held at once, up to SLICES times; queries of a block.
SLICE_ROWS, SLICES, BLOCK = 100_000, 8, 6_000


def _customers(spark, sf_dir) -> DataFrame:
    spent = (table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id"))
             .agg(F.count(F.lit(1)).cast("double").alias("orders"), F.sum("o_totalprice").alias("spent"),
                  F.avg("o_totalprice").alias("mean_price"), F.max("o_totalprice").alias("top_price")))
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), (F.col("c_mktsegment") == NEW).alias("is_new"),
        F.col("c_acctbal").alias("balance"), F.col("c_nationkey").cast("double").alias("nation"))
    return cut_lineage(rows.join(spent, "id", "left").na.fill(0.0, COLUMNS[2:]))


def _scaled(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(training vectors, new vectors)."""
    rows = _customers(spark, sf_dir)
    params = D.fit_robust_scaler(rows.where(~F.col("is_new")), COLUMNS)
    ready = cut_lineage(D.apply_robust_scaler(rows, params, COLUMNS)
                        .select("id", "is_new", F.array(*COLUMNS).alias("vec")))
    release(rows)
    return ready.where(~F.col("is_new")).drop("is_new"), ready.where("is_new").drop("is_new")


def e3_lof_new_customers(spark, sf_dir):
    """Scores, offsets and predictions of the new customers for every k of the list."""
    train, new = _scaled(spark, sf_dir)
    fitted = cut_lineage(LOF.lof_fit_list(train, KS))
    scores = LOF.lof_score_list(new, train, fitted, KS)
    return LOF.lof_predict(scores, LOF.lof_offsets(fitted, CONTAMINATION)).select(
        F.col("id").alias("c_custkey"), "k", "lof", "offset", "anomaly_score", "prediction")


def e3_neighbour_recall_customers(spark, sf_dir):
    """How much of the exact neighbour lists of all customers (training and new) the
    approximate index finds, for every k of the list.  Both lists of a slice of customers
    are compared and deleted before the next slice's are made: whole lists of all would
    take several times the input."""
    train, new = _scaled(spark, sf_dir)
    boxes, leaves = Boxes(train), Leaves(train)
    counts = []
    for every in leaves.slices(train.unionByName(new), SLICE_ROWS, SLICES):
        exact = LOF.neighbour_lists(every, boxes, max(KS), exclude_self=True, block=BLOCK)
        found = LOF.neighbour_lists(every, leaves, max(KS), exclude_self=True, approximate=True, block=BLOCK)
        counts.append(cut_lineage(recall_lists(found, exact, KS).select("k", "neighbours", "found")))
        release(exact, found)
    return (reduce(DataFrame.unionByName, counts).groupBy("k")
            .agg(F.sum("neighbours").alias("neighbours"), F.sum("found").alias("found"))
            .withColumn("recall", F.col("found") / F.col("neighbours")))


# -- frozen detectors: parameter tables given by a rule, so that any engine can score ----
TREES, DEPTH, DIMS, FEATURES = 5, 3, 64, 8


def frozen_forest() -> pd.DataFrame:
    """A complete forest of the isolation forest's node table: node i of tree t splits
    column (11 t + 5 i) mod 64 at (t - 2) / 50; the leaves hold 2, 5, 8, ... rows."""
    rows, inner = [], (1 << DEPTH) - 1
    for t in range(TREES):
        for i in range(2 * inner + 1):
            leaf = i >= inner
            rows.append((t, i, -1 if leaf else (11 * t + 5 * i) % DIMS, 0.0 if leaf else (t - 2) / 50,
                         -1 if leaf else 2 * i + 1, -1 if leaf else 2 * i + 2, 2 + 3 * (i - inner) if leaf else 0, 128))
    return pd.DataFrame(rows, columns=["tree", "node", "feature", "split", "left", "right", "size", "sample"])


def frozen_svm() -> SVM.RffOneClass:
    """A one-class SVM of eight features whose numbers follow a rule."""
    model = SVM.RffOneClass(DIMS, 1.0, n_features=FEATURES)
    model.W = np.array([[((j + 1) * (d + 3)) % 7 - 3 for d in range(DIMS)] for j in range(FEATURES)]) / 4
    model.b = np.arange(FEATURES) / 2
    model.w, model.rho = (np.arange(FEATURES) - 3) / 8, 0.05
    return model


def _embeddings(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vec"))


def e2_score_frozen_embeddings(spark, sf_dir):
    scored = IF.score_forest(_embeddings(spark, sf_dir), "vec_id", "vec", frozen_forest())
    return scored.select(F.col("id").alias("vec_id"), "iforest_score")


def e4_score_frozen_embeddings(spark, sf_dir):
    return frozen_svm().score(_embeddings(spark, sf_dir), "vec_id", "vec").withColumnRenamed("id", "vec_id")


def _tree_sql(nodes: pd.DataFrame, node: int, depth: int) -> str:
    n = nodes.loc[node]
    if n.feature < 0:
        return repr(float(depth + IF.c_factor(n["size"])))
    return (f"CASE WHEN v[{int(n.feature) + 1}] < {float(n.split)!r} THEN {_tree_sql(nodes, int(n.left), depth + 1)} "
            f"ELSE {_tree_sql(nodes, int(n.right), depth + 1)} END")


_VECTORS = "(SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
_PATHS = " + ".join(_tree_sql(g.reset_index(drop=True), 0, 0) for _, g in frozen_forest().groupby("tree"))
_SVM = frozen_svm()
_DECISION = " + ".join(
    f"{float(_SVM.w[j])!r} * {float(np.sqrt(2 / FEATURES))!r} * cos(list_inner_product(v, {[float(x) for x in _SVM.W[j]]}::DOUBLE[]) + {float(_SVM.b[j])!r})"
    for j in range(FEATURES))


QUERIES = {
    "e2_score_frozen_embeddings": e2_score_frozen_embeddings,
    "e4_score_frozen_embeddings": e4_score_frozen_embeddings,
    "e3_lof_new_customers": e3_lof_new_customers,
    "e3_neighbour_recall_customers": e3_neighbour_recall_customers,
}

_Q = ", ".join(f"quantile_cont({c}, [0.25, 0.5, 0.75]) AS q_{c}" for c in COLUMNS)
_SCALED = ", ".join(f"({c} - q_{c}[2]) / (CASE WHEN q_{c}[3] - q_{c}[1] = 0 THEN 1.0 ELSE q_{c}[3] - q_{c}[1] END) AS {c}" for c in COLUMNS)
_DIST = "sqrt(" + " + ".join(f"pow(a.{c} - b.{c}, 2)" for c in COLUMNS) + ")"

SQL = {
    "e2_score_frozen_embeddings": f"""SELECT vec_id, pow(2.0, -(({_PATHS}) / {TREES}) / {float(IF.c_factor(128))!r}) AS iforest_score
  FROM {_VECTORS}""",
    "e4_score_frozen_embeddings": f"""SELECT vec_id, {_SVM.rho!r} - ({_DECISION}) AS ocsvm_score,
  CAST({_SVM.rho!r} - ({_DECISION}) > 0 AS INTEGER) AS prediction FROM {_VECTORS}""",
    "e3_lof_new_customers": f"""WITH c AS (
  SELECT c_custkey AS id, c_mktsegment = '{NEW}' AS is_new, c_acctbal AS balance, CAST(c_nationkey AS DOUBLE) AS nation,
         coalesce(orders, 0) AS orders, coalesce(spent, 0) AS spent, coalesce(mean_price, 0) AS mean_price,
         coalesce(top_price, 0) AS top_price
  FROM customer LEFT JOIN (SELECT o_custkey, CAST(count(*) AS DOUBLE) AS orders, sum(o_totalprice) AS spent,
      avg(o_totalprice) AS mean_price, max(o_totalprice) AS top_price FROM orders GROUP BY 1) ON o_custkey = c_custkey),
p AS (SELECT {_Q} FROM c WHERE NOT is_new),
z AS (SELECT id, is_new, {_SCALED} FROM c, p),
nn AS (SELECT * FROM (SELECT a.id AS q, a.is_new, b.id AS r, {_DIST} AS dist,
      row_number() OVER (PARTITION BY a.id ORDER BY {_DIST}, b.id) AS rn
    FROM z a JOIN z b ON NOT b.is_new AND a.id <> b.id) WHERE rn <= {max(KS)}),
ks AS (SELECT unnest({KS}) AS k),
n AS (SELECT nn.*, k FROM nn JOIN ks ON rn <= k),
kd AS (SELECT q AS id, k, max(dist) AS kdist FROM n WHERE NOT is_new GROUP BY ALL),
lrd AS (SELECT n.q AS id, n.k, any_value(is_new) AS is_new, 1.0 / (avg(greatest(kdist, dist)) + 1e-10) AS lrd
    FROM n JOIN kd ON kd.id = n.r AND kd.k = n.k GROUP BY n.q, n.k),
lof AS (SELECT n.q AS id, n.k, any_value(n.is_new) AS is_new, avg(o.lrd) / any_value(s.lrd) AS lof
    FROM n JOIN lrd o ON o.id = n.r AND o.k = n.k JOIN lrd s ON s.id = n.q AND s.k = n.k GROUP BY n.q, n.k),
off AS (SELECT k, quantile_cont(-lof, {CONTAMINATION}) AS offset FROM lof WHERE NOT is_new GROUP BY k)
SELECT id AS c_custkey, CAST(lof.k AS INTEGER) AS k, lof, off.offset, lof + off.offset AS anomaly_score,
  CAST(-lof < off.offset AS INTEGER) AS prediction
FROM lof JOIN off ON off.k = lof.k WHERE is_new""",
}
