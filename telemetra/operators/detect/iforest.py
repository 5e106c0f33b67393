"""E2 Isolation Forest: trees grown in parallel, scoring map-only.

Each row joins tree t when a seeded hash of (id, t) falls under a keep
probability sized for ~3x ``max_samples`` rows per tree; each tree then keeps
its ``max_samples`` rows with the smallest hash -- a sample without
replacement that is repeatable under recomputation.  ``groupBy(tree)
.applyInPandas`` grows one tree per group (at most ``max_samples`` rows), the
forest (trees x <= 2*max_samples nodes) is collected -- its size does not grow
with the data -- and scoring is a ``mapInPandas`` over the rows.

Score ``2 ** (-mean path length / c(max_samples))`` (higher = more anomalous).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.plans.hscan import exact_quantiles
from telemetra.session import ship_package

NODE_SCHEMA = ("tree int, node int, feature int, split double, left int, right int, size int, "
               "sample int")
EULER = 0.5772156649015329


def c_factor(n) -> np.ndarray:
    """Average path length of an unsuccessful BST search among n points."""
    n = np.asarray(n, dtype=np.float64)
    out = np.where(n > 2, 2.0 * (np.log(np.maximum(n - 1, 1)) + EULER) - 2.0 * (n - 1) / np.maximum(n, 1),
                   np.where(n == 2, 1.0, 0.0))
    return out


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    nodes = []   # (node, feature, split, left, right, size)

    def build(idx: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append(None)
        sub = x[idx]
        if depth >= max_depth or len(idx) <= 1:
            nodes[me] = (me, -1, 0.0, -1, -1, len(idx))
            return me
        lo, hi = sub.min(0), sub.max(0)
        usable = np.nonzero(hi > lo)[0]
        if len(usable) == 0:
            nodes[me] = (me, -1, 0.0, -1, -1, len(idx))
            return me
        f = int(rng.choice(usable))
        s = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] < s
        left = build(idx[go_left], depth + 1)
        right = build(idx[~go_left], depth + 1)
        nodes[me] = (me, f, s, left, right, len(idx))
        return me

    build(np.arange(len(x)), 0)
    return nodes


def fit_forest(df: DataFrame, id_col: str, vec_col: str, n_trees: int = 100,
               max_samples: int = 256, seed: int = 42) -> pd.DataFrame:
    """Grow the forest; returns the node table (small, bounded by
    n_trees * 2 * max_samples rows), with the rows that each tree was grown from
    (``sample``): it can be saved and read back as it is."""
    n = df.count()
    psi = min(max_samples, n)
    keep = min(1.0, 3.0 * psi / max(n, 1))
    # the whole signed 64-bit hash range: a keep probability of ~1e-9 (10^12
    # rows) still maps to a threshold with ~10^10 hash values below it
    limit = min(int(-(2 ** 63) + keep * 2.0 ** 64), 2 ** 63 - 1)
    h = lambda t: F.xxhash64(F.col(id_col), t, F.lit(seed))
    trees = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)),
                     lambda t: F.lit(keep >= 1.0) | (h(t) <= F.lit(limit)))
    sampled = (df.select(id_col, vec_col, F.explode(trees).alias("tree"))
               .withColumn("_h", h(F.col("tree"))))
    depth = int(math.ceil(math.log2(max(psi, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_h", id_col]).head(psi)
        tree = int(pdf["tree"].iloc[0])
        x = np.stack([np.asarray(v, dtype=np.float64) for v in pdf[vec_col]])
        rng = np.random.default_rng([seed, tree])
        nodes = _grow(x, rng, depth)
        out = pd.DataFrame(nodes, columns=["node", "feature", "split", "left", "right", "size"])
        out.insert(0, "tree", tree)
        return out.astype({"tree": "int32", "node": "int32", "feature": "int32", "left": "int32",
                           "right": "int32", "size": "int32"}).assign(sample=np.int32(psi))

    ship_package(df.sparkSession)
    forest = sampled.groupBy("tree").applyInPandas(grow, NODE_SCHEMA)
    return forest.toPandas()


def score_forest(df: DataFrame, id_col: str, vec_col: str, nodes: pd.DataFrame) -> DataFrame:
    """(id, iforest_score) by vectorised traversal of every tree."""
    psi = int(nodes["sample"].iloc[0])
    trees = []
    for t, g in nodes.groupby("tree"):
        g = g.sort_values("node")
        trees.append((g["feature"].to_numpy(), g["split"].to_numpy(), g["left"].to_numpy(),
                      g["right"].to_numpy(), g["size"].to_numpy()))
    norm = float(c_factor(psi))

    def fn(it):
        for pdf in it:
            if len(pdf) == 0:
                continue
            x = np.stack([np.asarray(v, dtype=np.float64) for v in pdf[vec_col]])
            total = np.zeros(len(x))
            for feat, split, left, right, size in trees:
                node = np.zeros(len(x), dtype=np.int64)
                depth = np.zeros(len(x))
                active = feat[node] >= 0
                while active.any():
                    f = feat[node[active]]
                    goes_left = x[active, f] < split[node[active]]
                    node[active] = np.where(goes_left, left[node[active]], right[node[active]])
                    depth[active] += 1
                    active = feat[node] >= 0
                total += depth + c_factor(size[node])
            score = np.power(2.0, -(total / len(trees)) / norm)
            yield pd.DataFrame({"id": pdf[id_col].astype("int64"), "iforest_score": score})

    ship_package(df.sparkSession)
    return df.select(id_col, vec_col).mapInPandas(fn, "id long, iforest_score double")


def iforest_threshold(train_scores: DataFrame, contamination: float) -> DataFrame:
    """E5: (1 - contamination) quantile of the training scores."""
    return exact_quantiles(train_scores.select(F.col("iforest_score").alias("x")), [], "x",
                           [1 - contamination]).select(F.col("q").alias("threshold"))
