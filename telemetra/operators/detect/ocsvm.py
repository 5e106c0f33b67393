"""E4 One-Class SVM (RBF) in primal form with random Fourier features; E6 gamma.

The kernel ``exp(-gamma |x - y|^2)`` is approximated by
``phi(x) = sqrt(2/D) cos(W x + b)`` with ``W ~ N(0, 2 gamma)``,
``b ~ U(0, 2 pi)`` (Rahimi and Recht, 2007).  The one-class objective
``0.5 |w|^2 - rho + 1/(nu n) sum max(0, rho - w.phi(x_i))`` is minimised by steps of w;
the best rho for a w is the nu-quantile of ``w.phi(x)``.  A step is one pass over the
rows with one buffer per partition: the sum of phi over the rows below the current rho,
and a histogram of ``w.phi(x)`` (bounded by ``sqrt(2) |w|``) from which the next rho is
read.  Only these D + HISTOGRAM + 1 numbers reach the driver, whatever the rows.  Steps
end when the averaged w no longer moves.  The random projection (D x d) is sent once.

Score ``rho - w.phi(x)``: positive outside the learned support (higher = more
anomalous, the reference's negated decision function).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.session import cut_lineage, ship_package


def gamma_scale(df: DataFrame, vec_col: str, dims: int) -> DataFrame:
    """Gamma 'scale' = 1 / (n_features * Var(X)) over every matrix entry;
    'auto' = 1 / n_features."""
    v = df.select(F.explode(F.col(vec_col)).alias("v"))
    return v.agg(F.var_pop(F.col("v").cast("double")).alias("variance")).select(
        "variance", (1.0 / (F.lit(dims) * F.col("variance"))).alias("gamma_scale"),
        F.lit(1.0 / dims).alias("gamma_auto"))


#: Cells of the histogram that rho is read from.
HISTOGRAM = 8192


class RffOneClass:
    def __init__(self, dims: int, gamma: float, nu: float = 0.05, n_features: int = 2048,
                 steps: int = 13, tolerance: float = 0.01, seed: int = 42):
        rng = np.random.default_rng(seed)
        self.W = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(n_features, dims))
        self.b = rng.uniform(0.0, 2 * np.pi, size=n_features)
        self.D, self.nu, self.steps, self.tolerance = n_features, nu, steps, tolerance
        self.w = np.zeros(n_features)
        self.rho = 0.0
        #: passes over the rows that the last fit took
        self.passes = 0

    def fit(self, df: DataFrame, vec_col: str) -> "RffOneClass":
        """The first pass takes the mean of phi as w.  Every further one takes the
        step of the strongly convex part with rate 1/(t+1) (Pegasos) at the rho read from
        the pass before, and the iterates are averaged with rising weight.  It ends after
        ``steps`` passes, or when the average moves by less than ``tolerance`` of its
        length.  A last pass sets rho for the averaged w: ``steps`` + 2 passes at most."""
        spark = df.sparkSession
        ship_package(spark)
        src = cut_lineage(df.select(vec_col))
        sent = spark.sparkContext.broadcast((self.W, self.b))
        self.passes = 0
        total, _, n = self._pass(src, vec_col, sent, None, 0.0)
        if not n:
            raise ValueError("no rows to fit")
        self.w = total / n
        rho, average, weight = 0.0, np.zeros(self.D), 0.0
        for t in range(1, self.steps + 1):
            below, rho, n = self._pass(src, vec_col, sent, self.w, rho if t > 1 else None)
            if t > 1:                                     # the first pass only finds rho
                eta = 1.0 / t
                self.w = (1 - eta) * self.w + eta * below / (self.nu * n)
            before = average
            weight += t
            average = before + (self.w - before) * (t / weight)
            if t > 2 and np.linalg.norm(average - before) <= self.tolerance * np.linalg.norm(average):
                break
        self.w = average
        _, self.rho, _ = self._pass(src, vec_col, sent, self.w, None)
        sent.unpersist()
        return self

    def _pass(self, src: DataFrame, vec_col: str, sent, w: np.ndarray | None, rho: float | None):
        """One pass: (sum of phi over rows with w.phi < rho, or over all without w; the
        nu-quantile of w.phi; rows)."""
        D, nu = self.D, self.nu
        bound = float(np.sqrt(2.0) * np.linalg.norm(w)) if w is not None else 0.0

        def fn(it):
            W, b = sent.value
            g, cells, n = np.zeros(D), np.zeros(HISTOGRAM), 0.0
            for pdf in it:
                if len(pdf) == 0:
                    continue
                x = np.stack([np.asarray(v, dtype=np.float64) for v in pdf[vec_col]])
                phi = np.sqrt(2.0 / D) * np.cos(x @ W.T + b)
                n += len(x)
                if w is None:
                    g += phi.sum(0)
                    continue
                s = phi @ w
                if rho is not None:
                    g += phi[s < rho].sum(0)
                at = np.clip((s + bound) / (2 * bound or 1.0) * HISTOGRAM, 0, HISTOGRAM - 1).astype(int)
                cells += np.bincount(at, minlength=HISTOGRAM)
            held = np.concatenate([g, cells, [n]])
            j = np.flatnonzero(held)
            yield pd.DataFrame({"j": j.astype(np.int32), "v": held[j]})

        # the partial buffers are added by a grouped sum, map-side first
        found = (src.mapInPandas(fn, "j int, v double").groupBy("j").agg(F.sum("v").alias("v")).toPandas()
                 .set_index("j")["v"].reindex(range(D + HISTOGRAM + 1), fill_value=0.0).to_numpy())
        self.passes += 1
        cells, n = found[D:D + HISTOGRAM], found[-1]
        upto = np.cumsum(cells)
        cell = int(np.searchsorted(upto, nu * n)) if w is not None else 0
        within = (nu * n - (upto[cell] - cells[cell])) / max(cells[cell], 1.0) if w is not None and cell < HISTOGRAM else 0.0
        return found[:D], -bound + 2 * bound * (cell + within) / HISTOGRAM, n

    def score(self, df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
        W, b, D, w, rho = self.W, self.b, self.D, self.w, self.rho

        def fn(it):
            for pdf in it:
                if len(pdf) == 0:
                    continue
                x = np.stack([np.asarray(v, dtype=np.float64) for v in pdf[vec_col]])
                phi = np.sqrt(2.0 / D) * np.cos(x @ W.T + b)
                s = rho - phi @ w
                yield pd.DataFrame({"id": pdf[id_col].astype("int64"), "ocsvm_score": s,
                                    "prediction": (s > 0).astype("int32")})

        ship_package(df.sparkSession)
        return df.select(id_col, vec_col).mapInPandas(fn, "id long, ocsvm_score double, prediction int")
