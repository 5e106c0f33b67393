"""Score ensembles G1-G9."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra import config
from telemetra.operators.evaluate import evaluate_grouped
from telemetra.plans.hscan import average_ranks
from telemetra.plans.lookup import keyed_lookup
from telemetra.session import cut_lineage


def fit_minmax(df: DataFrame, score: str) -> DataFrame:
    """G1: one row (min, max); a constant score gets max = min + 1."""
    g = df.agg(F.min(score).alias("min"), F.max(score).alias("max"))
    return g.select("min", F.when(F.col("max") == F.col("min"), F.col("min") + 1.0)
                    .otherwise(F.col("max")).alias("max"))


def apply_minmax(df: DataFrame, score: str, params: DataFrame, out: str) -> DataFrame:
    """(s - min) / (max - min) with frozen parameters, no clipping.  The
    parameter row is one row, broadcast."""
    p = params.select(F.col("min").alias("_mn"), F.col("max").alias("_mx"))
    return (df.crossJoin(F.broadcast(p))
            .withColumn(out, (F.col(score) - F.col("_mn")) / (F.col("_mx") - F.col("_mn")))
            .drop("_mn", "_mx"))


def percentile_rank(df: DataFrame, score: str, out: str) -> DataFrame:
    """Average rank of ties divided by n (pandas ``rank(pct=True)``), from
    distinct-score counts and a distributed prefix sum -- not
    ``percent_rank()``, which differs on ties and runs in one task without a
    partition.  A hot score is no join key (``plans.lookup``)."""
    r = average_ranks(df, [], score).select(score, "cnt", (F.col("rank_avg") / F.col("n")).alias(out))
    return keyed_lookup(df, r, [score], "cnt", [out])


def weighted(a: str, b: str, wa: float | str, wb: float | str) -> F.Column:
    """G4."""
    ca = F.col(wa) if isinstance(wa, str) else F.lit(float(wa))
    cb = F.col(wb) if isinstance(wb, str) else F.lit(float(wb))
    return ca * F.col(a) + cb * F.col(b)


def minimum(a: str, b: str) -> F.Column:
    """G5."""
    return F.least(F.col(a), F.col(b))


def cascade(first: str, second: str, gate: float | str) -> F.Column:
    """Second stage's score where the first stage reaches the gate, else 0."""
    g = F.col(gate) if isinstance(gate, str) else F.lit(float(gate))
    return F.when(F.col(first) >= g, F.col(second)).otherwise(F.lit(0.0))


def weight_grid(spark, weights: Sequence[tuple[float, float]]) -> DataFrame:
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(weights)],
                                 "weight_id int, w_a double, w_b double")


def gate_grid(spark, gates: Sequence[float]) -> DataFrame:
    return spark.createDataFrame([(i, float(g)) for i, g in enumerate(gates)],
                                 "gate_id int, gate double")


def gate_search(df: DataFrame, y: str, first: str, second: str, gates: Sequence[float],
                min_recall: float = config.MIN_RECALL) -> DataFrame:
    """One cascade order under every gate: the curve metrics, the operating point
    with the required recall and ``reach``, the share of positives that pass the gate.
    Where it is below the recall, only the threshold 0 (all rows) reaches it; a gate
    with no threshold that does is left out.  All gates are one grouped job over the
    rows collapsed to (first's highest gate passed, second score, label)."""
    spark = df.sparkSession
    grid = gate_grid(spark, sorted(gates))
    passed = F.size(F.filter(F.array(*[F.lit(float(g)) for g in sorted(gates)]), lambda g: g <= F.col(first)))
    rows = cut_lineage(df.groupBy(passed.alias("_passed"), F.col(second).alias("_second"), F.col(y).alias("y"))
                       .agg(F.count(F.lit(1)).alias("_w")))
    long = rows.join(F.broadcast(grid)).select(
        "gate_id", "gate", "y", F.when(F.col("_passed") > F.col("gate_id"), F.col("_second")).otherwise(F.lit(0.0)).alias("score"),
        "_w", (F.col("_passed") > F.col("gate_id")).alias("_through"))
    reach = long.groupBy("gate_id", "gate").agg(F.try_divide(
        F.sum(F.when(F.col("_through") & (F.col("y") == 1), F.col("_w")).otherwise(0)),
        F.sum(F.when(F.col("y") == 1, F.col("_w")).otherwise(0))).alias("reach"))
    found = evaluate_grouped(long, "y", "score", ["gate_id", "gate"], min_recall, weight="_w")
    return found.join(reach, ["gate_id", "gate"]).where(F.col("threshold").isNotNull())


def best_gate(found: DataFrame) -> DataFrame:
    """The gate of the highest (pr_auc, precision, -fpr, recall); the first wins ties."""
    key = F.struct("pr_auc", "precision", -F.col("false_positive_rate"), "recall", -F.col("gate_id"))
    return found.agg(F.max_by(F.struct(*found.columns), key).alias("b")).where("b IS NOT NULL").select("b.*")


def operational_score(df: DataFrame, a: str, b: str, params_a: DataFrame, params_b: DataFrame,
                      wa: float, wb: float, threshold: float) -> DataFrame:
    """Frozen min-max per detector, weighted sum, inclusive threshold."""
    out = apply_minmax(apply_minmax(df, a, params_a, "_na"), b, params_b, "_nb")
    return (out.withColumn("anomaly_score", weighted("_na", "_nb", wa, wb))
            .withColumn("prediction", (F.col("anomaly_score") >= F.lit(threshold)).cast("int"))
            .drop("_na", "_nb"))
