"""Feature engineering D1-D12: label repair, engineered columns, feature
sets, stratified split, robust scaling and one-hot encoding.

Fitted preprocessors are small parameter tables ``(column_name, center,
scale)`` and a category list, applied by joining a one-row broadcast table:
no fitted object lives on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.functions.exprs import long_form
from telemetra.plans.hscan import exact_quantiles, prefix_sums
from telemetra.session import cut_lineage

TEMP_DIFF = "Temperature difference"
POWER = "Power"
TORQUE_WEAR = "Torque_ToolWear_Product"


@dataclass
class Roles:
    """Which physical column plays which telemetry role."""
    type_col: str = "Type"
    air: str = "Air temperature"
    process: str = "Process temperature"
    speed: str = "Rotational speed"
    torque: str = "Torque"
    wear: str = "Tool wear"
    target: str = "Machine failure"
    modes: Sequence[str] = field(default_factory=lambda: ["TWF", "HDF", "PWF", "OSF", "RNF"])
    row_id: Sequence[str] = field(default_factory=lambda: ["UID"])

    def feature_sets(self) -> dict[str, list[str]]:
        base = [self.type_col, self.air, self.process, self.speed, self.torque, self.wear]
        return {
            "base": base,
            "engineered": base + [TEMP_DIFF, POWER, TORQUE_WEAR],
            "engineered_only": [self.type_col, TEMP_DIFF, POWER, TORQUE_WEAR],
            "reduced": [self.type_col, self.process, TEMP_DIFF, self.speed, self.torque,
                        self.wear, TORQUE_WEAR],
        }


def repair_labels(df: DataFrame, roles: Roles) -> DataFrame:
    """Target 0 with any failure mode 1 becomes 1."""
    t = F.col(roles.target)
    g = F.greatest(*[F.col(m) for m in roles.modes])
    return df.withColumn(roles.target, F.when((t == 0) & (g == 1), F.lit(1)).otherwise(t))


def engineer(df: DataFrame, roles: Roles) -> DataFrame:
    """Temperature difference, mechanical power (W), torque x wear."""
    return (df.withColumn(TEMP_DIFF, F.col(roles.process) - F.col(roles.air))
            .withColumn(POWER, F.col(roles.torque) * (2 * math.pi * F.col(roles.speed) / 60))
            .withColumn(TORQUE_WEAR, F.col(roles.torque) * F.col(roles.wear)))


def select_features(df: DataFrame, roles: Roles, feature_set: str, keep: Sequence[str] = ()
                    ) -> DataFrame:
    """Project a named feature set (unknown name -> error)."""
    sets = roles.feature_sets()
    if feature_set not in sets:
        raise ValueError(f"unknown feature set {feature_set!r}; choose from {sorted(sets)}")
    return df.select(*keep, *sets[feature_set])


def stratified_split(df: DataFrame, id_cols: Sequence[str], label: str, seed: int = 42,
                     shares: tuple[float, float] = (0.70, 0.85), accuracy: int = 100000, exact: bool = False
                     ) -> DataFrame:
    """Seeded 70/15/15 split per class.  Each row gets a number in [0, 1) from the
    MD5 of its stable id; a class is cut at the quantiles of its numbers, from a bounded
    sketch (one aggregate, no sort), or with ``exact`` at the exact ones (any engine cuts
    there).  Membership is repeatable under repartitioning and recomputation."""
    h = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in id_cols], F.lit(str(seed))))
    x = df.withColumn("_h", F.conv(F.substring(h, 1, 12), 16, 10).cast("long") / float(16 ** 12))
    if exact:
        q = exact_quantiles(x.select(label, "_h"), [label], "_h", list(shares))
        cuts = q.groupBy(label).agg(F.array_sort(F.collect_list("q")).alias("_cuts"))
    else:
        cuts = x.groupBy(label).agg(F.percentile_approx("_h", list(shares), accuracy).alias("_cuts"))
    return (x.join(F.broadcast(cuts), label)
            .withColumn("split", F.when(F.col("_h") <= F.col("_cuts")[0], "train")
                        .when(F.col("_h") <= F.col("_cuts")[1], "validation").otherwise("test"))
            .drop("_h", "_cuts"))


def fit_rows(df: DataFrame, label: str, approach: str = "semi_supervised") -> DataFrame:
    """The rows a detector is fitted on."""
    if approach == "semi_supervised":
        return df.where(F.col(label) == 0)
    if approach == "unsupervised":
        return df
    raise ValueError("approach must be 'semi_supervised' or 'unsupervised'")


def fit_robust_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, center, scale) with center = median, scale = IQR;
    zero IQR -> 1 (scikit-learn ``RobustScaler``)."""
    long = long_form(df, columns)
    q = exact_quantiles(long, ["column_name"], "x", [0.25, 0.5, 0.75])
    p = q.groupBy("column_name").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("_q1"),
        F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("center"),
        F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("_q3"))
    iqr = F.col("_q3") - F.col("_q1")
    return p.select("column_name", "center",
                    F.when(iqr == 0, F.lit(1.0)).otherwise(iqr).alias("scale"))


def apply_robust_scaler(df: DataFrame, params: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale with frozen parameters; the tiny parameter table is pivoted
    to one row and broadcast."""
    wide = params.groupBy().pivot("column_name", list(columns)).agg(
        F.first("center").alias("c"), F.first("scale").alias("s"))
    out = df.crossJoin(F.broadcast(wide))
    for c in columns:
        out = out.withColumn(c, (F.col(c).cast("double") - F.col(f"{c}_c")) / F.col(f"{c}_s"))
    return out.drop(*[f"{c}_c" for c in columns], *[f"{c}_s" for c in columns])


#: Up to so many categories become columns; more become one sparse column.
WIDE_CATEGORIES = 1000


def fit_categories(df: DataFrame, column: str) -> DataFrame:
    """The sorted distinct categories of the fit rows as a table (category,
    position), however many: a parameter table, fit to be saved."""
    cats = cut_lineage(df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("category")).agg(
        F.lit(1).alias("one")))
    return prefix_sums(cats, [], "category", ["one"], with_totals=False).select(
        "category", (F.col("cum_one") - 1).cast("long").alias("position"))


def fit_one_hot(df: DataFrame, column: str) -> list | DataFrame:
    """The sorted category list where it is short enough for a column each
    (counted), else the category table."""
    cats = cut_lineage(fit_categories(df, column))
    if cats.count() > WIDE_CATEGORIES:
        return cats
    return sorted(r[0] for r in cats.select("category").collect())


def apply_one_hot(df: DataFrame, column: str, categories: Sequence | DataFrame, prefix: str | None = None,
                  drop: bool = True) -> DataFrame:
    """Unseen categories give all zeros (``handle_unknown='ignore'``).  With a category
    table the row of zeros and a one is kept as ``<prefix>_position``, NULL for none:
    the table is joined, sent along only if Spark finds it small."""
    pre = prefix or column
    if isinstance(categories, DataFrame):
        known = categories.select(F.col("category").alias("_oh"), F.col("position").alias(f"{pre}_position"))
        out = df.join(known, df[column] == known["_oh"], "left").drop("_oh")
        return out.drop(column) if drop else out
    out = df.withColumns({f"{pre}_{cat}": F.coalesce((F.col(column) == F.lit(cat)).cast("double"), F.lit(0.0))
                          for cat in categories}) if categories else df
    return out.drop(column) if drop else out


def preprocess(df: DataFrame, roles: Roles, feature_set: str, fit_filter, approach: str,
               keep: Sequence[str] = (), raw: str | None = None) -> tuple[DataFrame, DataFrame, list]:
    """Fit scaler + encoder on the fit rows, apply to every row.  Returns
    (features, scaler parameters, categories).  ``fit_filter`` selects the
    training rows (a Column).  With ``raw`` (D11) every input column is also kept
    unscaled under that prefix, beside its row's split and features."""
    feats = engineer(df, roles)
    cols = roles.feature_sets()[feature_set]
    numeric = [c for c in cols if c != roles.type_col]
    fit = fit_rows(feats.where(fit_filter), roles.target, approach)
    params = fit_robust_scaler(fit, numeric)
    cats = fit_one_hot(fit, roles.type_col)
    kept = [F.col(c).alias(f"{raw}{c}") for c in cols] if raw else []
    out = feats.select(*keep, *kept, *cols)
    out = apply_robust_scaler(out, params, numeric)
    out = apply_one_hot(out, roles.type_col, cats)
    return out, params, cats
