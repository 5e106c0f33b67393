"""E1 ECOD: empirical-CDF outlier detection.

Per feature, the left tail ``P(X <= x)`` and right tail ``P(X >= x)`` come from the
fitted model, a table of the distinct training values with their running counts
(:func:`ecdf`; one prefix sum over collapsed values).  A row's outlier score is the sum
over its features of ``max(-ln left, -ln right, skew-chosen tail)``: the right tail for
positive skew, the left for negative, both summed for zero skew.  Null and NaN features
add nothing.

Scoring (:func:`score_rows`) looks a row's values up by order, not by equality, so a hot
value is no hot key and a new value takes its place among the fitted ones.  Features of
up to ``lookup_values`` distinct values (counted) are sent as sorted arrays, and the row
is scored where it stands: no shuffle, no long form.  Larger features are dealt into
ranges of the fitted values; rows and values of a range meet in tasks of bounded size,
and only a key and a number per row come back.

The library scores new rows against the union of training and new rows; that
is the default here (``union=True``), so tails are never empty.  With
``union=False`` the training ECDF alone is used: a new value is ranked among
the training values, and one outside the training range gets an infinite tail score.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.functions.exprs import long_form
from telemetra.plans.hscan import exact_quantiles, prefix_sums
from telemetra.session import cut_lineage, ship_package

#: Distinct values of a feature that are sent to every task (16 bytes each).
LOOKUP_VALUES = 1 << 20
#: Rows of one range that a task looks up at a time.
LOOKUP_ROWS = 1 << 18


def value_table(df: DataFrame, features: Sequence[str], weight: str | None = None) -> DataFrame:
    """(column_name, x, cnt): the distinct values of every feature, collapsed map-side."""
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    long = long_form(df.select(*features, w.alias("_w")), features, ids=["_w"])
    return long.groupBy("column_name", "x").agg(F.sum("_w").alias("cnt"))


def _skew_sign(counts: DataFrame) -> DataFrame:
    """Sign of the population skewness per feature from counted values."""
    m = counts.groupBy("column_name").agg(
        F.sum("cnt").alias("n"), F.sum(F.col("cnt") * F.col("x")).alias("s1"))
    c = counts.join(F.broadcast(m), "column_name").withColumn("d", F.col("x") - F.col("s1") / F.col("n"))
    mom = c.groupBy("column_name").agg(F.sum(F.col("cnt") * F.pow("d", 3)).alias("m3"))
    return mom.select("column_name", F.signum(F.col("m3")).alias("skew_sign"))


def ecdf(counts: DataFrame) -> DataFrame:
    """The fitted model (column_name, x, cnt, cum, n, skew_sign) of counted values; a
    written table, fit to be saved and read back."""
    counts = cut_lineage(counts)
    s = prefix_sums(counts, ["column_name"], "x", ["cnt"]).select(
        "column_name", "x", "cnt", F.col("cum_cnt").alias("cum"), F.col("total_cnt").alias("n"))
    return cut_lineage(s.join(F.broadcast(_skew_sign(counts)), "column_name"))


def tail_table(dist: DataFrame) -> DataFrame:
    """(column_name, x, left, right, skew_sign) from a weighted long table
    (column_name, x, w)."""
    n = F.col("n").cast("double")
    return ecdf(dist.groupBy("column_name", "x").agg(F.sum("w").alias("cnt"))).select(
        "column_name", "x", (F.col("cum") / n).alias("left"),
        ((F.col("n") - F.col("cum") + F.col("cnt")) / n).alias("right"), "skew_sign")


def _steps(cum: np.ndarray, before: float) -> np.ndarray:
    """Running counts below the first fitted value and at every one."""
    return np.concatenate([[before], cum])


def _outlyingness(v: np.ndarray, x: np.ndarray, steps: np.ndarray, n: float, sign: float) -> np.ndarray:
    """Tail score of values among the fitted values ``x`` with running counts ``steps``;
    missing values score 0."""
    upto = np.searchsorted(x, v, "right")
    below = upto - (x[upto - 1] == v) * (upto > 0) if len(x) else upto
    with np.errstate(divide="ignore", invalid="ignore"):
        if sign > 0 or sign < 0:                    # the tail of the skew is one of the two
            score = -np.log(np.minimum(steps[upto], n - steps[below]) / n)
        else:
            score = -np.log(steps[upto] / n) - np.log((n - steps[below]) / n)
    return np.where(np.isnan(v), 0.0, score) + 0.0


def _sizes(model: DataFrame) -> dict[str, tuple[int, int, float]]:
    """Per feature: distinct values, rows, skew sign."""
    rows = model.groupBy("column_name").agg(F.count(F.lit(1)).alias("values"), F.max("n").alias("n"),
                                            F.first("skew_sign").alias("sign")).collect()
    return {r["column_name"]: (r["values"], r["n"], r["sign"]) for r in rows}


def _sent(model: DataFrame, features: Sequence[str], sizes) -> F.Column:
    """Score of features whose values are sent along."""
    held = model.where(F.col("column_name").isin(list(features))).select("column_name", "x", "cum").toPandas()
    tables = []
    for c in features:
        own = held[held.column_name == c].sort_values("x")
        tables.append((own.x.to_numpy(np.float64), _steps(own["cum"].to_numpy(np.float64), 0.0), float(sizes[c][1]), sizes[c][2]))

    @F.arrow_udf("double")
    def score(*columns: pa.Array) -> pa.Array:
        total = np.zeros(len(columns[0]))
        for column, fitted in zip(columns, tables):
            total += _outlyingness(column.to_numpy(zero_copy_only=False), *fitted)
        return pa.array(total)

    return score(*[F.col(c).cast("double") for c in features])


def _by_ranges(rows: DataFrame, key: str, feature: str, model: DataFrame, size, values: int, per_task: int) -> DataFrame:
    """(key, score) of a feature whose values are too many to send: rows and fitted
    values meet by range."""
    _, n, sign = size
    own = model.where(F.col("column_name") == feature).select("x", "cnt", "cum")
    ranges = -(-size[0] // values)
    shares = [i / ranges for i in range(1, ranges)]
    edges = own.agg(F.percentile_approx("x", shares, 10_000).alias("e")).first()["e"] if shares else []
    edges = np.unique(np.array(edges, np.float64))

    @F.pandas_udf("int")
    def range_of(x: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, x.to_numpy(np.float64), "right"))

    asked = rows.select(F.col(key).alias("key"), F.col(feature).cast("double").alias("v"))
    asked = cut_lineage(asked.where("v IS NOT NULL AND NOT isnan(v)").withColumn("range", range_of("v")))
    blocks = asked.groupBy("range").agg(F.ceil(F.count(F.lit(1)) / per_task).cast("int").alias("blocks"))
    blocks = cut_lineage(blocks)
    left = asked.join(F.broadcast(blocks), "range").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")))
    right = (own.withColumn("range", range_of("x")).join(F.broadcast(blocks), "range")
             .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1))))

    def look_up(given: pd.DataFrame, fitted: pd.DataFrame) -> pd.DataFrame:
        fitted = fitted.sort_values("x")
        if len(fitted):
            x, cum = fitted.x.to_numpy(), fitted["cum"].to_numpy(np.float64)
            before = cum[0] - fitted["cnt"].iloc[0]
        else:                               # below all fitted values
            x, cum, before = np.zeros(0), np.zeros(0), 0.0
        return pd.DataFrame({"key": given.key, "s": _outlyingness(given.v.to_numpy(), x, _steps(cum, before), float(n), sign)})

    return (left.select("range", "block", "key", "v").groupBy("range", "block")
            .cogroup(right.select("range", "block", "x", "cnt", "cum").groupBy("range", "block"))
            .applyInPandas(look_up, "key long, s double"))


def score_rows(df: DataFrame, features: Sequence[str], model: DataFrame, out: str = "ecod_score",
               lookup_values: int = LOOKUP_VALUES, lookup_rows: int = LOOKUP_ROWS) -> DataFrame:
    """``df`` with its ECOD score under the fitted ``model`` (of :func:`ecdf`).  A
    feature without fitted values scores 0."""
    sizes = _sizes(model)
    small = [c for c in features if c in sizes and sizes[c][0] <= lookup_values]
    large = [c for c in features if c in sizes and sizes[c][0] > lookup_values]
    ship_package(df.sparkSession)
    near = _sent(model, small, sizes) if small else F.lit(0.0)
    if not large:
        return df.withColumn(out, near)
    rows = cut_lineage(df.withColumn("_ec_key", F.monotonically_increasing_id()))
    far = None
    for c in large:
        part = _by_ranges(rows, "_ec_key", c, model, sizes[c], lookup_values, lookup_rows)
        far = part if far is None else far.unionByName(part)
    far = far.groupBy(F.col("key").alias("_ec_key")).agg(F.sum("s").alias("_ec_far"))
    return (rows.join(far, "_ec_key", "left")
            .withColumn(out, near + F.coalesce("_ec_far", F.lit(0.0))).drop("_ec_key", "_ec_far"))


def ecod_scores(train: DataFrame, score: DataFrame, features: Sequence[str], ids: Sequence[str],
                weight: str | None = None, union: bool = True, **lookup) -> DataFrame:
    """Score the rows of ``score`` (identified by ``ids``; optional multiplicity
    column ``weight``) against the ECDF of ``train`` (plus ``score`` when
    ``union``).  Returns (ids, ecod_score)."""
    counts = value_table(train, features, weight)
    if union and score is not train:
        both = counts.unionByName(value_table(score, features, weight))
        counts = both.groupBy("column_name", "x").agg(F.sum("cnt").alias("cnt"))
    return score_rows(score, features, ecdf(counts), **lookup).select(*ids, "ecod_score")


def ecod_fit(train: DataFrame, features: Sequence[str], ids: Sequence[str],
             contamination: float = 0.03, weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Training scores (training ECDF only, as the library's fit) and the
    threshold = (1 - contamination) quantile of them.  Returns
    (train_scores, threshold_row)."""
    scored = score_rows(train, features, ecdf(value_table(train, features, weight)))
    ts = cut_lineage(scored.select(*ids, "ecod_score", *([weight] if weight else [])))
    thr = exact_quantiles(ts, [], "ecod_score", [1 - contamination], weight=weight).select(
        F.col("q").alias("threshold"))
    return ts, thr


def ecod_predict(scores: DataFrame, threshold: DataFrame) -> DataFrame:
    """E5: library cut is strict: ``score > threshold``."""
    return (scores.crossJoin(F.broadcast(threshold))
            .withColumn("prediction", (F.col("ecod_score") > F.col("threshold")).cast("int")))
