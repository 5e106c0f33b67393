"""Profiling / EDA aggregations C1-C14.

Per-column statistics are computed on the unpivoted (column_name, x) form so
one grouped aggregation covers every column; exact quantiles go through the
distributed prefix-sum scan instead of a per-group value map.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetra.functions.exprs import adjusted_skewness, long_form, present_double
from telemetra.plans.hscan import exact_quantiles
from telemetra.session import cut_lineage


def type_kind(dt: T.DataType) -> str:
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integer"
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "float"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "timestamp"
    if isinstance(dt, T.BooleanType):
        return "boolean"
    return "string"


def column_info(df: DataFrame) -> DataFrame:
    """(column_name, kind, non_null) -- types from the schema, counts
    from one aggregate."""
    one = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    kinds = F.create_map(*itertools.chain.from_iterable(
        (F.lit(f.name), F.lit(type_kind(f.dataType))) for f in df.schema.fields))
    return (one.unpivot([], df.columns, "column_name", "non_null")
            .withColumn("kind", kinds[F.col("column_name")]))


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """Category frequency including NULL."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """C4: min, max, mean, median per column."""
    long = long_form(df, columns)
    stats = long.groupBy("column_name").agg(
        F.min("x").alias("minimum"), F.max("x").alias("maximum"), F.avg("x").alias("mean"))
    med = exact_quantiles(long, ["column_name"], "x", [0.5]).select(
        "column_name", F.col("q").alias("median"))
    return stats.join(med, "column_name")


def _texts(df: DataFrame) -> Column:
    """Every column of a row as (column_name, value text); -0.0 reads as 0.0."""
    def text(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        return (c + F.lit(0.0) if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else c).cast("string")

    return F.array(*[F.struct(F.lit(f.name).alias("column_name"), text(f).alias("value")) for f in df.schema.fields])


def cardinality(df: DataFrame) -> DataFrame:
    """Distinct values per column (NULL counts as a value, pandas
    ``nunique(dropna=False)``), percent unique and id check.  One pass collapses the
    table to (column, value) map-side; a distinct count per column in one aggregate
    would Expand the whole table once per column."""
    pairs = df.select(F.explode(_texts(df)).alias("p")).select("p.*").groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("_c"))
    per = pairs.groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_values"), F.sum("_c").alias("_n"))
    return per.select("column_name", "distinct_values",
                      F.round(F.col("distinct_values") / F.col("_n") * 100, 2).alias("pct_unique"),
                      (F.col("distinct_values") == F.col("_n")).alias("is_unique_id"))


#: Registers of a distinct-count sketch, as a power of two.
SKETCH_LG = 14


def cardinality_sketches(df: DataFrame, keys: Sequence[str] = (), lg: int = SKETCH_LG) -> DataFrame:
    """C5, approximate: (keys, column_name, rows, nulls, sketch), one HyperLogLog sketch
    of every column and batch in one aggregate; fit to be kept and merged with later
    batches."""
    fields = [f for f in df.schema.fields if f.name not in keys]
    aggs = []
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        v = c + F.lit(0.0) if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else c
        aggs += [F.hll_sketch_agg(v.cast("string"), lg).alias(f"_s{i}"), F.count_if(c.isNull()).alias(f"_n{i}")]
    one = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *aggs)
    return one.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.col("rows"), F.col(f"_n{i}").alias("nulls"), F.col(f"_s{i}").alias("sketch"))
        for i, f in enumerate(fields)])).alias("s")).select(*keys, "s.*")


def merged_cardinality(sketches: DataFrame) -> DataFrame:
    """Distinct values per column estimated from the sketches of all batches; the
    standard error is 1.04 / sqrt(2 ** lg) of the value."""
    g = sketches.groupBy("column_name").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("_e"), F.sum("rows").alias("rows"),
        F.max(F.signum("nulls")).cast("long").alias("_null"))
    return g.select("column_name", "rows", (F.col("_e") + F.col("_null")).alias("estimate"))


def skewness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bias-adjusted skewness and its level (|s| < 0.5 low, < 1 moderate)."""
    long = long_form(df, columns)
    g = long.groupBy("column_name").agg(F.skewness("x").alias("_g1"),
                                        F.count("x").cast("double").alias("_n"))
    s = adjusted_skewness(F.col("_g1"), F.col("_n"))
    return g.select("column_name", s.alias("skewness")).withColumn(
        "level", F.when(F.abs("skewness") < 0.5, "low")
        .when(F.abs("skewness") < 1, "moderate").otherwise("high"))


def iqr_bounds(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, column_name, q1, median, q3, lower, upper) with 1.5 IQR fences."""
    long = long_form(df, columns, ids=keys)
    q = exact_quantiles(long, [*keys, "column_name"], "x", [0.25, 0.5, 0.75])
    piv = q.groupBy(*keys, "column_name").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("median"),
        F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return piv.select("*", (F.col("q1") - 1.5 * iqr).alias("lower"),
                      (F.col("q3") + 1.5 * iqr).alias("upper"))


def iqr_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column the fences, outlier count and percent."""
    long = long_form(df, columns, drop_nulls=False)
    b = iqr_bounds(df, columns)
    x = F.col("x")
    out = (long.join(F.broadcast(b), "column_name")
           .groupBy("column_name", "lower", "upper")
           .agg(F.count_if(~F.isnan(x) & ((x < F.col("lower")) | (x > F.col("upper")))).alias("outliers"),
                F.count(F.lit(1)).alias("_n")))
    return out.select("column_name", "lower", "upper", "outliers",
                      F.round(F.col("outliers") * 100.0 / F.col("_n"), 2).alias("outlier_pct"))


def outlier_flag(df: DataFrame, columns: Sequence[str], bounds: DataFrame) -> DataFrame:
    """Add ``any_outlier``: OR over the columns of the IQR test.  ``bounds`` is
    one row per column (tiny); it is pivoted to one row and joined in."""
    wide = bounds.groupBy().pivot("column_name", list(columns)).agg(
        F.first("lower").alias("lo"), F.first("upper").alias("hi"))
    flag = F.lit(False)
    for c in columns:
        x = present_double(c)
        flag = flag | F.coalesce((x < F.col(f"{c}_lo")) | (x > F.col(f"{c}_hi")), F.lit(False))
    return df.crossJoin(F.broadcast(wide)).withColumn("any_outlier", flag).drop(
        *[f"{c}_lo" for c in columns], *[f"{c}_hi" for c in columns])


def rate_by(df: DataFrame, group: str | list, label: str) -> DataFrame:
    """Rows, positives and positive rate percent per group."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(label).alias("failures"),
        F.round(F.avg(label) * 100, 2).alias("failure_rate_pct"))


def extreme_rates(df: DataFrame, columns: Sequence[str], label: str, bounds: DataFrame) -> DataFrame:
    """C8 per column: (column_name, extreme, rows, failures, failure_rate_pct) of the rows
    outside and inside the column's own fences; missing values are in neither.  One
    pass for all columns."""
    long = long_form(df, columns, ids=[label])
    flagged = long.join(F.broadcast(bounds.select("column_name", "lower", "upper")), "column_name").withColumn(
        "extreme", (F.col("x") < F.col("lower")) | (F.col("x") > F.col("upper")))
    return flagged.groupBy("column_name", "extreme").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(label).alias("failures"),
        F.round(F.avg(label) * 100, 2).alias("failure_rate_pct"))


def class_share(df: DataFrame, label: str) -> DataFrame:
    """Counts and percent per class; the share uses a window over the
    aggregated rows only."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    return g.withColumn("pct", F.round(F.col("count") * 100.0 / F.sum("count").over(Window.partitionBy()), 2))


def correlations(df: DataFrame, columns: Sequence[str], threshold: float = 0.80) -> DataFrame:
    """Pearson correlation of every pair (rows with both values) in one aggregate; ``strong`` when
    |r| >= threshold."""
    pairs = list(itertools.combinations(columns, 2))
    one = df.agg(*[F.corr(present_double(a), present_double(b)).alias(f"{a}__{b}") for a, b in pairs])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                 F.col(f"{a}__{b}").alias("pearson")) for a, b in pairs])).alias("r")).select(
        "r.*").withColumn("strong", F.abs("pearson") >= threshold)


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """Equal-width histogram (last bin closed) with its empty bins, and the markers:
    (column_name, bin, lower, upper, count, mean, median, marker), ``marker`` naming the
    bin that holds the mean, the median or both.  A constant column has one bin.  The
    values are collapsed once; range, mean, median and counts are read from them."""
    values = cut_lineage(long_form(df, columns).groupBy("column_name", "x").agg(F.count(F.lit(1)).alias("cnt")))
    mm = values.groupBy("column_name").agg(F.min("x").alias("_lo"), F.max("x").alias("_hi"),
                                           (F.sum(F.col("x") * F.col("cnt")) / F.sum("cnt")).alias("mean"))
    median = exact_quantiles(values, ["column_name"], "x", [0.5], weight="cnt", collapsed=True).select(
        "column_name", F.col("q").alias("median"))
    mm = cut_lineage(mm.join(median, "column_name"))

    def bin_of(x):
        return F.when(F.col("_hi") == F.col("_lo"), 0).otherwise(F.least(F.floor(
            (x - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo"))), F.lit(bins - 1))).cast("int")

    counts = (values.join(F.broadcast(mm), "column_name").withColumn("bin", bin_of(F.col("x")))
              .groupBy("column_name", "bin").agg(F.sum("cnt").alias("count")))
    width = (F.col("_hi") - F.col("_lo")) / bins
    last = F.when(F.col("_hi") == F.col("_lo"), 0).otherwise(bins - 1)
    every = mm.withColumn("bin", F.explode(F.sequence(F.lit(0), last)))
    marker = F.concat_ws("+", F.when(F.col("bin") == bin_of(F.col("mean")), "mean"),
                         F.when(F.col("bin") == bin_of(F.col("median")), "median"))
    return (every.join(counts, ["column_name", "bin"], "left")
            .select("column_name", "bin", (F.col("_lo") + F.col("bin") * width).alias("lower"),
                    (F.col("_lo") + (F.col("bin") + 1) * width).alias("upper"),
                    F.coalesce("count", F.lit(0)).alias("count"), "mean", "median", marker.alias("marker")))


def box_stats(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Per (group, column) q1, median, q3, whiskers (extreme values inside
    the fences) and outlier count."""
    long = long_form(df, columns, ids=[by])
    b = iqr_bounds(df, columns, keys=[by])
    x = F.col("x")
    inside = (x >= F.col("lower")) & (x <= F.col("upper"))
    return (long.join(b, [by, "column_name"])
            .groupBy(by, "column_name", "q1", "median", "q3")
            .agg(F.min(F.when(inside, x)).alias("whisker_low"),
                 F.max(F.when(inside, x)).alias("whisker_high"),
                 F.count_if(~inside).alias("outliers")))


def transform_skewness(df: DataFrame, column: str,
                       lambdas: Sequence[float] = tuple(round(-2 + 0.1 * i, 1) for i in range(41))
                       ) -> DataFrame:
    """C14: skewness of raw, log1p, sqrt and Box-Cox transforms.  The Box-Cox
    lambda maximises the profile log-likelihood over a grid; every lambda is a
    grouped aggregate over (lambda, x) so the data is read once."""
    x = F.col(column).cast("double")
    base = df.select(x.alias("x")).where(F.col("x").isNotNull())
    simple = base.agg(
        F.skewness("x").alias("raw"), F.skewness(F.log1p("x")).alias("log1p"),
        F.skewness(F.sqrt("x")).alias("sqrt"), F.count("x").cast("double").alias("_n"))
    lam = F.array(*[F.lit(float(v)) for v in lambdas])
    y = F.when(F.col("lam") == 0, F.ln("x")).otherwise((F.pow("x", F.col("lam")) - 1) / F.col("lam"))
    per = (base.where(F.col("x") > 0).select("x", F.explode(lam).alias("lam"))
           .withColumn("y", y)
           .groupBy("lam").agg(F.var_pop("y").alias("_v"), F.sum(F.ln("x")).alias("_sl"),
                               F.count(F.lit(1)).cast("double").alias("_m"),
                               F.skewness("y").alias("_sk")))
    llf = (F.col("lam") - 1) * F.col("_sl") - F.col("_m") / 2 * F.ln(F.col("_v"))
    best = per.select("lam", "_sk", "_m", llf.alias("llf")).orderBy(
        F.col("llf").desc(), F.col("lam")).limit(1)
    out = simple.crossJoin(best)
    rows = [("raw", F.col("raw"), "_n"), ("log1p", F.col("log1p"), "_n"),
            ("sqrt", F.col("sqrt"), "_n"), ("boxcox", F.col("_sk"), "_m")]
    return out.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("transform"),
                 adjusted_skewness(v, F.col(n)).alias("skewness"),
                 (F.col("lam") if k == "boxcox" else F.lit(None).cast("double")).alias("lambda"))
        for k, v, n in rows])).alias("r")).select("r.*")


def kelvin_to_celsius(c: str) -> "F.Column":
    """Unit change K -> degrees C."""
    return F.col(c) - 273.15


def check_roles(features: Sequence[str], ids: Sequence[str], labels: Sequence[str]) -> None:
    """Identifiers and labels never enter the feature set (leakage)."""
    leak = sorted(set(features) & (set(ids) | set(labels)))
    if leak:
        raise ValueError(f"identifier / label columns in the feature set: {leak}")


TIME_WORDS = ("time", "date", "timestamp", "fecha", "hora", "ts")


def time_like_columns(df: DataFrame) -> list[str]:
    """C17: columns whose name or type suggests a time axis (metadata only)."""
    out = []
    for f in df.schema.fields:
        name = f.name.lower()
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)) or any(
                w == name or name.endswith("_" + w) or name.startswith(w + "_") for w in TIME_WORDS):
            out.append(f.name)
    return out
