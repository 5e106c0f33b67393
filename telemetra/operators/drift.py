"""Reference profiles and distribution drift: H1, H2, H11, H12, H17, H18.

Profiles are small tables (one row per column, <= 10 bins) derived from the
data by distributed aggregations; the data itself is never collected.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetra import config
from telemetra.functions.exprs import bin_index, long_form, present_double
from telemetra.plans.hscan import exact_quantiles
from telemetra.session import cut_lineage, ship_package


# ---------------------------------------------------------------- H1 ------
def numeric_edges(long: DataFrame, keys: Sequence[str], bins: int = config.PROFILE_BINS,
                  weight: str | None = None) -> DataFrame:
    """(keys, bin_edges): unique quantiles on the 0..1 grid without the first
    and last one.  ``long`` is (keys, x) with no missing x; ``weight`` names a
    multiplicity column when the rows are already collapsed."""
    probs = [i / bins for i in range(bins + 1)]
    q = exact_quantiles(long, keys, "x", probs, weight=weight, collapsed=weight is not None)
    uniq = (q.groupBy(*keys)
            .agg(F.array_sort(F.array_distinct(F.collect_list("q"))).alias("_u")))
    return uniq.select(*keys, F.slice("_u", 2, F.greatest(F.size("_u") - 2, F.lit(0)))
                       .alias("bin_edges"))


def numeric_profile(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (),
                    bins: int = config.PROFILE_BINS) -> DataFrame:
    """H1: per (keys, column_name): count, minimum, maximum, mean, population
    standard deviation, inner bin edges and bin proportions."""
    long = long_form(df, columns, ids=keys)
    gk = [*keys, "column_name"]
    # one pass over the input collapses it to (keys, column, value, count) -- written
    # once, partial aggregation absorbs repeated values; moments, edges and bin counts
    # are read from it
    values = cut_lineage(long.groupBy(*gk, "x").agg(F.count(F.lit(1)).alias("cnt")))
    x, n = F.col("x"), F.col("cnt")
    first = values.groupBy(*gk).agg(F.sum("cnt").alias("count"), F.min("x").alias("minimum"), F.max("x").alias("maximum"),
                                    (F.sum(x * n) / F.sum(n)).alias("mean"))
    # around the mean: no cancellation
    spread = values.join(F.broadcast(first.select(*gk, "mean")), gk).groupBy(*gk).agg(
        F.sqrt(F.sum(n * F.pow(x - F.col("mean"), 2)) / F.sum(n)).alias("standard_deviation"))
    stats = first.join(spread, gk)
    edges = numeric_edges(values, gk, bins, weight="cnt")
    counts = (values.join(edges, gk).withColumn("bin", bin_index("bin_edges", "x"))
              .groupBy(*gk, "bin").agg(F.sum("cnt").alias("n")))
    all_bins = edges.select(*gk, F.explode(F.sequence(F.lit(0), F.size("bin_edges")))
                            .alias("bin"))
    props = (all_bins.join(counts, [*gk, "bin"], "left")
             .withColumn("n", F.coalesce("n", F.lit(0)))
             .groupBy(*gk)
             .agg(F.array_sort(F.collect_list(F.struct("bin", "n"))).alias("_bn"),
                  F.sum("n").alias("_tot")))
    props = props.select(*gk, F.transform("_bn", lambda s: s["n"] / F.col("_tot"))
                         .alias("bin_proportions"))
    return cut_lineage(stats.join(edges, gk).join(props, gk))


def profile_bins(profile: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Long form of a numeric profile: (keys, column_name, bin, lower_edge,
    upper_edge, proportion); NULL edges stand for -inf / +inf."""
    gk = [*keys, "column_name"]
    e = F.col("bin_edges")
    return (profile.select(*gk, "bin_edges",
                           F.posexplode("bin_proportions").alias("bin", "proportion"))
            .select(*gk, "bin",
                    F.when(F.col("bin") > 0, F.element_at(e, F.col("bin"))).alias("lower_edge"),
                    F.when(F.col("bin") < F.size(e), F.element_at(e, F.col("bin") + 1))
                    .alias("upper_edge"),
                    "proportion"))


# ---------------------------------------------------------------- H2 ------
def categorical_long(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()
                     ) -> DataFrame:
    """(keys, column_name, category) with nulls kept as the text 'None'
    (pandas ``astype(str)`` on an object column)."""
    casted = df.select(*keys, *[F.coalesce(F.col(c).cast("string"), F.lit("None")).alias(c)
                                for c in columns])
    return casted.unpivot(list(keys), list(columns), "column_name", "category")


def categorical_profile(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()
                        ) -> DataFrame:
    """H2: (keys, column_name, category, count, proportion)."""
    gk = [*keys, "column_name"]
    counts = categorical_long(df, columns, keys).groupBy(*gk, "category").agg(
        F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(*gk)
    return cut_lineage(counts.withColumn("proportion", F.col("count") / F.sum("count").over(w)))


# ---------------------------------------------------------------- H11 -----
def _psi_from_counts(grid: DataFrame, gk: Sequence[str], eps: float = config.PSI_EPSILON
                     ) -> DataFrame:
    """grid: (gk, bin, proportion, n) over every profile bin -> (gk, psi, current_count)."""
    w = Window.partitionBy(*gk)
    t = (grid.withColumn("_tot", F.sum("n").over(w))
         .withColumn("_a", F.greatest(F.col("n") / F.col("_tot"), F.lit(eps)))
         .withColumn("_e", F.greatest(F.col("proportion"), F.lit(eps)))
         .withColumn("_a", F.col("_a") / F.sum("_a").over(w))
         .withColumn("_e", F.col("_e") / F.sum("_e").over(w)))
    return (t.groupBy(*gk)
            .agg(F.sum((F.col("_a") - F.col("_e")) * F.ln(F.col("_a") / F.col("_e"))).alias("psi"),
                 F.sum("n").alias("current_count")))


def psi(current: DataFrame, profile: DataFrame, columns: Sequence[str],
        keys: Sequence[str] = ()) -> DataFrame:
    """H11 (and H17 with ``keys`` = batch columns): PSI of the current values
    on the reference bins, empty bins included.  Returns (keys, column_name,
    psi, current_count); a column with no current values gets no row."""
    cur = long_form(current, columns, ids=keys)
    edges = profile.select("column_name", "bin_edges")
    gk = [*keys, "column_name"]
    # the bin counts (groups x <= 11 rows) feed both the group list and the
    # grid: written once, so the current data is read once
    counts = cut_lineage(cur.join(edges, "column_name")
                         .withColumn("bin", bin_index("bin_edges", "x"))
                         .groupBy(*gk, "bin").agg(F.count(F.lit(1)).alias("n")))
    prof_bins = profile.select("column_name", F.posexplode("bin_proportions")
                               .alias("bin", "proportion"))
    groups = counts.select(*gk).distinct()
    grid = (groups.join(prof_bins, "column_name")
            .join(counts, [*gk, "bin"], "left")
            .withColumn("n", F.coalesce("n", F.lit(0))))
    return _psi_from_counts(grid, gk)


# ---------------------------------------------------------------- H12 -----
def js_divergence(current: DataFrame, profile: DataFrame, columns: Sequence[str],
                  keys: Sequence[str] = ()) -> DataFrame:
    """Jensen-Shannon divergence (natural log, not square-rooted) over the
    union of reference and current categories.  ``profile`` is
    (column_name, category, proportion)."""
    gk = [*keys, "column_name"]
    # category counts feed the group list and the full join: written once
    cur = cut_lineage(categorical_long(current, columns, keys).groupBy(*gk, "category")
                      .agg(F.count(F.lit(1)).alias("_n")))
    groups = cur.select(*gk).distinct()
    exp = groups.join(profile.select("column_name", "category",
                                     F.col("proportion").alias("_p")), "column_name")
    both = exp.join(cur, [*gk, "category"], "full_outer")
    w = Window.partitionBy(*gk)
    t = (both.fillna(0, ["_p", "_n"])
         .withColumn("_e", F.col("_p") / F.sum("_p").over(w))
         .withColumn("_a", F.col("_n") / F.sum("_n").over(w))
         .withColumn("_m", (F.col("_e") + F.col("_a")) / 2))
    kl = lambda p: F.when(F.col(p) > 0, F.col(p) * F.ln(F.col(p) / F.col("_m"))).otherwise(0.0)
    return t.groupBy(*gk).agg((0.5 * (F.sum(kl("_e")) + F.sum(kl("_a")))).alias("js_divergence"))


# ---------------------------------------------------------------- H18 -----
def shift_factors(spark, n: int = config.SHIFT_FACTOR_COUNT,
                  lo: float = config.SHIFT_FACTOR_MIN, hi: float = config.SHIFT_FACTOR_MAX
                  ) -> DataFrame:
    """numpy ``linspace(lo, hi, n)`` as a table (factor_id, factor)."""
    step = (hi - lo) / (n - 1)
    return spark.range(n).select(
        F.col("id").alias("factor_id"),
        F.when(F.col("id") == n - 1, F.lit(hi))
        .otherwise(F.lit(lo) + F.col("id") * F.lit(step)).alias("factor"))


def counts_below(df: DataFrame, column: str, thresholds: Sequence[float]) -> list[int]:
    """Per threshold the number of values below it, in one map-only pass: each task
    places its values among the sorted thresholds (binary search) and returns counts per
    interval, which a grouped sum adds.  NULL and NaN are no values.  The thresholds are
    a bounded grid; as many counts reach the driver."""
    order = np.argsort(np.asarray(thresholds, np.float64), kind="stable")
    edges = np.asarray(thresholds, np.float64)[order]

    def fn(batches):
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False).astype(np.float64)
            at, n = np.unique(np.searchsorted(edges, x[~np.isnan(x)], "right"), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(n.astype(np.int64))], names=["at", "n"])

    ship_package(df.sparkSession)
    values = df.select(present_double(column).alias("x")).where("x IS NOT NULL")
    rows = values.mapInArrow(fn, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(len(edges) + 1, np.int64)
    for r in rows:
        cells[r["at"]] = r["n"]
    below = np.empty(len(edges), np.int64)
    below[order] = np.cumsum(cells)[:-1]
    return [int(cells.sum()), *below.tolist()]


def shift_psi(current: DataFrame, profile: DataFrame, column: str, std: float | None = None
              ) -> DataFrame:
    """PSI of ``column + std * factor`` for every factor of the grid, without
    copying or sorting the data: the shifted bin counts are differences of
    ``#(x < edge - std*factor)``, all of them from one :func:`counts_below` pass.

    Returns (factor_id, factor, psi)."""
    spark = current.sparkSession
    own = profile.where(F.col("column_name") == column).select("bin_edges", "bin_proportions", "standard_deviation").first()
    if own is None:
        raise ValueError(f"no reference profile of {column!r}")
    s = float(own["standard_deviation"] if std is None else std)
    factors = [(r["factor_id"], r["factor"]) for r in shift_factors(spark).collect()]      # the grid: bounded
    asked = [(f, edge - s * x) for f, x in factors for edge in own["bin_edges"]]
    total, *below = counts_below(current, column, [t for _, t in asked])
    k, rows = len(own["bin_edges"]), []
    for i, (f, x) in enumerate(factors):
        upto = [0, *below[i * k:(i + 1) * k], total]
        rows += [(f, x, j, p, upto[j + 1] - upto[j]) for j, p in enumerate(own["bin_proportions"])]
    grid = spark.createDataFrame(rows, "factor_id long, factor double, bin int, proportion double, n long")
    return _psi_from_counts(grid, ["factor_id", "factor"]).select("factor_id", "factor", "psi")


def pick_shift(shifts: DataFrame, psi_min: float, psi_max: float | None, target: float
               ) -> DataFrame:
    """The factor whose PSI is nearest ``target`` inside [psi_min, psi_max);
    the smallest factor wins ties (the reference keeps the first)."""
    cond = F.col("psi") >= psi_min
    if psi_max is not None:
        cond = cond & (F.col("psi") < psi_max)
    return (shifts.where(cond)
            .orderBy(F.abs(F.col("psi") - target), F.col("factor_id")).limit(1))
