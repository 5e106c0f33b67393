"""Distributed prefix sums and exact quantiles over an ordered value, per group.

A running sum with ``Window.orderBy`` and no ``partitionBy`` runs in one task.
Instead the rows are dealt into ranges of (keys, value) by Spark's range
partitioner, whose cut points come from a bounded sample, and the range id is
written beside each row.  The number of ranges follows from the counted rows
(about ``RANGE_ROWS`` in each; one range for a small input), so a task's share
stays the same at every size and neither a hot group nor the only group of a
keyless scan lands in one task.  The running sum is taken inside (keys, range);
the totals of the earlier ranges are added from a table of one row per
(keys, range).

There is one algorithm for all sizes.  A null key is a group of its own.
Everything here expects its input collapsed to one row per (keys, value): ties
are merged before the scan, which also removes hot values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetra.session import cut_lineage

#: Rows of a range, on average: what one task sorts.
RANGE_ROWS = 200_000
_RANGE = "_hs_b"


def _in_ranges(df: DataFrame, keys: Sequence[str], order: Column,
               ranges: int | None) -> DataFrame:
    """``df`` (a written table) with its range id; ids rise with (keys, order)."""
    n = ranges or max(1, math.ceil(df.count() / RANGE_ROWS))
    if n == 1:
        return df.withColumn(_RANGE, F.lit(0))
    return cut_lineage(df.repartitionByRange(n, *keys, order)
                       .withColumn(_RANGE, F.spark_partition_id()))


def _join_ranges(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` joined to the per-range table ``other`` on null-safe keys and range."""
    on = [*keys, _RANGE]
    renamed = other.withColumnsRenamed({c: f"_hs_on_{c}" for c in on})
    cond = [df[c].eqNullSafe(renamed[f"_hs_on_{c}"]) for c in on]
    return df.join(renamed, cond).drop(*[f"_hs_on_{c}" for c in on])


def _offsets(df: DataFrame, keys: Sequence[str], weight_cols: Sequence[str]) -> DataFrame:
    """(keys, range): per weight its sum in the range (``_hs_t_``), in the ranges
    before (``_hs_o_``) and in the whole group (``total_``)."""
    totals = df.groupBy(*keys, _RANGE).agg(*[F.sum(w).alias(f"_hs_t_{w}") for w in weight_cols])
    whole = Window.partitionBy(*keys)
    before = whole.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "*",
        *[F.coalesce(F.sum(f"_hs_t_{w}").over(before), F.lit(0)).alias(f"_hs_o_{w}") for w in weight_cols],
        *[F.sum(f"_hs_t_{w}").over(whole).alias(f"total_{w}") for w in weight_cols])


def prefix_sums(df: DataFrame, keys: Sequence[str], order_col: str,
                weight_cols: Sequence[str], ranges: int | None = None,
                descending: bool = False, prefix: str = "cum_",
                with_totals: bool = True) -> DataFrame:
    """Add ``cum_<w>`` = sum of ``w`` over rows whose order value is <= this
    row's (>= when ``descending``) within the same keys; and ``total_<w>``.

    ``df`` must hold one row per (keys, order_col).  ``ranges`` overrides the
    number derived from the row count."""
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    b = _in_ranges(cut_lineage(df), keys, order, ranges)
    run = Window.partitionBy(*keys, _RANGE).orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = b.select("*", *[F.sum(w).over(run).alias(f"_hs_r_{w}") for w in weight_cols])
    out = _join_ranges(local, _offsets(b, keys, weight_cols), keys)
    return cut_lineage(out.select(
        *df.columns,
        *[(F.col(f"_hs_r_{w}") + F.col(f"_hs_o_{w}")).alias(f"{prefix}{w}") for w in weight_cols],
        *[f"total_{w}" for w in weight_cols if with_totals]))


def _present(df: DataFrame, value_col: str) -> Column:
    """Neither null nor NaN (pandas counts both as missing)."""
    x = F.col(value_col)
    if isinstance(df.schema[value_col].dataType, (T.FloatType, T.DoubleType)):
        return x.isNotNull() & ~F.isnan(x)
    return x.isNotNull()


def value_counts(df: DataFrame, keys: Sequence[str], value_col: str,
                 weight: str | None = None) -> DataFrame:
    """Collapse to (keys, value, cnt); null and NaN values dropped.  ``weight`` is a
    row multiplicity column (rows already collapsed upstream)."""
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    return (df.where(_present(df, value_col))
            .groupBy(*keys, value_col).agg(F.sum(w).alias("cnt")))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value_col: str,
                    probs: Sequence[float], ranges: int | None = None,
                    weight: str | None = None, collapsed: bool = False) -> DataFrame:
    """Exact linear-interpolation quantiles (numpy 'linear', DuckDB
    ``quantile_cont``, Spark ``percentile``).  Returns (keys, p, q); null and NaN
    values are left out, a null key is a group, a group without values has no row.

    One pass over ``df`` collapses it to (keys, value, count) -- partial
    aggregation absorbs repeated and hot values -- written once.  The counts of
    its ranges tell which ranges hold a wanted rank, and only those are sorted.
    ``collapsed``: ``df`` is an already written table with one row per
    (keys, value) and ``weight`` counts; it is read as it is, not written again."""
    gk = list(keys)
    if collapsed and weight:
        counts = (df.where(_present(df, value_col))
                  .select(*gk, value_col, F.col(weight).cast("long").alias("cnt")))
    else:
        counts = cut_lineage(value_counts(df, gk, value_col, weight))
    b = _in_ranges(counts, gk, F.col(value_col).asc(), ranges)

    # ranks wanted of each range: two per probability at most
    asked = (_offsets(b, gk, ["cnt"])
             .withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
             .withColumn("_h", (F.col("total_cnt") - 1).cast("double") * F.col("p"))
             .withColumn("_r", F.explode(F.array_distinct(F.array(F.floor("_h"), F.ceil("_h")))))
             .withColumn("_at", F.col("_r") - F.col("_hs_o_cnt"))
             .where((F.col("_at") >= 0) & (F.col("_at") < F.col("_hs_t_cnt")))
             .groupBy(*gk, _RANGE).agg(F.collect_list(F.struct("p", "_h", "_r", "_at")).alias("_asked")))
    run = Window.partitionBy(*gk, _RANGE).orderBy(value_col).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = _join_ranges(b, asked, gk).withColumn("_cum", F.sum("cnt").over(run))
    hit = F.filter("_asked", lambda a: (a["_at"] < F.col("_cum")) & (a["_at"] >= F.col("_cum") - F.col("cnt")))
    x = F.col(value_col).cast("double")
    ends = (ranked.select(*gk, x.alias("_x"), F.explode(hit).alias("_a"))
            .select(*gk, "_x", "_a.*")
            .groupBy(*gk, "p", "_h")
            .agg(F.min_by("_x", "_r").alias("_lo"), F.max_by("_x", "_r").alias("_hi")))
    lo, hi, h = F.col("_lo"), F.col("_hi"), F.col("_h")
    q = F.when(lo == hi, lo).otherwise((F.ceil(h) - h) * lo + (h - F.floor(h)) * hi)
    return cut_lineage(ends.select(*gk, "p", q.alias("q")))


def average_ranks(df: DataFrame, keys: Sequence[str], value_col: str,
                  ranges: int | None = None) -> DataFrame:
    """(keys, value, cnt, rank_avg, n): 1-based average rank of each distinct
    value (pandas ``rank(method='average')``)."""
    counts = value_counts(df, keys, value_col)
    scanned = prefix_sums(counts, keys, value_col, ["cnt"], ranges=ranges)
    return scanned.select(
        *keys, value_col, "cnt",
        ((F.col("cum_cnt") - F.col("cnt")) + (F.col("cnt") + 1) / 2.0).alias("rank_avg"),
        F.col("total_cnt").alias("n"))
