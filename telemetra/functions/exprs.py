"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c: str | Column, numeric: bool) -> Column:
    """pandas-style missing: None, and NaN for floating columns."""
    c = col_(c)
    return (c.isNull() | F.isnan(c)) if numeric else c.isNull()


def severity_higher(value: str | Column, warning: float, critical: float) -> Column:
    """Higher is worse: >= critical, >= warning, else stable.  NaN/NULL -> stable
    (Python comparisons with NaN are false; Spark orders NaN above all)."""
    v = col_(value)
    ok = v.isNotNull() & ~F.isnan(v)
    return (F.when(ok & (v >= F.lit(critical)), "critical")
            .when(ok & (v >= F.lit(warning)), "warning")
            .otherwise("stable"))


def severity_lower(value: str | Column, warning: float, critical: float) -> Column:
    """Lower is worse: < critical, < warning (strict), else stable."""
    v = col_(value)
    ok = v.isNotNull() & ~F.isnan(v)
    return (F.when(ok & (v < F.lit(critical)), "critical")
            .when(ok & (v < F.lit(warning)), "warning")
            .otherwise("stable"))


def status_rank(status: str | Column) -> Column:
    s = col_(status)
    return F.when(s == "critical", 2).when(s == "warning", 1).otherwise(0)


def rank_status(rank: str | Column) -> Column:
    r = col_(rank)
    return F.when(r == 2, "critical").when(r == 1, "warning").otherwise("stable")


def safe_div(num: Column, den: Column, default: float = 0.0) -> Column:
    """num / den, ``default`` when den is 0 or NULL (zero_division=0)."""
    return F.when((den.isNull()) | (den == 0), F.lit(default)).otherwise(num / den)


def long_form(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = (),
              name: str = "column_name", value: str = "x",
              drop_nulls: bool = True) -> DataFrame:
    """Unpivot measurement columns to (ids, column_name, x double).  An Expand
    node: no shuffle."""
    casted = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    out = casted.unpivot(list(ids), list(columns), name, value)
    if drop_nulls:
        out = out.where(F.col(value).isNotNull() & ~F.isnan(F.col(value)))
    return out


def present_double(c: str | Column) -> Column:
    """``c`` as a double, NULL where it is NaN or cannot be read as a number."""
    return F.nanvl(col_(c).try_cast("double"), F.lit(None).cast("double"))


def bin_index(edges: str | Column, x: str | Column) -> Column:
    """Index of the histogram bin over (-inf, e1, ..., ek, inf): the number of
    inner edges <= x (bins are [a, b), numpy ``histogram``)."""
    xc = col_(x)
    return F.size(F.filter(col_(edges), lambda e: e <= xc))


def adjusted_skewness(g1: Column, n: Column) -> Column:
    """Bias-adjusted sample skewness G1 (pandas / DuckDB) from Spark's
    population g1."""
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def round6(c: Column) -> Column:
    return F.round(c, 6)
