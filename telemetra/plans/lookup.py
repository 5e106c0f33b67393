"""Null-safe look-ups whose hot keys are no join keys.

A table of counted keys is joined to the rows it was counted from.  Keys that hold more
than a thousandth of all rows -- at most ``HOT`` of them -- are sent to every task; the
other rows meet their key by a shuffle, where none is large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.session import cut_lineage

#: A key is hot above a share of 1 / HOT of the rows, so at most HOT keys are.
HOT = 1024


def keyed_lookup(df: DataFrame, table: DataFrame, keys: Sequence[str], count: str, values: Sequence[str]) -> DataFrame:
    """``df`` with the ``values`` of its key in ``table`` (one row per key; ``count`` is
    the number of its rows in ``df``); NULL equals NULL.  Rows without the key get NULL."""
    total = table.agg(F.sum(count).alias("_lk_total"))
    names = {k: f"_lk_{i}" for i, k in enumerate(keys)}
    own = cut_lineage(table.crossJoin(F.broadcast(total)).select(
        *[F.col(k).alias(n) for k, n in names.items()], F.struct(*values).alias("_lk_v"),
        (F.col(count) * HOT > F.col("_lk_total")).alias("_lk_hot")))

    def same(left, right):
        on = F.lit(True)
        for k, n in names.items():
            on = on & left[k].eqNullSafe(right[n])
        return on

    hot = F.broadcast(own.where("_lk_hot").drop("_lk_hot").withColumnRenamed("_lk_v", "_lk_near"))
    marked = df.join(hot, same(df, hot), "left").drop(*names.values())
    # a row that has its values asks for no key: its group in the shuffle is its own hash
    rest = own.where("NOT _lk_hot").drop("_lk_hot").withColumnRenamed("_lk_v", "_lk_far")
    near, far = marked.where("_lk_near IS NOT NULL"), marked.where("_lk_near IS NULL")
    far = far.join(rest, same(far, rest), "left").drop(*names.values())
    out = near.withColumn("_lk_far", F.lit(None).cast(own.schema["_lk_v"].dataType)).unionByName(far)
    return out.select(*df.columns, *[F.coalesce(F.col("_lk_near")[v], F.col("_lk_far")[v]).alias(v) for v in values])
