"""Exact deduplication by progressive refinement (DataFrame functions only).

Rows are grouped by text length, then by the hash of a prefix among rows whose
length repeats, then by the full hash among rows whose length and prefix repeat:
the full content is hashed for surviving groups only.  The survivors of a level
reach the next scan as a bit mask of fixed size (a bounded broadcast; a false
positive costs one needless hash and changes nothing).  Only (length, hash, id)
are shuffled, aggregated on the map side first, so a group that holds a third of
all rows arrives as a few partial rows; the decision goes back to the rows by an
outer join whose large partitions adaptive execution splits.

Defined results: a null text counts as the empty text; a null id sorts below any
id; of rows that repeat both text and largest id exactly one is kept, that with the
smallest SHA-256 of all its columns; an empty table gives an empty result; input columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bit_mask_table, cut_lineage, has_bit, pick, with_outputs

LENGTH_BITS = 20
PREFIX_BITS = 24


def _one_of_each(tied: DataFrame, columns: list[str]) -> DataFrame:
    """Of rows that repeat id and text, one keeps ``__xd_kept``: of different rows that
    with the smallest SHA-256.  Equal rows are collapsed on the map side and spread out
    again behind the shuffle, so one row repeated without end is no large group."""
    keys = ["__xd_len", "__xd_sha", "__xd_id"]
    rows = tied.groupBy(*[pick(c) for c in tied.columns]).agg(F.count(F.lit(1)).alias("__xd_n"))
    rows = cut_lineage(rows.withColumn("__xd_row", F.sha2(F.to_json(F.struct(*[pick(c) for c in columns])), 256)))
    first = rows.groupBy(*keys).agg(F.min("__xd_row").alias("__xd_first")).withColumnsRenamed({k: f"{k}_on" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_on"))
    spread = rows.join(first, same).withColumn("__xd_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__xd_n"))))
    chosen = (F.col("__xd_row") == F.col("__xd_first")) & (F.col("__xd_i") == 1)
    return spread.withColumn("__xd_kept", chosen).select(*[pick(c) for c in tied.columns])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = 64, digest_all: bool = False) -> DataFrame:
    """Every row of ``docs`` with ``keep_id`` (largest id among equal texts),
    ``group_size``, ``kept`` and ``text_sha256`` (null outside surviving groups
    unless ``digest_all``)."""
    text = F.coalesce(pick(text_col).cast("string"), F.lit(""))
    base = docs.withColumns({
        "__xd_len": F.octet_length(text).cast("long"),
        "__xd_id": pick(id_col),
    })
    lengths = (base.groupBy("__xd_len").count().where("count > 1").select("__xd_len"))
    level1 = has_bit(base, "__xd_len", bit_mask_table(lengths, "__xd_len", LENGTH_BITS),
                     LENGTH_BITS, "__xd_l1")
    level1 = level1.withColumn("__xd_pre", F.when(
        F.col("__xd_l1"), F.xxhash64("__xd_len", F.substring(text, 1, prefix_chars))))
    prefixes = (level1.where("__xd_l1").groupBy("__xd_len", "__xd_pre").count()
                .where("count > 1").select("__xd_pre"))
    level2 = has_bit(level1, "__xd_pre", bit_mask_table(prefixes, "__xd_pre", PREFIX_BITS),
                     PREFIX_BITS, "__xd_l2")
    rows = level2.withColumn("__xd_sha", F.when(F.col("__xd_l2"), F.sha2(text, 256)))
    # before the join: the join then carries the digest, not the text
    rows = rows.withColumn("__xd_digest", F.coalesce("__xd_sha", F.sha2(text, 256)) if digest_all
                           else F.col("__xd_sha"))

    per_id = (rows.where("__xd_l2").groupBy("__xd_len", "__xd_sha", "__xd_id")
              .agg(F.count(F.lit(1)).alias("n")))
    groups = cut_lineage(
        per_id.groupBy("__xd_len", "__xd_sha")
        .agg(F.max(F.struct("__xd_id", "n")).alias("top"), F.sum("n").alias("__xd_size"))
        .where("__xd_size > 1")
        .select(F.col("__xd_len").alias("__xd_glen"), F.col("__xd_sha").alias("__xd_gsha"),
                F.col("top.__xd_id").alias("__xd_top"), F.col("top.n").alias("__xd_ties"),
                "__xd_size"))
    # rows outside surviving groups need no look-up and are not shuffled
    alone = rows.where("NOT __xd_l2").withColumns({
        "__xd_keep": F.col("__xd_id"), "__xd_size": F.lit(1).cast("long"), "__xd_kept": F.lit(True)})
    joined = rows.where("__xd_l2").join(groups, (F.col("__xd_len") == F.col("__xd_glen"))
                       & (F.col("__xd_sha") == F.col("__xd_gsha")), "left")
    joined = joined.withColumns({
        "__xd_keep": F.when(F.col("__xd_size").isNull(), F.col("__xd_id")).otherwise(F.col("__xd_top")),
        "__xd_size": F.coalesce("__xd_size", F.lit(1).cast("long")),
        "__xd_kept": F.col("__xd_size").isNull() | F.col("__xd_id").eqNullSafe(F.col("__xd_top")),
    })
    if not groups.where("__xd_ties > 1").isEmpty():      # repeated (id, text) rows: keep one
        tied = F.coalesce(F.col("__xd_kept") & (F.col("__xd_ties") > 1), F.lit(False))
        joined = joined.where(~tied).unionByName(_one_of_each(joined.where(tied), docs.columns))
    joined = alone.unionByName(joined.select(alone.columns))
    return with_outputs(joined, {"keep_id": "__xd_keep", "group_size": "__xd_size",
                                 "kept": "__xd_kept", "text_sha256": "__xd_digest"}, docs.columns)
