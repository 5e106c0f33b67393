"""Mixing sources to target weights by a time-varying curriculum (DataFrame
functions only).

Each source has a share of the words (its weight, capped at ``max_repeats``
times its size, the excess shared out again by weight) and a schedule: a
piecewise linear density over training time t in [0, 1].  The integral of the
schedule, times the share, is the source's cumulative word demand; a document
whose words start at offset c of its source is trained on at the time t at which
the demand reaches c, and documents are sorted by range of t.  A source whose
share exceeds its size is gone through again, ``max_repeats`` times at most.

Offsets are prefix sums of sizes within a source in md5(id) order.  A source is
cut into hash buckets (one per shuffle partition and 100,000 rows at least), each
bucket's total is summed first, and the running sum inside a bucket starts from
the total of the buckets before it: a source with a third of all rows is spread
over all tasks.  What is known of a source is joined to the totals of its buckets,
and these to the rows, by source and bucket: no broadcast is
forced.  Sources are ranked and filled by prefix sums over ranges, however many.

Defined results: a null text has size 0 and is never taken; null sources form one
source, last in order; a null id orders as the empty string; rows that repeat an
id are told apart by size and text hash and each counts; documents of size 0, and
those behind the target, have no position; documents of equal position follow by source
and offset; an empty table gives an empty result; input columns named like an output are
replaced.  Both :func:`mix_plan` and :func:`mix_copies` hold to this.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.hscan import prefix_sums
from .common import cut_lineage, default_partitions, discard, pick, staged, with_outputs

BUCKET_ROWS = 100_000
WORD = r"[^\x20\x09-\x0D]+"
#: Density over training time as (time, weight) knots, taken in turn by the sources.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)),
             ((0.0, 1.0), (1.0, 1.0)),
             ((0.0, 0.5), (0.5, 0.5), (1.0, 2.0)))


def inverse_demand(knots, u: Column) -> Column:
    """The time at which the normalised integral of a piecewise linear density
    reaches ``u`` in [0, 1]."""
    pieces, total = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        if t1 <= t0 or w0 < 0 or w1 < 0:
            raise ValueError("schedule times must rise and weights must not be negative")
        pieces.append((total, t0, w0, (w1 - w0) / (t1 - t0), t1))
        total += (w0 + w1) / 2 * (t1 - t0)
    if total <= 0:
        raise ValueError("a schedule needs a positive integral")
    v, out = u * F.lit(total), F.lit(float(knots[-1][0]))
    for start, t0, w0, slope, t1 in reversed(pieces):
        d = v - F.lit(start)
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + F.lit(2 * slope) * d))
        step = F.when(F.lit(w0) + root > 0, F.lit(2.0) * d / (F.lit(w0) + root)).otherwise(F.lit(0.0))
        t = F.least(F.lit(float(t1)), F.lit(t0) + step)
        out = t if (start, t0) == pieces[-1][:2] else F.when(v < F.lit(start + (w0 + w0 + slope * (t1 - t0)) / 2 * (t1 - t0)), t).otherwise(out)
    return out


def _weight(rank: Column, weights) -> Column:
    return F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))


def _target() -> Column:
    return F.least(F.col("cap").cast("double"), F.col("level") * F.col("w")).alias("target")


def source_targets(sources: DataFrame, weights, max_repeats: int, share: float,
                   ranges: int | None = None) -> DataFrame:
    """sources (src, source_size) -> rank, target: water filling in closed form.
    With sources in order of cap / weight, the level is the largest of
    (words - caps before) / (weights from here on); ranks and sums are prefix sums over
    ranges of sources, one range for few of them."""
    named = sources.select("src", "source_size", F.lit(1).cast("long").alias("one"), F.struct(
        F.col("src").isNull().alias("no"), F.coalesce("src", F.lit("")).alias("name")).alias("by"))
    ranked = prefix_sums(named, [], "by", ["one"], ranges).select(
        "src", "source_size", (F.col("cum_one") - 1).alias("rank"))
    ranked = ranked.withColumns({"w": _weight(F.col("rank"), weights), "cap": F.col("source_size") * max_repeats})
    ranked = ranked.withColumn("by", F.struct((F.col("cap") / F.col("w")).alias("fill"), "rank"))
    filled = prefix_sums(ranked, [], "by", ["cap", "w", "source_size"], ranges)
    words = F.col("total_source_size") * F.lit(float(share))
    level = filled.agg(F.max((words - (F.col("cum_cap") - F.col("cap")))
                             / (F.col("total_w") - F.col("cum_w") + F.col("w"))).alias("level"))
    return filled.crossJoin(F.broadcast(level)).select("src", "source_size", "rank", _target())


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", weights=(1, 2, 3), schedules=SCHEDULES,
             max_repeats: int = 3, share: float = 1.0) -> DataFrame:
    """Every row of ``docs`` with ``size`` (words), ``source_size``, ``target`` of
    its source (words), ``start`` (its word offset in the source), ``taken`` (words
    the mix takes over all repeats; the last document of a source is cut at the
    target) and ``position`` (training time of the first copy, null if not taken)."""
    spark = docs.sparkSession
    base = docs.withColumns({
        "__mx_size": F.coalesce(F.regexp_count(pick(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long"),
        "__mx_src": pick(source_col).cast("string"),
        "__mx_ord": F.md5(F.coalesce(pick(id_col).cast("string"), F.lit("")).cast("binary")),
    })
    # words are counted once for all sums, and once where the rows themselves go on
    sized = staged(base.select("__mx_size", "__mx_src", "__mx_ord"))
    sources = cut_lineage(sized.groupBy(F.col("__mx_src").alias("src"))
                          .agg(F.sum("__mx_size").alias("source_size"), F.count(F.lit(1)).alias("n")))
    most = sources.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    buckets = max(default_partitions(spark), math.ceil(most / BUCKET_ROWS))
    plan = source_targets(sources.drop("n"), weights, max_repeats, share).select(
        _key(F.col("src")).alias("__mx_key"), F.col("source_size").alias("__mx_ssize"),
        F.col("rank").alias("__mx_rank"), F.col("target").alias("__mx_target"))
    own = {"__mx_key": _key(F.col("__mx_src")), "__mx_bucket": F.floor(
        F.conv(F.substring("__mx_ord", 1, 8), 16, 10).cast("long") * buckets / (1 << 32)).cast("int")}
    base = base.withColumns(own)

    totals = sized.withColumns(own).groupBy("__mx_key", "__mx_bucket").agg(F.sum("__mx_size").alias("t"))
    ahead = (Window.partitionBy("__mx_key").orderBy("__mx_bucket")
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = cut_lineage(totals.select(
        "__mx_key", "__mx_bucket", F.coalesce(F.sum("t").over(ahead), F.lit(0)).alias("__mx_ahead")).join(plan, "__mx_key"))
    discard(sized)
    inside = (Window.partitionBy("__mx_key", "__mx_bucket")
              .orderBy("__mx_ord", "__mx_size", F.xxhash64(pick(text_col).cast("string")))
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = base.join(offsets, ["__mx_key", "__mx_bucket"]).withColumn(
        "__mx_start", F.col("__mx_ahead") + F.coalesce(F.sum("__mx_size").over(inside), F.lit(0)))
    goal = F.round("__mx_target").cast("long")
    parts = [F.greatest(F.lit(0), F.least(F.col("__mx_size"), goal - F.col("__mx_start") - F.col("__mx_ssize") * e))
             for e in range(max_repeats)]
    rows = rows.withColumn("__mx_parts", F.array(*parts)).withColumns({
        "__mx_taken": sum((F.col("__mx_parts")[e] for e in range(1, max_repeats)), F.col("__mx_parts")[0]),
        "__mx_pos": F.when(F.col("__mx_parts")[0] > 0,
                           _time(F.col("__mx_start") / F.col("__mx_target"), schedules)),
    })
    return with_outputs(rows, {"size": "__mx_size", "source_size": "__mx_ssize",
                               "target": "__mx_target", "start": "__mx_start", "taken": "__mx_taken",
                               "position": "__mx_pos", "source_rank": "__mx_rank",
                               "copy_words": "__mx_parts"}, docs.columns)


def _key(src: Column) -> Column:
    """A source as a key that is never null."""
    return F.when(src.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), src))


def _time(u: Column, schedules) -> Column:
    u = F.least(F.lit(1.0), u)
    out = inverse_demand(schedules[-1], u)
    for k in range(len(schedules) - 2, -1, -1):
        out = F.when(F.col("__mx_rank") % len(schedules) == k, inverse_demand(schedules[k], u)).otherwise(out)
    return out


def in_training_order(plan: DataFrame) -> DataFrame:
    """Range-sort by training position; ties and untaken rows are spread by offset."""
    keys = [F.col("position").asc_nulls_last(), F.col("source_rank"), F.col("start")]
    return plan.repartitionByRange(*keys).sortWithinPartitions(*keys)


def mix_copies(docs: DataFrame, schedules=SCHEDULES, **options) -> DataFrame:
    """The training set in training order: one row per whole copy taken, with
    ``copy`` (0, 1, ...) and ``position``.  A copy of which the target covers less
    than half is left out, one of which it covers more is taken whole, so a source
    is off its target by half a document at most."""
    plan = mix_plan(docs, schedules=schedules, **options)
    copies = plan.select("*", F.posexplode("copy_words").alias("copy", "__mx_words")).where(
        "__mx_words > 0 AND 2 * __mx_words >= size")
    offset = (F.col("start") + F.col("copy") * F.col("source_size")) / F.col("target")
    copies = copies.withColumn("__mx_rank", F.col("source_rank")).withColumn(
        "position", _time(offset, schedules))
    return in_training_order(copies.drop("__mx_words", "__mx_rank", "copy_words"))
