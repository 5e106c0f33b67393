"""Data-quality gate B1-B25.

All aggregate-only rules share one ``agg`` pass; full-row duplicates (B5) and
id uniqueness (B9) each need their own grouping.  Results are a long table
``(rule, passed, observed, failing, detail)``, one row per rule, and the gate
verdict (B13) is an aggregate over that table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetra import config
from telemetra.plans.lookup import keyed_lookup
from telemetra.session import cut_lineage

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)
FLOAT_TYPES = (T.FloatType, T.DoubleType)

RESULT_SCHEMA = "rule string, passed boolean, observed double, failing bigint, detail string"


@dataclass
class GateSpec:
    """Column roles and limits of the gate (the reference's JSON contract)."""
    required_columns: Sequence[str]
    min_rows: int = config.MIN_ROWS
    allow_extra_columns: bool = False
    max_missing_rate: float = config.MAX_MISSING_RATE
    markers: Sequence[str] = tuple(config.MISSING_MARKERS)
    max_duplicate_rate: float = config.MAX_DUPLICATE_RATE
    numeric_columns: Sequence[str] = ()
    categories: dict = field(default_factory=dict)
    binary_columns: Sequence[str] = ()
    id_columns: Sequence = ()
    positive_columns: Sequence[str] = ()
    nonnegative_columns: Sequence[str] = ()
    ordered_pair: tuple | None = None          # (low, high): high must exceed low
    target: str | None = None
    modes: Sequence[str] = ()
    max_contradiction_rate: float = config.MAX_LABEL_CONTRADICTION_RATE


def _is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, NUMERIC_TYPES)


def _is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, FLOAT_TYPES)


def missing_cell(df: DataFrame, c: str) -> Column:
    col = F.col(c)
    return (col.isNull() | F.isnan(col)) if _is_float(df, c) else col.isNull()


# The text of a number, date or timestamp always holds a digit, apart from
# these words; a boolean reads true / false.
_DIGITLESS_TEXT = {T.FloatType: {"nan", "infinity", "-infinity"},
                   T.DoubleType: {"nan", "infinity", "-infinity"},
                   T.BooleanType: {"true", "false"}}
_TYPED = NUMERIC_TYPES + (T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def _possible_markers(df: DataFrame, c: str, markers: Sequence[str]) -> list[str]:
    """The markers the text of column ``c`` can equal: all of them for text,
    for typed columns only those with a digit or the type's digit-free words --
    usually none, so no per-cell cast to string is made at all."""
    norm = [m.strip().lower() for m in markers]
    dt = df.schema[c].dataType
    if not isinstance(dt, _TYPED):
        return norm
    words = next((v for k, v in _DIGITLESS_TEXT.items() if isinstance(dt, k)), set())
    return [m for m in norm if m in words or any(ch.isdigit() for ch in m)]


def marker_cell(df: DataFrame, c: str, markers: Sequence[str]) -> Column:
    """Trimmed, lower-cased text in the marker list; NaN is missing, not text."""
    possible = _possible_markers(df, c, markers)
    if not possible:
        return F.lit(False)
    norm = F.lower(F.trim(F.col(c).cast("string")))
    hit = norm.isin(*possible)
    if _is_float(df, c):
        hit = hit & ~F.isnan(F.col(c))
    return F.coalesce(hit, F.lit(False))


def _row(rule: str, passed: Column, observed: Column, failing: Column, detail: Column) -> Column:
    return F.struct(F.lit(rule).alias("rule"), passed.cast("boolean").alias("passed"),
                    observed.cast("double").alias("observed"),
                    failing.cast("long").alias("failing"), detail.cast("string").alias("detail"))


def _bad_value(c: str, allowed: Sequence) -> Column:
    return F.when(~F.col(c).isin(*allowed) & F.col(c).isNotNull(), F.col(c).cast("string"))


def domain_offenders(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row, per check ``k`` a struct ``(n, lo, hi)``: the exact number of
    distinct non-NULL values of ``checks[k]`` and the smallest and largest as
    examples -- bounded, unlike a collected set of hostile values.

    One pass: every row emits its non-NULL ``(check, value)`` pairs, a grouping
    on the pair collapses them map-side (a hot value becomes one row per task)
    and the second grouping counts per check.  Several exact distinct counts in
    one aggregate would instead Expand the whole table once per count."""
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in checks.items()])
    distinct = (df.select(F.explode(pairs).alias("p")).select("p.k", "p.v")
                .where(F.col("v").isNotNull()).distinct())
    per = distinct.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"),
                                    F.max("v").alias("hi"))
    empty = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("string").alias("lo"),
                     F.lit(None).cast("string").alias("hi"))
    return per.agg(*[F.coalesce(F.max(F.when(F.col("k") == k, F.struct("n", "lo", "hi"))), empty)
                     .alias(k) for k in checks])


def offender_table(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Every offending value, (check, value, count)."""
    pairs = F.array(*[F.struct(F.lit(k).alias("check"), v.cast("string").alias("value")) for k, v in checks.items()])
    return (df.select(F.explode(pairs).alias("p")).select("p.check", "p.value").where(F.col("value").isNotNull())
            .groupBy("check", "value").agg(F.count(F.lit(1)).alias("count")))


def gate_offenders(df: DataFrame, spec: GateSpec) -> DataFrame:
    """B7 / B8 / B11 beside the verdict: (rule, column_name, value, count) of every value
    outside its domain."""
    present = set(df.columns)
    checks = {f"allowed_categories:{c}": _bad_value(c, list(v)) for c, v in spec.categories.items() if c in present}
    checks |= {f"binary_domain:{c}": _bad_value(c, [0, 1]) for c in spec.binary_columns if c in present}
    if spec.target in present:
        checks[f"target_classes:{spec.target}"] = _bad_value(spec.target, [0, 1])
    if not checks:
        return df.sparkSession.createDataFrame([], "rule string, column_name string, value string, count long")
    at = F.split("check", ":", 2)
    return offender_table(df, checks).select(at[0].alias("rule"), at[1].alias("column_name"), "value", "count")


def gate_report(results: DataFrame, offenders: DataFrame) -> DataFrame:
    """The gate as one flat row: verdict, rules, failed rules, the failing cells of
    each rule and the offending values (bounded by the rules; of the values the first 20
    of each column, the rest counted)."""
    first = Window.partitionBy("rule", "column_name").orderBy(F.col("count").desc(), "value")
    shown = (offenders.groupBy("rule", "column_name").agg(F.count(F.lit(1)).alias("values"), F.sum("count").alias("cells"))
             .join(offenders.withColumn("_n", F.row_number().over(first)).where("_n <= 20")
                   .groupBy("rule", "column_name").agg(F.array_sort(F.collect_list(F.struct("value", "count"))).alias("shown")),
                   ["rule", "column_name"]))
    listed = shown.agg(F.to_json(F.array_sort(F.collect_list(F.struct("rule", "column_name", "values", "cells", "shown"))))
                       .alias("offenders"))
    failed = results.agg(
        F.concat_ws(",", F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("rule"))))).alias("failed"),
        F.concat_ws(",", F.array_sort(F.collect_list(F.concat_ws(":", "rule", F.col("failing").cast("string"))))).alias("failing"))
    return gate_verdict(results).crossJoin(failed).crossJoin(listed)


def _offender_detail(c: str, col: str) -> Column:
    o = F.col(col)
    return F.when(o["n"] > 0, F.concat(F.lit(c + ":"), o["n"].cast("string"), F.lit(" values "),
                                       F.concat_ws("..", o["lo"], o["hi"])))


def gate_rules(df: DataFrame, spec: GateSpec) -> DataFrame:
    """B1-B12 as one result table."""
    cols = df.columns
    present = set(cols)
    n = F.count(F.lit(1))
    aggs: dict[str, Column] = {"n": n}
    # B3 missing cells
    aggs["missing"] = sum((F.sum(missing_cell(df, c).cast("long")) for c in cols), F.lit(0))
    # B4 markers
    for i, c in enumerate(cols):
        aggs[f"mk{i}"] = F.sum(marker_cell(df, c, spec.markers).cast("long"))
    # B7 categories, B8 binary domain, B11 target classes: exact distinct counts
    # from their own grouping (see ``domain_offenders``)
    checks: dict[str, Column] = {}
    for i, (c, allowed) in enumerate(spec.categories.items()):
        if c in present:
            checks[f"cat{i}"] = _bad_value(c, list(allowed))
    for i, c in enumerate(spec.binary_columns):
        if c in present:
            checks[f"bin{i}"] = _bad_value(c, [0, 1])
    # B10 physical ranges
    rng = []
    for c in spec.positive_columns:
        if c in present and _is_numeric(df, c):
            rng.append(F.count_if(F.col(c) <= 0))
    for c in spec.nonnegative_columns:
        if c in present and _is_numeric(df, c):
            rng.append(F.count_if(F.col(c) < 0))
    if spec.ordered_pair and all(c in present and _is_numeric(df, c) for c in spec.ordered_pair):
        lo, hi = spec.ordered_pair
        rng.append(F.count_if((F.col(hi) <= F.col(lo)) & ~missing_cell(df, lo)))
    aggs["ranges"] = sum(rng, F.lit(0)) if rng else F.lit(0)
    # B11 target classes, B12 label consistency
    has_labels = spec.target in present and all(m in present for m in spec.modes)
    if spec.target in present:
        tcol = F.col(spec.target).cast("string")
        checks["classes"] = tcol
        checks["classes_bad"] = F.when(~tcol.isin("0", "1"), tcol)
    if has_labels and spec.modes:
        t, g = F.col(spec.target), F.greatest(*[F.col(m) for m in spec.modes])
        aggs["contra"] = F.count_if((t != g) | t.isNull() | g.isNull())
    one = df.agg(*[v.alias(k) for k, v in aggs.items()])
    if checks:
        one = one.crossJoin(domain_offenders(df, checks))      # one row x one row

    cells = F.col("n") * F.lit(len(cols))
    rows = []
    # B1
    rows.append(_row("min_rows", F.col("n") >= spec.min_rows, F.col("n"), F.lit(0),
                     F.concat(F.lit(">= "), F.lit(str(spec.min_rows)))))
    # B2 (metadata)
    missing_cols = sorted(set(spec.required_columns) - present)
    extra_cols = sorted(present - set(spec.required_columns))
    schema_ok = not missing_cols and (spec.allow_extra_columns or not extra_cols)
    rows.append(_row("schema", F.lit(schema_ok),
                     F.lit(len(set(spec.required_columns) & present)),
                     F.lit(len(missing_cols) + (0 if spec.allow_extra_columns else len(extra_cols))),
                     F.lit(f"missing={missing_cols} extra={extra_cols}")))
    # B3
    miss_rate = F.when(cells > 0, F.col("missing") / cells).otherwise(1.0)
    rows.append(_row("missing_rate", miss_rate <= spec.max_missing_rate, miss_rate,
                     F.col("missing"), F.lit(f"<= {spec.max_missing_rate}")))
    # B4
    mk_total = sum((F.col(f"mk{i}") for i in range(len(cols))), F.lit(0))
    mk_detail = F.concat_ws(",", *[F.when(F.col(f"mk{i}") > 0,
                                          F.concat(F.lit(c + ":"), F.col(f"mk{i}").cast("string")))
                                   for i, c in enumerate(cols)])
    rows.append(_row("missing_markers", mk_total == 0, mk_total, mk_total, mk_detail))
    # B6 numeric types (metadata on a typed table)
    absent = [c for c in spec.numeric_columns if c not in present]
    non_num = [c for c in spec.numeric_columns if c in present and not _is_numeric(df, c)]
    rows.append(_row("numeric_types", F.lit(not absent and not non_num), F.lit(len(non_num)),
                     F.lit(len(absent) + len(non_num)),
                     F.lit(f"absent={absent} non_numeric={non_num}")))
    # B7
    cat_parts, cat_fail = [], []
    for i, c in enumerate(spec.categories):
        if c in present:
            cat_fail.append(F.col(f"cat{i}")["n"])
            cat_parts.append(_offender_detail(c, f"cat{i}"))
        else:
            cat_fail.append(F.lit(1))
            cat_parts.append(F.lit(c + ":absent"))
    cat_n = sum(cat_fail, F.lit(0))
    rows.append(_row("allowed_categories", cat_n == 0, cat_n, cat_n, F.concat_ws(",", *cat_parts)))
    # B8
    bin_parts, bin_fail = [], []
    for i, c in enumerate(spec.binary_columns):
        if c in present:
            bin_fail.append(F.col(f"bin{i}")["n"])
            bin_parts.append(_offender_detail(c, f"bin{i}"))
        else:
            bin_fail.append(F.lit(1))
            bin_parts.append(F.lit(c + ":absent"))
    bin_n = sum(bin_fail, F.lit(0))
    rows.append(_row("binary_domain", bin_n == 0, bin_n, bin_n, F.concat_ws(",", *bin_parts)))
    # B10
    rows.append(_row("physical_ranges", F.col("ranges") == 0, F.col("ranges"), F.col("ranges"),
                     F.lit("0 impossible values")))
    # B11
    if spec.target in present:
        cl = F.col("classes")
        ok = (cl["n"] == 2) & (cl["lo"] == "0") & (cl["hi"] == "1")
        detail = F.when(cl["n"] <= 2, F.concat_ws(",", cl["lo"], F.when(cl["n"] == 2, cl["hi"]))) \
            .otherwise(F.concat(cl["n"].cast("string"), F.lit(" classes")))
        rows.append(_row("target_classes", ok, cl["n"], F.col("classes_bad")["n"], detail))
    else:
        rows.append(_row("target_classes", F.lit(False), F.lit(0), F.lit(1), F.lit("absent")))
    # B12
    if has_labels and spec.modes:
        rate = F.when(F.col("n") > 0, F.col("contra") / F.col("n")).otherwise(1.0)
        rows.append(_row("label_consistency", rate <= spec.max_contradiction_rate, rate,
                         F.col("contra"), F.lit(f"<= {spec.max_contradiction_rate}")))
    else:
        rows.append(_row("label_consistency", F.lit(False), F.lit(1.0), F.lit(0), F.lit("absent")))
    agg_part = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")

    dup = duplicate_rows(df).select(
        _row("duplicate_rate",
             F.col("duplicate_rate") <= spec.max_duplicate_rate, F.col("duplicate_rate"),
             F.col("duplicate_rows"), F.lit(f"<= {spec.max_duplicate_rate}")).alias("r")).select("r.*")
    ids = id_duplicates(df, [i for i in spec.id_columns
                             if all(c in present for c in _as_tuple(i))])
    absent_ids = [i for i in spec.id_columns if not all(c in present for c in _as_tuple(i))]
    idr = ids.agg(F.sum("duplicates").alias("d"),
                  F.concat_ws(",", F.array_sort(F.collect_list(
                      F.concat(F.col("id_column"), F.lit(":"), F.col("duplicates").cast("string")))))
                  .alias("detail"))
    idr = idr.select(_row("unique_ids", (F.coalesce(F.col("d"), F.lit(0)) == 0) & F.lit(not absent_ids),
                          F.coalesce(F.col("d"), F.lit(0)), F.coalesce(F.col("d"), F.lit(0)),
                          F.col("detail")).alias("r")).select("r.*")
    return agg_part.unionByName(dup).unionByName(idr)


def _as_tuple(i) -> tuple:
    return tuple(i) if isinstance(i, (list, tuple)) else (i,)


#: Repeated fingerprints (16 bytes each) that are sent to every task.
SENT_FINGERPRINTS = 1 << 20


def row_fingerprint(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of the columns.  Equal rows have equal ones; unequal rows may."""
    cols = [F.col(f"`{c}`") for c in columns]
    return [F.xxhash64(F.lit(seed), *cols) for seed in (17, 91)]


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None, fingerprint=row_fingerprint) -> DataFrame:
    """Rows equal to an earlier row on ``columns`` (all by default).
    NULL equals NULL in grouping, as in pandas ``duplicated``.

    Rows are grouped by a 128-bit fingerprint, so the whole table's shuffle carries two
    numbers a row; only rows whose fingerprint repeats are grouped by their columns,
    which tells true copies from collisions.  Both groupings collapse map-side."""
    cols = list(columns or df.columns)
    f1, f2 = fingerprint(cols)
    marks = df.select(f1.alias("_f1"), f2.alias("_f2"))
    repeats = cut_lineage(marks.groupBy("_f1", "_f2").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1"))
    total = df.agg(F.count(F.lit(1)).alias("rows"))
    marked = df.withColumns({"_f1": f1, "_f2": f2})
    if repeats.count() <= SENT_FINGERPRINTS:          # then no row moves before it is collapsed
        asked = marked.join(F.broadcast(repeats.drop("_c")), ["_f1", "_f2"], "left_semi")
    else:
        asked = keyed_lookup(marked, repeats, ["_f1", "_f2"], "_c", ["_c"]).where("_c IS NOT NULL")
    g = asked.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias("_c"))
    return total.crossJoin(g.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))).select(
        "rows", "duplicate_rows",
        F.when(F.col("rows") > 0, F.col("duplicate_rows") / F.col("rows")).otherwise(1.0)
        .alias("duplicate_rate"))


def id_duplicates(df: DataFrame, id_columns: Sequence) -> DataFrame:
    """Per id column (or column tuple): rows - distinct values, NULL
    counting as one value.  (id_column, duplicates).  One scan: every row names its
    value of each id, collapsed map-side."""
    tuples = [_as_tuple(i) for i in id_columns]
    if not tuples:
        return df.sparkSession.createDataFrame([], "id_column string, duplicates bigint")
    named = F.array(*[F.struct(F.lit("+".join(t)).alias("id_column"),
                               F.to_json(F.struct(*[F.col(f"`{c}`") for c in t])).alias("value")) for t in tuples])
    counts = (df.select(F.explode(named).alias("i")).select("i.*").groupBy("id_column", "value")
              .agg(F.count(F.lit(1)).alias("_c")))
    found = counts.groupBy("id_column").agg(F.sum(F.col("_c") - 1).alias("_d"))
    every = df.sparkSession.createDataFrame([("+".join(t),) for t in tuples], "id_column string")
    return every.join(found, "id_column", "left").select("id_column", F.coalesce("_d", F.lit(0)).cast("long").alias("duplicates"))


def gate_verdict(results: DataFrame) -> DataFrame:
    """The gate passes when every rule passes and at least one ran."""
    return results.agg(
        F.count(F.lit(1)).alias("rules"),
        F.count_if("passed").alias("passed_rules"),
        F.count_if(~F.col("passed")).alias("failed_rules"),
        (F.coalesce(F.bool_and("passed"), F.lit(False)) & (F.count(F.lit(1)) > 0))
        .alias("gate_passed"))


# ----------------------------------------------------------- per-rule helpers
def markers_by_column(df: DataFrame, markers: Sequence[str] = tuple(config.MISSING_MARKERS)
                      ) -> DataFrame:
    """(column_name, markers) per column, one pass."""
    one = df.agg(*[F.sum(marker_cell(df, c, markers).cast("long")).alias(c) for c in df.columns])
    return one.unpivot([], df.columns, "column_name", "markers")


def missing_by_column(df: DataFrame) -> DataFrame:
    """(column_name, missing, missing_pct) per column, one pass."""
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.sum(missing_cell(df, c).cast("long")).alias(c) for c in df.columns])
    long = one.unpivot(["_n"], df.columns, "column_name", "missing")
    return long.select("column_name", "missing",
                       F.round(F.col("missing") * 100.0 / F.col("_n"), 2).alias("missing_pct"))


def range_violations(df: DataFrame, positive: Sequence[str], nonnegative: Sequence[str],
                     ordered_pair: tuple | None = None) -> DataFrame:
    """(check, column_name, violations); NULL and NaN never count."""
    checks = [(f"positive", c, F.count_if(F.col(c) <= 0)) for c in positive]
    checks += [("nonnegative", c, F.count_if(F.col(c) < 0)) for c in nonnegative]
    if ordered_pair:
        lo, hi = ordered_pair
        checks.append(("ordered", f"{hi}>{lo}", F.count_if((F.col(hi) <= F.col(lo)) & ~missing_cell(df, lo))))
    one = df.agg(*[e.alias(f"_v{i}") for i, (_, _, e) in enumerate(checks)])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("check"), F.lit(c).alias("column_name"),
                 F.col(f"_v{i}").cast("long").alias("violations"))
        for i, (k, c, _) in enumerate(checks)])).alias("r")).select("r.*")


def regex_violations(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose text does not match ``pattern`` (NULLs excluded)."""
    c = F.col(column)
    return df.agg(F.count_if(c.isNotNull() & ~c.rlike(pattern)).alias("violations"),
                  F.count(c).alias("checked"))


def prefix_mismatch(df: DataFrame, id_column: str, category: str) -> DataFrame:
    """First character of the id differs from the category."""
    return df.agg(F.count_if(F.substring(F.col(id_column), 1, 1) != F.col(category))
                  .alias("mismatches"))


def infinite_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, infinities)."""
    one = df.agg(*[F.count_if(F.abs(F.col(c).cast("double")) == F.lit(float("inf"))).alias(c)
                   for c in columns])
    return one.unpivot([], list(columns), "column_name", "infinities")


def blank_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, blanks) -- cells that are empty after trimming."""
    one = df.agg(*[F.count_if(F.trim(F.col(c)) == "").alias(c) for c in columns])
    return one.unpivot([], list(columns), "column_name", "blanks")


def id_permutation(df: DataFrame, id_column: str) -> DataFrame:
    """B20 re-aimed: ids form a gap-free permutation of 1..n."""
    c = F.col(id_column)
    return df.agg(F.min(c).alias("min_id"), F.max(c).alias("max_id"),
                  F.count(F.lit(1)).alias("rows"),
                  F.count_distinct(c).alias("distinct_ids")).withColumn(
        "is_permutation",
        (F.col("min_id") == 1) & (F.col("max_id") == F.col("rows"))
        & (F.col("distinct_ids") == F.col("rows")))


def sequence_gaps(df: DataFrame, id_column: str) -> DataFrame:
    """Number of adjacent pairs of the sorted ids whose difference is not
    1 (duplicates included).  Equals (n - 1) - #{distinct v : v + 1 present};
    computed with one semi join of the distinct ids, no global sort."""
    v = df.select(F.col(id_column).alias("v")).where(F.col("v").isNotNull())
    n = v.agg(F.count(F.lit(1)).alias("n"))
    d = v.distinct()
    nxt = d.select((F.col("v") - 1).alias("v"))
    linked = d.join(nxt, "v", "left_semi").agg(F.count(F.lit(1)).alias("linked"))
    return n.crossJoin(linked).select(
        F.greatest(F.col("n") - 1 - F.col("linked"), F.lit(0)).cast("long").alias("gaps"),
        F.col("n").alias("rows"))


def label_contradictions(df: DataFrame, target: str, modes: Sequence[str]) -> DataFrame:
    """Failure without a mode, mode without failure, and per mode the
    count inside the second case."""
    t = F.col(target)
    g = F.greatest(*[F.col(m) for m in modes])
    second = (t == 0) & (g == 1)
    return df.agg(F.count_if((t == 1) & (g == 0)).alias("failure_without_mode"),
                  F.count_if(second).alias("mode_without_failure"),
                  *[F.count_if(second & (F.col(m) == 1)).alias(f"{m}_in_second") for m in modes])


# ---------------------------------------------------------- scoring contract
def contract_violations(df: DataFrame, category: str, allowed: Sequence[str],
                        positive: Sequence[str], nonnegative: Sequence[str],
                        payload: str | None = None) -> DataFrame:
    """Per row the list of 'field:reason' failures of the scoring
    contract (required, numeric, category, bounds, finite, unexpected).  Fields arrive as
    text or numbers; text is ``try_cast``.  With ``payload``, a map column of all fields
    that came, each field is read from it and every key beyond the contract is
    ``unexpected``.  Adds ``violations`` and ``valid``."""
    given = df
    if payload:
        names = [category, *positive, *nonnegative]
        df = df.select("*", *[F.col(payload)[c].alias(c) for c in names if c not in df.columns])
    checks = [F.when(F.col(category).isNull(), F.lit(f"{category}:required"))
              .when(~F.col(category).isin(*allowed), F.lit(f"{category}:category"))]
    for c, strict in [(c, True) for c in positive] + [(c, False) for c in nonnegative]:
        raw = F.col(c)
        num = F.expr(f"try_cast(`{c}` AS DOUBLE)")
        bad_bound = (num <= 0) if strict else (num < 0)
        checks.append(
            F.when(raw.isNull(), F.lit(f"{c}:required"))
            .when(num.isNull(), F.lit(f"{c}:type"))
            .when(F.isnan(num) | (F.abs(num) == F.lit(float("inf"))), F.lit(f"{c}:finite"))
            .when(bad_bound, F.lit(f"{c}:{'gt0' if strict else 'ge0'}")))
    viol = F.array_compact(F.array(*checks))
    if payload:
        beyond = F.array_sort(F.array_except(F.map_keys(payload), F.array(*[F.lit(c) for c in (category, *positive, *nonnegative)])))
        viol = F.concat(viol, F.coalesce(F.transform(beyond, lambda k: F.concat(k, F.lit(":unexpected"))), F.array().cast("array<string>")))
        df = df.withColumn("violations", viol).select(*given.columns, "violations")
        return df.withColumn("valid", F.size("violations") == 0)
    return df.withColumn("violations", viol).withColumn("valid", F.size("violations") == 0)


def batch_duplicates(df: DataFrame, batch: str, row_no: str, fields: Sequence[str]) -> DataFrame:
    """Rows that repeat an earlier row of the same batch on ``fields`` (NULL equals
    NULL): (batch, fields, row_no, copies, first_row), ``first_row`` the number of the
    first occurrence.  Where numbers repeat, ``copies`` tells how many such rows there
    are; of those with the first number one is the original.  Rows are collapsed by
    number first, and a hot group is no join key (``plans.lookup``)."""
    keys = [batch, *fields]
    rows = cut_lineage(df.groupBy(*keys, row_no).agg(F.count(F.lit(1)).alias("copies")))
    first = rows.groupBy(*keys).agg(F.min(row_no).alias("first_row"), F.sum("copies").alias("_all"),
                                    F.count(F.lit(1)).alias("_rows")).where("_all > 1")
    found = keyed_lookup(rows, first, keys, "_rows", ["first_row"]).where("first_row IS NOT NULL")
    found = found.withColumn("copies", F.col("copies") - (F.col(row_no) == F.col("first_row")).cast("int"))
    return found.where("copies > 0").select(*keys, row_no, "copies", "first_row")


def duplicate_message(duplicates: DataFrame, batch: str, row_no: str, shown: int = 10) -> DataFrame:
    """Per batch the copies, and the text of the first ``shown`` of them."""
    place = Window.partitionBy(batch).orderBy(row_no, "first_row")
    # the first rows of a batch by a bounded heap, not a sorted batch
    listed = (duplicates.select(batch, row_no, "first_row", "copies")
              .withColumn("_n", F.row_number().over(place)).where(F.col("_n") <= shown)
              .groupBy(batch).agg(F.concat_ws(",", F.transform(
                  F.array_sort(F.collect_list(F.struct("_n", F.concat_ws("->", row_no, "first_row").alias("t")))),
                  lambda x: x["t"])).alias("message")))
    totals = duplicates.groupBy(batch).agg(F.sum("copies").alias("duplicate_rows"),
                                           F.count_distinct("first_row").alias("originals"))
    return totals.join(listed, batch)


def batch_sizes(df: DataFrame, batch: str, low: int = 1, high: int = config.SCORING_BATCH_MAX
                ) -> DataFrame:
    """(batch, rows, size_ok)."""
    return (df.groupBy(batch).agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("size_ok", (F.col("rows") >= low) & (F.col("rows") <= high)))


def schema_contract(df: DataFrame, expected: Sequence[tuple[str, str]]) -> DataFrame:
    """Column order and integer / float kind per column against the
    contract (metadata only: no data pass)."""
    kinds = {T.ByteType: "integer", T.ShortType: "integer", T.IntegerType: "integer",
             T.LongType: "integer", T.FloatType: "float", T.DoubleType: "float",
             T.DecimalType: "float", T.StringType: "string", T.BooleanType: "boolean"}
    actual = [(f.name, next((v for k, v in kinds.items() if isinstance(f.dataType, k)), "other"))
              for f in df.schema.fields]
    rows = []
    for pos, (name, kind) in enumerate(expected):
        got = actual[pos] if pos < len(actual) else (None, None)
        rows.append((pos, name, kind, got[0], got[1], got[0] == name, got[1] == kind))
    return df.sparkSession.createDataFrame(
        rows, "position int, expected_name string, expected_kind string, actual_name string, "
              "actual_kind string, name_ok boolean, kind_ok boolean")
