"""Registered data-quality queries: B1-B25."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra import config
from telemetra.jobs.common import lineitem
from telemetra.operators import quality as Q
from telemetra.session import cut_lineage
from telemetra.sources.tables import table

MODES = ["mode_returned", "mode_accepted"]


def gate_input(spark, sf_dir):
    """lineitem with the label columns of the telemetry contract: target =
    open line, two failure modes from the return flag."""
    li = lineitem(spark, sf_dir)
    return li.select(
        "*",
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("target"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("mode_returned"),
        F.when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("mode_accepted"))


def gate_spec(df) -> Q.GateSpec:
    return Q.GateSpec(
        required_columns=list(df.columns),
        numeric_columns=["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
        categories={"l_returnflag": ["A", "N", "R"], "l_linestatus": ["F", "O"]},
        binary_columns=["target", *MODES],
        id_columns=[("l_orderkey", "l_linenumber")],
        positive_columns=["l_quantity", "l_extendedprice"],
        nonnegative_columns=["l_discount", "l_tax"],
        ordered_pair=("l_discount", "l_tax"),
        target="target", modes=MODES)


def b1_b12_gate_lineitem(spark, sf_dir):
    df = gate_input(spark, sf_dir)
    return Q.gate_rules(df, gate_spec(df))


def broken_input(spark, sf_dir):
    """A batch that breaks the schema, type, category, domain and marker rules: a column
    is gone, one has come, a number is text with markers in it, large returns have an
    unknown flag, and the seventh lines a third class."""
    df = gate_input(spark, sf_dir)
    return df.drop("l_tax").withColumns({
        "l_discount": F.when(F.col("l_linenumber") == 1, " N/A ").otherwise(F.lit("0.05")),
        "l_returnflag": F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45),
                               F.concat(F.lit("X"), F.col("l_linenumber").cast("string"))).otherwise(F.col("l_returnflag")),
        "target": F.when(F.col("l_linenumber") == 7, 2).otherwise(F.col("target")),
        "note": F.lit("added")})


def _broken(spark, sf_dir):
    df = broken_input(spark, sf_dir)
    return df, gate_spec(gate_input(spark, sf_dir))


def b1_b12_gate_broken_lineitem(spark, sf_dir):
    return Q.gate_rules(*_broken(spark, sf_dir))


def b7_b8_offenders_lineitem(spark, sf_dir):
    """Every value of the broken batch outside its domain, with its count."""
    return Q.gate_offenders(*_broken(spark, sf_dir))


def b14_gate_report_lineitem(spark, sf_dir):
    """The broken batch's gate as one flat row, written as a report and read back."""
    df, spec = _broken(spark, sf_dir)
    report = Q.gate_report(cut_lineage(Q.gate_rules(df, spec)), cut_lineage(Q.gate_offenders(df, spec)))
    return cut_lineage(report)


def b13_gate_verdict_lineitem(spark, sf_dir):
    return Q.gate_verdict(b1_b12_gate_lineitem(spark, sf_dir))


def b3_missing_lineitem(spark, sf_dir):
    return Q.missing_by_column(lineitem(spark, sf_dir))


def b4_markers_orders(spark, sf_dir):
    return Q.markers_by_column(table(spark, sf_dir, "orders"),
                               markers=[*config.MISSING_MARKERS, "4-not specified"])


def b5_duplicates_lineitem(spark, sf_dir):
    return Q.duplicate_rows(lineitem(spark, sf_dir),
                            ["l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax"])


def b9_unique_lineitem(spark, sf_dir):
    return Q.id_duplicates(lineitem(spark, sf_dir),
                           ["l_orderkey", ("l_orderkey", "l_linenumber"), "l_partkey"])


def b10_ranges_lineitem(spark, sf_dir):
    return Q.range_violations(lineitem(spark, sf_dir), ["l_quantity", "l_extendedprice", "l_discount"],
                              ["l_tax"], ("l_discount", "l_tax"))


def b15_regex_customer(spark, sf_dir):
    return Q.regex_violations(table(spark, sf_dir, "customer"), "c_name", r"^Customer#\d{9}$")


def b16_prefix_part(spark, sf_dir):
    """Product ids that begin with the type's letter, but for parts above size 40."""
    part = table(spark, sf_dir, "part")
    kind = F.substring("p_type", 1, 1)
    ids = part.select(kind.alias("kind"), F.concat(F.when(F.col("p_size") > 40, F.lit("#")).otherwise(kind),
                                                   F.col("p_partkey").cast("string")).alias("product_id"))
    return Q.prefix_mismatch(ids, "product_id", "kind")


def b17_infinite_lineitem(spark, sf_dir):
    return Q.infinite_values(lineitem(spark, sf_dir),
                             ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


def b19_blank_part(spark, sf_dir):
    return Q.blank_text(table(spark, sf_dir, "part"), ["p_name", "p_brand", "p_type"])


def b20_permutation_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return Q.id_permutation(o.select((F.col("o_orderkey") + 1).alias("uid")), "uid")


def b21_gaps_orders(spark, sf_dir):
    return Q.sequence_gaps(table(spark, sf_dir, "orders"), "o_custkey")


def b22_contradictions_lineitem(spark, sf_dir):
    return Q.label_contradictions(gate_input(spark, sf_dir), "target", MODES)


def b23_contract_lineitem(spark, sf_dir):
    """The contract over the payloads that came: text for a number in the second lines of
    open orders, and a field too many from the sixth line on."""
    li = lineitem(spark, sf_dir)
    names = ["l_returnflag", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    kv = [x for c in names for x in (F.lit(c), F.when(
        (F.lit(c) == "l_discount") & (F.col("l_linenumber") == 2) & (F.col("l_linestatus") == "O"), F.lit("n/a"))
        .otherwise(F.col(c).cast("string")))]
    extra = F.when(F.col("l_linenumber") >= 6, F.create_map(F.lit("l_comment"), F.lit("x"))).otherwise(
        F.create_map().cast("map<string,string>"))
    payload = li.select(F.map_concat(F.create_map(*kv), extra).alias("payload"))
    checked = Q.contract_violations(payload, "l_returnflag", ["A", "N"],
                                    ["l_quantity", "l_extendedprice", "l_discount"], ["l_tax"], payload="payload")
    return (checked.select(F.explode_outer("violations").alias("violation"))
            .groupBy(F.coalesce("violation", F.lit("valid")).alias("violation"))
            .agg(F.count(F.lit(1)).alias("rows")))


def b24_batch_dups_lineitem(spark, sf_dir):
    """Per batch the repeated rows and the first ten of them.  Row numbers repeat here."""
    li = lineitem(spark, sf_dir).select(
        F.year("l_shipdate").alias("batch_id"),
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("row_no"),
        "l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax")
    d = Q.batch_duplicates(li, "batch_id", "row_no",
                           ["l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax"])
    return Q.duplicate_message(cut_lineage(d), "batch_id", "row_no")


def b25_batch_sizes_orders(spark, sf_dir):
    return Q.batch_sizes(table(spark, sf_dir, "orders"), "o_custkey", 1, 12)


QUERIES = {
    "b1_b12_gate_lineitem": b1_b12_gate_lineitem,
    "b1_b12_gate_broken_lineitem": b1_b12_gate_broken_lineitem,
    "b7_b8_offenders_lineitem": b7_b8_offenders_lineitem,
    "b14_gate_report_lineitem": b14_gate_report_lineitem,
    "b13_gate_verdict_lineitem": b13_gate_verdict_lineitem,
    "b3_missing_lineitem": b3_missing_lineitem,
    "b4_markers_orders": b4_markers_orders,
    "b5_duplicates_lineitem": b5_duplicates_lineitem,
    "b9_unique_lineitem": b9_unique_lineitem,
    "b10_ranges_lineitem": b10_ranges_lineitem,
    "b15_regex_customer": b15_regex_customer,
    "b16_prefix_part": b16_prefix_part,
    "b17_infinite_lineitem": b17_infinite_lineitem,
    "b19_blank_part": b19_blank_part,
    "b20_permutation_orders": b20_permutation_orders,
    "b21_gaps_orders": b21_gaps_orders,
    "b22_contradictions_lineitem": b22_contradictions_lineitem,
    "b23_contract_lineitem": b23_contract_lineitem,
    "b24_batch_dups_lineitem": b24_batch_dups_lineitem,
    "b25_batch_sizes_orders": b25_batch_sizes_orders,
}

# ------------------------------------------------------------------ oracle SQL
_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_GATE_COLS = _LI_COLS + ["target", "mode_returned", "mode_accepted"]
_FLOATS = {"l_quantity", "l_extendedprice", "l_discount", "l_tax"}
_GATE_IN = """(SELECT *, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS target,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS mode_returned,
  CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS mode_accepted FROM lineitem)"""
_MARKERS = ", ".join(f"'{m}'" for m in config.MISSING_MARKERS)


def _miss(c):
    return f"({c} IS NULL OR isnan({c}))" if c in _FLOATS else f"({c} IS NULL)"


def _mark(c, markers=_MARKERS):
    e = f"coalesce(lower(trim(CAST({c} AS VARCHAR))) IN ({markers}), false)"
    return f"({e} AND NOT isnan({c}))" if c in _FLOATS else e


def _row(rule, passed, observed, failing, detail):
    return (f"SELECT '{rule}' AS rule, CAST({passed} AS BOOLEAN) AS passed, "
            f"CAST({observed} AS DOUBLE) AS observed, CAST({failing} AS BIGINT) AS failing, "
            f"CAST({detail} AS VARCHAR) AS detail")


_MISS_SUM = " + ".join(f"sum(CAST({_miss(c)} AS BIGINT))" for c in _GATE_COLS)
_MARK_SUM = " + ".join(f"sum(CAST({_mark(c)} AS BIGINT))" for c in _GATE_COLS)
_GATE_SQL = f"""WITH g AS {_GATE_IN},
a AS (SELECT count(*) AS n, {_MISS_SUM} AS missing, {_MARK_SUM} AS markers,
  count_if(l_quantity <= 0) + count_if(l_extendedprice <= 0) + count_if(l_discount < 0)
    + count_if(l_tax < 0) + count_if(l_tax <= l_discount) AS ranges,
  list_sort(list_distinct(list(CAST(target AS VARCHAR)))) AS classes,
  count_if(target <> greatest(mode_returned, mode_accepted) OR target IS NULL) AS contra,
  count(DISTINCT CASE WHEN l_returnflag NOT IN ('A','N','R') THEN l_returnflag END)
   + count(DISTINCT CASE WHEN l_linestatus NOT IN ('F','O') THEN l_linestatus END) AS cats,
  count(DISTINCT CASE WHEN target NOT IN (0,1) THEN target END)
   + count(DISTINCT CASE WHEN mode_returned NOT IN (0,1) THEN mode_returned END)
   + count(DISTINCT CASE WHEN mode_accepted NOT IN (0,1) THEN mode_accepted END) AS bins
  FROM g),
d AS (SELECT sum(c - 1) AS dups, sum(c) AS rows FROM (SELECT count(*) AS c FROM g GROUP BY {", ".join(_GATE_COLS)})),
u AS (SELECT sum(c - 1) AS dups FROM (SELECT count(*) AS c FROM g GROUP BY l_orderkey, l_linenumber))
{_row('min_rows', 'n >= 10000', 'n', 0, "'>= 10000'")} FROM a
UNION ALL {_row('schema', 'true', len(_GATE_COLS), 0, "'missing=[] extra=[]'")}
UNION ALL {_row('missing_rate', 'missing / (n * 14) <= 0.0', 'missing / (n * 14)', 'missing', "'<= 0.0'")} FROM a
UNION ALL {_row('missing_markers', 'markers = 0', 'markers', 'markers', "''")} FROM a
UNION ALL {_row('numeric_types', 'true', 0, 0, "'absent=[] non_numeric=[]'")}
UNION ALL {_row('allowed_categories', 'cats = 0', 'cats', 'cats', "''")} FROM a
UNION ALL {_row('binary_domain', 'bins = 0', 'bins', 'bins', "''")} FROM a
UNION ALL {_row('physical_ranges', 'ranges = 0', 'ranges', 'ranges', "'0 impossible values'")} FROM a
UNION ALL {_row('target_classes', "array_to_string(classes, ',') = '0,1'", 'len(classes)',
                'len(list_filter(classes, lambda z: z NOT IN (\'0\', \'1\')))',
                "array_to_string(classes, ',')")} FROM a
UNION ALL {_row('label_consistency', 'contra / n <= 0.003', 'contra / n', 'contra', "'<= 0.003'")} FROM a
UNION ALL {_row('duplicate_rate', 'dups / rows <= 0.0', 'dups / rows', 'dups', "'<= 0.0'")} FROM d
UNION ALL {_row('unique_ids', 'dups = 0', 'dups', 'dups', "'l_orderkey+l_linenumber:' || dups")} FROM u"""

_ORD_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
             "o_orderpriority"]
_ORD_MARKERS = _MARKERS + ", '4-not specified'"


def _mark_ord(c):
    e = f"coalesce(lower(trim(CAST({c} AS VARCHAR))) IN ({_ORD_MARKERS}), false)"
    return f"({e} AND NOT isnan({c}))" if c == "o_totalprice" else e


_BAD = f"""(SELECT * EXCLUDE (l_tax) REPLACE (CASE WHEN l_linenumber = 1 THEN ' N/A ' ELSE '0.05' END AS l_discount,
  CASE WHEN l_returnflag = 'R' AND l_quantity > 45 THEN 'X' || l_linenumber ELSE l_returnflag END AS l_returnflag,
  CASE WHEN l_linenumber = 7 THEN 2 ELSE target END AS target), 'added' AS note FROM {_GATE_IN})"""
_BAD_COLS = [c for c in _GATE_COLS if c != "l_tax"] + ["note"]
_BAD_MISS = " + ".join(f"sum(CAST({'(l_discount IS NULL)' if c == 'l_discount' else _miss(c)} AS BIGINT))" for c in _BAD_COLS)
_BAD_GATE = f"""WITH g AS {_BAD},
a AS (SELECT count(*) AS n, {_BAD_MISS} AS missing, count_if(lower(trim(l_discount)) IN ({_MARKERS})) AS markers,
  count_if(l_quantity <= 0) + count_if(l_extendedprice <= 0) AS ranges,
  list_sort(list_distinct(list(CAST(target AS VARCHAR)))) AS classes,
  count_if(target <> greatest(mode_returned, mode_accepted)) AS contra,
  count(DISTINCT CASE WHEN l_returnflag NOT IN ('A','N','R') THEN l_returnflag END) AS cats,
  min(CASE WHEN l_returnflag NOT IN ('A','N','R') THEN l_returnflag END) AS lo,
  max(CASE WHEN l_returnflag NOT IN ('A','N','R') THEN l_returnflag END) AS hi,
  count(DISTINCT CASE WHEN target NOT IN (0,1) THEN target END) AS bins FROM g),
d AS (SELECT sum(c - 1) AS dups, sum(c) AS rows FROM (SELECT count(*) AS c FROM g GROUP BY {", ".join(_BAD_COLS)})),
u AS (SELECT sum(c - 1) AS dups FROM (SELECT count(*) AS c FROM g GROUP BY l_orderkey, l_linenumber))
{_row('min_rows', 'n >= 10000', 'n', 0, "'>= 10000'")} FROM a
UNION ALL {_row('schema', 'false', len(_GATE_COLS) - 1, 2, '$$missing=[' + "'l_tax'" + '] extra=[' + "'note'" + ']$$')}
UNION ALL {_row('missing_rate', 'missing / (n * 14) <= 0.0', 'missing / (n * 14)', 'missing', "'<= 0.0'")} FROM a
UNION ALL {_row('missing_markers', 'markers = 0', 'markers', 'markers', "CASE WHEN markers > 0 THEN 'l_discount:' || markers ELSE '' END")} FROM a
UNION ALL {_row('numeric_types', 'false', 1, 2, '$$absent=[' + "'l_tax'" + '] non_numeric=[' + "'l_discount'" + ']$$')}
UNION ALL {_row('allowed_categories', 'cats = 0', 'cats', 'cats', "CASE WHEN cats > 0 THEN 'l_returnflag:' || cats || ' values ' || lo || '..' || hi ELSE '' END")} FROM a
UNION ALL {_row('binary_domain', 'bins = 0', 'bins', 'bins', "CASE WHEN bins > 0 THEN 'target:1 values 2..2' ELSE '' END")} FROM a
UNION ALL {_row('physical_ranges', 'ranges = 0', 'ranges', 'ranges', "'0 impossible values'")} FROM a
UNION ALL {_row('target_classes', "array_to_string(classes, ',') = '0,1'", 'len(classes)',
                'len(list_filter(classes, lambda z: z NOT IN (\'0\', \'1\')))',
                "CASE WHEN len(classes) <= 2 THEN array_to_string(classes, ',') ELSE len(classes) || ' classes' END")} FROM a
UNION ALL {_row('label_consistency', 'contra / n <= 0.003', 'contra / n', 'contra', "'<= 0.003'")} FROM a
UNION ALL {_row('duplicate_rate', 'dups / rows <= 0.0', 'dups / rows', 'dups', "'<= 0.0'")} FROM d
UNION ALL {_row('unique_ids', 'dups = 0', 'dups', 'dups', "'l_orderkey+l_linenumber:' || dups")} FROM u"""
_BAD_VALUES = f"""(SELECT 'allowed_categories' AS rule, 'l_returnflag' AS column_name, l_returnflag AS value, count(*) AS count
  FROM {_BAD} WHERE l_returnflag NOT IN ('A', 'N', 'R') GROUP BY 3
  UNION ALL SELECT 'binary_domain', 'target', '2', count(*) FROM {_BAD} WHERE target = 2 HAVING count(*) > 0
  UNION ALL SELECT 'target_classes', 'target', '2', count(*) FROM {_BAD} WHERE target = 2 HAVING count(*) > 0)"""

SQL = {
    "b1_b12_gate_broken_lineitem": _BAD_GATE,
    "b7_b8_offenders_lineitem": f"SELECT * FROM {_BAD_VALUES}",
    "b14_gate_report_lineitem": f"""WITH r AS ({_BAD_GATE}), v AS {_BAD_VALUES},
s AS (SELECT *, row_number() OVER (PARTITION BY rule, column_name ORDER BY count DESC, value) AS n FROM v),
o AS (SELECT rule, column_name, count(*) AS vals, CAST(sum(count) AS BIGINT) AS cells,
  list({{'value': value, 'count': count}} ORDER BY value) FILTER (n <= 20) AS shown FROM s GROUP BY ALL)
SELECT count(*) AS rules, count_if(passed) AS passed_rules, count_if(NOT passed) AS failed_rules, bool_and(passed) AS gate_passed,
  string_agg(CASE WHEN NOT passed THEN rule END, ',' ORDER BY rule) AS failed,
  string_agg(rule || ':' || failing, ',' ORDER BY rule || ':' || failing) AS failing,
  (SELECT CAST(to_json(list({{'rule': rule, 'column_name': column_name, 'values': vals, 'cells': cells, 'shown': shown}}
     ORDER BY rule, column_name)) AS VARCHAR) FROM o) AS offenders FROM r""",
    "b1_b12_gate_lineitem": _GATE_SQL,
    "b13_gate_verdict_lineitem": f"""WITH r AS ({_GATE_SQL})
SELECT count(*) AS rules, count_if(passed) AS passed_rules, count_if(NOT passed) AS failed_rules,
       coalesce(bool_and(passed), false) AND count(*) > 0 AS gate_passed FROM r""",
    "b3_missing_lineitem": "WITH a AS (SELECT count(*) AS n, "
    + ", ".join(f"sum(CAST({_miss(c)} AS BIGINT)) AS {c}" for c in _LI_COLS)
    + " FROM lineitem) "
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS missing, "
                         f"round({c} * 100.0 / n, 2) AS missing_pct FROM a" for c in _LI_COLS),
    "b4_markers_orders": "WITH a AS (SELECT "
    + ", ".join(f"sum(CAST({_mark_ord(c)} AS BIGINT)) AS {c}" for c in _ORD_COLS)
    + " FROM orders) "
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS markers FROM a" for c in _ORD_COLS),
    "b5_duplicates_lineitem": """SELECT CAST(sum(c) AS BIGINT) AS rows, CAST(sum(c - 1) AS BIGINT) AS duplicate_rows,
  sum(c - 1) / sum(c) AS duplicate_rate FROM (SELECT count(*) AS c FROM lineitem
  GROUP BY l_returnflag, l_linestatus, l_quantity, l_discount, l_tax)""",
    "b9_unique_lineitem": """SELECT 'l_orderkey' AS id_column, CAST(sum(c - 1) AS BIGINT) AS duplicates
  FROM (SELECT count(*) c FROM lineitem GROUP BY l_orderkey)
UNION ALL SELECT 'l_orderkey+l_linenumber', CAST(sum(c - 1) AS BIGINT)
  FROM (SELECT count(*) c FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL SELECT 'l_partkey', CAST(sum(c - 1) AS BIGINT)
  FROM (SELECT count(*) c FROM lineitem GROUP BY l_partkey)""",
    "b10_ranges_lineitem": """WITH a AS (SELECT count_if(l_quantity <= 0) q, count_if(l_extendedprice <= 0) p,
  count_if(l_discount <= 0) d, count_if(l_tax < 0) t, count_if(l_tax <= l_discount) o FROM lineitem)
SELECT 'positive' AS "check", 'l_quantity' AS column_name, q AS violations FROM a
UNION ALL SELECT 'positive', 'l_extendedprice', p FROM a
UNION ALL SELECT 'positive', 'l_discount', d FROM a
UNION ALL SELECT 'nonnegative', 'l_tax', t FROM a
UNION ALL SELECT 'ordered', 'l_tax>l_discount', o FROM a""",
    "b15_regex_customer": r"""SELECT count_if(c_name IS NOT NULL AND NOT regexp_full_match(c_name, '^Customer#\d{9}$')) AS violations,
  count(c_name) AS checked FROM customer""",
    "b16_prefix_part": """SELECT count_if(substring(CASE WHEN p_size > 40 THEN '#' ELSE substring(p_type, 1, 1) END
  || p_partkey, 1, 1) <> substring(p_type, 1, 1)) AS mismatches FROM part""",
    "b17_infinite_lineitem": "WITH a AS (SELECT "
    + ", ".join(f"count_if(abs(CAST({c} AS DOUBLE)) = 'infinity'::DOUBLE) AS {c}" for c in sorted(_FLOATS))
    + " FROM lineitem) "
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS infinities FROM a" for c in sorted(_FLOATS)),
    "b19_blank_part": """WITH a AS (SELECT count_if(trim(p_name) = '') n, count_if(trim(p_brand) = '') b,
  count_if(trim(p_type) = '') t FROM part)
SELECT 'p_name' AS column_name, n AS blanks FROM a UNION ALL SELECT 'p_brand', b FROM a
UNION ALL SELECT 'p_type', t FROM a""",
    "b20_permutation_orders": """SELECT min(o_orderkey + 1) AS min_id, max(o_orderkey + 1) AS max_id,
  count(*) AS rows, count(DISTINCT o_orderkey + 1) AS distinct_ids,
  min(o_orderkey + 1) = 1 AND max(o_orderkey + 1) = count(*) AND count(DISTINCT o_orderkey + 1) = count(*)
    AS is_permutation FROM orders""",
    "b21_gaps_orders": """WITH v AS (SELECT o_custkey AS v FROM orders WHERE o_custkey IS NOT NULL),
d AS (SELECT DISTINCT v FROM v)
SELECT CAST(greatest((SELECT count(*) FROM v) - 1
         - (SELECT count(*) FROM d WHERE v + 1 IN (SELECT v FROM d)), 0) AS BIGINT) AS gaps,
       (SELECT count(*) FROM v) AS rows""",
    "b22_contradictions_lineitem": f"""SELECT
  count_if(target = 1 AND greatest(mode_returned, mode_accepted) = 0) AS failure_without_mode,
  count_if(target = 0 AND greatest(mode_returned, mode_accepted) = 1) AS mode_without_failure,
  count_if(target = 0 AND greatest(mode_returned, mode_accepted) = 1 AND mode_returned = 1) AS mode_returned_in_second,
  count_if(target = 0 AND greatest(mode_returned, mode_accepted) = 1 AND mode_accepted = 1) AS mode_accepted_in_second
  FROM {_GATE_IN}""",
    "b23_contract_lineitem": """WITH v AS (SELECT list_filter([
  CASE WHEN l_returnflag IS NULL THEN 'l_returnflag:required'
       WHEN l_returnflag NOT IN ('A', 'N') THEN 'l_returnflag:category' END,
  CASE WHEN l_quantity IS NULL THEN 'l_quantity:required' WHEN l_quantity <= 0 THEN 'l_quantity:gt0' END,
  CASE WHEN l_extendedprice IS NULL THEN 'l_extendedprice:required'
       WHEN l_extendedprice <= 0 THEN 'l_extendedprice:gt0' END,
  CASE WHEN l_linenumber = 2 AND l_linestatus = 'O' THEN 'l_discount:type'
       WHEN l_discount IS NULL THEN 'l_discount:required' WHEN l_discount <= 0 THEN 'l_discount:gt0' END,
  CASE WHEN l_tax IS NULL THEN 'l_tax:required' WHEN l_tax < 0 THEN 'l_tax:ge0' END,
  CASE WHEN l_linenumber >= 6 THEN 'l_comment:unexpected' END],
  lambda z: z IS NOT NULL) AS vs FROM lineitem),
e AS (SELECT unnest(CASE WHEN len(vs) = 0 THEN ['valid'] ELSE vs END) AS violation FROM v)
SELECT violation, count(*) AS rows FROM e GROUP BY violation""",
    "b24_batch_dups_lineitem": """WITH li AS (SELECT year(l_shipdate) AS batch_id, l_orderkey * 100 + l_linenumber AS row_no,
  l_returnflag, l_linestatus, l_quantity, l_discount, l_tax FROM lineitem),
r AS (SELECT *, count(*) AS c FROM li GROUP BY ALL),
f AS (SELECT *, min(row_no) OVER g AS first_row, sum(c) OVER g AS whole FROM r
  WINDOW g AS (PARTITION BY batch_id, l_returnflag, l_linestatus, l_quantity, l_discount, l_tax)),
d AS (SELECT batch_id, row_no, first_row, c - CAST(row_no = first_row AS INTEGER) AS copies FROM f WHERE whole > 1),
n AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY row_no, first_row) AS n FROM d WHERE copies > 0)
SELECT batch_id, CAST(sum(copies) AS BIGINT) AS duplicate_rows, count(DISTINCT first_row) AS originals,
  string_agg(row_no || '->' || first_row, ',' ORDER BY n) FILTER (n <= 10) AS message FROM n GROUP BY batch_id""",
    "b25_batch_sizes_orders": """SELECT o_custkey, count(*) AS rows, count(*) >= 1 AND count(*) <= 12 AS size_ok
  FROM orders GROUP BY o_custkey""",
}
