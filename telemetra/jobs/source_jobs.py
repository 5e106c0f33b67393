"""Registered source / sink queries: A1, A2, A3, A8, A9, A10.

CSV and JSON inputs are written by Spark from the given tables into a fresh
folder under the checkpoint folder, then read back through the operators.
"""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from telemetra.jobs.common import lineitem
from telemetra.sources import files as A
from telemetra.sources.tables import table
from telemetra.streaming.stream import scratch_location


def a1_csv_customer(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    path = scratch_location(spark, "a1") + "/customer_csv"
    A.write_table(cust, path, fmt="csv")
    back = A.read_csv_typed(spark, path, cust.schema)
    return back.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"),
                                            F.sum("c_acctbal").alias("acctbal"),
                                            F.count_distinct("c_nationkey").alias("nations"))


PART_FIELDS = ["p_partkey", "p_brand", "p_retailprice", "p_size"]


def a2_tolerant_csv_part(spark, sf_dir):
    """part the way a spreadsheet exports it: ';' separator, decimal comma, padded
    lower-case brand, a column too many and one that is missing, lines with a cell too
    many (size above 45) or too few (size 1 and 2), and prices that are no number (size
    3); read back with the tolerant ingest, and what it reports."""
    part = table(spark, sf_dir, "part")
    price = F.when(F.col("p_size") == 3, "n/a").otherwise(
        F.regexp_replace(F.format_string("%.2f", "p_retailprice"), r"\.", ","))
    cells = [F.col("p_partkey").cast("string"), F.concat(F.lit("  "), F.lower("p_brand")), price,
             F.col("p_size").cast("string")]
    line = F.concat_ws(";", *cells, F.when(F.col("p_size") > 2, "note"), F.when(F.col("p_size") > 45, "more"))
    path = scratch_location(spark, "a2") + "/part_csv"
    # one text column whose name is the header line
    (part.select(line.alias(";".join([*PART_FIELDS, "note"]))).write.option("header", True)
     .option("sep", "\u0001").option("quote", "\u0000").csv(path))
    df, report = A.read_csv_tolerant(spark, path, [*PART_FIELDS, "p_type"],
                                     numeric=["p_retailprice", "p_size"], upper=["p_brand"])
    rejects = report["rejects"].agg(F.count(F.lit(1)).alias("rejected_lines"))
    return (df.groupBy("p_brand").agg(F.count(F.lit(1)).alias("parts"),
                                      F.count_if(F.col("p_retailprice").isNull()).alias("unreadable_prices"),
                                      F.round(F.sum("p_retailprice"), 2).alias("retail"),
                                      F.sum("p_size").alias("size"))
            .crossJoin(rejects)                               # one row
            .withColumns({"separator": F.lit(report["separator"]), "missing": F.lit(",".join(report["missing"])),
                          "extra": F.lit(",".join(report["extra"]))}))


def a3_jsonl_events(spark, sf_dir):
    """The request log with damage: lines cut in half (value above 40), blank lines after
    errors, and latencies as text."""
    ev = table(spark, sf_dir, "events")
    path = scratch_location(spark, "a3") + "/events_jsonl"
    whole = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("request_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.col("event_type").alias("path"), F.col("value").cast("string").alias("latency_ms"), "props"))
    cut = F.when(F.col("value") > 40, F.expr("left(line, length(line) div 2)")).otherwise(F.col("line"))
    lines = ev.select(whole.alias("line"), "value", "event_type").select(
        F.explode(F.when(F.col("event_type") == "error", F.array(cut, F.lit("  "))).otherwise(F.array(cut))).alias("value"))
    lines.write.text(path)
    rows, counts = A.read_jsonl_tolerant(spark, path, ["request_id", "timestamp", "path",
                                                       "latency_ms", "props"])
    k = F.get_json_object("props", "$.k").try_cast("int")
    missing, none = A.read_jsonl_tolerant(spark, path + "_missing", ["path"])
    return (rows.groupBy("path").agg(F.count(F.lit(1)).alias("events"),
                                     F.sum(F.col("latency_ms").try_cast("double")).alias("latency"),
                                     F.sum(k).alias("instances"))
            .crossJoin(counts.select("lines", F.col("corrupt").alias("corrupt_lines")))
            .crossJoin(none.select(F.col("lines").alias("missing_log_lines"))))


LOG_SCHEMA = "request_id string, timestamp timestamp, path string, latency_ms double"


def a7_log_events(spark, sf_dir):
    """Two appends to the request log, read back by a window of days."""
    ev = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("request_id"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_type").alias("path"), F.col("value").alias("latency_ms"))
    path = scratch_location(spark, "a7") + "/requests"
    early = F.col("timestamp") < F.lit("2024-01-12").cast("timestamp")
    A.append_log(ev.where(early), path)
    A.append_log(ev.where(~early), path)
    log = A.read_log(spark, path, LOG_SCHEMA, since=datetime.date(2024, 1, 10), until=datetime.date(2024, 1, 14))
    return log.groupBy("dt", "path").agg(F.count(F.lit(1)).alias("requests"), F.sum("latency_ms").alias("latency_ms"))


def a6_report_events(spark, sf_dir):
    """Requests by endpoint as a one-row JSON report, written and read back."""
    per = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("path")).agg(
        F.count(F.lit(1)).alias("requests"), F.max("user_id").alias("last_user"))
    path = scratch_location(spark, "a6") + "/report"
    A.write_table(A.report_row(per).select(F.col("report").alias("value")), path, fmt="text")
    report = F.from_json("value", "array<struct<path: string, requests: long, last_user: long>>")
    return spark.read.text(path).select(F.inline(report))


def a8_fingerprint_lineitem(spark, sf_dir):
    return A.fingerprint(lineitem(spark, sf_dir))


def a9_ingest_checks_lineitem(spark, sf_dir):
    """The table with its target, and the same without it."""
    li = lineitem(spark, sf_dir)
    whole = A.ingest_checks(li, None, 11, "l_linestatus")
    return whole.unionByName(A.ingest_checks(li.drop("l_linestatus"), None, 11, "l_linestatus"))


def a10_sample_orders(spark, sf_dir):
    return A.seeded_sample(table(spark, sf_dir, "orders"), 500, ["o_orderkey"], seed=42)


QUERIES = {
    "a1_csv_customer": a1_csv_customer,
    "a2_tolerant_csv_part": a2_tolerant_csv_part,
    "a3_jsonl_events": a3_jsonl_events,
    "a6_report_events": a6_report_events,
    "a7_log_events": a7_log_events,
    "a8_fingerprint_lineitem": a8_fingerprint_lineitem,
    "a9_ingest_checks_lineitem": a9_ingest_checks_lineitem,
    "a10_sample_orders": a10_sample_orders,
}

SQL = {
    "a1_csv_customer": """SELECT c_mktsegment, count(*) AS customers, sum(c_acctbal) AS acctbal,
  count(DISTINCT c_nationkey) AS nations FROM customer GROUP BY c_mktsegment""",
    "a2_tolerant_csv_part": """WITH l AS (SELECT count(*) AS rejected_lines FROM part WHERE p_size > 45 OR p_size <= 2)
SELECT upper(p_brand) AS p_brand, count(*) AS parts, count_if(p_size = 3) AS unreadable_prices,
  round(sum(CASE WHEN p_size <> 3 THEN round(p_retailprice, 2) END), 2) AS retail, sum(CAST(p_size AS DOUBLE)) AS size,
  any_value(rejected_lines) AS rejected_lines, ';' AS separator, 'p_type' AS missing, 'note' AS extra
  FROM part, l WHERE p_size BETWEEN 3 AND 45 GROUP BY upper(p_brand)""",
    "a3_jsonl_events": """WITH c AS (SELECT count(*) AS lines, count_if(value > 40) AS corrupt_lines FROM events)
SELECT event_type AS path, count(*) AS events, sum(value) AS latency,
  sum(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)) AS instances,
  any_value(lines) AS lines, any_value(corrupt_lines) AS corrupt_lines, 0 AS missing_log_lines
  FROM events, c WHERE value IS NULL OR value <= 40 GROUP BY event_type""",
    "a6_report_events": """SELECT event_type AS path, count(*) AS requests, max(user_id) AS last_user FROM events GROUP BY 1""",
    "a7_log_events": """SELECT CAST(ts AS DATE) AS dt, event_type AS path, count(*) AS requests, sum(value) AS latency_ms
  FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-15' GROUP BY ALL""",
    "a8_fingerprint_lineitem": """WITH h AS (SELECT md5(concat_ws(chr(31), """ + ", ".join(
        f"coalesce(CAST({c} AS VARCHAR), chr(0))" for c in (
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate")) + """)) AS h FROM lineitem)
SELECT count(*) AS rows, CAST(sum(CAST('0x' || h[1:16] AS UBIGINT)) AS VARCHAR) AS upper_sum,
  CAST(sum(CAST('0x' || h[17:32] AS UBIGINT)) AS VARCHAR) AS lower_sum FROM h""",
    "a10_sample_orders": """SELECT * FROM orders ORDER BY md5(o_orderkey || '|42'), o_orderkey LIMIT 500""",
    "a9_ingest_checks_lineitem": """WITH t AS (SELECT count(*) AS rows FROM lineitem)
SELECT rows, l_linestatus AS class, count(*) AS class_rows, 11 AS columns, true AS columns_ok,
  'l_linestatus' AS target, true AS target_present FROM lineitem, t GROUP BY ALL
UNION ALL SELECT rows, NULL, NULL, 10, false, 'l_linestatus', false FROM t""",
}
