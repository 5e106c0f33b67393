"""File sources and sinks A1-A10: typed and tolerant CSV, tolerant JSON
Lines, order-independent table fingerprint, seeded sample, ingest checks,
report / log sinks."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetra.session import cut_lineage


# ------------------------------------------------------------------ A1 ----
def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Typed scan with an explicit schema (no inference pass); malformed
    cells become NULL (PERMISSIVE)."""
    return (spark.read.schema(schema).option("header", True).option("sep", sep)
            .option("mode", "PERMISSIVE").csv(path))


# ------------------------------------------------------------------ A2 ----
def detect_separator(spark: SparkSession, path: str) -> str:
    """';' or ',' by counting both in the header line (first line only)."""
    first = spark.read.text(path).limit(1).collect()
    head = first[0][0] if first else ""
    return ";" if head.count(";") > head.count(",") else ","


def read_csv_tolerant(spark: SparkSession, path: str, expected: Sequence[str],
                      numeric: Sequence[str] = (), upper: Sequence[str] = ()) -> tuple[DataFrame, dict]:
    """Tolerant ingest: separator detection, BOM strip, quoted fields with
    doubled quotes, trimmed cells, blank rows skipped, decimal comma, upper-cased
    categories; header checks (empty, duplicate, missing, extra) are returned
    as a report.  Numbers are ``try_cast`` so bad cells become NULL instead of
    failing the job.  Lines with more or fewer cells than the header are no rows:
    they are in the report as the table ``rejects`` (line).  A repeated or empty
    header gets its position as a suffix or as its name."""
    sep = detect_separator(spark, path)
    first = spark.read.text(path).limit(1).collect()
    head = first[0][0].lstrip("\ufeff") if first else ""
    names = [c.strip() for c in next(csv.reader([head], delimiter=sep, skipinitialspace=True), [])]
    columns = [n if n and names.count(n) == 1 else f"{n or '_c'}{i}" for i, n in enumerate(names)]
    bad = "_corrupt_record"
    while bad in columns:
        bad = "_" + bad
    schema = T.StructType([T.StructField(f"{i}", T.StringType()) for i in range(len(columns))]
                          + [T.StructField(bad, T.StringType())])
    raw = (spark.read.schema(schema).option("header", True).option("sep", sep).option("quote", '"')
           .option("escape", '"').option("ignoreLeadingWhiteSpace", True)
           .option("ignoreTrailingWhiteSpace", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", bad).csv(path))
    # parsed once: rows and rejects read it, and column pruning would hide ragged lines
    raw = cut_lineage(raw) if columns else spark.createDataFrame([], schema)
    report = {
        "separator": sep,
        "empty_header": any(n == "" for n in names),
        "duplicate_header": sorted({n for n in names if names.count(n) > 1}),
        "missing": sorted(set(expected) - set(names)),
        "extra": sorted(set(names) - set(expected)),
        "rejects": raw.where(F.col(bad).isNotNull()).select(F.col(bad).alias("line")),
    }
    df = raw.where(F.col(bad).isNull()).drop(bad).toDF(*columns)
    nonblank = F.lit(False)
    for c in columns:
        nonblank = nonblank | (F.coalesce(F.trim(F.col(f"`{c}`")), F.lit("")) != "")
    df = df.where(nonblank)
    for c in numeric:
        if c in columns:
            df = df.withColumn(c, F.expr(f"try_cast(regexp_replace(trim(`{c}`), ',', '.') AS DOUBLE)"))
    for c in upper:
        if c in columns:
            df = df.withColumn(c, F.upper(F.trim(F.col(f"`{c}`"))))
    return df, report


# ------------------------------------------------------------------ A3 ----
def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, in any file system that Spark reads, exists."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_jsonl_tolerant(spark: SparkSession, path: str, fields: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """JSON Lines with every field read as text (a type mismatch must not turn
    a row corrupt); lines that are no JSON object are dropped and counted, blank lines
    are no lines, a path that does not exist is an empty log.  Returns (rows, counts).
    Rows and counts each read the text once; nothing is written."""
    if not path_exists(spark, path):
        lines = spark.createDataFrame([], "value string")
    else:
        lines = spark.read.text(path)
    parsed = F.from_json("value", T.MapType(T.StringType(), T.StringType()), {"mode": "PERMISSIVE"})
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields] + [T.StructField("_bad", T.StringType())])
    row = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    given = lines.where(F.trim("value") != "")
    object_ = F.trim("value").startswith("{") & parsed.isNotNull()
    counts = given.agg(F.count(F.lit(1)).alias("lines"),
                       F.count_if(F.coalesce(~object_ | row["_bad"].isNotNull(), F.lit(True))).alias("corrupt"))
    rows = given.where(object_).select(row.alias("_r")).where("_r._bad IS NULL").select(*[F.col(f"_r.`{f}`").alias(f) for f in fields])
    return rows, counts


# ------------------------------------------------------------------ A8 ----
def _row_text(columns: Sequence[str]):
    """The cells of a row as one text; NULL is told from every text."""
    return F.concat_ws("\u001f", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in columns])


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Order-independent table fingerprint in one pass: row count and the sums of the
    upper and lower 64 bits of the rows' MD5 (partition-parallel; a byte hash of a
    multi-file table would depend on file layout).  Any engine can compute it."""
    h = df.select(F.md5(_row_text(list(columns or df.columns))).alias("h"))
    half = lambda start: F.conv(F.substring("h", start, 16), 16, 10).cast("decimal(38,0)")
    return h.agg(F.count(F.lit(1)).alias("rows"), F.sum(half(1)).cast("string").alias("upper_sum"),
                 F.sum(half(17)).cast("string").alias("lower_sum"))


# ------------------------------------------------------------------ A10 ---
def seeded_sample(df: DataFrame, n: int, id_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """Fixed-size sample without replacement, repeatable under repartitioning and by any
    engine: the n rows with the smallest MD5 of ids and seed (TakeOrdered: top-n per
    partition, no full sort)."""
    h = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in id_cols], F.lit(str(seed))))
    return df.orderBy(h, *id_cols).limit(n)


# ------------------------------------------------------------------ A9 ----
def ingest_checks(df: DataFrame, expected_rows: int | None, expected_cols: int | None,
                  target: str) -> DataFrame:
    """Shape and class-count assertions as a table (one row per class).  Without the
    target column, one row that says so: no class, ``target_present`` false."""
    total = df.agg(F.count(F.lit(1)).alias("rows"))
    if target in df.columns:
        classes = df.groupBy(F.col(f"`{target}`").cast("string").alias("class")).agg(F.count(F.lit(1)).alias("class_rows"))
        out = total.join(classes, how="left")               # one row by one row per class
    else:
        out = total.withColumns({"class": F.lit(None).cast("string"), "class_rows": F.lit(None).cast("long")})
    out = out.withColumn("columns", F.lit(len(df.columns)))
    if expected_rows is not None:
        out = out.withColumn("rows_ok", F.col("rows") == expected_rows)
    if expected_cols is not None:
        out = out.withColumn("columns_ok", F.col("columns") == expected_cols)
    return out.withColumns({"target": F.lit(target), "target_present": F.lit(target in df.columns)})


# ------------------------------------------------------------------ A5-A7 -
def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    """Result sink (scores, thresholds, leaderboards, batches)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def append_log(df: DataFrame, path: str, partition_by: Sequence[str] = ("dt",)) -> None:
    """Append-only event log (request / prediction events) as JSON Lines,
    partitioned by day so a trailing window prunes partitions."""
    out = df
    if "dt" in partition_by and "dt" not in df.columns and "timestamp" in df.columns:
        out = df.withColumn("dt", F.to_date("timestamp"))
    out.write.mode("append").partitionBy(*partition_by).json(path)


def read_log(spark: SparkSession, path: str, schema: str, since=None, until=None) -> DataFrame:
    """A log that :func:`append_log` wrote: rows of the days [since, until] (dates), whose
    folders alone are read; a path that does not exist is an empty log."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"{schema}, dt date")
    log = spark.read.schema(f"{schema}, dt date").json(path)
    for bound, test in ((since, F.col("dt") >= F.lit(since)), (until, F.col("dt") <= F.lit(until))):
        log = log.where(test) if bound is not None else log
    return log


def report_row(df: DataFrame) -> DataFrame:
    """A one-row JSON report of a small result table (rule results, alerts:
    bounded by the number of rules / metrics, never by the data)."""
    return df.agg(F.to_json(F.array_sort(F.collect_list(F.struct(*df.columns)))).alias("report"))
