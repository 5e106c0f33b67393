"""Structured Streaming forms of the monitoring operators.

The reference re-reads its whole request log on every run; here the log is a
stream: endpoint metrics by panes under sliding windows (S1), windowed histogram
counts and PSI per closed window (S2), request-id de-duplication within the watermark
(S3), late-event accounting over all batches (S4) and streaming scoring with a
quarantine sink (S5).  Sinks are files with a checkpoint (exactly-once), or folders per
batch id (replayed batches replace themselves); ``run_available_now`` drains a bounded
source with an ``availableNow`` trigger, as tests and backfills do.
"""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from telemetra.functions.exprs import bin_index, present_double
from telemetra.operators import drift
from telemetra.session import checkpoint_dir

#: Relative accuracy of the latency quantiles.
ACCURACY = 0.01


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
                file_glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """File-source stream over ``folder`` (new files are picked up as they
    land); ``file_glob`` narrows it to matching file names."""
    r = spark.readStream.schema(schema).format(fmt)
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(folder)


def quantile_bucket(x: Column, accuracy: float = ACCURACY) -> Column:
    """The bucket of a value, named by its middle: a logarithmic grid whose buckets lie
    within ``accuracy`` of every value in them.  Counts per bucket are a quantile sketch
    that merges by addition.  NULL for a missing value."""
    g = (1 + accuracy) / (1 - accuracy)
    middle = 2 * F.pow(F.lit(g), F.ceil(F.ln(F.abs(x)) / math.log(g))) / (g + 1)
    return F.when(x == 0, F.lit(0.0)).when(x.isNotNull(), F.signum(x) * middle)


def endpoint_panes(stream: DataFrame, ts: str = "timestamp", path: str = "path",
                   status: str = "status_code", latency: str = "latency_ms", pane: str = "1 hour",
                   watermark: str = "10 minutes", accuracy: float = ACCURACY) -> DataFrame:
    """S1, in the stream: per tumbling pane, endpoint and latency bucket the requests,
    errors and latency sum.  An event goes into one pane; append mode emits a pane once
    the watermark passes its end, so the state is bounded by the panes still open."""
    x = present_double(latency)
    return (stream.withWatermark(ts, watermark)
            .groupBy(F.window(ts, pane).alias("w"), F.col(path).alias("path"),
                     quantile_bucket(x, accuracy).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("requests"), F.count_if(present_double(status) >= 400).alias("errors"),
                 F.count(x).alias("measured"), F.sum(x).alias("latency_sum"))
            .select(F.col("w.start").alias("pane_start"), "path", "bucket", "requests", "errors", "measured", "latency_sum"))


def sliding_windows(panes: DataFrame, until: str | None = None, window: str = "24 hours", slide: str = "1 hour",
                    quantile: float = 0.95) -> DataFrame:
    """Sliding windows put together from their closed panes: requests, errors, mean
    latency, and the latency quantile from the merged bucket counts (within the buckets'
    accuracy of the value at rank ``quantile * (n - 1)``).  Only windows that end by
    ``until`` (the stream's watermark), when all their panes are closed."""
    keys = ["window_start", "window_end", "path"]
    merged = (panes.groupBy(F.window("pane_start", window, slide).alias("w"), "path", "bucket")
              .agg(*[F.sum(c).alias(c) for c in ("requests", "errors", "measured", "latency_sum")])
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "path", "bucket",
                      "requests", "errors", "measured", "latency_sum"))
    if until is not None:
        merged = merged.where(F.col("window_end") <= F.lit(until).cast("timestamp"))
    own = Window.partitionBy(*keys)
    ranked = merged.withColumns({"_upto": F.sum("measured").over(own.orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)), "_n": F.sum("measured").over(own)})
    reached = (F.col("measured") > 0) & (F.col("_upto") > F.lit(quantile) * (F.col("_n") - 1))
    return ranked.groupBy(*keys).agg(
        F.sum("requests").alias("requests"), F.sum("errors").alias("errors"),
        F.try_divide(F.sum("latency_sum"), F.sum("measured")).alias("latency_mean_ms"),
        F.min(F.when(reached, F.col("bucket"))).alias("latency_p95_ms"))


def column_bin_counts(stream: DataFrame, profile: DataFrame, columns: Sequence[str], ts: str,
                      window: str = "1 hour", watermark: str = "10 minutes") -> DataFrame:
    """Counts per (tumbling window, column, reference bin).  NULL and NaN are in no
    bin.  The profile (one row per column) is a small broadcast."""
    edges = profile.select("column_name", "bin_edges")
    long = (stream.withWatermark(ts, watermark).select(ts, *[present_double(c).alias(c) for c in columns])
            .unpivot([ts], list(columns), "column_name", "x").where(F.col("x").isNotNull()))
    return (long.join(F.broadcast(edges), "column_name").withColumn("bin", bin_index("bin_edges", "x"))
            .groupBy(F.window(ts, window).alias("w"), "column_name", "bin").agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), "column_name", "bin", "n"))


PSI_SCHEMA = "window_start timestamp, column_name string, psi double, current_count long"


class WindowPsi:
    """A ``foreachBatch`` sink of closed windows' bin counts.  Each micro-batch
    writes its counts and the windows' PSI under its batch id, replacing what an earlier
    try of the same batch left, so a replay changes nothing."""

    def __init__(self, profile: DataFrame, folder: str):
        self.bins = profile.select("column_name", F.posexplode("bin_proportions").alias("bin", "proportion"))
        self.folder = folder.rstrip("/")

    def __call__(self, counts: DataFrame, batch_id: int) -> None:
        spark = counts.sparkSession
        kept = f"{self.folder}/counts/batch={batch_id}"
        counts.write.mode("overwrite").parquet(kept)          # the batch is computed once
        closed = spark.read.schema(counts.schema).parquet(kept)
        keys = ["window_start", "column_name"]
        grid = (closed.select(*keys).distinct().join(F.broadcast(self.bins), "column_name")
                .join(closed, [*keys, "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0))))
        drift._psi_from_counts(grid, keys).write.mode("overwrite").parquet(f"{self.folder}/psi/batch={batch_id}")

    def result(self, spark: SparkSession) -> DataFrame:
        """All windows closed so far."""
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/psi")
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return spark.createDataFrame([], PSI_SCHEMA)
        return spark.read.schema(PSI_SCHEMA).parquet(f"{self.folder}/psi").drop("batch")


class SplitSink:
    """A ``foreachBatch`` sink that deals a stream to several outputs: each batch is
    computed once and written under its id, then every output takes its rows from it and
    writes them under the same id, so a replay replaces its own folders."""

    def __init__(self, folder: str, outputs: dict):
        self.folder, self.outputs = folder.rstrip("/"), outputs

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = f"{self.folder}/batches/batch={batch_id}"
        batch.write.mode("overwrite").parquet(kept)
        whole = spark.read.schema(batch.schema).parquet(kept)
        for name, take in self.outputs.items():
            take(whole).write.mode("overwrite").parquet(f"{self.folder}/{name}/batch={batch_id}")

    def result(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/{name}").drop("batch")


def run_batches(df: DataFrame, name: str, sink, output_mode: str = "append") -> None:
    """Drain the stream through a ``foreachBatch`` sink with a checkpoint."""
    loc = scratch_location(df.sparkSession, name)
    q = (df.writeStream.foreachBatch(sink).outputMode(output_mode)
         .option("checkpointLocation", f"{loc}/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()


def windowed_bin_counts(stream: DataFrame, profile: DataFrame, column: str, ts: str,
                        window: str = "1 hour", watermark: str = "10 minutes") -> DataFrame:
    """Counts per (tumbling window, reference bin) of one numeric column;
    PSI of a closed window is then ``drift._psi_from_counts`` on these counts
    (e.g. in ``foreachBatch``).  NULL and NaN are in no bin.  The profile row is a small broadcast."""
    edges = profile.where(F.col("column_name") == column).select("bin_edges")
    x = present_double(column)
    return (stream.where(x.isNotNull()).withWatermark(ts, watermark).crossJoin(F.broadcast(edges))
            .withColumn("bin", bin_index("bin_edges", x))
            .groupBy(F.window(ts, window).alias("w"), "bin")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), "bin", "n"))


def dedup_requests(stream: DataFrame, keys: list[str], ts: str = "timestamp",
                   watermark: str = "1 hour") -> DataFrame:
    """S3: drop retried deliveries of the same request within the watermark."""
    return stream.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(keys)


def scratch_location(spark: SparkSession, name: str) -> str:
    """A fresh folder (URI) under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:12]}"


class ProgressAudit(StreamingQueryListener):
    """Every progress report of the queries that run while it listens, not only the
    last: input rows, watermark and the rows that state operators dropped as late.  A
    batch reported again (after a restart) replaces its earlier report."""

    def __init__(self):
        self.reports: dict[tuple[str, int], tuple[int, int, str | None]] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        late = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        self.reports[str(p.id), p.batchId] = (p.numInputRows, late, (p.eventTime or {}).get("watermark"))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.add(str(event.runId))

    def wait(self, query, seconds: float = 60.0) -> None:
        """Until the listener bus has delivered the end of ``query`` (reports come
        first)."""
        stop = time.monotonic() + seconds
        while str(query.runId) not in self.ended:
            if time.monotonic() > stop:
                raise TimeoutError(f"no end of query {query.runId} reported")
            time.sleep(0.05)

    def table(self, spark: SparkSession) -> DataFrame:
        """(query_id, batch_id, input_rows, late_rows, watermark), one row per batch."""
        return spark.createDataFrame(
            [(q, b, *r) for (q, b), r in sorted(self.reports.items())],
            "query_id string, batch_id long, input_rows long, late_rows long, watermark string")


def run_available_now(df: DataFrame, name: str, output_mode: str = "append",
                      partition_by: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Drain the stream into a parquet sink with a checkpoint and return the sink as a
    batch DataFrame plus the audit table of all its batches."""
    spark = df.sparkSession
    loc = scratch_location(spark, name)
    w = (df.writeStream.format("parquet").outputMode(output_mode)
         .option("checkpointLocation", f"{loc}/_checkpoint")
         .option("path", f"{loc}/data").trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    audit = ProgressAudit()
    spark.streams.addListener(audit)
    try:
        q = w.start()
        q.awaitTermination()
        audit.wait(q)
    finally:
        spark.streams.removeListener(audit)
    return spark.read.schema(df.schema).parquet(f"{loc}/data"), audit.table(spark)


def late_rows(audit: DataFrame) -> DataFrame:
    """Per batch with input its rows and those that came behind the watermark."""
    return audit.where("input_rows > 0").select("batch_id", "input_rows", "late_rows")


def last_watermark(audit: DataFrame) -> str | None:
    """The watermark that the stream had reached at its end."""
    return audit.agg(F.max("watermark")).first()[0]


def arrival_files(df: DataFrame, slice_col: str, folder: str) -> str:
    """``df`` written as one set of files per value of ``slice_col``, in rising order, so
    that a file stream of it delivers the slices one after the other.  ``folder/slice-N``
    each; the slices are a bounded list of batches."""
    spark = df.sparkSession
    slices = sorted(r[0] for r in df.select(slice_col).distinct().collect())
    path = spark._jvm.org.apache.hadoop.fs.Path
    target = path(folder)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    for n, s in enumerate(slices):
        part = f"{folder}/_slice-{n:05d}"
        df.where(F.col(slice_col) == s).drop(slice_col).coalesce(1).write.parquet(part)
        file = next(f.getPath() for f in fs.listStatus(path(part)) if f.getPath().getName().startswith("part-"))
        fs.rename(file, path(f"{folder}/slice-{n:05d}.parquet"))
    return folder


def split_contract(stream: DataFrame, violations: str = "violations") -> tuple[DataFrame, DataFrame]:
    """Valid rows go on to scoring, the rest to a quarantine sink."""
    return (stream.where(F.size(violations) == 0).drop(violations),
            stream.where(F.size(violations) > 0))
