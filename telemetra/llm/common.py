"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, cut_lineage, ship_package

__all__ = ["bit_mask_table", "checkpoint_dir", "cut_lineage", "default_partitions", "discard", "file_system", "has_bit",
           "pick", "released", "safe_name", "shared_folder", "ship_file", "ship_package", "shipped_path",
           "staged", "with_outputs"]


def safe_name(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores added until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def pick(name: str) -> Column:
    """A column by its literal name (dots and backticks in it are not syntax)."""
    return F.col("`" + name.replace("`", "``") + "`")


def with_outputs(df: DataFrame, outputs: dict[str, str], keep: list[str]) -> DataFrame:
    """``keep`` columns plus ``outputs`` (final name -> working name); an input
    column that has the name of an output is replaced by it."""
    names = {n.lower() for n in outputs}
    return df.select(*[pick(c) for c in keep if c.lower() not in names],
                     *[pick(work).alias(name) for name, work in outputs.items()])


def default_partitions(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")),
               spark.sparkContext.defaultParallelism)


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A fresh folder (URI) under the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"


#: Hadoop's names of stores that Arrow knows by another (fixed values).
STORE_NAMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss", "wasb": "abfs", "gcs": "gs"}


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of a URI as Hadoop writes it, and the path in it: local and
    mounted folders, HDFS and viewfs (where libhdfs is installed), S3, Google Cloud
    Storage and Azure.  Files are written under names of their own attempt and named in a
    manifest, so nothing needs to be renamed, which object stores cannot do."""
    scheme, colon, rest = uri.partition(":")
    if not colon or len(scheme) == 1:
        return pafs.FileSystem.from_uri(uri)
    rest = "//" + rest if rest.startswith("/") and not rest.startswith("//") else rest      # file:/folder
    return pafs.FileSystem.from_uri(f"{STORE_NAMES.get(scheme.lower(), scheme)}:{rest}")


def bit_mask_table(hashes: DataFrame, name: str, bits: int) -> DataFrame:
    """A set of 64-bit hashes as a bit mask of the fixed size ``2 ** bits``:
    rows (word, mask), ``2 ** bits / 64`` of them at most whatever the input, so
    that it may be broadcast.  Tests have false positives, never false negatives."""
    pos = f"pmod(`{name}`, {1 << bits}L)"
    return (hashes.select(F.expr(f"shiftright({pos}, 6)").alias("word"),
                          F.expr(f"shiftleft(1L, cast({pos} & 63 AS INT))").alias("bit"))
            .groupBy("word").agg(F.bit_or("bit").alias("mask")))


def has_bit(df: DataFrame, name: str, masks: DataFrame, bits: int, out: str) -> DataFrame:
    """``df`` with boolean ``out``: hash column ``name`` may be in the set ``masks``."""
    pos = f"pmod(`{name}`, {1 << bits}L)"
    word, mask = out + "_word", out + "_mask"
    masks = masks.select(F.col("word").alias(word), F.col("mask").alias(mask))
    hit = df.join(F.broadcast(masks), F.expr(f"shiftright({pos}, 6)") == F.col(word), "left")
    test = F.expr(f"coalesce(getbit(`{mask}`, cast({pos} & 63 AS INT)) = 1, false)")
    return hit.withColumn(out, test).drop(word, mask)


def staged(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read back; ``discard``
    deletes it once everything made from it is written too."""
    path = shared_folder(df.sparkSession, "staged")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def discard(df: DataFrame) -> None:
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def released(batches):
    """Pass a task's output on; when it ends, hand free memory back to the system,
    for the worker process goes on to other tasks."""
    try:
        yield from batches
    finally:
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):       # another C library
            pass


_SENT: set[tuple[str, str]] = set()


def ship_file(spark: SparkSession, path: str) -> str:
    """Send one driver-side file (a vocabulary) to every executor, once per
    application; returns the name for :func:`shipped_path`."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _SENT:
        spark.sparkContext.addFile(path)
        _SENT.add(key)
    return path.rstrip("/").rsplit("/", 1)[-1]


def shipped_path(name: str) -> str:
    return SparkFiles.get(name)
