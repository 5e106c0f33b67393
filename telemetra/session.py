"""Spark session helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "telemetra") -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    On a cluster the master, memory and checkpoint folder come from the
    submitting environment; here we only fill in what is unset.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` (a core setting, fixed at launch); only
    when it is unset (local tests) a scratch folder is registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="telemetra-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a parquet table in a fresh folder under the shared
    checkpoint folder and read it back: the plan below is computed once (an
    eager ``Dataset.checkpoint`` computes it twice, once to count and once to
    write), later stages read compact columnar files, and a lost executor costs
    a re-read instead of a recomputation of the whole lineage.  Never a local
    checkpoint.  Used where a derived table is read more than once.  The shuffle files
    of the plan below go once it is written, not whenever the driver collects garbage."""
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/tables/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(path)
    out = spark.read.parquet(path)
    out.table_path = path
    return out


#: Shuffle files of a query are removed when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders that :func:`cut_lineage` has written, by application.
_TABLES: dict[str, list[str]] = {}


def release_tables(spark: SparkSession) -> int:
    """Delete the tables that :func:`cut_lineage` has written so far in this application:
    for a job to call once its results are written, when nothing will be read from a
    frame made before.  Returns how many."""
    paths = _TABLES.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return len(paths)


def release(*frames: DataFrame) -> None:
    """Delete the tables of frames that :func:`cut_lineage` returned, once all that reads
    them is written; other frames (those of no rows) have none."""
    for df in frames:
        if not hasattr(df, "table_path"):
            continue
        p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.table_path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def scratch_dir(prefix: str = "telemetra-") -> str:
    return tempfile.mkdtemp(prefix=prefix, dir=os.environ.get("TMPDIR", "/tmp"))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers, once per
    application: the Python kernels (tree growth, kNN blocks) are pickled by
    reference to their module.  The package is zipped on the driver and handed
    to ``addPyFile``, which distributes it to every executor (the usual way to
    ship job code; executors never read the driver's folder themselves)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(scratch_dir("telemetra-pyfiles-"), "telemetra.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, dirs, files in os.walk(root):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
