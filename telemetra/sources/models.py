"""Fitted parameters as versioned tables.

A model is a set of named parameter tables (scaler, categories, ECDF, forest, weights,
thresholds) under ``folder/<model id>/<attempt>/<table>``.  A version is published by
creating the one small file ``folder/<model id>/_versions/<number>`` that names the
attempt, which a file system does for one writer only: a reader sees whole versions, two
fits at a time get two numbers, and a fit that dies leaves no version.  Scoring reads a
version back and fits nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from telemetra.session import checkpoint_dir


def model_folder(spark: SparkSession) -> str:
    """The models' folder under the shared folder of the cluster."""
    return f"{checkpoint_dir(spark).rstrip('/')}/models"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, model_id: str, folder: str | None = None) -> list[int]:
    """Published versions, oldest first."""
    fs, path = _fs(spark, f"{folder or model_folder(spark)}/{model_id}/_versions")
    if not fs.exists(path):
        return []
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(path) if f.getPath().getName().isdigit())


def save_model(spark: SparkSession, model_id: str, tables: dict[str, DataFrame], folder: str | None = None) -> int:
    """Write the tables and publish them as the next version; returns its number."""
    root = f"{folder or model_folder(spark)}/{model_id}"
    attempt = uuid.uuid4().hex
    for name, df in tables.items():
        df.write.parquet(f"{root}/{attempt}/{name}")
    names = "\n".join([attempt, *sorted(tables)])
    number = max(versions(spark, model_id, folder), default=0) + 1
    while True:
        fs, path = _fs(spark, f"{root}/_versions/{number:08d}")
        try:
            out = fs.create(path, False)
        except Exception as taken:                     # another fit has published this number
            if not fs.exists(path):
                raise taken
            number += 1
            continue
        out.write(bytearray(names.encode()))
        out.close()
        return number


def load_model(spark: SparkSession, model_id: str, version: int | None = None, folder: str | None = None) -> dict[str, DataFrame]:
    """The tables of a version (the newest by default); KeyError where there is none."""
    root = f"{folder or model_folder(spark)}/{model_id}"
    known = versions(spark, model_id, folder)
    if not known or (version is not None and version not in known):
        raise KeyError(f"no version {version or ''} of model {model_id!r}")
    marker = f"{root}/_versions/{(version or known[-1]):08d}"
    attempt, *names = spark.read.text(marker, wholetext=True).first()[0].split("\n")
    return {name: spark.read.parquet(f"{root}/{attempt}/{name}") for name in names}
