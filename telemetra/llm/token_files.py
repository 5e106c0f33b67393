"""Token-id output: flat unsigned integer files with 64-bit document offsets.

Documents are range-sorted by id (ties by text hash, so one repeated id is split
too); each task encodes its range and streams two files into the shared folder:

* ``tokens-NNNNN-<attempt>.bin``  all ids, little-endian unsigned 16 bit (32 if the vocabulary
  is larger), no header: fit for ``numpy.memmap``;
* ``docs-NNNNN-<attempt>.idx``    the magic bytes, the id width and the number n of documents
  (three little-endian int64), then n + 1 token offsets within the file, n document
  ids and n flags (1: the id is null), all little-endian int64.

A file has the name of its own attempt; only the attempts that the tasks return, one row
each, are named in ``manifest``, so a task that runs again changes nothing that is read,
and no file is renamed (object stores cannot).  The exclusive prefix sums of the rows are
the partitions' bases, stored there too.

Defined results: a null text is encoded as the empty text (end id only); null ids
sort first; repeated rows are documents of their own; an empty table writes an
empty manifest and reads back as no rows; columns other than id and text are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import default_partitions, file_system, pick, released, shared_folder, ship_file, ship_package, shipped_path
from .tokens import blocks, encoder

MAGIC = int.from_bytes(b"TOKIDX01", "little")
MANIFEST = "part int, name string, n_docs long, n_tokens long, width int, doc_base long, token_base long"
#: Ids that the reader holds at once, unless one document has more.
READ_IDS = 1 << 21


def write_token_files(docs: DataFrame, vocabulary: str, folder: str | None = None, end_id: int | None = 2,
                      id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write ``docs`` in ascending id order; returns the folder's URI."""
    spark = docs.sparkSession
    ship_package(spark)
    name = ship_file(spark, vocabulary)
    folder = folder or shared_folder(spark, "token_files")
    ordered = docs.select(pick(id_col).cast("long").alias("doc_id"), pick(text_col).cast("string").alias("text"))
    ordered = ordered.withColumn("tie", F.xxhash64("text"))
    ordered = (ordered.repartitionByRange(default_partitions(spark), "doc_id", "tie")
               .sortWithinPartitions("doc_id", "tie").drop("tie"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from released(_write_part(batches, shipped_path(name), folder, end_id))

    parts = sorted(tuple(r) for r in ordered.mapInArrow(
        write, "part int, name string, n_docs long, n_tokens long, width int").collect())
    rows, doc_base, token_base = [], 0, 0
    for part, own, n_docs, n_tokens, width in parts:
        rows.append((part, own, n_docs, n_tokens, width, doc_base, token_base))
        doc_base, token_base = doc_base + n_docs, token_base + n_tokens
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(f"{folder}/manifest")
    return folder


def _write_part(batches, vocabulary, folder, end_id):
    fs = path = out = None
    part = TaskContext.get().partitionId()
    enc = encoder(vocabulary)
    end = np.array([] if end_id is None else [end_id], dtype=enc.dtype)
    ids, flags, counts, own_name = [], [], [], f"{part:05d}-{uuid.uuid4().hex}"
    for batch in batches:
        texts = batch.column(1)
        for a, b in blocks(texts):
            tokens, offsets = enc.encode_all(texts.slice(a, b - a))
            if len(end):
                tokens = np.insert(tokens, offsets[1:], end[0])
            if out is None:
                fs, path = file_system(folder)
                fs.create_dir(path, recursive=True)
                out = fs.open_output_stream(f"{path}/tokens-{own_name}.bin")
            out.write(tokens.tobytes())
            counts.append(np.diff(offsets) + len(end))
            own = batch.column(0).slice(a, b - a)
            flags.append(own.is_null().to_numpy(zero_copy_only=False).astype("<i8"))
            ids.append(own.fill_null(0).to_numpy().astype("<i8"))
    if out is None:
        return
    out.close()
    n = np.concatenate(counts)
    offsets = np.concatenate([[0], np.cumsum(n)]).astype("<i8")
    with fs.open_output_stream(f"{path}/docs-{own_name}.idx") as index:
        index.write(np.array([MAGIC, enc.dtype.itemsize, len(n)], "<i8").tobytes())
        for section in (offsets, np.concatenate(ids), np.concatenate(flags)):
            index.write(section.astype("<i8").tobytes())
    yield pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([own_name]), pa.array([len(n)], pa.int64()),
         pa.array([int(offsets[-1])], pa.int64()), pa.array([enc.dtype.itemsize], pa.int32())],
        names=["part", "name", "n_docs", "n_tokens", "width"])


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (binary,
    little-endian unsigned 32 bit) of every document in the files."""
    ship_package(spark)
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    n = max(1, min(manifest.count(), default_partitions(spark)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _read_part(folder, row)

    return manifest.repartition(n).mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def _mapped(fs, path: str, dtype: str) -> np.ndarray:
    """A file as an array: memory-mapped where the folder is mounted."""
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r") if fs.get_file_info(path).size else np.zeros(0, dtype)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=dtype)


def _read_part(folder, row):
    fs, path = file_system(folder)
    index = _mapped(fs, f"{path}/docs-{row['name']}.idx", "<i8")
    magic, width, n = (int(x) for x in index[:3])
    if magic != MAGIC or n != row["n_docs"] or len(index) != 3 + n + 1 + 2 * n:
        raise ValueError(f"docs-{row['name']}.idx is damaged")
    offsets, ids, null = index[3:4 + n], index[4 + n:4 + 2 * n], index[4 + 2 * n:]
    tokens = _mapped(fs, f"{path}/tokens-{row['name']}.bin", f"<u{width}")
    if len(tokens) != offsets[-1]:
        raise ValueError(f"tokens-{row['name']}.bin has {len(tokens)} ids, not {offsets[-1]}")
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + READ_IDS, "right")) - 1)
        own = tokens[offsets[a]:offsets[b]].astype("<u4")
        bounds = ((offsets[a:b + 1] - offsets[a]) * 4).astype(np.int32)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.asarray(ids[a:b]), mask=np.asarray(null[a:b]).astype(bool)),
            pa.array(row["token_base"] + np.asarray(offsets[a:b])),
            pa.array(np.diff(offsets[a:b + 1])),
            pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(own.tobytes())]),
        ], names=["doc_id", "start", "n_tokens", "ids"])
        a = b
