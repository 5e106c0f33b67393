"""WARC archives in Zstandard with a dictionary, written and read back.

File layout: a leading skippable frame (magic 0x184D2A5D) holds the dictionary,
itself one Zstandard frame; then every record is one frame compressed with it.  The
dictionary is trained on a bounded sample of pages (``SAMPLE_PAGES`` expected, each
of ``SAMPLE_BYTES`` at most; nothing else is sampled).

Records with equal payloads of at least ``REVISIT_BYTES`` are one response (the
largest page id) and revisits that refer to it.  The reader walks a file frame by
frame, checks version line, required headers, lengths and digests, and raises
``ValueError`` with the file and record number on any damage.

Defined results: a null html is the empty payload; a null url has no
WARC-Target-URI; control characters and blanks in a url are percent-encoded; equal
payloads whose page ids are all null are all responses; rows that repeat the
largest id are all responses; an empty table writes no file and reads as no rows.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (bit_mask_table, cut_lineage, default_partitions, file_system, has_bit, pick, shared_folder,
                     ship_package)

REVISIT_BYTES = 1000
#: Bits of the mask of digests that repeat.
MASK_BITS = 24
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 65_536, 65_536
#: Fixed values of the formats.
SKIPPABLE_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-record-id", "warc-date", "warc-type", "content-length")
RECORDS = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
           "payload_digest string, payload binary")


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """page_id, url, payload, digest, n, refers_to (null: a response)."""
    rows = pages.select(
        pick(id_col).cast("long").alias("page_id"), pick(url_col).cast("string").alias("url"),
        F.coalesce(pick(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "n": F.length("payload").cast("long")})
    groups = cut_lineage(rows.where(F.col("n") >= REVISIT_BYTES).groupBy(F.col("digest").alias("g"))
                         .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("k"))
                         .where("k > 1 AND first IS NOT NULL").drop("k"))
    # only rows whose digest may repeat are looked up, so no other payload is shuffled
    masks = bit_mask_table(groups.select(F.xxhash64("g").alias("h")), "h", MASK_BITS)
    marked = has_bit(rows.withColumn("h", F.xxhash64("digest")), "h", masks, MASK_BITS, "may")
    asked = marked.where("may").join(groups, F.col("digest") == F.col("g"), "left")
    alone = marked.where("NOT may").withColumn("refers_to", F.lit(None).cast("long"))
    out = ["page_id", "url", "payload", "digest", "n", "refers_to"]
    return alone.select(out).unionByName(asked.withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))).select(out))


def train_dictionary(pages: DataFrame, html_col: str = "html") -> bytes:
    """A Zstandard dictionary from a bounded sample (raw content if too few pages)."""
    html = pick(html_col).cast("string")
    small = pages.where(F.octet_length(html).between(1, SAMPLE_BYTES)).select(html.alias("html"))
    n = small.count()
    if n > SAMPLE_PAGES:
        rate = int(SAMPLE_PAGES / n * (1 << 40))
        small = small.where(F.pmod(F.xxhash64("html"), F.lit(1 << 40)) < rate)
    samples = [r["html"].encode() for r in small.limit(2 * SAMPLE_PAGES).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES] or b"<html></html>"


def write_warc(pages: DataFrame, folder: str | None = None, date: str = "2024-01-01T00:00:00Z", **columns) -> str:
    """One archive per task under ``folder`` (a URI); returns it."""
    spark = pages.sparkSession
    ship_package(spark)
    folder = folder or shared_folder(spark, "warc")
    dictionary = train_dictionary(pages, columns.get("html_col", "html"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _write_part(batches, folder, dictionary, date)

    rows = sorted(tuple(r) for r in plan_records(pages, **columns).mapInArrow(
        write, "file string, n long").collect())
    spark.createDataFrame(rows, "file string, n long").coalesce(1).write.parquet(f"{folder}/manifest")
    return folder


def _url(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f-\x9f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def record_bytes(name: str, kind: str, date: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Record-ID", f"<{name}>"), ("WARC-Date", date), ("WARC-Type", kind), *headers,
            ("WARC-Block-Digest", "sha1:" + hashlib.sha1(block).hexdigest()), ("Content-Length", str(len(block)))]
    lines = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in head)
    return lines + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id, url, payload: bytes, digest: str, n: int, refers_to, date: str, fallback: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    headers = [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", "sha1:" + digest)]
    if url is not None:
        headers.append(("WARC-Target-URI", _url(url)))
    name = fallback if page_id is None else f"urn:page:{page_id}"
    if refers_to is None:
        return record_bytes(name, "response", date, headers, http + payload)
    headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    return record_bytes(name, "revisit", date, headers, http)


def dictionary_frame(dictionary: bytes) -> bytes:
    content = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(content)) + content


def _write_part(batches, folder, dictionary, date):
    part, out, n = TaskContext.get().partitionId(), None, 0
    name = f"part-{part:05d}-{uuid.uuid4().hex}.warc.zst"       # of this attempt; the manifest names those that count
    packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary),
                                      write_content_size=True)
    for batch in batches:
        for row in batch.to_pylist():
            if out is None:
                fs, path = file_system(folder)
                fs.create_dir(path, recursive=True)
                out = fs.open_output_stream(f"{path}/{name}", compression=None)
                out.write(dictionary_frame(dictionary))
                info = record_bytes(f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{folder}/{part}')}", "warcinfo",
                                    date, [("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                out.write(packer.compress(info))
            out.write(packer.compress(page_record(
                row["page_id"], row["url"], row["payload"], row["digest"], row["n"], row["refers_to"], date,
                f"urn:page:none-{part}-{n}")))
            n += 1
    if out is not None:
        out.close()
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n])], names=["file", "n"])


def frames(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The content of each frame after the dictionary's; one in memory at a time."""
    head = stream.read(8)
    magic, size = struct.unpack("<II", head) if len(head) == 8 else (0, 0)
    if magic != SKIPPABLE_MAGIC:
        raise ValueError("the file does not begin with a dictionary frame")
    content = stream.read(size)
    if len(content) != size:
        raise ValueError("the dictionary frame is cut off")
    if content[:4] == struct.pack("<I", FRAME_MAGIC):
        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
    data = b""
    while data or (data := stream.read(chunk)):
        frame, parts = unpacker.decompressobj(), []
        while True:
            parts.append(frame.decompress(data))
            if frame.eof:
                data = frame.unused_data
                break
            data = stream.read(chunk)
            if not data:
                raise ValueError("the last frame is cut off")
        yield b"".join(parts)


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one record, checked."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] not in (VERSION, b"WARC/1.0"):
        raise ValueError("no WARC version line")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon or not name.strip():
            raise ValueError(f"bad header line {line[:60]!r}")
        headers[name.strip().lower()] = value.strip()
    missing = [h for h in REQUIRED if h not in headers]
    if missing:
        raise ValueError(f"headers missing: {', '.join(missing)}")
    if not headers["content-length"].isdecimal():
        raise ValueError("Content-Length is not a number")
    n = int(headers["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"the block has {len(rest) - 4} bytes, Content-Length is {n}")
    block = rest[:n]
    digest = headers.get("warc-block-digest")
    if digest and digest != "sha1:" + hashlib.sha1(block).hexdigest():
        raise ValueError("block digest differs")
    return headers, block


_PAGE = re.compile(r"<urn:page:(-?\d+)>")


def page_of(headers: dict[str, str], block: bytes) -> dict | None:
    """The page that a response or revisit record holds, checked; None for others."""
    kind = headers["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    http, gap, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?mi)^content-length: *(\d+)\r?$", http)
    if not gap or not length:
        raise ValueError("no HTTP header")
    digest, n = headers.get("warc-payload-digest", "").removeprefix("sha1:"), int(length[1])
    refers = _PAGE.fullmatch(headers.get("warc-refers-to", ""))
    if kind == "response" and (len(payload) != n or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("payload length or digest differs")
    if kind == "revisit" and (payload or not refers or headers.get("warc-profile") != PROFILE):
        raise ValueError("bad revisit record")
    own = _PAGE.fullmatch(headers["warc-record-id"])
    return {"page_id": int(own[1]) if own else None, "url": headers.get("warc-target-uri"), "record_type": kind,
            "refers_to": int(refers[1]) if refers else None, "payload_bytes": n, "payload_digest": digest,
            "payload": payload if kind == "response" else None}


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The pages (``RECORDS``) of all archives in ``folder``'s manifest."""
    ship_package(spark)
    manifest = spark.read.schema("file string, n long").parquet(f"{folder}/manifest")
    tasks = max(1, min(manifest.count(), default_partitions(spark)))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows, size, total = [], 0, 0
                fs, path = file_system(folder)
                with fs.open_input_stream(f"{path}/{row['file']}", compression=None) as stream:
                    for k, raw in enumerate(frames(stream)):
                        try:
                            page = page_of(*parse_record(raw))
                        except ValueError as e:
                            raise ValueError(f"{row['file']}, record {k}: {e}") from e
                        if page:
                            rows.append(page)
                            size += len(raw)
                            total += 1
                        if size > 1 << 23:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                if total != row["n"]:
                    raise ValueError(f"{row['file']}: {total} records, {row['n']} were written")

    return manifest.repartition(tasks).mapInArrow(read, RECORDS)
