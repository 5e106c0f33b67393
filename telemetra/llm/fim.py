"""Fill-in-middle transformation with a piece table.

A document is never edited: it is a list of descriptors (buffer, start, length) over two
immutable buffers, its UTF-8 text and the sentinels.  :func:`cut` splits descriptors,
:func:`arrange` permutes the three cuts and puts sentinels between them, :func:`restore`
finds the cuts in an output and permutes them back, and :func:`digest` streams the
described bytes through SHA-256 without putting them together.

The units are lines (``[^\\n]*\\n|[^\\n]+``).  Where a document is cut, and its form,
follow from SHA-256 of ``seed:id``, so a repeated row or a task that runs again gives the
same output.

Defined results: a null text counts as empty; an empty text, and one that holds a
sentinel's string, stays ``plain``; a null id hashes as the empty string; repeated rows
are transformed alike, each by itself; an empty table gives an empty result; columns
other than id and text are ignored.  Texts are handled one after the other, so memory
is a batch and the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pick, released, ship_package

TEXT, MARKS = 0, 1
#: (buffer, start, length) in bytes.
Piece = tuple[int, int, int]
PIECES = "array<struct<buffer: int, start: long, length: long>>"
#: Bytes of text whose outputs are held at once, unless one text has more.
BLOCK_BYTES = 1 << 21


@dataclass(frozen=True)
class Marks:
    """The sentinels; their strings may not overlap one another."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    @property
    def buffer(self) -> bytes:
        return "".join((self.prefix, self.suffix, self.middle)).encode()

    def piece(self, name: str) -> Piece:
        start = 0
        for own in ("prefix", "suffix", "middle"):
            size = len(getattr(self, own).encode())
            if own == name:
                return MARKS, start, size
            start += size
        raise ValueError(f"no sentinel {name!r}")


def cut(pieces: list[Piece], at: int) -> tuple[list[Piece], list[Piece]]:
    """The pieces before and after byte ``at`` of what they describe."""
    left: list[Piece] = []
    for i, (buffer, start, length) in enumerate(pieces):
        if at < length:
            head = [(buffer, start, at)] if at else []
            return left + head, [(buffer, start + at, length - at), *pieces[i + 1:]]
        left.append((buffer, start, length))
        at -= length
    return left, []


def arrange(prefix: list[Piece], middle: list[Piece], suffix: list[Piece], form: str, marks: Marks) -> list[Piece]:
    """The cuts in the order of ``form`` (psm or spm), each behind its sentinel."""
    p, s = [marks.piece("prefix"), *prefix], [marks.piece("suffix"), *suffix]
    return (p + s if form == "psm" else s + p) + [marks.piece("middle"), *middle]


def spell(pieces: list[Piece], buffers: tuple) -> Iterator[memoryview]:
    for buffer, start, length in pieces:
        yield memoryview(buffers[buffer])[start:start + length]


def digest(pieces: list[Piece], buffers: tuple) -> str:
    """SHA-256 of the described bytes, lowercase hex."""
    state = hashlib.sha256()
    for part in spell(pieces, buffers):
        state.update(part)
    return state.hexdigest()


def restore(output: bytes, form: str, marks: Marks) -> list[Piece]:
    """The original text as pieces of ``output``: its cuts permuted back."""
    if form == "plain":
        return [(TEXT, 0, len(output))] if output else []
    order = ("prefix", "suffix", "middle") if form == "psm" else ("suffix", "prefix", "middle")
    cuts, start = {}, 0
    for name, after in zip(order, (*order[1:], None)):
        mark = getattr(marks, name).encode()
        if output[start:start + len(mark)] != mark:
            raise ValueError(f"no sentinel {mark!r} at byte {start}")
        start += len(mark)
        stop = output.index(getattr(marks, after).encode(), start) if after else len(output)
        cuts[name] = (TEXT, start, stop - start)
        start = stop
    return [cuts[name] for name in ("prefix", "middle", "suffix") if cuts[name][2]]


def draws(seed: int, ident: int | None) -> list[int]:
    """The first four 32-bit numbers of SHA-256 of ``seed:id``."""
    found = hashlib.sha256(f"{seed}:{'' if ident is None else ident}".encode()).digest()
    return [int.from_bytes(found[i:i + 4], "big") for i in range(0, 16, 4)]


def chars(data: np.ndarray) -> int:
    """Code points of UTF-8 bytes."""
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def transformed(text: bytes, ident: int | None, seed: int, transform: int, spm: int, marks: Marks):
    """(n, form, prefix code points, middle code points, pieces) of one text."""
    data = np.frombuffer(text, np.uint8)
    ends = np.flatnonzero(data == 10) + 1
    if len(data) and (not len(ends) or ends[-1] != len(data)):
        ends = np.append(ends, len(data))
    n, whole = len(ends), [(TEXT, 0, len(data))] if len(data) else []
    h1, h2, h3, h4 = draws(seed, ident)
    held = any(m.encode() in text for m in (marks.prefix, marks.suffix, marks.middle))
    if not n or held or h3 % 100 >= transform:
        return n, "plain", None, None, whole
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (int(ends[k - 1]) if k else 0 for k in (first, second))
    prefix, rest = cut(whole, a)
    middle, suffix = cut(rest, b - a)
    form = "spm" if h4 % 100 < spm else "psm"
    return n, form, chars(data[:a]), chars(data[a:b]), arrange(prefix, middle, suffix, form, marks)


def _blocks(texts: list[bytes]):
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= BLOCK_BYTES:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _utf8(column: pa.Array) -> list[bytes]:
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def fill_in_middle(docs: DataFrame, seed: int = 7, transform: int = 100, spm: int = 50, marks: Marks = Marks(),
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars, pieces (descriptors over the
    text, buffer 0, and the sentinels, buffer 1), output and its output_sha256.  Of 100
    documents ``transform`` are cut, of 100 of these ``spm`` have the suffix first."""
    ship_package(docs.sparkSession)
    schema = (f"doc_id long, n long, form string, prefix_chars long, middle_chars long, pieces {PIECES}, "
              "output string, output_sha256 string")
    piece = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), _utf8(batch.column(1))
            for a, b in _blocks(texts):
                rows = [transformed(t, i, seed, transform, spm, marks) for i, t in zip(ids[a:b], texts[a:b])]
                buffers = [(t, marks.buffer) for t in texts[a:b]]
                n, form, prefix, middle, pieces = zip(*rows)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                    pa.array([[dict(zip(("buffer", "start", "length"), p)) for p in own] for own in pieces], piece),
                    pa.array([b"".join(spell(p, x)) for p, x in zip(pieces, buffers)], pa.binary()).cast(pa.string()),
                    pa.array([digest(p, x) for p, x in zip(pieces, buffers)], pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "pieces", "output", "output_sha256"])

    return docs.select(pick(id_col).cast("long").alias("doc_id"), pick(text_col).cast("string").alias("text")).mapInArrow(
        lambda b: released(run(b)), schema)


def restored(outputs: DataFrame, marks: Marks = Marks(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, restored (the original text, from ``output`` and ``form`` alone)
    and its restored_sha256.  A null output is empty; an output that does not fit its
    form raises ValueError."""
    ship_package(outputs.sparkSession)
    given = outputs.select(*[pick(c) for c in keep], pick("output").cast("string").alias("__fm_output"),
                           pick("form").alias("__fm_form"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:len(keep)]]
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, forms = _utf8(batch.column(width)), batch.column(width + 1).to_pylist()
            for a, b in _blocks(texts):
                pieces = [restore(t, f, marks) for t, f in zip(texts[a:b], forms[a:b])]
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(i).slice(a, b - a) for i in range(width)],
                    pa.array([b"".join(spell(p, (t,))) for p, t in zip(pieces, texts[a:b])], pa.binary()).cast(pa.string()),
                    pa.array([digest(p, (t,)) for p, t in zip(pieces, texts[a:b])], pa.string())],
                    names=[*keep, "restored", "restored_sha256"])

    return given.mapInArrow(lambda b: released(run(b)), ", ".join([*fields, "restored string", "restored_sha256 string"]))
