"""Vector bin packing of token sequences under several limits at once.

A document is tokenised and cut into pieces of at most ``tokens`` ids; the pieces
are dealt evenly over blocks (by task and running number, so no key can be hot) and
each block of bounded size is packed by the dot-product heuristic: into the open
sequence goes the fitting piece with the largest weighted dot product of its demand
and the sequence's free room, over tokens, segments and loss-bearing tokens.  When
nothing fits and more than ``slack`` tokens are free, the best piece is cut to fill
the sequence and its rest goes on.  Only the last sequence of a block is left with
much room.

Defined results: a null text is the empty text (its end id only); null and repeated
ids are documents of their own; a document longer than a sequence fills several; an
empty table gives no pieces; columns other than the named ones are ignored.  By
default a sequence has room for as many segments as tokens, so only tokens and loss
bind; of pieces that fit equally well the first of the block goes in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import default_partitions, pick, released, ship_file, ship_package, shipped_path
from .tokens import blocks, encoder

#: Documents whose pieces a block gets on average.
BLOCK_DOCS = 1024
#: Bytes of text of a block at most, on average (its ids are no more).
BLOCK_BYTES = 16_000_000
PIECES = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
          "segment int, loss_tokens long, ids binary")


@dataclass(frozen=True)
class Limits:
    """Per sequence; ``slack``: free tokens that are not worth a cut."""
    tokens: int = 4096
    segments: int = 4096          # binds only where it is set lower (instruction data)
    loss: int = 4096
    slack: int = 8


def pack_block(length: np.ndarray, free_head: np.ndarray, limits: Limits):
    """Pack pieces of ``length`` ids whose first ``free_head`` ids bear no loss.
    Returns arrays (piece, skip, length, sequence, offset): ids [skip, skip + length)
    of the piece stand at ``offset`` of ``sequence``."""
    most = np.array([limits.tokens, limits.segments, limits.loss], dtype=float)
    skip = np.zeros(len(length), dtype=np.int64)
    left = length.astype(np.int64).copy()
    demand = np.empty((len(length), 3))
    demand[:, 0], demand[:, 1], demand[:, 2] = left, 1, left - np.minimum(free_head, left)
    demand /= most
    weight = demand.mean(axis=0) if len(length) else np.ones(3)
    weighted = demand * weight
    alive = np.ones(len(length), dtype=bool)
    remaining, out, sequence = len(length), [], 0
    while remaining:
        room, at = np.ones(3), 0
        while remaining:
            score = weighted @ room
            score[~(alive & (demand <= room + 1e-12).all(axis=1))] = -1
            k = int(score.argmax())
            take = int(left[k])
            if score[k] < 0:
                free = limits.tokens - at
                # cut the piece of most tokens: only loss-free ids, or as the loss limit allows
                if free <= limits.slack or room[1] * limits.segments < 1 - 1e-9:
                    break
                score = np.where(alive, weighted @ room, -1)
                k = int(score.argmax())
                head = max(0, int(free_head[k] - skip[k]))
                take = min(free, head + round(room[2] * limits.loss), int(left[k]) - 1)
                if take <= limits.slack:
                    break
            out.append((k, int(skip[k]), take, sequence, at))
            lossy = max(0, take - max(0, int(free_head[k] - skip[k])))
            room -= np.array([take, 1, lossy]) / most
            at += take
            if take == left[k]:
                alive[k] = False
                remaining -= 1
            else:
                skip[k] += take
                left[k] -= take
                rest = left[k] - min(max(0, int(free_head[k] - skip[k])), int(left[k]))
                demand[k] = np.array([left[k], 1, rest]) / most
                weighted[k] = demand[k] * weight
        if not at:
            raise ValueError("a piece exceeds the limits of a sequence")
        sequence += 1
    return [np.array(c, dtype=np.int64) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 5


def pack(docs: DataFrame, vocabulary: str, limits: Limits = Limits(), end_id: int | None = 2,
         id_col: str = "doc_id", text_col: str = "text", prompt_tokens_col: str | None = None) -> DataFrame:
    """Pieces of the packed sequences (``PIECES``), with their ids as little-endian
    unsigned 32-bit binary.  ``prompt_tokens_col``: leading ids of a document that
    bear no loss (instruction data); none by default."""
    spark = docs.sparkSession
    ship_package(spark)
    name = ship_file(spark, vocabulary)
    rows = docs.select(
        pick(id_col).cast("long").alias("doc_id"), pick(text_col).cast("string").alias("text"),
        (F.coalesce(pick(prompt_tokens_col).cast("long"), F.lit(0)) if prompt_tokens_col
         else F.lit(0).cast("long")).alias("head"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    n_blocks = max(1, -(-size["n"] // BLOCK_DOCS), -(-size["b"] // BLOCK_BYTES))
    piece_limit = min(limits.tokens, limits.loss)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from released(_cut(batches, shipped_path(name), piece_limit, end_id, n_blocks))

    def pack_group(table: pa.Table) -> pa.Table:
        return _pack_group(table, limits)

    pieces = rows.mapInArrow(cut, "block long, doc_id long, start long, doc_tokens long, head long, ids binary")
    n = min(n_blocks, max(default_partitions(spark), n_blocks // 8))
    return pieces.repartition(n, "block").groupBy("block").applyInArrow(pack_group, PIECES)


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Slices of an array as a binary column; ``bounds`` in items."""
    wide = (bounds * data.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1,
                                 [None, pa.py_buffer(wide.tobytes()), pa.py_buffer(data.tobytes())])


def _cut(batches, vocabulary, piece_limit, end_id, n_blocks):
    enc = encoder(vocabulary)
    # every task deals its pieces round from a start of its own
    at = (TaskContext.get().partitionId() * 0x9E3779B1) % n_blocks
    for batch in batches:
        texts = batch.column(1)
        for a, b in blocks(texts, 1 << 22):
            tokens, offsets = enc.encode_all(texts.slice(a, b - a))
            if end_id is not None:
                tokens = np.insert(tokens, offsets[1:], end_id)
                offsets = offsets + np.arange(len(offsets))
            size = np.diff(offsets)
            n = -(-size // piece_limit)
            doc = np.repeat(np.arange(len(size)), n)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * piece_limit
            bounds = np.append(offsets[:-1][doc] + start, offsets[-1])
            heads = batch.column(2).slice(a, b - a).to_numpy()[doc]
            block = (at + np.arange(len(doc))) % n_blocks
            at = (at + len(doc)) % n_blocks
            yield pa.RecordBatch.from_arrays([
                pa.array(block), batch.column(0).slice(a, b - a).take(pa.array(doc)),
                pa.array(start), pa.array(size[doc]), pa.array(heads), _binary(tokens, bounds),
            ], names=["block", "doc_id", "start", "doc_tokens", "head", "ids"])


def _pack_group(table: pa.Table, limits: Limits) -> pa.Table:
    table = table.combine_chunks()
    raw = table["ids"].to_pylist()
    block = table["block"][0].as_py()
    doc_tokens, start, head = (table[c].to_numpy() for c in ("doc_tokens", "start", "head"))
    total = sum(map(len, raw))
    length = np.minimum(doc_tokens - start, min(limits.tokens, limits.loss))
    width = total // int(length.sum())
    free_head = np.clip(head - start, 0, length)
    piece, skip, size, sequence, offset = pack_block(length, free_head, limits)
    ids = [np.frombuffer(raw[k], f"<u{width}", z, s * width) for k, s, z in zip(piece.tolist(), skip.tolist(), size.tolist())]
    flat = np.concatenate(ids).astype("<u4")
    fresh = np.append(True, sequence[1:] != sequence[:-1])
    segment = np.arange(len(sequence)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    return pa.table({
        "doc_id": table["doc_id"].take(pa.array(piece)),
        "start": pa.array(start[piece] + skip), "length": pa.array(size),
        "doc_tokens": pa.array(doc_tokens[piece]),
        "sequence_id": pa.array(block * (1 << 32) + sequence), "offset": pa.array(offset),
        "segment": pa.array(segment.astype(np.int32)),
        "loss_tokens": pa.array(size - np.clip(free_head[piece] - skip, 0, size)),
        "ids": _binary(flat, np.concatenate([[0], np.cumsum(size)])),
    })
