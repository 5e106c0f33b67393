"""Blocks of packing follow the bytes of long documents, not their number alone."""

import pytest

from telemetra.llm import packing

P = pytest.importorskip("public_tokenizers")


def test_long_documents_are_dealt_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_BYTES", 4_000, raising=False)
    docs = spark.createDataFrame([(1, "long words here " * 2_000), (2, None), (3, "short")], "doc_id long, text string")
    limits = packing.Limits(tokens=64, segments=4, loss=60)
    rows = packing.pack(docs, P.path("word_bpe_49k.json"), limits).select("doc_id", "start", "length", "doc_tokens", "sequence_id").collect()
    blocks = {}
    for r in rows:
        blocks[r.sequence_id >> 32] = blocks.get(r.sequence_id >> 32, 0) + r.length
    assert len(blocks) == 9 and max(blocks.values()) < 1.5 * sum(blocks.values()) / len(blocks)
    for i in (1, 2, 3):
        own = sorted((r.start, r.length, r.doc_tokens) for r in rows if r.doc_id == i)
        assert [s for s, _, _ in own] == [sum(n for _, n, _ in own[:k]) for k in range(len(own))]
        assert sum(n for _, n, _ in own) == own[0][2]
