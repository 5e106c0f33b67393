"""Corpus operators against brute force on small tables with nulls, empty texts,
ties, repeated rows and clashing column names."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from telemetra.llm import (exact_dedup, jaccard_join, language_id, mixing, packing, pii, sharding, token_files, topk,
                           warc)
from telemetra.llm.tokens import Encoder

P = pytest.importorskip("public_tokenizers")
BASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon "
ROWS = [(1, BASE * 2, "a"), (2, BASE * 2, None), (3, None, "b"), (4, "", "b"), (5, BASE * 2 + "omega", "a"),
        (5, "one two", "a"), (6, "ONE two", "c"), (7, "x " * 5000, "a"), (8, "mail me@x.org or +1 555 123 4567", None),
        (None, "no id here at all", "c"), (9, "  \n\t ", "a"), (10, "one two", "a"), (10, "one two", "a")]
SCHEMA = "doc_id long, text string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumn("size", F.lit(0)).withColumn("kept", F.lit("x"))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(docs, empty):
    rows = exact_dedup.exact_dedup(docs, digest_all=True).collect()
    groups = {}
    for i, t, _ in ROWS:
        groups.setdefault(t or "", []).append(i)
    assert len(rows) == len(ROWS)
    for r in rows:
        ids = groups[r.text or ""]
        assert r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None)
        assert r.text_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert sum(r.kept for r in rows) == len(groups)
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_mixing(docs, empty):
    rows = mixing.mix_plan(docs).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.taken <= 3 * r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    for own in by.values():
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1
    assert sum(o[0].target for o in by.values()) == pytest.approx(sum(r["size"] for r in rows))
    assert mixing.mix_plan(empty).count() == 0 and mixing.mix_copies(docs).count() > 0


def test_sharding(docs, empty):
    rows = sharding.assign_shards(docs, 3).collect()
    for s in {r.shard for r in rows}:
        own = sorted(r.slot for r in rows if r.shard == s)
        assert own == list(range(len(own)))
    assert sharding.assign_shards(empty, 3).count() == 0
    totals = [(i, 10 + i % 7, 1) for i in range(500)]
    before = sharding.balanced_map(totals, 4)
    after = sharding.grown_map(before, totals, 4)
    assert all(after[k] in (before[k], 4) for k in before)
    load = [sum(b for k, b, _ in totals if after[k] == s) for s in range(5)]
    assert max(load) < 1.2 * min(load)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_library(name):
    e = Encoder(P.path(name))
    texts = [t for _, t, _ in ROWS] + [" a b", "a  b", "Don't. stop,\nnow\n\nx", "été À ß İ", "<|endoftext|> a\x01 b", "日本 語"]
    ids, at = e.encode_all(pa.array(texts))
    for k, t in enumerate(texts):
        assert ids[at[k]:at[k + 1]].tolist() == e.library.encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_added_tokens_as_the_library_encodes_them(name):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(P.path(name))             # with its default settings
    texts = ["<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b c", "<|ENDOFTEXT|> a", "x. <|startoftext|>,\ny",
             "The <|EndOfText|>", "<|endoftext| >", "no token", None, "", "Two <|endoftext|><|endoftext|>  É"]
    e = Encoder(P.path(name))
    ids, at = e.encode_all(pa.array(texts))
    for k, t in enumerate(texts):
        assert ids[at[k]:at[k + 1]].tolist() == plain.encode(t or "", add_special_tokens=False).ids


def test_token_files_round_trip(spark, docs, empty):
    path = P.path("byte_bpe_50k.json")
    e = Encoder(path)
    rows = token_files.read_token_files(spark, token_files.write_token_files(docs, path)).orderBy("start").collect()
    assert len(rows) == len(ROWS)
    want = sorted(((-1 if i is None else i), zlib.crc32(np.append(e.encode(t or ""), 2).astype("<u4").tobytes()))
                  for i, t, _ in ROWS)
    assert sorted(((-1 if r.doc_id is None else r.doc_id), zlib.crc32(r.ids)) for r in rows) == want
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    assert token_files.read_token_files(spark, token_files.write_token_files(empty, path)).count() == 0


def test_packing(docs, empty):
    path = P.path("word_bpe_49k.json")
    limits = packing.Limits(tokens=64, segments=4, loss=60)
    rows = packing.pack(docs, path, limits).collect()
    e = Encoder(path)
    assert sum(r.length for r in rows) == sum(len(e.encode(t or "")) + 1 for _, t, _ in ROWS)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for own in by.values():
        own.sort(key=lambda r: r.offset)
        assert len(own) <= 4 and sum(r.length for r in own) <= 64 and sum(r.loss_tokens for r in own) <= 60
        assert [r.offset for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
    assert packing.pack(empty, path).count() == 0


def test_pii(docs, empty):
    t = "Card 4111 1111 1111 1111, 256.1.1.1 and 10.0.0.1, a@b.c_d@e.f.g; IBAN DE89 3704 0044 0532 0130 00 ok"
    kinds = [(k, x) for k, _, _, x, _ in pii.find_spans(t)]
    assert kinds == [("email", "a@b.c"), ("email", "_d@e.f.g"), ("ip", "10.0.0.1"), ("card", "4111 1111 1111 1111"),
                     ("iban", "DE89 3704 0044 0532 0130 00")]
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    for s in (t, "@@a@b.c", "a@b c@d.e", "x@y.z@w.v"):
        assert list(pii.emails(s)) == [m.span() for m in email.finditer(s)]
    assert pii.find_pii(docs).where("size(pii) > 0").count() == 1 and pii.find_pii(empty).count() == 0


def test_language(spark, empty):
    rows = [(i, ("the and of with this " if i % 2 else "der und die nicht mit ") * 20, "en" if i % 2 else "de") for i in range(40)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = language_id.label_texts(["the of with", "und nicht die", None, "12 !", "the with of " * 9 + "der und nicht " * 9], model)
    assert [g["lang"] for g in got[:4]] == ["en", "de", "und", "und"]
    assert [s["lang"] for s in got[4]["spans"]] == ["en", "de"]
    none = language_id.train(empty.withColumn("lang", F.lit(None).cast("string")))
    assert language_id.label_texts(["the"], none)[0]["lang"] == "und"


def test_warc(spark):
    big = "<p>" + "x" * 2000
    rows = [(1, "http://a b", big), (2, None, big), (3, "u", None), (4, "u", ""), (None, "u", big), (2, "v", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.read_warc(spark, warc.write_warc(pages)).collect()
    assert sorted((str(r.page_id), r.record_type, r.refers_to) for r in got) == sorted(
        [("1", "revisit", 2), ("2", "response", None), ("2", "response", None), ("None", "revisit", 2),
         ("3", "response", None), ("4", "response", None)], key=lambda x: (x[0], x[1]))
    raw = warc.page_record(1, "u", b"body", hashlib.sha1(b"body").hexdigest(), 4, None, "2024-01-01T00:00:00Z", "x")
    assert warc.page_of(*warc.parse_record(raw))["payload"] == b"body"
    for bad in (raw[:-1], raw.replace(b"WARC/1.1", b"WARC/9"), raw.replace(b"body", b"bodY")):
        with pytest.raises(ValueError):
            warc.page_of(*warc.parse_record(bad))


def test_topk(spark):
    rows = [(i, [float((i * 7 + d * 3) % 11 - 5) / 8 for d in range(6)]) for i in range(0, 300)]
    rows += [(1000, None), (1001, [float("nan")] * 6), (1002, [1.0, None, 1.0, 1.0, 1.0, 1.0])]
    got = topk.top_k(topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")),
                     F.col("vec_id") % 100 == 0, 10).collect()
    v = {i: np.floor(1024 * np.array(x)).astype(int) for i, x in rows[:300]}
    for q in (0, 100, 200):
        want = sorted((-int(v[q] @ v[i]), i) for i in v if i != q)[:10]
        assert [(-r.score, r.vec_id) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == want
    assert {r.query_id for r in got} == {0, 100, 200}


def test_jaccard(docs, empty, spark):
    rng = np.random.default_rng(3)
    texts = []
    for g in range(12):
        base = rng.integers(0, 500, rng.integers(8, 200)).tolist()
        for _ in range(6):
            own = list(base)
            for _ in range(rng.integers(0, 5)):
                own[rng.integers(0, len(own))] = int(rng.integers(0, 500))
            texts.append(" ".join(f"w{x}" for x in own))
    sets = [set(tuple(w[i:i + 4]) for i in range(len(w) - 3)) for w in (t.split() for t in texts)]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if 100 * same >= 85 * (len(sets[i]) + len(sets[j]) - same):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(table).collect()}
    assert got == dict(enumerate(root))
    odd = jaccard_join.jaccard_components(docs).collect()
    assert len(odd) == len(ROWS)
    assert all(r.component_id is None for r in odd if r.doc_id is None)
    assert jaccard_join.jaccard_components(empty).count() == 0
