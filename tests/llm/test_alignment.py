"""Cross-tokenizer alignment against a plain loop over all token pairs."""

import hashlib
import random
from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
import pytest

from telemetra.llm import alignment, queries

P = pytest.importorskip("public_tokenizers")
import sentencepiece  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from telemetra.llm.tokens import _byte_chars  # noqa: E402

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
WORDS = "the alignment of tokenizers naïve Äußerst 数学日本語 it's 3.14159 <|endoftext|> </s> <0x41> x_y(z) émoji🙂 unforgettable\nline a\tb etc. don't".split(" ")
TEXTS = [None, "", " ", "a", "the quick brown fox", "two  spaces\n\nand lines ", "has ▁ inside", "<s>special</s> <unk>", "数学と日本語の文章" * 9,
         "\x00 nul", "\x01mark", " lead", "tab\tx\r\ny\n z", "aaaa" * 40, "ﬁ nbsp x", "line\nbreak\nhere a\nb"]


def long_text(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    s = sentencepiece.SentencePieceProcessor(model_file=B)
    chars = {c: b for b, c in _byte_chars().items()}

    def tokens(text):
        if not text:
            return [], []
        a = [(i, bytes(chars[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(s.id_to_piece(i)[3:5], 16)]) if s.is_byte(i) else s.id_to_piece(i).replace("▁", " ").encode())
             for i in s.encode(text)]
        want = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else ([], [])

    return tokens


def spans(tokens):
    out, at = [], 0
    for i, data in tokens:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def plain(texts, tokens):
    """The contract's columns without the id, by comparing all pairs."""
    rows, docs = [], Counter()
    for text in texts:
        a, b = map(spans, tokens(text))
        common = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, low = [], 0
        for c in common:
            groups.append(",".join(str(i) for i, _, e in a if low < e <= c) + "|" + ",".join(str(i) for i, _, e in b if low < e <= c))
            low = c
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        docs.update(set(links))
        rows.append((len(a), len(b), ";".join(groups), len(groups), links))
    best = defaultdict(int)
    for (i, _), n in docs.items():
        best[i] = max(best[i], n)
    return [(na, nb, ng, len(links), sum(docs[x] == best[x[0]] for x in links), sum(docs[x] for x in links),
             hashlib.sha256(g.encode()).hexdigest() if g else "") for na, nb, g, ng, links in rows]


@pytest.fixture(scope="module")
def rows():
    texts = TEXTS + [long_text(40, s) for s in range(6)] + [long_text(900, 9), "x" * 700 + " end of it"]
    return [(i, t, "c") for i, t in enumerate(texts)] + [(None, "the quick", "c"), (4, TEXTS[4], "c"), (4, TEXTS[4], "c")]


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_query_on_rows(spark, tmp_path, rows, library):
    spark.createDataFrame(rows, "doc_id long, text string, n_a string").write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op13_alignment(spark, str(tmp_path))
    assert tuple(found.columns) == COLUMNS
    want = [(r[0], *x) for r, x in zip(rows, plain([r[1] for r in rows], library))]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    assert any(w[3] == 0 for w in want) and any(w[5] < w[4] for w in want)


@pytest.mark.parametrize("chunk", [1, 7, 64])
def test_long_texts_by_fragments(spark, rows, library, chunk):
    some = [r for r in rows if r[1] is None or len(r[1]) < 400][:24] + [(99, long_text(60, 3), "c")]
    docs = spark.createDataFrame(some, "doc_id long, text string, x string")
    found = alignment.align(docs, A, B, chunk_bytes=chunk, digest=True).select(*COLUMNS)
    want = [(r[0], *x) for r, x in zip(some, plain([r[1] for r in some], library))]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_blocks_of_pair_counts_and_groups_text(spark, rows, library):
    docs = spark.createDataFrame(rows, "doc_id long, text string, x string")
    found = alignment.aligned(docs, A, B)
    written = alignment.staged(found.withColumn("key", alignment.F.monotonically_increasing_id()))
    whole = alignment.with_counts(written).drop("groups").collect()
    parts = alignment.with_counts(written, broadcast_pairs=50).drop("groups").collect()
    assert sorted(map(tuple, whole), key=repr) == sorted(map(tuple, parts), key=repr)
    by = {r.doc_id: r.groups for r in found.collect()}
    a, b = library("a")
    assert by[3] == f"{a[0][0]}|" + ",".join(str(i) for i, _ in b) and by[0] == by[6] == ""


def test_composition_is_associative():
    pair = alignment.Pair(A, B)
    text = long_text(80, 5)
    tokens = pair.encode(pa.array([text]))
    size = len(text.encode()) + 1
    r = random.Random(2)
    for _ in range(20):
        edges = [0, *sorted(r.sample(range(1, size), 12)), size]
        parts = [alignment.fragment(pair, tokens, 0, x, y) for x, y in zip(edges[:-1], edges[1:])]
        want = repr_of(reduce(lambda x, y: alignment.compose(pair, x, y), parts))
        while len(parts) > 1:                       # any tree
            i = r.randrange(len(parts) - 1)
            parts[i:i + 2] = [alignment.compose(pair, *parts[i:i + 2])]
        assert repr_of(parts[0]) == want
        assert repr_of(alignment.compose(pair, alignment.Fragment(), parts[0])) == want


def repr_of(f):
    return (f.cut, f.whole, f.body.groups, f.body.n_groups, f.body.n_links, f.body.pair.tolist(), f.body.times.tolist(),
            [x.tolist() for side in (f.prefix, f.suffix) for x in side.parts()])


def test_ranges_cover_and_stay_bounded():
    for text, chunk in ((long_text(300, 1), 50), ("y" * 500, 50), ("a b " * 100, 7), ("数学" * 100 + " a b c d", 20), ("x", 1)):
        data = text.encode()
        found = alignment.ranges(data, chunk)
        assert found[0][0] == 0 and found[-1][1] == len(data) + 1
        assert all(x[1] == y[0] for x, y in zip(found, found[1:]))
        assert all(lo <= after and hi >= upto for after, upto, lo, hi in found)
        assert sum(hi - lo for *_, lo, hi in found) <= 3 * (len(data) + 1)


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
