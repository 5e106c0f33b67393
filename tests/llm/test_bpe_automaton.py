"""The tokenisation automaton against the library and against its own definition."""

import hashlib
import itertools
import json

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from telemetra.llm import bpe_automaton, queries
from telemetra.llm.bpe_automaton import Automaton, AutomatonEncoder, Labels

P = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

TEXTS = [None, "", " ", "a", "aaaaaaaa aaa aa", "The QUICK brown fox's tail, isn't it?\n\n  indented\tline ", "Äußerst schön — été ÀÉ",
         "<|endoftext|> in <|startoftext|>text<|endoftext|>", "数学と日本語の文章、混ぜる", "x" * 3000 + " 1234567890" * 50,
         "naïve café  nbsp line", "🙂🙂 emoji 👩‍👩‍👧", "É" * 200, "tab\there", "it'll we've I'd", "ﬁ ligature İstanbul", "a\r\nb", "\x00nul \x01mark"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_and_decoder_equal_the_library(name):
    own, library = AutomatonEncoder(P.path(name)), Tokenizer.from_file(P.path(name))
    ids, offsets = own.encode_all(pa.array(TEXTS))
    lists = [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
    assert lists == [library.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    array = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))
    assert Labels(P.path(name)).decode_all(array).to_pylist() == [library.decode(x, skip_special_tokens=False) for x in lists]


def _toy(merges):
    from telemetra.llm.tokens import _byte_chars

    vocab = {c: i for i, c in enumerate(_byte_chars().values())}
    for a, b in merges:
        vocab.setdefault(a + b, len(vocab))
    return {"type": "BPE", "vocab": vocab, "merges": merges}


def _merged(word, model):
    """Merges applied one after the other, each from the left."""
    parts = list(word)
    for a, b in model["merges"]:
        out = []
        for p in parts:
            if out and out[-1] == a and p == b:
                out[-1] = a + b
            else:
                out.append(p)
        parts = out
    return [model["vocab"][p] for p in parts]


@pytest.mark.parametrize("merges", [
    [("a", "a"), ("aa", "a"), ("aa", "aa")], [("a", "b"), ("ab", "a"), ("b", "a")], [("b", "a"), ("a", "b"), ("ba", "b"), ("ab", "ba")],
    [("a", "b"), ("b", "b"), ("ab", "bb"), ("bb", "bb"), ("a", "a")], []])
def test_accepts_exactly_the_merged_sequences(merges):
    model = _toy(merges)
    automaton = Automaton(model)
    tokens = [model["vocab"][t] for t in sorted({"a", "b", *(a + b for a, b in merges)})]
    words = ["".join(w) for n in range(1, 8) for w in itertools.product("ab", repeat=n)]
    merged = {w: _merged(w, model) for w in words}
    together = automaton.encode_words([w.encode() for w in words])
    for w, ids in zip(words, together):
        assert ids == merged[w] == automaton.encode_word(w.encode())
    # of all token sequences exactly the merged ones have all their arcs
    label = {i: s for s, i in model["vocab"].items()}
    for n in range(2, 5):
        for path in itertools.product(tokens, repeat=n):
            arcs = automaton.allows(np.array(path[:-1]), np.array(path[1:])).all()
            assert arcs == (_merged("".join(label[t] for t in path), model) == list(path))


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        Automaton({"type": "WordPiece"})
    with pytest.raises(ValueError):
        Automaton({"type": "BPE", "vocab": {"a": 0}, "merges": []})


def test_query_on_rows(spark, tmp_path):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "no id", "x"), (3, "a", "x"), (3, "a", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = sorted(queries.op11_bpe(spark, str(tmp_path)).collect(), key=repr)
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(decoded.encode()).hexdigest()))
    assert [tuple(r) for r in found] == [w for w in sorted(want, key=lambda w: f"Row(doc_id={w[0]!r}, n_tokens={w[1]}, ids_sha256={w[2]!r}")]
    assert bpe_automaton.encode(docs.limit(0), P.path("word_bpe_49k.json")).count() == 0
    nulls = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bpe_automaton.decode(nulls, P.path("word_bpe_49k.json")).select(F.length("decoded")).first()[0] == 0


def test_vocabulary_file_is_read_not_the_library_model():
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        model = json.load(f)["model"]
    automaton = Automaton(model)
    assert automaton.gadget.get(np.array([model["vocab"]["i"]]), np.array([model["vocab"]["n"]]))[0] == 0
    assert len([s for s in automaton.born.tolist() if s >= 0]) == len(model["merges"])
