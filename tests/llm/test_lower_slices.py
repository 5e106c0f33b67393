"""The encoder lowers only the bytes of the slice that it is given."""

import numpy as np
import pyarrow as pa
import pytest

from telemetra.llm import tokens

P = pytest.importorskip("public_tokenizers")


def test_slice_reads_its_own_bytes():
    texts = pa.array(["A" * 10_000, "Àb Z[`{", "", "End é"], pa.large_string())
    low = tokens._ascii_lower(texts.slice(1, 3))
    assert low.to_pylist() == ["Àb z[`{", "", "end é"]
    assert low.buffers()[2].size < 100
    assert tokens._ascii_lower(texts).to_pylist() == ["a" * 10_000, "Àb z[`{", "", "end é"]


def test_slices_encode_as_the_library_does():
    enc = tokens.Encoder(P.path("word_bpe_49k.json"))
    given = ["The END, the end.", None, "", "É \x01 Über Ab\nCd", "tail <|endoftext|> x", "the"] * 3
    texts = pa.array(given, pa.string())
    for a, n in ((0, 18), (1, 2), (3, 7), (17, 1)):
        ids, offsets = enc.encode_all(texts.slice(a, n))
        want = [enc.library.encode(t or "", add_special_tokens=False).ids for t in given[a:a + n]]
        assert [ids[i:j].tolist() for i, j in zip(offsets[:-1], offsets[1:])] == want
        assert np.all(np.diff(offsets) >= 0)
