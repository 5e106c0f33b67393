"""Fill-in-middle by a piece table against plain string work."""

import hashlib
import re

import pytest

from telemetra.llm import fim, queries

TEXTS = [None, "", "one line", "a\nb\nc\n", "\n\n\n", "é\nß ü\n数学\n", "has <P> inside\nx", "<<S\n<M\n>P>\n", "l\n" * 3000, "\r\n<", "x<S\ny"]


def plain(ident, text, seed=7, transform=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, h = len(units), hashlib.sha256(f"{seed}:{'' if ident is None else ident}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= transform:
        return n, "plain", None, None, text
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    return [(i, t, "z") for i in range(40) for t in TEXTS] + [(None, "a\nb\n", "z"), (3, "a\nb\n", "z"), (3, "a\nb\n", "z")]


def test_query_and_round_trip(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    want = sorted(((i, *plain(i, t)[:4], _sha(plain(i, t)[4]), _sha(t or "")) for i, t, _ in rows), key=repr)
    assert sorted((tuple(r) for r in queries.op12_fim(spark, str(tmp_path)).collect()), key=repr) == want
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_outputs_pieces_and_shares(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string")
    out = fim.fill_in_middle(docs, seed=3, transform=50, spm=20)
    found = out.collect()
    want = sorted(((i, *plain(i, t, 3, 50, 20)) for i, t, _ in rows), key=repr)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found), key=repr) == want
    assert all(_sha(r.output) == r.output_sha256 for r in found)
    texts = {(i, plain(i, t, 3, 50, 20)[4]): (t or "").encode() for i, t, _ in rows}
    for r in found:
        buffers = (texts[r.doc_id, r.output], fim.Marks().buffer)
        assert b"".join(fim.spell([tuple(p) for p in r.pieces], buffers)).decode() == r.output
    back = fim.restored(out).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.restored) for r in back) == sorted(
        (-1 if i is None else i, t or "") for i, t, _ in rows)


def test_empty_table_and_misfits(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert fim.restored(fim.fill_in_middle(none)).count() == 0
    with pytest.raises(ValueError):
        fim.restore(b"no sentinel", "psm", fim.Marks())
    left, right = fim.cut([(0, 5, 3), (1, 0, 2), (0, 9, 4)], 4)
    assert left == [(0, 5, 3), (1, 0, 1)] and right == [(1, 1, 1), (0, 9, 4)]
