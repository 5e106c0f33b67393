"""Stages of the pipeline keep the columns of their input, whatever their names."""

import pytest

import corpus_pipeline

NAMES = ["size", "start", "position", "score", "kept", "copy", "n_chars"]
TEXT = [" ".join(f"{w}{c}" for w in ("the", "and", "of", "with") for c in "abcdefghijkl") + f" {i}" * 9 for i in range(6)]
ROWS = [(i, t, "en", f"s{i % 2}") for i, t in enumerate([*TEXT, TEXT[0], None, "", "12 34"])]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_clashing_columns(spark, name, stage):
    rows = [(*r, *(f"{n}{r[0]}" for n in NAMES)) for r in ROWS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                 + ", ".join(f"{n} string" for n in NAMES))
    out = stage(spark, docs, "")
    assert out.columns == docs.columns
    got = [tuple(r) for r in out.collect()]
    assert got and set(got) <= set(rows)
    ids = sorted(r[0] for r in got)
    if name == "language_id":
        assert ids == list(range(7))
    if name == "exact_dedup":
        assert len(ids) == 8 and 6 in ids and 0 not in ids and len({7, 8} & set(ids)) == 1
