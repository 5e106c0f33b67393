"""near_distinct where ids repeat: rows go by their own text, ties are defined."""

from telemetra.llm import jaccard_join

SCHEMA = "doc_id long, text string, source string"
LONG = [" ".join(f"{c}{i}" for i in range(60)) for c in "pqr"]
ROWS = [(7, LONG[0], "a"), (7, LONG[1], "b"), (7, LONG[1], "c"), (8, LONG[0] + " end", "d"), (9, LONG[1] + " end", "e"),
        (5, LONG[2] + " end", "f"), (7, LONG[2], "g"), (6, None, "h"), (6, "", "i"), (4, " ", "j"), (None, LONG[0], "k"),
        (None, LONG[0], "l"), (3, "", "m")]


def kept(spark, rows):
    return sorted(r.source for r in jaccard_join.near_distinct(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect())


def test_repeated_ids(spark):
    got = kept(spark, ROWS)
    # 7 stands at three texts; b, c and h, i repeat an id and its text
    assert [s for s in got if s not in "bchi"] == ["a", "f", "j", "k", "l", "m"]
    assert len({"b", "c"} & set(got)) == 1 and len({"h", "i"} & set(got)) == 1
    assert got == kept(spark, ROWS[::-1])


def test_unique_ids_and_empty(spark):
    assert kept(spark, [r for r in ROWS if r[2] not in "bcghi"]) == ["a", "e", "f", "j", "k", "l", "m"]
    assert kept(spark, []) == []
