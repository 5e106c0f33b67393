import os

import numpy as np
from pyspark.sql import functions as F
from telemetra import session
from telemetra.plans import knn

VEC = "id long, vec array<double>"


def _rows(spark, x, first=0):
    return spark.createDataFrame([(first + i, v.tolist()) for i, v in enumerate(x)], VEC)


def test_recall_of_slices_is_the_recall_of_all(spark):
    rng = np.random.default_rng(8)
    x = np.vstack([rng.normal(size=(700, 3)), np.ones((40, 3))])
    every, train = _rows(spark, x), _rows(spark, x[:600])
    args = {"trees": 2, "leaf_rows": 40}
    boxes, leaves = knn.Boxes(train, box_rows=100), knn.Leaves(train, **args)
    slices = leaves.slices(every, 100, 4)
    assert len(slices) == 4 and sorted(r["id"] for s in slices for r in s.collect()) == list(range(740))
    assert max(s.count() for s in slices) < 400
    got, tables = {}, []
    for part in slices:
        exact, found = knn.knn_lists(part, boxes, 12, exclude_self=True), knn.approximate_knn_lists(part, leaves, 12, exclude_self=True)
        for r in knn.recall_lists(found, exact, [3, 12]).collect():
            a, b = got.get(r["k"], (0, 0))
            got[r["k"]] = a + r["neighbours"], b + r["found"]
        session.release(exact, found)
        tables += [exact.table_path, found.table_path]
    whole = knn.recall_lists(knn.approximate_knn_lists(every, train, 12, exclude_self=True, **args),
                             knn.knn_lists(every, train, 12, exclude_self=True), [3, 12]).collect()
    assert got == {r["k"]: (r["neighbours"], r["found"]) for r in whole}
    assert not any(os.path.exists(t.removeprefix("file:")) for t in tables)         # no slice's lists stay


def test_a_written_table_leaves_no_setting_behind(spark):
    before = spark.conf.get(session.CLEANUP, "false")
    out = session.cut_lineage(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count())
    assert out.count() == 7 and spark.conf.get(session.CLEANUP) == before


def test_few_pairs_of_many_dimensions_are_measured(monkeypatch):
    rng = np.random.default_rng(9)
    x, y = rng.normal(size=(64, 32)), rng.normal(size=(30_000, 32))
    pairs, measure = [], knn._distances
    monkeypatch.setattr(knn, "_distances", lambda a, b: pairs.append(len(a)) or measure(a, b))
    i, r, d = knn._search(np.arange(64) + 50_000, x, np.arange(len(y)), y, 10, True)
    exact = np.sqrt(((x[:, None] - y[None]) ** 2).sum(-1))
    order = np.argsort(exact, axis=1, kind="stable")[:, :10]
    assert (r.reshape(64, 10) == order).all() and (i == np.repeat(np.arange(64), 10)).all()
    assert np.allclose(d.reshape(64, 10), np.take_along_axis(exact, order, 1), rtol=1e-12)
    assert sum(pairs) < 64 * len(y) // 50


def test_squares_that_overflow_lose_no_neighbour():
    y = np.array([[1e200, float(v)] for v in range(300)])
    i, r, d = knn._search(np.array([5, 299]), y[[5, 299]], np.arange(300), y, 2, True)
    assert r.tolist() == [4, 6, 298, 297] and d.tolist() == [1, 1, 1, 2]
