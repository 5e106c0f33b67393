"""Prefix sums, exact quantiles, kNN join, ECOD, LOF and curve metrics against
brute force on small fixtures; partition invariance and plan shape."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from telemetra.operators import evaluate as E
from telemetra.operators.detect import ecod, lof
from telemetra.plans import hscan, knn


import pytest


@pytest.mark.parametrize("ranges", [None, 1, 7, 1000])
@pytest.mark.parametrize("descending", [False, True])
def test_prefix_sums_match_cumsum(spark, ranges, descending):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 500), "x": rng.normal(size=500).round(2),
                        "w": rng.integers(1, 5, 500)})
    pdf = pdf.groupby(["g", "x"], as_index=False)["w"].sum()
    out = hscan.prefix_sums(spark.createDataFrame(pdf), ["g"], "x", ["w"], ranges=ranges,
                            descending=descending).toPandas()
    exp = pdf.sort_values(["g", "x"], ascending=not descending).assign(cum=lambda d: d.groupby("g")["w"].cumsum())
    m = out.merge(exp, on=["g", "x"])
    assert len(m) == len(pdf) and (m["cum_w"] == m["cum"]).all()


@pytest.mark.parametrize("ranges", [None, 1, 1000])
def test_exact_quantiles_match_numpy(spark, ranges):
    rng = np.random.default_rng(2)
    v = rng.exponential(size=1001).round(3)
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.9, 0.97, 1.0]
    q = {r["p"]: r["q"] for r in hscan.exact_quantiles(df, [], "x", probs, ranges=ranges).collect()}
    for p in probs:
        assert math.isclose(q[p], float(np.quantile(v, p)), rel_tol=1e-12, abs_tol=1e-12)


def test_null_keys_and_missing_values_alike_at_any_range_count(spark):
    rows = [(None, 1.0), (None, 4.0), (None, float("nan")), ("a", 2.0), ("a", 2.0), ("a", None),
            ("a", 9.0), ("b", float("nan")), ("c", 5.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    want_q = {(None, 0.5): 2.5, ("a", 0.5): 2.0, ("c", 0.5): 5.0, (None, 1.0): 4.0, ("a", 1.0): 9.0, ("c", 1.0): 5.0}
    want_s = {(None, 1.0, 1, 2), (None, 4.0, 2, 2), ("a", 2.0, 2, 3), ("a", 9.0, 3, 3), ("c", 5.0, 1, 1)}
    for n in (None, 1, 1000):
        q = hscan.exact_quantiles(df, ["k"], "x", [0.5, 1.0], ranges=n).collect()
        assert len(q) == len(want_q) and {(r["k"], r["p"]): r["q"] for r in q} == want_q
        s = hscan.prefix_sums(hscan.value_counts(df, ["k"], "x"), ["k"], "x", ["cnt"], ranges=n).collect()
        assert len(s) == len(want_s) and {(r["k"], r["x"], r["cum_cnt"], r["total_cnt"]) for r in s} == want_s


def test_only_group_is_cut_into_ranges(spark, monkeypatch):
    monkeypatch.setattr(hscan, "RANGE_ROWS", 100)
    placed = hscan._in_ranges(spark.range(1000).select(F.col("id").alias("x")), [], F.col("x").asc(), None)
    sizes = [r["count"] for r in placed.groupBy(hscan._RANGE).count().collect()]
    assert len(sizes) == 10 and max(sizes) <= 200


def test_empty_input_has_no_quantiles(spark):
    df = spark.createDataFrame([], "k string, x double")
    assert hscan.exact_quantiles(df, ["k"], "x", [0.5]).collect() == []
    assert hscan.prefix_sums(hscan.value_counts(df, [], "x"), [], "x", ["cnt"]).collect() == []


def test_partition_invariance(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(float(x),) for x in rng.normal(size=300)], "x double")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        res = []
        for n in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            res.append(sorted(r["q"] for r in hscan.exact_quantiles(df, [], "x", [0.1, 0.5]).collect()))
        assert res[0] == res[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_knn_join_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 5))
    x[10] = x[11]                                   # exact duplicate points
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(len(x))], "id long, vec array<double>")
    k = 7
    got = knn.knn_join(df, df, k, exclude_self=True, block=64).toPandas()
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    for q in (0, 10, 11, 123, 299):
        exp = sorted(range(len(x)), key=lambda r: (d[q, r], r))[:k]
        g = got[got.q_id == q].sort_values(["dist", "r_id"])
        assert list(g.r_id) == exp


def test_lof_matches_direct_formula(spark):
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(size=(80, 3)), [[6.0, 6.0, 6.0]]])
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(len(x))], "id long, vec array<double>")
    k = 5
    got = lof.lof_fit(df, k=k).toPandas().set_index("id").sort_index()
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    nn = np.array([sorted(range(len(x)), key=lambda r: (d[q, r], r))[:k] for q in range(len(x))])
    kd = np.array([d[q, nn[q]].max() for q in range(len(x))])
    lrd = np.array([1 / (np.mean(np.maximum(kd[nn[q]], d[q, nn[q]])) + 1e-10) for q in range(len(x))])
    lof_v = np.array([lrd[nn[q]].mean() / lrd[q] for q in range(len(x))])
    assert np.allclose(got["lof"].to_numpy(), lof_v, rtol=1e-9)
    assert got["lof"].idxmax() == 80


def test_ecod_matches_direct_formula(spark):
    rng = np.random.default_rng(6)
    tr = rng.lognormal(size=(200, 2)).round(2)
    cu = rng.lognormal(size=(50, 2)).round(2)
    tdf = spark.createDataFrame([(f"t{i}", *map(float, r)) for i, r in enumerate(tr)], "id string, a double, b double")
    cdf = spark.createDataFrame([(f"c{i}", *map(float, r)) for i, r in enumerate(cu)], "id string, a double, b double")
    got = ecod.ecod_scores(tdf, cdf, ["a", "b"], ["id"]).toPandas().set_index("id")
    u = np.vstack([tr, cu])
    for i in (0, 7, 49):
        s = 0.0
        for j in range(2):
            col = u[:, j]
            left = (col <= cu[i, j]).mean()
            right = (col >= cu[i, j]).mean()
            m3 = ((col - col.mean()) ** 3).mean()
            ul, ur = -np.log(left), -np.log(right)
            sk = ur if m3 > 0 else (ul if m3 < 0 else ul + ur)
            s += max(ul, ur, sk)
        assert math.isclose(got.loc[f"c{i}", "ecod_score"], s, rel_tol=1e-12)


def test_curve_metrics_match_direct(spark):
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, 400)
    s = (rng.normal(size=400) + y).round(1)          # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, score double")
    r = E.curve_metrics(E.score_table(df, "y", "score")).first()
    ranks = pd.Series(s).rank().to_numpy()
    n1, n0 = y.sum(), (1 - y).sum()
    auc = (ranks[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)
    ap = 0.0
    for t in np.unique(s)[::-1]:
        pred = s >= t
        tp = (pred & (y == 1)).sum()
        ap += ((s == t) & (y == 1)).sum() / n1 * tp / pred.sum()
    assert math.isclose(r["roc_auc"], auc, rel_tol=1e-12)
    assert math.isclose(r["pr_auc"], ap, rel_tol=1e-12)


def test_no_cartesian_product_in_psi_plan(spark):
    import io
    import contextlib
    from telemetra.jobs import drift_jobs
    df = drift_jobs.h11_psi_lineitem(spark, "/root/testdata/sf0.001")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    plan = buf.getvalue()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def _blob_with_outlier(spark, seed):
    rng = np.random.default_rng(seed)
    x = np.vstack([rng.normal(size=(300, 4)), [[8.0, 8.0, 8.0, 8.0]]])
    return spark.createDataFrame([(i, x[i].tolist()) for i in range(len(x))], "id long, vec array<double>")


def test_isolation_forest_deterministic_and_ranks_outlier(spark):
    from telemetra.operators.detect import iforest
    df = _blob_with_outlier(spark, 8)
    runs = []
    for _ in range(2):
        forest = iforest.fit_forest(df, "id", "vec", n_trees=50, max_samples=128, seed=7)
        runs.append(iforest.score_forest(df, "id", "vec", forest).toPandas().sort_values("id"))
    assert np.array_equal(runs[0]["iforest_score"].to_numpy(), runs[1]["iforest_score"].to_numpy())
    s = runs[0].set_index("id")["iforest_score"]
    assert s.idxmax() == 300 and 0 < s.min() and s.max() < 1


def test_rff_one_class_deterministic_and_ranks_outlier(spark):
    from telemetra.operators.detect import ocsvm
    df = _blob_with_outlier(spark, 9)
    gamma = ocsvm.gamma_scale(df, "vec", 4).first()["gamma_scale"]
    scores = []
    for _ in range(2):
        m = ocsvm.RffOneClass(4, gamma, nu=0.05, n_features=2048, seed=3).fit(df, "vec")
        scores.append(m.score(df, "id", "vec").toPandas().sort_values("id"))
    assert np.allclose(scores[0]["ocsvm_score"], scores[1]["ocsvm_score"])
    s = scores[0].set_index("id")["ocsvm_score"]
    assert s.idxmax() == 300


def test_ecod_ranks_new_values_in_the_training_ecdf(spark):
    train = [float(i * i) for i in range(20)]                   # skewed to the right
    new = {0: 1000.0, 1: 5.5, 2: -3.0, 3: 16.0, 4: 361.0}
    tdf = spark.createDataFrame([(i, v) for i, v in enumerate(train)], "id long, a double")
    cdf = spark.createDataFrame(list(new.items()), "id long, a double")
    got = {r["id"]: r["ecod_score"] for r in ecod.ecod_scores(tdf, cdf, ["a"], ["id"], union=False).collect()}
    ln = lambda n: math.inf if n == 0 else -math.log(n / len(train))
    for k, x in new.items():
        want = max(ln(sum(t <= x for t in train)), ln(sum(t >= x for t in train)))
        assert got[k] == want or math.isclose(got[k], want, rel_tol=1e-12)


def _lof_by_hand(train, new, k):
    """scikit-learn's novelty scores by the formula."""
    def lists(x, own):
        d = np.sqrt(((x[:, None, :] - train[None, :, :]) ** 2).sum(-1))
        if own:
            np.fill_diagonal(d, np.inf)
        order = np.lexsort((np.broadcast_to(np.arange(len(train)), d.shape), d), axis=1)[:, :k]
        return order, np.take_along_axis(d, order, 1)

    nn, dist = lists(train, True)
    kd = dist[:, -1]
    lrd = 1 / (np.maximum(kd[nn], dist).mean(1) + 1e-10)
    nn_new, dist_new = lists(new, False)
    lrd_new = 1 / (np.maximum(kd[nn_new], dist_new).mean(1) + 1e-10)
    return lrd[nn].mean(1) / lrd, lrd[nn_new].mean(1) / lrd_new


def test_one_neighbour_list_serves_every_k_and_new_rows(spark):
    rng = np.random.default_rng(8)
    x, y = rng.normal(size=(150, 4)), rng.normal(size=(30, 4)) * 2
    x[3] = x[4]
    vec = "id long, vec array<double>"
    train = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], vec)
    new = spark.createDataFrame([(1000 + i, v.tolist()) for i, v in enumerate(y)], vec)
    ks = [5, 11, 20]
    fitted = lof.lof_fit_list(train, ks).cache()
    scored = lof.lof_score_list(new, train, fitted, ks).toPandas()
    fit = fitted.toPandas()
    for k in ks:
        own, novel = _lof_by_hand(x, y, k)
        assert np.allclose(fit[fit.k == k].sort_values("id").lof, own, rtol=1e-9)
        assert np.allclose(scored[scored.k == k].sort_values("id").lof, novel, rtol=1e-9)
    one = lof.lof_fit(train, 11)
    assert np.allclose(lof.lof_score_new(new, train, one, 11).toPandas().sort_values("id").lof, _lof_by_hand(x, y, 11)[1])
    flagged = lof.lof_predict(lof.lof_score_list(new, train, fitted, ks), lof.lof_offsets(fitted, 0.05)).toPandas()
    for k in ks:
        own, novel = _lof_by_hand(x, y, k)
        cut = np.quantile(-own, 0.05)
        assert (flagged[flagged.k == k].sort_values("id").prediction.to_numpy() == (-novel < cut)).all()


def test_approximate_neighbours_recall(spark):
    rng = np.random.default_rng(9)
    x = np.vstack([rng.normal(size=(1500, 6)), rng.normal(size=(500, 6)) * 0.1 + 4, np.zeros((40, 6))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>").cache()
    exact = knn.knn_join(df, df, 30, exclude_self=True)
    found = knn.approximate_knn_join(df, df, 30, exclude_self=True, leaf_rows=200, block=64)
    row = knn.recall(found, exact).first()
    assert row.neighbours == 30 * len(x) and row.recall >= 0.9
    assert found.groupBy("q_id").count().agg({"count": "max"}).first()[0] <= 30
    assert knn.approximate_knn_join(df, df.limit(0), 3).count() == 0


def test_partitioned_selection_breaks_ties_by_id():
    x = np.array([[0.0], [1.0], [1.0], [-1.0], [2.0]])
    out = knn._nearest(np.array([7]), np.zeros((1, 1)), np.array([9, 4, 2, 3, 7]), x, 3, True)
    assert out.r_id.tolist() == [9, 2, 3] and out.dist.tolist() == [0.0, 1.0, 1.0]


def test_ecod_scores_are_the_same_by_ranges(spark):
    rng = np.random.default_rng(11)
    rows = [(i, float(round(a, 1)), None if i % 17 == 0 else float(b), float("nan") if i % 13 == 0 else 1.0)
            for i, (a, b) in enumerate(rng.normal(size=(500, 2)))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    new = spark.createDataFrame([(i, a * 3, b, 2.0) for i, a, b, _ in rows], "id long, a double, b double, c double")
    model = ecod.ecdf(ecod.value_table(df, ["a", "b", "c"]))
    whole = ecod.score_rows(new, ["a", "b", "c"], model).select("id", "ecod_score").toPandas().sort_values("id")
    parts = ecod.score_rows(new, ["a", "b", "c"], model, lookup_values=20, lookup_rows=60)
    assert "_ec_key" not in parts.columns
    parts = parts.select("id", "ecod_score").toPandas().sort_values("id")
    assert np.allclose(whole.ecod_score, parts.ecod_score, rtol=1e-12) and np.isinf(whole.ecod_score).all()
    plan = ecod.score_rows(new, ["a", "b", "c"], model)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Join" not in plan
