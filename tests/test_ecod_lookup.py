import numpy as np
from telemetra.operators.detect import ecod


def test_one_look_up_gives_both_tails():
    rng = np.random.default_rng(1)
    x = np.unique(rng.normal(size=300).round(1))
    cnt = rng.integers(1, 9, len(x))
    cum, n = np.cumsum(cnt).astype(float), float(cnt.sum())
    v = np.concatenate([x, x + 0.05, [-99.0, 99.0, np.nan, np.inf, -np.inf]])
    for sign in (-1.0, 0.0, 1.0):
        got = ecod._outlyingness(v, x, ecod._steps(cum, 0.0), n, sign)
        with np.errstate(divide="ignore"):
            left = np.array([-np.log(cnt[x <= t].sum() / n) for t in v])
            right = np.array([-np.log(cnt[x >= t].sum() / n) for t in v])
        want = np.maximum(np.maximum(left, right), left + right if sign == 0 else left if sign < 0 else right)
        assert np.allclose(got, np.where(np.isnan(v), 0.0, want), rtol=1e-12)
    assert (ecod._outlyingness(v, np.zeros(0), np.zeros(1), n, 1.0)[:-3] == np.inf).all()


def test_rows_reach_the_score_as_arrow_columns(spark):
    """No struct and no pandas frame a batch: the plan evaluates an Arrow function on plain columns."""
    df = spark.range(100).selectExpr("id", "cast(id % 7 as double) a", "cast(if(id % 5 = 0, null, id) as double) b")
    scored = ecod.score_rows(df, ["a", "b"], ecod.ecdf(ecod.value_table(df, ["a", "b"])))
    assert "struct" not in scored._jdf.queryExecution().optimizedPlan().toString().lower()
    assert scored.where("ecod_score IS NULL OR isnan(ecod_score)").count() == 0
