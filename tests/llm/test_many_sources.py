"""Targets of any number of sources, and training positions by numeric integration."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemetra.llm import mixing


def filled(sizes, weights, repeats, share):
    """Targets by raising the level until the words are shared out."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    cap = {s: n * repeats for s, n in sizes.items()}
    words = sum(sizes.values()) * share
    low, high = 0.0, float(max([1, *cap.values()]))
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(cap[s], level * w[s]) for s in sizes) < words else (low, level)
    return {s: min(cap[s], high * w[s]) for s in sizes}


@pytest.mark.parametrize("ranges", [None, 7])
@pytest.mark.parametrize("share", [1.0, 0.4])
def test_targets_equal_water_filling(spark, share, ranges):
    rng = np.random.default_rng(3)
    sizes = {f"s{i:03d}": int(n) for i, n in enumerate(rng.integers(0, 400, 90))} | {None: 1000, "": 3, "big": 90_000}
    sources = spark.createDataFrame(list(sizes.items()), "src string, source_size long")
    got = {r.src: r for r in mixing.source_targets(sources, (1, 2, 3), 3, share, ranges).collect()}
    want = filled(sizes, (1, 2, 3), 3, share)
    assert got.keys() == sizes.keys() and all(math.isclose(got[s].target, t, rel_tol=1e-6, abs_tol=1e-6) for s, t in want.items())
    assert got[None]["rank"] == len(sizes) - 1 and got[""]["rank"] == 0


@pytest.mark.parametrize("knots", [*mixing.SCHEDULES, ((0.0, 0.0), (0.3, 4.0), (0.6, 0.0), (0.8, 0.0), (1.0, 1.0))])
def test_positions_invert_the_integrated_schedule(spark, knots):
    us = [i / 64 for i in range(65)]
    got = [r.t for r in spark.createDataFrame([(u,) for u in us], "u double").coalesce(1)
           .select(mixing.inverse_demand(knots, F.col("u")).alias("t")).collect()]
    grid = np.linspace(0, 1, 200_001)
    density = np.interp(grid, *zip(*knots))
    area = np.concatenate([[0], np.cumsum((density[1:] + density[:-1]) / 2 * np.diff(grid))])
    for u, t in zip(us, got):
        assert abs(np.interp(t, grid, area) / area[-1] - u) < 1e-4, (u, t)
    assert all(a <= b + 1e-12 for a, b in zip(got, got[1:]))


def test_bad_schedules_are_refused():
    for knots in (((0.0, 1.0), (0.0, 1.0)), ((0.0, 0.0), (1.0, 0.0)), ((0.0, -1.0), (1.0, 1.0))):
        with pytest.raises(ValueError):
            mixing.inverse_demand(knots, F.lit(0.5))
