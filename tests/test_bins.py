"""Supervised bins of several variables at once against those of one, and a plain search."""

import numpy as np

from lendgrid.operators import risk_models as rm


def gini(y):
    return y.sum() - y.sum() ** 2 / len(y) if len(y) else 0.0


def plain(x, y, leaves, least):
    edges = []
    for _ in range(leaves - 1):
        best = None
        bounds = [-np.inf, *edges, np.inf]
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            m = (x > lo) & (x <= hi)
            v = np.unique(x[m])
            for a, b in zip(v, v[1:], strict=False):
                e = (a + b) / 2
                left, right = y[m & (x <= e)], y[m & (x > e)]
                gain = round(gini(y[m]) - gini(left) - gini(right), 9)
                if len(left) >= least and len(right) >= least and gain > 0 and (best is None or (gain, -e) > best):
                    best = (gain, -e)
        if best is None:
            break
        edges = sorted([*edges, -best[1]])
    return edges


def test_all_variables_at_once(spark):
    rng = np.random.default_rng(4)
    x = np.stack([rng.integers(0, 60, 1200), rng.integers(300, 500, 1200), rng.integers(0, 3, 1200), np.full(1200, 5)]).astype(float)
    y = (rng.random(1200) < np.where(x[0] > 40, 0.7, np.where(x[1] < 350, 0.5, 0.1))).astype(int)
    rows = [(*map(float, v), int(k)) for v, k in zip(x.T, y, strict=True)] + [(None, float("nan"), 1.0, None, None), (None, None, None, None, 1)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, y int")
    got = {r.variable: r.edges for r in rm.supervised_bins_of(df, ["a", "b", "c", "d"], "y", 4, 60).collect()}
    assert got == {n: plain(v, y, 4, 60) for n, v in zip("abcd", x, strict=True)} and got["d"] == [] and len(got["a"]) == 3
    assert got["b"] == rm.supervised_bins(df.where("NOT isnan(b)"), "b", "y", 4, 60)
