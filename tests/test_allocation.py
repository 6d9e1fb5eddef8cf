"""Allocation by a tree of pairs against the fold, and against dynamic programming for many segments."""

import numpy as np

from lendgrid.operators import allocation as al

SCHEMA = "segment_cut_off string, solution string, oa_amt_h0 double, risk double"


def made_up(n, seed, points=5):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        p = np.cumsum(rng.integers(1, 40, points)) * 10.0
        r = np.sort(rng.integers(4, 20, points)).astype(float)
        rows += [(f"s{i:03d}", f"p{k}", float(p[k]), float(r[k])) for k in range(points)]
    return rows


def best(rows, target):
    """Most production for each total slack in tens, segment by segment; slacks are whole tens here."""
    reach = sum(abs(int(q * (r - target))) // 10 for _, _, q, r in rows) + 1
    at = np.full(2 * reach + 1, -np.inf)
    at[reach] = 0.0
    for seg in sorted({r[0] for r in rows}):
        new = np.full_like(at, -np.inf)
        for name, _, q, risk in rows:
            if name == seg:
                new = np.maximum(new, np.roll(at, int(round(q * (risk - target))) // 10) + q)
        at = new
    top = at[: reach + 1].max()
    return top if np.isfinite(top) else None


def test_tree_is_the_fold(spark):
    for seed in (1, 2):
        rows = made_up(5, seed)
        f = spark.createDataFrame([*rows, ("s000", "odd", None, 3.0)], SCHEMA)
        tree = sorted(map(tuple, al.allocate_tree(f, 9.0).collect()))
        fold = sorted(map(tuple, al.allocate_exact(f.where("solution <> 'odd'"), 9.0, sorted({r[0] for r in rows})).collect()))
        assert sum(r[2] for r in tree) == sum(r[2] for r in fold) == best(rows, 9.0) and len(tree) == 5
        assert sum(r[2] * (r[3] - 9.0) for r in tree) <= 0


def test_many_segments(spark):
    rows = made_up(200, 7)
    out = al.allocate_tree(spark.createDataFrame(rows, SCHEMA), 9.0).collect()
    assert len(out) == 200 and sum(r.oa_amt_h0 for r in out) == best(rows, 9.0)


def test_nothing_feasible(spark):
    rows = [(s, k, p, r + 20) for s, k, p, r in made_up(3, 1)]
    assert al.allocate_tree(spark.createDataFrame(rows, SCHEMA), 9.0).count() == 0
    assert al.allocate_tree(spark.createDataFrame([], SCHEMA), 9.0).count() == 0
    one = al.allocate_tree(spark.createDataFrame([("a", "x", 10.0, 5.0), ("a", "y", 20.0, 8.0), ("a", "z", 30.0, 12.0)], SCHEMA), 9.0).collect()
    assert [r.solution for r in one] == ["y"]
