"""The monotone surface against the min-max formula over all staircases."""

from itertools import product

import numpy as np
import pytest

from lendgrid.operators.isotonic import monotone_surface

CELLS = "k string, score_rf_bin int, risk_score_rf_bin int, a double, w double"


def min_max(a, w):
    """Fit of rows (safest last) by columns (safest first): the largest, over upper sets, of the least average with a lower set."""
    n0, n1 = a.shape
    stairs = [s for s in product(range(n1 + 1), repeat=n0) if all(x <= y for x, y in zip(s, s[1:], strict=False))]
    sets = [np.array([[j < s[i] for j in range(n1)] for i in range(n0)]) for s in stairs]  # lower sets
    fit = np.full((n0, n1), -np.inf)
    for up in sets:
        for i, j in zip(*np.nonzero(~up & (w > 0)), strict=True):
            low = min(a[m].sum() / w[m].sum() for s in sets if s[i, j] for m in [~up & s])
            fit[i, j] = max(fit[i, j], low)
    return fit


@pytest.mark.parametrize("shape", [(3, 3), (4, 3)])
def test_against_min_max(spark, shape):
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for key in ("noise", "monotone", "falling", "gaps"):
        n0, n1 = shape
        i, j = np.mgrid[0:n0, 0:n1]
        y = {"noise": rng.uniform(0, 1, shape), "monotone": 0.1 * (n0 - i) + 0.2 * j, "falling": 1.0 * i - 1.0 * j + 5, "gaps": rng.uniform(0, 1, shape)}[key]
        w = rng.uniform(1, 9, shape)
        if key == "gaps":
            w[0, 1] = w[2, 2] = 0.0
        fit = min_max(y * w, w)
        rows += [(key, int(p + 1), int(q + 1), float(y[p, q] * w[p, q] / 7), float(w[p, q])) for p in range(n0) for q in range(n1)]
        want |= {(key, p + 1, q + 1): fit[p, q] for p in range(n0) for q in range(n1) if w[p, q] > 0}
    df = spark.createDataFrame(rows, CELLS)
    out = monotone_surface(df, list(range(shape[0], 0, -1)), list(range(1, shape[1] + 1)), "a", "w", ["k"])
    got = {(r.k, r.score_rf_bin, r.risk_score_rf_bin): (r.ratio, r.fitted) for r in out.collect()}
    assert set(got) == set(want) and all(abs(got[k][1] - want[k]) < 1e-9 for k in want)
    assert all(abs(a - b) < 1e-9 for (k, *_), (a, b) in got.items() if k == "monotone")
    assert len({round(b, 9) for (k, *_), (_, b) in got.items() if k == "falling"}) == 1


def test_no_cells(spark):
    assert monotone_surface(spark.createDataFrame([], CELLS), [2, 1], [1, 2], "a", "w", ["k"]).count() == 0
