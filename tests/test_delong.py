"""The matrix of AUC covariances against NumPy."""

import numpy as np

from lendgrid.operators import discrimination as dis


def placements(s, y):
    a, b = s[y == 1], s[y == 0]
    win = (a[:, None] > b[None, :]) + 0.5 * (a[:, None] == b[None, :])
    return win.mean(axis=1), win.mean(axis=0)


def test_delong_matrix(spark):
    rng = np.random.default_rng(6)
    rows, want = [], {}
    for g in ("a", "b"):
        y = rng.integers(0, 2, 300)
        s = np.stack([np.round(y + rng.normal(size=300), 1), rng.integers(0, 5, 300) + y, -rng.normal(size=300)])
        rows += [(g, int(k), *map(float, (v[0], v[1], -v[2]))) for k, v in zip(y, s.T, strict=True)]
        v10, v01 = zip(*[placements(x, y) for x in s], strict=True)
        cov = np.cov(v10) / (y == 1).sum() + np.cov(v01) / (y == 0).sum()
        want |= {(g, i, j): (np.mean(v10[i]), np.mean(v10[j]), cov[i, j], cov[i, i] + cov[j, j] - 2 * cov[i, j]) for i in range(3) for j in range(i, 3)}
    rows += [("a", None, 1.0, 1.0, 1.0), ("a", 1, None, 1.0, 1.0), ("single", 1, 1.0, 2.0, 3.0), ("single", 1, 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "g string, y int, p double, q double, r double")
    names = ["p", "q", "r"]
    out = dis.delong_matrix(df, {"p": False, "q": False, "r": True}, "y", ["g"]).collect()
    for r in out:
        if r.g == "single":
            assert r.auc_first is None and r.covariance is None and r.p_value is None
            continue
        first, second, cov, var = want[r.g, names.index(r.first), names.index(r.second)]
        assert np.allclose([r.auc_first, r.auc_second, r.covariance], [first, second, cov])
        assert r.first == r.second or np.isclose(r.standard_error, np.sqrt(var)) and np.isclose(r.z, (first - second) / np.sqrt(var))
    assert len(out) == 18
