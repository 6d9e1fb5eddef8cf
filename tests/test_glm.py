"""Keyed Tweedie, logistic and hurdle fits against NumPy, each key on its own."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendgrid.operators import glm, risk_models as rm

XS = ["score_rf_bin", "risk_score_rf_bin"]


def grid(spark, seed=3):
    """Cells of three keys: mixed targets, targets above 0 only, zeros only; some without target, weight or feature."""
    rng = np.random.default_rng(seed)
    rows = []
    for key, zeros in (("mixed", 0.4), ("above", 0.0), ("none", 1.0)):
        for x in range(1, 5):
            for z in range(1, 5):
                for _ in range(3):
                    y = 0.0 if rng.uniform() < zeros else float(np.exp(0.2 * x - 0.3 * z + rng.normal(0, 0.3)))
                    rows.append((key, x, z, y, float(rng.uniform(1, 9))))
    rows += [("mixed", 1, 1, None, 5.0), ("mixed", 1, 1, 3.0, 0.0), ("mixed", 1, 1, 3.0, None), ("mixed", None, 1, 3.0, 2.0), ("empty", 1, 1, None, 1.0), (None, 2, 2, 1.0, 1.0)]
    return spark.createDataFrame(rows, "k string, score_rf_bin int, risk_score_rf_bin int, target double, todu_amt_pile_h6 double").repartition(4)


def arrays(df, key):
    rows = [r for r in df.collect() if r.k == key and None not in (r.target, r.todu_amt_pile_h6, r.score_rf_bin) and r.todu_amt_pile_h6 > 0]
    a = np.array([(r.score_rf_bin, r.risk_score_rf_bin, r.target, r.todu_amt_pile_h6) for r in rows], dtype=float)
    return np.column_stack([np.ones(len(a)), a[:, :2]]), a[:, 2], a[:, 3]


def coefficients(models, key):
    got = {r.feature: r.coefficient for r in models.collect() if r.k == key}
    return np.array([got["(intercept)"], *[got[x] for x in XS]])


@pytest.mark.parametrize("strength", [0.0, 0.05])
def test_tweedie_is_at_the_optimum(spark, strength):
    df = grid(spark)
    models = glm.fit_glm(df, XS, ["k"], "tweedie", strength=strength)
    for key in ("mixed", "above"):
        x, y, w = arrays(df, key)
        b = coefficients(models, key)
        mu = np.exp(x @ b)
        slope = x.T @ (w * (y - mu) * mu**-0.5) - strength * w.sum() * np.array([0, b[1], b[2]])  # of the quasi-likelihood: 0 at its maximum
        assert np.abs(slope).max() < 1e-7
    a, s = rm.fit_cells("tweedie", x[:, 1:], y, w, strength)
    assert np.allclose(b, [a, *s], atol=1e-6)


def test_logistic_is_at_the_optimum(spark):
    df = grid(spark).withColumn("target", F.when(F.col("target") > 0, 1.0).when(F.col("target") == 0, 0.0))
    b = coefficients(glm.fit_glm(df, XS, ["k"], "logistic", strength=0.01), "mixed")
    x, y, w = arrays(df, "mixed")
    slope = x.T @ (w * (y - 1 / (1 + np.exp(-x @ b)))) - 0.01 * w.sum() * np.array([0, b[1], b[2]])
    assert np.abs(slope).max() < 1e-8


def test_gaussian_and_a_dependent_feature(spark):
    df = grid(spark)
    x, y, w = arrays(df, "mixed")
    assert np.allclose(coefficients(glm.fit_glm(df, XS, ["k"], "gaussian"), "mixed"), np.linalg.lstsq(np.sqrt(w)[:, None] * x, np.sqrt(w) * y, rcond=None)[0])
    twice = glm.fit_glm(df.withColumn("again", F.col(XS[1]) * 2), [*XS, "again"], ["k"], "tweedie")
    assert {r.coefficient for r in twice.where("k = 'mixed' AND feature = 'again'").collect()} == {0.0}
    assert np.allclose(coefficients(twice, "mixed"), coefficients(glm.fit_glm(df, XS, ["k"], "tweedie"), "mixed"), atol=1e-8)


def test_keys_do_not_touch_each_other(spark):
    df = grid(spark)
    every = {(r.k, r.feature): r.coefficient for r in glm.fit_glm(df, XS, ["k"], "tweedie").collect()}
    for key in ("mixed", "above", "none"):
        alone = {(r.k, r.feature): r.coefficient for r in glm.fit_glm(df.where(F.col("k") == key), XS, ["k"], "tweedie").collect()}
        assert alone == {k: v for k, v in every.items() if k[0] == key} and all(np.isfinite(v) for v in alone.values())
    assert {k for k, _ in every} == {"mixed", "above", "none", None}


def test_hurdle(spark):
    df = grid(spark).where("k IS NOT NULL")
    out = glm.hurdle_glm(df, XS, ["k"], strength=0.01, ridge=0.0)
    assert out.count() == df.count()
    rows = out.collect()
    assert all(r.probability == 1.0 for r in rows if r.k == "above") and all(r.prediction == 0.0 for r in rows if r.k == "none")
    assert all(r.prediction is None for r in rows if r.k == "empty")
    x, y, w = arrays(df, "mixed")
    nz = (y > 0).astype(float)
    b = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ b))
        g = x.T @ (w * (nz - p)) - 0.01 * w.sum() * np.array([0, b[1], b[2]])
        b = b + np.linalg.solve(x.T @ ((w * p * (1 - p))[:, None] * x) + 0.01 * w.sum() * np.diag([0, 1, 1]), g)
    on = y > 0
    c = np.linalg.lstsq(np.sqrt(w[on])[:, None] * x[on], np.sqrt(w[on]) * y[on], rcond=None)[0]
    for r in rows:
        if r.k == "mixed" and r.score_rf_bin is not None:
            v = np.array([1, r.score_rf_bin, r.risk_score_rf_bin])
            assert abs(r.prediction - max(v @ c, 0) / (1 + np.exp(-v @ b))) < 1e-8


def folds(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(f, x, z, float(rng.uniform(1, 5)), float(rng.uniform(0, 1)), float(rng.uniform(5, 9)), float(np.exp(-0.3 * x + rng.normal(0, 0.1)))) for f in range(3) for x in range(1, 5) for z in range(1, 5)]
    return spark.createDataFrame(rows, "fold int, score_rf_bin int, risk_score_rf_bin int, vt double, validation double, todu_amt_pile_h6 double, target double")


def test_search(spark):
    one, two = folds(spark, 1), folds(spark, 2)
    scores = {r.name: r for r in rm.cv_results(rm.fold_scores(glm.glm_cv(one, XS))).collect()}
    assert len(scores) == 9
    plain = rm.cv_results(rm.fold_scores(rm.grid_cv(one, [(f"{n} {s:g}", n, XS, s, 0.0) for n, _, strengths in glm.GLM_GRID for s in strengths])))
    for r in plain.collect():
        assert abs(r.mean - scores[r.name].mean) < 1e-7 and abs(r.se - scores[r.name].se) < 1e-7
    fresh = {r.name: r.mean for r in rm.cv_results(rm.fold_scores(glm.glm_cv(two, XS))).collect()}
    got = {r.family: r for r in glm.glm_search(one, two, XS).collect()}
    for family in ("linear", "ridge", "tweedie"):
        best = min((round(r.mean, 9), n) for n, r in scores.items() if n.startswith(family))
        assert got[family].name == best[1] and abs(got[family].fresh_mean - fresh[best[1]]) < 1e-12


def test_nothing_to_fit_and_unknown_family(spark):
    df = grid(spark)
    assert glm.fit_glm(df.where("false"), XS, ["k"], "tweedie").count() == 0 and glm.hurdle_glm(df.where("false"), XS, ["k"]).count() == 0
    with pytest.raises(ValueError, match="unknown family"):
        glm.fit_glm(df, XS, ["k"], "poisson")
