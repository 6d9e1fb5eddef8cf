"""Models, folds and searches against plain NumPy; sinks against what was written."""

import hashlib
import json
import math
import random
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import Observation, functions as F

from lendgrid.functions import scalars as fn
from lendgrid.operators import cells as cl, consolidate as co, cutoffs as cut, population as pop, quality as dq, risk_models as rm, stability as st
from lendgrid.sources import applications as src, shared

X, Y = cl.CELL


@pytest.fixture(scope="module")
def grid(spark):
    rng = random.Random(3)
    rows = [(a, b, 0.02 * b + 0.01 * a + rng.random() * 0.02, 1000.0 + 500 * rng.random()) for a in range(1, 6) for b in range(1, 5)]
    return spark.createDataFrame(rows, f"{X} int, {Y} int, target double, todu_amt_pile_h6 double").cache()


def arrays(grid):
    rows = grid.orderBy(X, Y).collect()
    return np.array([[r[X], r[Y]] for r in rows], float), np.array([r.target for r in rows]), np.array([r.todu_amt_pile_h6 for r in rows])


def by_cell(df, c="prediction"):
    return np.array([r[c] for r in df.orderBy(X, Y).collect()])


def ridge(x, y, w, alpha):
    full = np.column_stack([np.ones(len(x)), x])
    return full @ np.linalg.solve(full.T @ (w[:, None] * full) + np.diag([0.0] + [alpha] * x.shape[1]), full.T @ (w * y))


@pytest.mark.parametrize("kind,strength", [("linear", 0.0), ("ridge", 50.0)])
def test_closed_form_models(grid, kind, strength):
    x, y, w = arrays(grid)
    want = ridge(x, y, w, strength)
    assert np.allclose(by_cell(rm.linear_risk_model(grid, cl.CELL, kind, strength).transform(grid)), want, atol=1e-7)
    a, b = rm.fit_cells(kind, x, y, w, strength)
    assert np.allclose(a + x @ b, want, atol=1e-9)


@pytest.mark.parametrize("kind,l1", [("lasso", 1.0), ("elastic_net", 0.5)])
def test_sparse_models_meet_their_conditions(grid, kind, l1):
    x, y, w = arrays(grid)
    v, strength = w / w.sum(), 0.003
    a, b = rm.fit_cells(kind, x, y, w, strength, l1)
    r = y - a - x @ b
    slope = (v[:, None] * x * r[:, None]).sum(axis=0) - strength * (1 - l1) * b
    assert abs((v * r).sum()) < 1e-9
    for g, c in zip(slope, b):
        assert abs(g - strength * l1 * np.sign(c)) < 1e-7 if c else abs(g) <= strength * l1 + 1e-9
    assert np.allclose(by_cell(rm.linear_risk_model(grid, cl.CELL, kind, strength, l1).transform(grid)), a + x @ b, atol=2e-4)


def test_tweedie_model(grid):
    x, y, w = arrays(grid)
    a, b = rm.fit_cells("tweedie", x, y, w)
    mu = np.exp(a + x @ b)
    score = np.column_stack([np.ones(len(x)), x]).T @ (w * (y - mu) * mu ** (1 - 1.5))
    assert np.abs(score).max() < 1e-3
    assert np.allclose(by_cell(rm.tweedie_model(grid, cl.CELL).transform(grid)), mu, rtol=1e-3)


def test_hurdle_predictions(spark, grid):
    whole = rm.hurdle_predictions(grid, cl.CELL)  # every target is above zero: the size alone
    x, y, w = arrays(grid)
    assert np.allclose(by_cell(whole), np.maximum(ridge(x, y, w, 0.0), 0), atol=1e-4)
    part = grid.withColumn("target", F.when(F.col(X) > 2, F.col("target")).otherwise(0.0))
    got = rm.hurdle_predictions(part, cl.CELL)
    assert got.columns == [*part.columns, "prediction"]
    p = by_cell(got)
    assert (p >= 0).all() and p[x[:, 0] == 1].max() < p[x[:, 0] == 5].min()


def records(spark, n=600):
    rng = random.Random(5)
    rows = [(i, rng.randint(1, 4), rng.randint(1, 4), round(100 + 900 * rng.random(), 2)) for i in range(n)]
    rows = [(i, a, b, round(t * 0.01 * (a + 2 * b) * rng.random(), 2), t) for i, a, b, t in rows]
    return rows, spark.createDataFrame(rows, f"authorization_id long, {X} int, {Y} int, todu_30ever_h6 double, todu_amt_pile_h6 double")


def fold_of(i, k, seed=17):
    return math.floor(int(hashlib.md5(f"{seed}|{i}".encode()).hexdigest()[:8], 16) / 2**32 * k)


def folds_brute(rows, k):
    s = defaultdict(lambda: np.zeros(2))
    for i, a, b, bad, t in rows:
        s[fold_of(i, k), a, b] += (bad, t)
    every = defaultdict(lambda: np.zeros(2))
    for (_, a, b), v in s.items():
        every[a, b] += v
    return {(f, a, b): (s[f, a, b], every[a, b] - s[f, a, b]) for f in range(k) for a, b in every}


def test_folds_and_cross_validation(spark):
    rows, df = records(spark)
    k, want = 3, folds_brute(rows, 3)
    folds = rm.fold_cells(df, k)
    got = {(r.fold, r[X], r[Y]): r for r in folds.collect()}
    assert got.keys() == want.keys()
    for key, (own, rest) in want.items():
        assert got[key].vt == pytest.approx(own[1]) and got[key].target == pytest.approx(7 * rest[0] / rest[1]) and got[key].todu_amt_pile_h6 == pytest.approx(rest[1])
    models = [("linear", "linear", list(cl.CELL), 0.0, 0.0), ("ridge", "ridge", [X, Y, f"{X}_2"], 30.0, 0.0)]
    p = rm.grid_cv(folds, models).cache()
    rmse = {(r.name, r.fold): r.rmse for r in rm.fold_scores(p).collect()}
    for name, _, features, alpha, _ in models:
        for f in range(k):
            cells = sorted(c[1:] for c in want if c[0] == f)
            x = np.array([[a, b, a * a][: len(features)] for a, b in cells], float)
            own, rest = (np.array([want[f, a, b][j] for a, b in cells]) for j in (0, 1))
            pred = ridge(x, 7 * rest[:, 0] / rest[:, 1], rest[:, 1], alpha)
            ok = own[:, 1] > 0
            err = math.sqrt((own[ok, 1] * (pred[ok] - 7 * own[ok, 0] / own[ok, 1]) ** 2).sum() / own[ok, 1].sum())
            assert rmse[name, f] == pytest.approx(err, rel=1e-8)
    ci = {(r[X], r[Y]): r for r in rm.cell_prediction_ci(p.where("name = 'linear'")).collect()}
    one = [r.prediction for r in p.where(f"name = 'linear' AND {X} = 2 AND {Y} = 3").collect()]
    assert ci[2, 3].n_folds == 3 and ci[2, 3].mean == pytest.approx(np.mean(one)) and ci[2, 3].high == pytest.approx(np.mean(one) + 1.96 * np.std(one, ddof=1))
    assert rm.grid_cv(folds, models, least_cells=17).count() == 0


def test_search_and_feature_sets(spark):
    _, df = records(spark)
    grid = [("ridge", (0.1, 1000.0), (0.0,)), ("lasso", (0.001, 5.0), (1.0,)), ("elastic_net", (0.01,), (0.5,)), ("tweedie", (0.0,), (0.0,)), ("linear", (0.0,), (0.0,))]
    got = {r.family: r for r in rm.hyperparameter_search(df, 4, rm.FEATURE_SETS["base"], grid).collect()}
    assert set(got) == {"ridge", "lasso", "elastic_net", "tweedie", "linear"}
    every = {r.name: r.mean for r in rm.cv_results(rm.fold_scores(rm.grid_cv(rm.fold_cells(df, 4), rm.grid_models(rm.FEATURE_SETS["base"], grid)))).collect()}
    assert got["ridge"].mean == pytest.approx(min(every["ridge 0.1"], every["ridge 1000"])) and got["lasso"].name == "lasso 0.001"
    fresh = {r.name: r.mean for r in rm.cv_results(rm.fold_scores(rm.grid_cv(rm.fold_cells(df, 4, 18), rm.grid_models(rm.FEATURE_SETS["base"], grid)))).collect()}
    assert all(r.fresh_mean == pytest.approx(fresh[r.name]) for r in got.values())
    sets = {r.name: r for r in rm.feature_set_cv(rm.fold_cells(df, 4)).collect()}
    assert len(sets) == 8 and sets["original"].mean == pytest.approx(sets["simple"].mean) and sets["full"].complexity == 9


def test_weighted_r2(spark):
    d = spark.createDataFrame([("a", 1.0, 1.0, 2.0), ("a", 3.0, 2.0, 1.0), ("b", 1.0, 1.0, 1.0)], "k string, target double, prediction double, todu_amt_pile_h6 double")
    got = {r.k: r.r2 for r in rm.weighted_r2(d, ["k"]).collect()}
    mean = 5 / 3
    assert got["a"] == pytest.approx(1 - 1 / (2 * (1 - mean) ** 2 + (3 - mean) ** 2)) and got["b"] is None


def test_weighted_r2_of_equal_targets(spark):
    """Rounding leaves the sums apart by a little where all targets are equal: there is nothing to explain, whatever the weights."""
    rng = random.Random(3)
    d = spark.createDataFrame([(str(k), 0.12, 0.12, rng.uniform(4e9, 8e9)) for k in range(20) for _ in range(16)], "k string, target double, prediction double, todu_amt_pile_h6 double")
    assert [r.r2 for r in rm.weighted_r2(d, ["k"]).collect()] == [None] * 20


def bins_brute(xs, ys, leaves, least):
    edges = []
    for _ in range(leaves - 1):
        found = []
        bounds = [-math.inf, *edges, math.inf]
        for lo, hi in zip(bounds, bounds[1:]):
            own = [(x, y) for x, y in zip(xs, ys) if lo < x <= hi]
            values = sorted({x for x, _ in own})
            rest = lambda part: sum(y for _, y in part) * (1 - sum(y for _, y in part) / len(part))
            for a, b in zip(values, values[1:]):
                left, right = [p for p in own if p[0] <= a], [p for p in own if p[0] > a]
                if len(left) >= least and len(right) >= least and (gain := round(rest(own) - rest(left) - rest(right), 9)) > 0:
                    found.append((-gain, (a + b) / 2))
        if not found:
            break
        edges = sorted([*edges, min(found)[1]])
    return edges


def test_supervised_bins(spark):
    rng = random.Random(8)
    xs = [float(rng.randint(0, 40)) for _ in range(600)]
    ys = [int(rng.random() < (0.1 if x < 12 else 0.6 if x < 25 else 0.3)) for x in xs]
    d = spark.createDataFrame([*zip(xs, ys), (None, 1)], "x double, y int")
    for leaves, least in ((2, 30), (4, 30), (5, 100)):
        got = rm.supervised_bins(d, "x", "y", leaves, least)
        assert got == bins_brute(xs, ys, leaves, least) and len(got) >= 1
    assert rm.supervised_bins(d, "x", "y", 3, 400) == []


def test_combined_score_is_at_its_optimum(spark):
    rng = random.Random(2)
    rows = [(i, rng.gauss(0, 2), rng.gauss(5, 1)) for i in range(400)]
    rows = [(i, a, b, int(rng.random() < 1 / (1 + math.exp(-a + 0.5 * (b - 5))))) for i, a, b in rows]
    d = spark.createDataFrame(rows, "id long, a double, b double, y int")
    got = rm.combined_score(d, ["a", "b"], "y").orderBy("id").collect()
    z = np.array([[r.a, r.b] for r in got])
    z = (z - z.mean(axis=0)) / z.std(axis=0, ddof=1)
    full, y, b = np.column_stack([np.ones(len(z)), z]), np.array([r.y for r in got]), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-full @ b))
        b = b - np.linalg.solve(full.T @ ((p * (1 - p))[:, None] * full) + np.diag([0, 1.0, 1.0]), full.T @ (p - y) + np.array([0, b[1], b[2]]))
    assert np.allclose([r.combined for r in got], full @ b, atol=1e-4)


def test_scores_in_a_session_that_has_observed(spark):
    """An observation leaves something in the session that can't go to tasks: logistic models must not take the session along."""
    seen = Observation()
    spark.range(5).observe(seen, F.count("*").alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 5
    rows = [(i, float(i % 7), float(i % 5), int(i % 7 > 3) if i % 3 else 0, 1.0 + i % 2) for i in range(60)]
    d = spark.createDataFrame(rows, "id long, a double, b double, y int, todu_amt_pile_h6 double")
    assert len(rm.combined_score(d.withColumn("c", F.lit(4.0)), ["a", "b", "c"], "y").where("combined is not null").collect()) == 60
    p = [r.prediction for r in rm.hurdle_predictions(d.withColumn("target", F.col("y") * 2.0), ["a", "b"]).collect()]
    assert len(p) == 60 and all(0 <= x <= 2.001 for x in p) and max(p) > 0.5


def test_saved_models_score_alike(grid, tmp_path):
    m = rm.linear_risk_model(grid, cl.CELL)
    rm.save_model(m, str(tmp_path / "m"), cl.CELL, kind="linear")
    assert np.allclose(by_cell(rm.batch_score(str(tmp_path / "m"), grid)), by_cell(m.transform(grid)))
    with pytest.raises(ValueError):
        rm.batch_score(str(tmp_path / "m"), grid.drop(X))


def test_alerts_are_json(spark, tmp_path):
    report = spark.createDataFrame([("score_rf", 0.31), ("oa_amt", 0.02), ("__overall__", 0.12)], "variable string, psi double")
    report = report.select("variable", "psi", fn.stability_status(F.col("psi")).alias("status"), fn.severity(F.col("psi")).alias("severity"))
    a = st.drift_alerts(report, "all", "recent")
    src.write_alerts(a, str(tmp_path / "alerts"))
    got = [json.loads(line) for f in Path(tmp_path / "alerts").glob("*.json") for line in f.read_text().splitlines()]
    assert {(x["variable"], x["severity"], x["psi_value"]) for x in got} == {("score_rf", "critical", 0.31), ("oa_amt", "info", 0.02), ("__overall__", "warning", 0.12)}


def test_monomials(spark):
    d = pop.monomial_features(spark.createDataFrame([(2, 3, 5)], "a int, b int, c int"), ["a", "b", "c"], 3).first().asDict()
    assert len(d) == 19 and d["a_2_x_c"] == 20.0 and d["a_x_b_x_c"] == 30.0 and d["c_3"] == 125.0


def test_projections_of_masks(spark):
    rows = [("s", a, b, c, int(a + b + c <= 4)) for a in (1, 2, 3) for b in (1, 2) for c in (1, 2)]
    got = {(r.dimension, r.bin): r.accepted for r in cut.mask_projections(spark.createDataFrame(rows, "solution string, a int, b int, c int, accept int"), ["a", "b", "c"]).collect()}
    assert got == {("a", 1.0): 1, ("a", 2.0): 1, ("a", 3.0): 0, ("b", 1.0): 1, ("b", 2.0): 1, ("c", 1.0): 1, ("c", 2.0): 1}


def test_risk_intervals(spark):
    d = spark.createDataFrame([("m", "a", None, "x", 1.0, 2.0), ("m", "b", None, "x", 2.0, 4.0), ("m", "c", None, "sure", 3.0, 3.0)], "scenario string, segment string, supersegment string, metric string, risk_low double, risk_high double").withColumn("period", F.lit("p"))
    got = {(r.level, r.name, r.metric): r for r in co.combine_risk_ci(d).collect()}
    half = math.sqrt(0.5**2 + 1.0**2)
    t = got["total", "TOTAL", "x"]
    assert t.risk_ci_lower == pytest.approx(4.5 - half) and t.risk_ci_upper == pytest.approx(4.5 + half)
    assert (got["segment", "c", "sure"].risk_ci_lower, got["segment", "c", "sure"].risk_ci_upper) == (0, 0)


def test_lowest_edge_is_inside(spark):
    d = spark.createDataFrame([(float(i),) for i in range(300, 400)], "x double")
    assert pop.outside_share(d, "x", 300.0, 399.0).first().outside == 0
    assert pop.bin_scores_clamped(d, "x", [300, 350, 399], quota=0.0).count() == 100


def test_direction_weighs_by_amount(spark):
    rows = [(b, 1.0 + 0.4 * b, 10.0, 1.0 if b < 4 else 1000.0) for b in range(1, 6)]
    got = cut.infer_direction(spark.createDataFrame(rows, "v int, todu_30ever_h6 double, todu_amt_pile_h6 double, oa_amt double"), "v", 400).first()
    assert got.direction == 1 and got.covariance > 0
    flat = spark.createDataFrame([(b, 1.0 + 1e-6 * b, 10.0, 1.0) for b in range(1, 6)], "v int, todu_30ever_h6 double, todu_amt_pile_h6 double, oa_amt double")
    assert cut.infer_direction(flat, "v", 50).first().covariance == pytest.approx(0, abs=1e-12)  # equal once rounded


def test_sketches_agree_with_exact_quantiles(spark):
    rng = random.Random(1)
    d = spark.createDataFrame([(rng.gauss(10, 2),) for _ in range(2000)] + [(500.0,)] * 40, "x double")
    a, b = dq.check_outliers(d, ["x"]).first(), dq.check_outliers(d, ["x"], approximate=True).first()
    assert abs(a.n_outliers - b.n_outliers) <= 2 and a.status == b.status == "warn"
    assert abs(dq.profile(d, approximate=True).first().n_distinct - 2001) < 60


def test_prepared_table_follows_its_files(spark, tmp_path):
    for t in ("orders", "customer", "lineitem"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    n = shared.prepared(spark, str(tmp_path)).count()
    path = dict(spark.__dict__["_lendgrid_prepared"])
    assert shared.prepared(spark, str(tmp_path)).count() == n and spark.__dict__["_lendgrid_prepared"] == path
    spark.read.parquet("/root/testdata/sf0.001/orders.parquet").limit(10).write.mode("overwrite").parquet(str(tmp_path / "orders.parquet"))
    assert shared.prepared(spark, str(tmp_path)).count() == 10
