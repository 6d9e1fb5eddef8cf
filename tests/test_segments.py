"""Keyed models against NumPy, and the levels that segments fall back to."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendgrid.operators import segment_models as sm

SCHEMA = "segment_cut_off string, score_rf_bin int, risk_score_rf_bin int, oa_amt_h0 double, todu_amt_pile_h6 double, todu_30ever_h6 double"


def booked_rows(segments, seed=3):
    rng = np.random.default_rng(seed)
    out = []
    for name, cells in segments.items():
        for k in range(cells):
            x, z = 1 + k // 4, 1 + k % 4
            for _ in range(4):
                t = float(round(rng.uniform(500, 5000), 2))
                out.append((name, x, z, round(t * 0.9, 2), t, round(t * (0.01 * x + 0.02 * z) * rng.uniform(0.8, 1.2) / 7, 2)))
    return out


@pytest.mark.parametrize("ridge", [0.0, 25.0])
def test_fit_keyed(spark, ridge):
    rng = np.random.default_rng(1)
    data = {k: (rng.normal(size=(20, 3)), rng.normal(size=20), rng.uniform(0.1, 5, 20)) for k in ("a", "b", None)}
    rows = [(k, *map(float, x), float(y), float(w)) for k, (xs, ys, ws) in data.items() for x, y, w in zip(xs, ys, ws, strict=True)]
    rows += [("a", None, 1.0, 1.0, 1.0, 1.0), ("a", 1.0, 1.0, 1.0, None, 1.0), ("a", 9.0, 9.0, 9.0, 9.0, 0.0)]
    df = spark.createDataFrame(rows, "k string, p double, q double, r double, y double, w double").where("k IS NOT NULL")
    got = {(r.k, r.feature): r.coefficient for r in sm.fit_keyed(df, ["p", "q", "r"], ["k"], "y", "w", ridge).collect()}
    for k in ("a", "b"):
        x, y, w = data[k]
        mx, my = np.average(x, axis=0, weights=w), np.average(y, weights=w)
        b = np.linalg.solve((x - mx).T @ (w[:, None] * (x - mx)) + ridge * np.eye(3), (x - mx).T @ (w * (y - my)))
        assert np.allclose([got[k, f] for f in ("p", "q", "r")], b) and np.isclose(got[k, sm.INTERCEPT], my - mx @ b)


def test_dependent_and_constant_features(spark):
    rows = [("a", float(i), 2.0 * i, 5.0, 3.0 * i + 1, 1.0) for i in range(6)] + [("one", 2.0, 4.0, 5.0, 7.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, p double, q double, c double, y double, w double")
    m = sm.fit_keyed(df, ["p", "q", "c"], ["k"], "y", "w")
    got = {(r.k, r.feature): round(r.coefficient, 9) for r in m.collect()}
    assert [got["a", f] for f in ("p", "q", "c", sm.INTERCEPT)] == [3.0, 0.0, 0.0, 1.0]
    assert got["one", "p"] == 0.0 and got["one", sm.INTERCEPT] == 7.0
    p = sm.predict_keyed(df.unionByName(df.where("k = 'a'").withColumn("k", F.lit("new"))), m, ["k"], ["p", "q", "c"])
    assert {(r.k, r.prediction is None or abs(r.prediction - r.y) < 1e-9) for r in p.collect()} == {("a", True), ("one", True), ("new", True)}
    assert p.where("k = 'new' AND prediction IS NOT NULL").count() == 0
    assert sm.fit_keyed(df.where("false"), ["p"], ["k"], "y", "w").count() == 0


def test_segments_fall_back(spark):
    df = spark.createDataFrame(booked_rows({"own": 16, "small": 6, "sister": 14, "lonely": 5}), SCHEMA)
    m = sm.segment_models(df, ["score_rf_bin", "risk_score_rf_bin"], {"pair": ["small", "sister"], "wide": ["small", "own"]}, 12).cache()
    used = {(r.segment_cut_off, r.level, r.name) for r in m.collect()}
    assert used == {("own", "segment", "own"), ("small", "supersegment", "pair"), ("sister", "segment", "sister"), ("lonely", "all", "all")}
    assert m.groupBy("segment_cut_off").count().where("count = 5").count() == 4
    few = sm.segment_models(df.where("segment_cut_off = 'lonely'"), ["score_rf_bin", "risk_score_rf_bin"], {}, 12)
    assert {r.level for r in few.collect()} == {"all"}


def test_summary_of_segments_scores_rejects_by_their_model(spark):
    rows = booked_rows({"own": 16, "sister": 16})
    d = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'booked' AS status_name", "cast(null AS string) AS reject_reason", "oa_amt_h0 AS oa_amt", "400.0D AS score_rf")
    r = spark.createDataFrame([("own", 2, 3, 1000.0), ("fresh", 1, 1, 500.0)], "segment_cut_off string, score_rf_bin int, risk_score_rf_bin int, oa_amt double")
    d = d.unionByName(r.selectExpr("*", "'rejected' AS status_name", "'09-score' AS reject_reason", "0.0D AS todu_30ever_h6", "0.0D AS todu_amt_pile_h6", "oa_amt AS oa_amt_h0", "300.0D AS score_rf"))
    f = ["score_rf_bin", "risk_score_rf_bin"]
    m = sm.segment_models(d.where("status_name = 'booked'"), f, {}, 12)
    out = {(x.segment_cut_off, x.score_rf_bin, x.risk_score_rf_bin): x for x in sm.segment_cell_summary(d, m, f).collect()}
    c = {(x.kind, x.feature): x.coefficient for x in m.where("segment_cut_off = 'own'").collect()}
    got = out["own", 2, 3]
    ratio = c["risk", sm.INTERCEPT] + 2 * c["risk", "score_rf_bin"] + 3 * c["risk", "risk_score_rf_bin"]
    exposure = c["exposure", sm.INTERCEPT] + 1000 * c["exposure", "oa_amt_h0"]
    assert np.isclose(got.todu_amt_pile_h6_rep, exposure) and np.isclose(got.todu_30ever_h6_rep, ratio * exposure / 7 * (1 + 1.5 * 0.2))
    assert np.isclose(got.oa_amt_h0, got.oa_amt_h0_boo + 1000) and len(out) == 33
    assert out["fresh", 1, 1].todu_30ever_h6_rep == 0.0  # a segment without booked records has no model: nothing is made up
