"""Small hand-computed frames for the portfolio operators, and invariants between them."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lendgrid.functions import scalars as fn
from lendgrid.operators import allocation as al, audit as au, cells as cl, consolidate as co, cutoffs as cut, discrimination as dis, monitoring as mon, population as pop, quality as dq, risk_models as rm, stability as st
from lendgrid.sources import applications as src


def test_right_closed_bins(spark):
    d = spark.createDataFrame([(320.0, 10.0), (350.0, 20.0), (350.1, 20.5), (380.0, 55.0), (450.0, 80.0), (900.0, 95.0), (None, 1.0)], "score_rf double, risk_score_rf double")
    got = [(r.score_rf_bin, r.risk_score_rf_bin) for r in pop.bin_scores(d).collect()]
    assert got == [(1, 1), (1, 1), (2, 2), (2, 3), (3, 3), (4, 4)]


def test_quota_of_clamped_bins(spark):
    d = spark.createDataFrame([(float(i),) for i in range(1, 101)], "x double")
    with pytest.raises(ValueError):
        pop.bin_scores_clamped(d, "x", [0, 50, 90])
    assert {r[0] for r in pop.bin_scores_clamped(d, "x", [0, 50, 99]).select("x_bin").collect()} == {1, 2}


def test_risk_ratio_and_its_inverse(spark):
    d = spark.createDataFrame([(10.0, 100.0), (0.0, 0.0), (1.0, None)], "a double, t double")
    r = d.select(fn.risk_ratio(F.col("a"), F.col("t")).alias("r"), fn.risk_ratio(F.col("a"), F.col("t"), percent=True).alias("p")).collect()
    assert [tuple(x) for x in r] == [(0.7, 70.0), (None, None), (None, None)]
    assert d.select(fn.arrears_from_ratio(F.lit(0.7), F.col("t"))).first()[0] == pytest.approx(10.0)


def test_status_update_order(spark):
    d = spark.createDataFrame([("booked", None, "n", "n"), ("booked", None, "y", "n"), ("canceled", None, "n", "y"), ("booked", None, "y", "y")], "status_name string, reject_reason string, m_ct_direct_sc_a string, m_ct_direct_b string")
    assert [tuple(r)[:2] for r in pop.update_status(d).collect()] == [("booked", None), ("rejected", "09-score"), ("rejected", "08-other"), ("rejected", "09-score")]


def test_dates_and_segments(spark):
    d = spark.createDataFrame([("machinery",), ("building",), ("automobile",), ("my machinery",)], "segment_cut_off string")
    assert pop.segment_filter(d, "mach|auto").count() == 2 and pop.segment_filter(d, "building").count() == 1
    with pytest.raises(ValueError):
        pop.filter_by_date(d, "2024-02-01", "2024-01-01")
    assert pop.assign_segments(d).groupBy("level").count().where("level = 'supersegment'").first()["count"] == 2


def test_quality_checks(spark):
    d = spark.createDataFrame([(1, 5.0, "booked")] * 98 + [(2, None, "rejected"), (3, 1e6, "Booked")], "k int, x double, status_name string")
    assert dq.check_missing(d, ["x"]).first().status == "pass"
    assert dq.check_outliers(d, ["x"]).first().n_outliers == 1
    assert dq.check_duplicates(d, ["k"]).first().n_duplicates == 97
    assert dq.check_booked_ratio(d).first().share == pytest.approx(0.99)
    same = spark.createDataFrame([(1.0,)] * 5, "x double")
    assert dq.check_outliers(same, ["x"]).count() == 0
    with pytest.raises(ValueError):
        dq.validate_or_fail(spark.createDataFrame([("missing", "fail")], "name string, status string"))


def test_standardise(spark):
    d = spark.createDataFrame([("A b", float("nan"))], ["Some Name", "X"])
    assert src.standardise(d).columns == ["some_name", "x"] and tuple(src.standardise(d).first()) == ("a_b", None)


def long(spark, y, s):
    return spark.createDataFrame([("m", i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, s))], "score_name string, id long, y int, s double")


def test_perfect_and_random_scores(spark):
    m = dis.auc_gini_ks(long(spark, [0] * 5 + [1] * 5, [i / 10 for i in range(1, 11)])).first()
    assert (m.auc, m.gini, m.ks) == (1.0, 1.0, 1.0)
    t = dis.auc_gini_ks(long(spark, [0, 1, 0, 1], [1, 1, 1, 1])).first()
    assert (t.auc, t.gini, t.ks) == (0.5, 0.0, 0.0)
    assert dis.auc_gini_ks(long(spark, [0, 0], [1, 2])).first().auc is None


def test_auc_delong_and_lift_against_brute_force(spark):
    rng = random.Random(3)
    y = [rng.random() < 0.3 for _ in range(200)]
    s = [round(rng.gauss(1.0 if v else 0.0, 1.0), 1) for v in y]
    pos, neg = [b for a, b in zip(y, s) if a], [b for a, b in zip(y, s) if not a]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    m = dis.auc_gini_ks(long(spark, y, s)).first()
    assert m.auc == pytest.approx(auc) and m.gini == pytest.approx(2 * auc - 1)
    s2 = [rng.gauss(0.4 if v else 0.0, 1.0) for v in y]
    both = long(spark, y, s).union(long(spark, y, s2).withColumn("score_name", F.lit("n")))
    d = dis.delong(both, "m", "n").first()
    v10 = lambda sc: [sum((a > b) + 0.5 * (a == b) for b in [q for w, q in zip(y, sc) if not w]) / len(neg) for a in [q for w, q in zip(y, sc) if w]]
    v01 = lambda sc: [sum((a > b) + 0.5 * (a == b) for a in [q for w, q in zip(y, sc) if w]) / len(pos) for b in [q for w, q in zip(y, sc) if not w]]
    var = lambda x: sum((v - sum(x) / len(x)) ** 2 for v in x) / (len(x) - 1)
    d10, d01 = [a - b for a, b in zip(v10(s), v10(s2))], [a - b for a, b in zip(v01(s), v01(s2))]
    assert d.standard_error == pytest.approx(math.sqrt(var(d10) / len(pos) + var(d01) / len(neg)))
    assert d.p_value == pytest.approx(math.erfc(abs(d.z) / math.sqrt(2)), abs=1e-6)
    lift = dis.lift_table(long(spark, y, s)).orderBy("bin").collect()
    assert [r.n_records for r in lift] == [20] * 10 and lift[-1].cumulative_pct_bads == 1.0 and sum(r.n_bads for r in lift) == len(pos)
    pr = dis.precision_recall(long(spark, y, s)).orderBy("s").first()
    assert pr.recall == 1.0 and pr.precision == pytest.approx(len(pos) / 200)
    boot = dis.bootstrap_gini_ks(long(spark, y, s), 50).first()
    assert boot.gini_low < m.gini < boot.gini_high


def test_psi_of_equal_samples_is_zero(spark):
    d = spark.createDataFrame([(float(i % 37),) for i in range(500)], "x double")
    assert st.psi(d, d, ["x"]).first().psi == pytest.approx(0.0, abs=1e-12)
    moved = d.select((F.col("x") + 30).alias("x"))
    assert st.stability_report(d, moved, ["x"]).first().status == "unstable"
    counts = {r.severity: r.n for r in st.alert_counts(st.drift_alerts(st.stability_report(d, moved, ["x"]), "s", "p")).collect()}
    assert counts == {"info": 0, "warning": 0, "critical": 1}
    cats = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert st.csi(cats, cats, "c").first().csi == pytest.approx(0.0, abs=1e-12)


def test_uplift_and_acceptance(spark):
    d = spark.createDataFrame([(1, 1, "booked", None)] * 3 + [(1, 1, "rejected", "09-score"), (1, 2, "rejected", "08-other")], "score_rf_bin int, risk_score_rf_bin int, status_name string, reject_reason string")
    r = {x.risk_score_rf_bin: x.acceptance_rate for x in cl.acceptance_rates(d).collect()}
    assert r == {1: 0.75, 2: 1.0}
    c = spark.createDataFrame([(1, 1, 100.0), (9, 9, 10.0)], "score_rf_bin int, risk_score_rf_bin int, todu_30ever_h6_rep double")
    up = {x.score_rf_bin: x.todu_30ever_h6_rep for x in cl.reject_uplift(c, cl.acceptance_rates(d)).collect()}
    assert up == {1: 137.5, 9: 10.0}


def test_rolling_and_anomalies(spark):
    s = spark.createDataFrame([(f"2024-{m:02d}", float(v)) for m, v in enumerate([10, 11, 9, 10, 10, 11, 50, 10], 1)], "month string, v double")
    r = mon.spc_anomalies(s, "v", window=6).orderBy("month").collect()
    assert [x.anomaly for x in r][:6] == ["none"] * 6 and r[6].anomaly == "above" and r[5].center is None
    roll = s.select("month", mon.rolling_sum("v", "month", 3).alias("x")).orderBy("month").collect()
    assert [x.x for x in roll][:4] == [None, None, 30.0, 30.0]


def grid(spark, seed, n=4):
    rng = random.Random(seed)
    rows = []
    for a in range(1, n + 1):
        for b in range(1, n + 1):
            boo, rep = [[rng.uniform(1, 100), 0.0, rng.uniform(50, 500)] for _ in range(2)]
            boo[1], rep[1] = boo[2] * rng.uniform(0.01, 0.3), rep[2] * rng.uniform(0.01, 0.3)
            rows.append((a, b, *[round(x, 2) for x in boo], *[round(x, 2) for x in rep]))
    d = spark.createDataFrame(rows, "score_rf_bin int, risk_score_rf_bin int, oa_amt_h0_boo double, todu_30ever_h6_boo double, todu_amt_pile_h6_boo double, oa_amt_h0_rep double, todu_30ever_h6_rep double, todu_amt_pile_h6_rep double")
    return cl.with_totals(d).withColumns({m: F.round(m, 2) for m in cl.INDICATORS})


@pytest.mark.parametrize("seed", [1, 2])
def test_fold_equals_enumeration(spark, seed):
    g = grid(spark, seed)
    lv = cut.prefix_levels(g)
    sols = cut.monotone_cutoffs(lv, [4, 3, 2, 1])
    assert sols.count() == 70
    k = cut.solution_kpis(cut.solution_cuts(sols, [4, 3, 2, 1]), lv).collect()
    t = spark.createDataFrame([(60.0,), (90.0,), (110.0,), (400.0,)], "target double")
    got = {r.target: r.production for r in cut.frontier_by_target(lv, t, [4, 3, 2, 1]).collect()}
    for target, production in got.items():
        ok = [x.oa_amt_h0 for x in k if 7 * x.todu_30ever_h6 - target / 100 * x.todu_amt_pile_h6 <= 1e-9]
        assert production == pytest.approx(max(ok))
    assert len(got) == 4
    f = cut.pareto_filter(spark.createDataFrame([(x.solution, x.oa_amt_h0, x.risk) for x in k], "solution string, oa_amt_h0 double, risk double")).orderBy("risk").collect()
    assert all(a.oa_amt_h0 < b.oa_amt_h0 for a, b in zip(f, f[1:]))


def test_masks_cutoffs_and_violations(spark):
    g = grid(spark, 3)
    cuts = spark.createDataFrame([("s", 4, 4), ("s", 3, 2), ("s", 2, 2), ("s", 1, 0)], "solution string, score_rf_bin int, level int")
    m = cut.masks(cuts, g)
    assert m.agg(F.sum("accept")).first()[0] == 8
    assert {r.score_rf_bin: r.cut for r in cut.mask_to_cutoffs(m).collect()} == {4: 4.0, 3: 2.0, 2: 2.0, 1: float("-inf")}
    assert cut.monotonicity_violations(m, {"score_rf_bin": False, "risk_score_rf_bin": True}).count() == 0
    bad = spark.createDataFrame([("s", 1, 1, 0), ("s", 1, 2, 1)], "solution string, score_rf_bin int, risk_score_rf_bin int, accept int")
    assert cut.monotonicity_violations(bad, {"score_rf_bin": False, "risk_score_rf_bin": True}).count() == 1


def test_applied_cuts_add_up(spark):
    g = grid(spark, 5)
    c = spark.createDataFrame([(i, 2.0) for i in range(1, 5)], "score_rf_bin int, cut double")
    m = {r.metric: r for r in cut.apply_cuts(g, c).collect()}
    assert m["Optimum selected"].production == pytest.approx(m["Actual"].production - m["Swap-out"].production + m["Swap-in"].production)
    flips = cut.sensitivity(g, [0.0], 100.0, [4, 3, 2, 1]).first()
    assert flips.n_flips == 0


def test_exact_allocation_beats_ranked(spark):
    rows = [("A", "0", 0.5, 1000.0), ("A", "1", 1.0, 2000.0), ("A", "2", 1.5, 2500.0), ("B", "0", 0.8, 1500.0), ("B", "1", 1.2, 3000.0), ("B", "2", 2.0, 4000.0)]
    f = spark.createDataFrame(rows, "segment_cut_off string, solution string, risk double, oa_amt_h0 double")
    best = 0.0
    for a in rows[:3]:
        for b in rows[3:]:
            if a[3] * (a[2] - 1.1) + b[3] * (b[2] - 1.1) <= 1e-9:
                best = max(best, a[3] + b[3])
    exact, ranked = al.allocate_exact(f, 1.1, ["A", "B"]), al.allocate_ranked(f, 1.1)
    total = lambda d: sum(r.oa_amt_h0 for r in d.collect())
    assert total(exact) == best >= total(ranked)
    t = al.allocation_table(exact).where("segment_cut_off IS NULL").first()
    assert t.production == best and t.risk <= 1.1 + 1e-9
    assert al.allocate_exact(f, 0.1, ["A", "B"]).count() == 0


def test_audit_classes(spark):
    d = spark.createDataFrame(
        [(1, "booked", None, 1, 1, 10.0), (2, "booked", None, 1, 3, 10.0), (3, "rejected", "09-score", 1, 1, 10.0), (4, "rejected", "09-score", 1, 3, 10.0), (5, "rejected", "08-other", 1, 1, 10.0), (6, "booked", None, 9, 1, 10.0)],
        "authorization_id int, status_name string, reject_reason string, score_rf_bin int, risk_score_rf_bin int, oa_amt_h0 double",
    )
    c = spark.createDataFrame([(1, 2.0)], "score_rf_bin int, cut double")
    a = au.audit_records(d, c, financing_rate=0.5)
    assert [r.classification for r in a.orderBy("authorization_id").collect()] == ["keep", "swap_out", "swap_in", "rejected", "rejected_other", "unknown"]
    assert au.audit_summary(a).where("classification = 'swap_in'").first().amount_adjusted == 5.0


def test_consolidation_levels(spark):
    m = spark.createDataFrame([("base", "main", s, p, "Actual", v, 1.0, 10.0) for s, p, v in (("a", "x", 1.0), ("b", "x", 2.0), ("c", None, 4.0))], "scenario string, period string, segment string, supersegment string, metric string, production double, todu_30ever_h6 double, todu_amt_pile_h6 double")
    got = {(r.level, r.name): r.production for r in co.consolidate(m).collect()}
    assert got == {("segment", "a"): 1.0, ("segment", "b"): 2.0, ("segment", "c"): 4.0, ("supersegment", "x"): 3.0, ("total", "TOTAL"): 7.0}
    assert {r.risk for r in co.consolidate(m).collect()} == {70.0}


def test_models(spark):
    rng = random.Random(1)
    rows = [(a, b, 100.0 + 10 * a + b, round(1.0 - 0.1 * a + 0.2 * b + rng.uniform(-0.01, 0.01), 4)) for a in range(1, 5) for b in range(1, 5)]
    c = spark.createDataFrame(rows, "score_rf_bin int, risk_score_rf_bin int, todu_amt_pile_h6 double, target double")
    p = rm.linear_risk_model(c, cl.CELL).transform(c)
    assert p.agg(F.max(F.abs(F.col("prediction") - F.col("target")))).first()[0] < 0.05
    t = {(r.score_rf_bin, r.risk_score_rf_bin): r.prediction for r in rm.monotone_tree_surface(c).collect()}
    assert all(t[a, b] <= t[a, b + 1] for a in range(1, 5) for b in range(1, 4)) and all(t[a + 1, b] <= t[a, b] for a in range(1, 4) for b in range(1, 5))
    e = rm.exposure_model(spark.createDataFrame([(float(x), 2.0 * x + 1) for x in range(10)], "oa_amt_h0 double, todu_amt_pile_h6 double")).first()
    assert (e.slope, e.intercept) == (pytest.approx(2.0), pytest.approx(1.0))
    r = spark.createDataFrame([("big", 5, 1.0, 0.2), ("small", 2, 1.1, 0.1), ("bad", 1, 2.0, 0.1)], "name string, complexity int, mean double, se double")
    assert rm.one_se_select(r).first().name == "small"


def test_results_round_trip(spark, tmp_path):
    d = spark.createDataFrame([("a", "base", "main", 1.0)], "segment string, scenario string, period string, production double")
    src.write_results(d, str(tmp_path), "t")
    assert src.read_results(spark, str(tmp_path), "t").select(d.columns).collect() == d.collect()
    d.write.option("header", "true").csv(str(tmp_path / "c"))
    assert src.ingest(spark, str(tmp_path / "c"), "csv").count() == 1


def test_every_query_has_a_name_and_most_have_sql():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.oracle_sql()) >= 100
