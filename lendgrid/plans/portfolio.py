"""Queries over cells and monthly series."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..functions import scalars as fn
from ..operators import cells as cl, monitoring as mon, population as pop
from .registry import COMMON_SQL, booked, clean, demand, query

#: Fixed coefficients stand for fitted models where a query has to agree with SQL.
EXPOSURE = (0.97, 1500.0)
STRESS, FINANCING, COEFFICIENT = 1.25, 0.8, 1.0


def fixed_risk():
    """A linear risk surface of the two bins."""
    return F.lit(0.09) - F.lit(0.003) * F.col("score_rf_bin") + F.lit(0.005) * F.col("risk_score_rf_bin")


CELLS_SQL = COMMON_SQL + """,
boo AS (SELECT score_rf_bin, risk_score_rf_bin, sum(todu_30ever_h6::DECIMAL(20,4))::DOUBLE AS todu_30ever_h6_boo, sum(todu_amt_pile_h6::DECIMAL(20,4))::DOUBLE AS todu_amt_pile_h6_boo, sum(oa_amt_h0::DECIMAL(20,4))::DOUBLE AS oa_amt_h0_boo FROM booked GROUP BY 1, 2),
rates AS (SELECT score_rf_bin, risk_score_rf_bin, n_booked, n_rejected, CASE WHEN n_booked + n_rejected > 0 THEN n_booked::DOUBLE / (n_booked + n_rejected) ELSE 1.0 END AS acceptance_rate FROM (
  SELECT score_rf_bin, risk_score_rf_bin, count(*) FILTER (status_name = 'booked') AS n_booked, count(*) FILTER (status_name = 'rejected' AND reject_reason = '09-score') AS n_rejected FROM demand GROUP BY 1, 2)),
rej AS (SELECT score_rf_bin, risk_score_rf_bin, sum(oa_amt::DECIMAL(20,4))::DOUBLE AS oa_amt_h0_rep FROM demand WHERE status_name = 'rejected' AND reject_reason = '09-score' GROUP BY 1, 2),
scored AS (SELECT *, ratio_rep * todu_amt_pile_h6_rep / 7.0::DOUBLE AS todu_30ever_h6_rep FROM (SELECT *, 0.97::DOUBLE * oa_amt_h0_rep + 1500.0::DOUBLE AS todu_amt_pile_h6_rep, greatest(1.25::DOUBLE * (0.09::DOUBLE - 0.003::DOUBLE * score_rf_bin + 0.005::DOUBLE * risk_score_rf_bin), 0.0) AS ratio_rep FROM rej)),
up AS (SELECT score_rf_bin, risk_score_rf_bin, oa_amt_h0_rep, todu_amt_pile_h6_rep, ratio_rep, uplift, todu_30ever_h6_rep * uplift AS todu_30ever_h6_rep FROM (
  SELECT s.*, least(greatest(1.0::DOUBLE + 1.5::DOUBLE * (1 - coalesce(acceptance_rate, 1.0)), 1.0), 3.0) AS uplift FROM scored s LEFT JOIN rates USING (score_rf_bin, risk_score_rf_bin))),
cells AS (SELECT *, todu_30ever_h6_boo + todu_30ever_h6_rep AS todu_30ever_h6, todu_amt_pile_h6_boo + todu_amt_pile_h6_rep AS todu_amt_pile_h6, oa_amt_h0_boo + oa_amt_h0_rep AS oa_amt_h0 FROM (
  SELECT score_rf_bin, risk_score_rf_bin, coalesce(todu_30ever_h6_boo, 0) AS todu_30ever_h6_boo, coalesce(todu_amt_pile_h6_boo, 0) AS todu_amt_pile_h6_boo, coalesce(oa_amt_h0_boo, 0) AS oa_amt_h0_boo,
   coalesce(todu_30ever_h6_rep * 0.8::DOUBLE, 0) AS todu_30ever_h6_rep, coalesce(todu_amt_pile_h6_rep * 0.8::DOUBLE, 0) AS todu_amt_pile_h6_rep, coalesce(oa_amt_h0_rep * 0.8::DOUBLE, 0) AS oa_amt_h0_rep
  FROM boo FULL JOIN up USING (score_rf_bin, risk_score_rf_bin)))"""


def cells(spark, d):
    return cl.cell_summary(demand(spark, d), fixed_risk(), EXPOSURE, STRESS, FINANCING, COEFFICIENT)


def rounded(df, n=4):
    """Doubles rounded, for results whose last digits depend on the order of additions."""
    return df.select(*[F.round(c, n).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("agg1_booked_cells", "SELECT * FROM boo", CELLS_SQL)
def agg1(spark, d):
    return cl.booked_cells(booked(spark, d), fn.annual_coefficient(F.lit("1998-07-01").cast("date"), F.lit("1999-06-01").cast("date")))


@query("agg2_cell_target", """
WITH t AS (SELECT *, round_even(7.0::DOUBLE * todu_30ever_h6 / nullif(todu_amt_pile_h6, 0), 2) AS target FROM (SELECT score_rf_bin, risk_score_rf_bin, sum(todu_30ever_h6::DECIMAL(20,4))::DOUBLE AS todu_30ever_h6, sum(todu_amt_pile_h6::DECIMAL(20,4))::DOUBLE AS todu_amt_pile_h6, sum(oa_amt_h0::DECIMAL(20,4))::DOUBLE AS oa_amt_h0, count(*) AS n_observations FROM booked GROUP BY 1, 2)),
m AS (SELECT quantile_cont(target, 0.5) AS mid FROM t), s AS (SELECT quantile_cont(abs(target - mid), 0.5) AS mad FROM t, m)
SELECT t.* FROM t, m, s WHERE target IS NOT NULL AND (mad = 0 OR 0.6745 * abs(target - mid) < 3 * mad)""")
def agg2(spark, d):
    return cl.cell_target(booked(spark, d))


@query("agg3_cell_summary", "SELECT score_rf_bin, risk_score_rf_bin, round(todu_30ever_h6_boo, 4) AS todu_30ever_h6_boo, round(todu_amt_pile_h6_boo, 4) AS todu_amt_pile_h6_boo, round(oa_amt_h0_boo, 4) AS oa_amt_h0_boo, round(todu_30ever_h6_rep, 4) AS todu_30ever_h6_rep, round(todu_amt_pile_h6_rep, 4) AS todu_amt_pile_h6_rep, round(oa_amt_h0_rep, 4) AS oa_amt_h0_rep, round(todu_30ever_h6, 4) AS todu_30ever_h6, round(todu_amt_pile_h6, 4) AS todu_amt_pile_h6, round(oa_amt_h0, 4) AS oa_amt_h0 FROM cells", CELLS_SQL)
def agg3(spark, d):
    return rounded(cells(spark, d))


@query("agg4_stress_factor", """
WITH c AS (SELECT quantile_cont(score_rf, 0.05) AS cut FROM booked)
SELECT worst, overall, worst / overall AS stress_factor FROM (SELECT (sum(todu_30ever_h6::DECIMAL(20,4)) FILTER (score_rf <= cut))::DOUBLE / (sum(todu_amt_pile_h6::DECIMAL(20,4)) FILTER (score_rf <= cut))::DOUBLE AS worst, sum(todu_30ever_h6::DECIMAL(20,4))::DOUBLE / sum(todu_amt_pile_h6::DECIMAL(20,4))::DOUBLE AS overall FROM booked, c)""")
def agg4(spark, d):
    return mon.stress_factor(booked(spark, d))


@query("agg5_transformation_rate", """
WITH e AS (SELECT * FROM clean WHERE se_decision_id IN ('ok', 'rv')), w AS (SELECT * FROM e WHERE mis_date > (SELECT max(mis_date) - INTERVAL 12 MONTH FROM e))
SELECT month, eligible, booked, booked / eligible AS rate FROM (SELECT date_trunc('month', mis_date)::DATE AS month, sum(oa_amt::DECIMAL(20,4))::DOUBLE AS eligible, sum((CASE WHEN status_name = 'booked' THEN oa_amt ELSE 0 END)::DECIMAL(20,4))::DOUBLE AS booked FROM w GROUP BY ROLLUP (1))""")
def agg5(spark, d):
    return mon.transformation_rate(clean(spark, d))


@query("agg6_financing_rate", """
WITH m AS (SELECT mis_date, sum((CASE WHEN status_name = 'booked' THEN oa_amt ELSE 0 END)::DECIMAL(20,4))::DOUBLE AS b, sum(oa_amt::DECIMAL(20,4))::DOUBLE AS e FROM clean WHERE se_decision_id = 'ok' GROUP BY 1),
w AS (SELECT sum((CASE WHEN status_name = 'booked' THEN oa_amt ELSE 0 END)::DECIMAL(20,4))::DOUBLE / sum(oa_amt::DECIMAL(20,4))::DOUBLE AS weighted_rate FROM clean WHERE se_decision_id = 'ok' AND mis_date >= DATE '1998-07-01')
SELECT round_even((SELECT avg(b / e) FROM (SELECT * FROM m ORDER BY mis_date DESC LIMIT 6)) * 100, 1) AS mean_rate, weighted_rate FROM w""")
def agg6(spark, d):
    return mon.financing_rate(clean(spark, d), 6, "1998-07-01")


@query("agg7_reject_uplift", "SELECT score_rf_bin, risk_score_rf_bin, 'linear' AS method, round(uplift, 6) AS uplift, round(todu_30ever_h6_rep, 4) AS arrears FROM up UNION ALL SELECT score_rf_bin, risk_score_rf_bin, 'power', round(u, 6), round(a * u, 4) FROM (SELECT score_rf_bin, risk_score_rf_bin, todu_30ever_h6_rep AS a, least(greatest(pow(1.0 / greatest(acceptance_rate, 0.01), 0.5), 1.0), 2.0) AS u FROM scored LEFT JOIN rates USING (score_rf_bin, risk_score_rf_bin))", CELLS_SQL)
def agg7(spark, d):
    dem = demand(spark, d)
    c, r = cl.score_rejects(cl.rejected_cells(dem), fixed_risk(), EXPOSURE, STRESS), cl.acceptance_rates(dem)
    out = lambda x, m: x.select(*cl.CELL, F.lit(m).alias("method"), F.round("uplift", 6).alias("uplift"), F.round("todu_30ever_h6_rep", 4).alias("arrears"))
    return out(cl.reject_uplift(c, r), "linear").union(out(cl.reject_uplift(c, r, "power", 0.5, 2.0), "power"))


@query("agg8_acceptance_rates", "SELECT * FROM rates", CELLS_SQL)
def agg8(spark, d):
    return cl.acceptance_rates(demand(spark, d))


MONTHLY_SQL = """
WITH m AS (SELECT segment_cut_off, mis_date AS month, count(*) AS n_records, count(*) FILTER (status_name = 'booked') AS n_booked, (sum(oa_amt_h0::DECIMAL(20,4)) FILTER (status_name = 'booked'))::DOUBLE AS production,
  count(oa_amt_h0) FILTER (status_name = 'booked') AS k, (sum(todu_30ever_h6::DECIMAL(20,4)) FILTER (status_name = 'booked'))::DOUBLE AS a, (sum(todu_amt_pile_h6::DECIMAL(20,4)) FILTER (status_name = 'booked'))::DOUBLE AS t,
  (sum(score_rf::DECIMAL(20,4)) FILTER (status_name = 'booked'))::DOUBLE AS s, count(score_rf) FILTER (status_name = 'booked') AS sn FROM clean GROUP BY 1, 2),
mm AS (SELECT segment_cut_off, month, n_records, n_booked, n_booked::DOUBLE / n_records AS approval_rate, production, production / nullif(k, 0) AS mean_production, round_even(7.0::DOUBLE * a / nullif(t, 0) * 100, 2) AS risk, s / nullif(sn, 0) AS mean_score_rf FROM m)"""


@query("agg9_monthly_metrics", MONTHLY_SQL + " SELECT * FROM mm")
def agg9(spark, d):
    return mon.monthly_metrics(clean(spark, d), ["segment_cut_off"])


SERIES_SQL = """
WITH s AS (SELECT mis_date, sum(oa_amt_h0::DECIMAL(20,4))::DOUBLE AS production, sum(todu_30ever_h6::DECIMAL(20,4))::DOUBLE AS arrears, sum(todu_amt_pile_h6::DECIMAL(20,4))::DOUBLE AS exposure FROM clean WHERE status_name = 'booked' GROUP BY 1),
r AS (SELECT *, count(*) OVER w AS n, (sum(arrears::DECIMAL(20,4)) OVER w)::DOUBLE AS a6, (sum(exposure::DECIMAL(20,4)) OVER w)::DOUBLE AS e6 FROM s WINDOW w AS (ORDER BY mis_date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW))"""


@query("agg10_risk_production_series", SERIES_SQL + """
SELECT mis_date, production, arrears, exposure, round_even(7.0::DOUBLE * arrears / exposure * 100, 2) AS risk, CASE WHEN n = 6 THEN round_even(7.0::DOUBLE * a6 / e6 * 100, 2) END AS rolling_risk,
 CASE year(mis_date) WHEN 1998 THEN 70.0 WHEN 1999 THEN 72.5 END::DOUBLE AS "limit" FROM r""")
def agg10(spark, d):
    limits = spark.createDataFrame([(1998, 70.0), (1999, 72.5)], "year int, limit double")
    return mon.risk_production_series(clean(spark, d).where("status_name = 'booked'"), limits)


@query("win1_rolling_sum", SERIES_SQL + " SELECT mis_date, arrears, CASE WHEN n = 6 THEN a6 END AS rolling FROM r")
def win1(spark, d):
    s = mon.risk_production_series(clean(spark, d).where("status_name = 'booked'"))
    return s.select("mis_date", "arrears", mon.rolling_sum("arrears", "mis_date").alias("rolling"))


@query("win2_spc_anomalies", MONTHLY_SQL + """,
l AS (SELECT segment_cut_off, month, approval_rate, list(approval_rate) OVER w AS v, stddev_samp(approval_rate) OVER w AS sd FROM mm WINDOW w AS (PARTITION BY segment_cut_off ORDER BY month ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, CASE WHEN len(v) = 6 THEN list_aggregate(v, 'quantile_cont', 0.5) END AS center FROM l),
g AS (SELECT *, CASE WHEN len(v) = 6 THEN list_aggregate(list_transform(v, lambda x: abs(x - center)), 'quantile_cont', 0.5) END AS mad FROM c),
b AS (SELECT *, 2.0 * 2.5706 / 1.959964 * CASE WHEN mad > 0 THEN mad / 0.6745 ELSE CASE WHEN len(v) = 6 THEN sd END END AS width FROM g)
SELECT segment_cut_off, month, round(approval_rate, 6) AS approval_rate, round(center, 6) AS center, round(center - width, 6) AS lower, round(center + width, 6) AS upper,
 CASE WHEN approval_rate > center + width THEN 'above' WHEN approval_rate < center - width THEN 'below' ELSE 'none' END AS anomaly FROM b""")
def win2(spark, d):
    m = mon.monthly_metrics(clean(spark, d), ["segment_cut_off"]).select("segment_cut_off", "month", "approval_rate")
    return rounded(mon.spc_anomalies(m, "approval_rate", keys=["segment_cut_off"]), 6)


@query("win3_trend_line", MONTHLY_SQL + """,
x AS (SELECT segment_cut_off, month, approval_rate, (row_number() OVER (PARTITION BY segment_cut_off ORDER BY month) - 1)::DOUBLE AS x FROM mm),
f AS (SELECT segment_cut_off, regr_slope(approval_rate, x) AS slope, regr_intercept(approval_rate, x) AS intercept FROM x GROUP BY 1)
SELECT segment_cut_off, month, round(approval_rate, 6) AS approval_rate, x, round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(intercept + slope * x, 6) AS trend FROM x JOIN f USING (segment_cut_off)""")
def win3(spark, d):
    m = mon.monthly_metrics(clean(spark, d), ["segment_cut_off"]).select("segment_cut_off", "month", "approval_rate")
    return rounded(mon.trend_line(m, "approval_rate", keys=["segment_cut_off"]), 6)


@query("win9_last_n_months", MONTHLY_SQL + " SELECT * EXCLUDE (k9) FROM (SELECT *, row_number() OVER (PARTITION BY segment_cut_off ORDER BY month DESC) AS k9 FROM mm) WHERE k9 <= 3")
def win9(spark, d):
    return mon.last_n(mon.monthly_metrics(clean(spark, d), ["segment_cut_off"]), "month", 3, ["segment_cut_off"])


@query("agg14_group_stats", "SELECT score_rf_bin AS \"group\", avg(risk_score_rf::DECIMAL(20,4))::DOUBLE AS mean, count(risk_score_rf) AS n FROM clean GROUP BY 1")
def agg14(spark, d):
    return mon.group_stats(clean(spark, d), "score_rf_bin", "risk_score_rf")


@query("agg15_marginalise", "SELECT segment_cut_off, score_rf_bin, a AS todu_30ever_h6, t AS todu_amt_pile_h6, o AS oa_amt_h0, round_even(7.0::DOUBLE * a / nullif(t, 0), 6) AS ratio FROM (SELECT segment_cut_off, score_rf_bin, sum(todu_30ever_h6::DECIMAL(20,4))::DOUBLE AS a, sum(todu_amt_pile_h6::DECIMAL(20,4))::DOUBLE AS t, sum(oa_amt_h0::DECIMAL(20,4))::DOUBLE AS o FROM booked GROUP BY 1, 2)")
def agg15(spark, d):
    keys = ["segment_cut_off", *cl.CELL]
    c = booked(spark, d).groupBy(*keys).agg(*[fn.money_sum(i).alias(i) for i in cl.INDICATORS])
    return cl.marginalise(c, ["segment_cut_off", "score_rf_bin"])


@query("cut1_complete_grid", "SELECT s.segment_cut_off, a AS score_rf_bin, b AS risk_score_rf_bin, coalesce(todu_30ever_h6_boo, 0) AS todu_30ever_h6_boo, coalesce(todu_amt_pile_h6_boo, 0) AS todu_amt_pile_h6_boo, coalesce(oa_amt_h0_boo, 0) AS oa_amt_h0_boo FROM (SELECT DISTINCT segment_cut_off FROM booked) s CROSS JOIN range(1, 5) x(a) CROSS JOIN range(1, 5) y(b) LEFT JOIN (SELECT segment_cut_off, score_rf_bin, risk_score_rf_bin, sum(todu_30ever_h6::DECIMAL(20,4))::DOUBLE AS todu_30ever_h6_boo, sum(todu_amt_pile_h6::DECIMAL(20,4))::DOUBLE AS todu_amt_pile_h6_boo, sum(oa_amt_h0::DECIMAL(20,4))::DOUBLE AS oa_amt_h0_boo FROM booked GROUP BY 1, 2, 3) c ON c.segment_cut_off = s.segment_cut_off AND score_rf_bin = a AND risk_score_rf_bin = b")
def cut1(spark, d):
    c = cl.booked_cells(booked(spark, d), 1.0, ["segment_cut_off", *cl.CELL])
    return cl.complete_grid(c, {"score_rf_bin": range(1, 5), "risk_score_rf_bin": range(1, 5)}, ["segment_cut_off"])


@query("ml14_score_rejects", "SELECT score_rf_bin, risk_score_rf_bin, oa_amt_h0_rep, round(todu_amt_pile_h6_rep, 4) AS todu_amt_pile_h6_rep, round(ratio_rep, 6) AS ratio_rep, round(todu_30ever_h6_rep, 4) AS todu_30ever_h6_rep FROM scored", CELLS_SQL)
def ml14(spark, d):
    s = cl.score_rejects(cl.rejected_cells(demand(spark, d)), fixed_risk(), EXPOSURE, STRESS)
    return s.select(*cl.CELL, "oa_amt_h0_rep", F.round("todu_amt_pile_h6_rep", 4).alias("todu_amt_pile_h6_rep"), F.round("ratio_rep", 6).alias("ratio_rep"), F.round("todu_30ever_h6_rep", 4).alias("todu_30ever_h6_rep"))


@query("ml13_training_grid", "SELECT a AS score_rf_bin, b AS risk_score_rf_bin, (a * b)::DOUBLE AS score_rf_bin_x_risk_score_rf_bin, coalesce(oa_amt_h0_boo, 0) AS oa_amt_h0_boo, round_even(7.0::DOUBLE * todu_30ever_h6_boo / nullif(todu_amt_pile_h6_boo, 0), 2) AS target FROM range(1, 5) x(a) CROSS JOIN range(1, 5) y(b) LEFT JOIN boo ON score_rf_bin = a AND risk_score_rf_bin = b", CELLS_SQL)
def ml13(spark, d):
    g = cl.complete_grid(cl.booked_cells(booked(spark, d)), {"score_rf_bin": range(1, 5), "risk_score_rf_bin": range(1, 5)})
    g = pop.poly_features(g, *cl.CELL)
    return g.select(*cl.CELL, "score_rf_bin_x_risk_score_rf_bin", "oa_amt_h0_boo", fn.risk_ratio(F.col("todu_30ever_h6_boo"), F.col("todu_amt_pile_h6_boo")).alias("target"))


@query("ml15_recent_period_summary", """
WITH train AS (SELECT score_rf_bin, risk_score_rf_bin, round_even(7.0::DOUBLE * todu_30ever_h6_boo / nullif(todu_amt_pile_h6_boo, 0), 2) AS risk FROM boo),
n AS (SELECT score_rf_bin, risk_score_rf_bin, sum(oa_amt_h0::DECIMAL(20,4))::DOUBLE AS production FROM recent_booked GROUP BY 1, 2)
SELECT score_rf_bin, risk_score_rf_bin, production, round(0.97::DOUBLE * production + 1500.0::DOUBLE, 4) AS exposure, risk IS NULL AS unseen, round(coalesce(risk, 1.25::DOUBLE * (0.09::DOUBLE - 0.003::DOUBLE * score_rf_bin + 0.005::DOUBLE * risk_score_rf_bin)), 6) AS risk,
 round(coalesce(risk, 1.25::DOUBLE * (0.09::DOUBLE - 0.003::DOUBLE * score_rf_bin + 0.005::DOUBLE * risk_score_rf_bin)) * (0.97::DOUBLE * production + 1500.0::DOUBLE) / 7.0, 4) AS arrears FROM n LEFT JOIN train USING (score_rf_bin, risk_score_rf_bin)""", CELLS_SQL)
def ml15(spark, d):
    from ..operators.recent import recent_period_cells

    return rounded(recent_period_cells(booked(spark, d), booked(spark, d, pop.RECENT), fixed_risk() * STRESS, EXPOSURE))


@query("jn7_unseen_cells", "SELECT DISTINCT score_rf_bin, risk_score_rf_bin, segment_cut_off, se_decision_id, early_bad FROM recent_booked r WHERE NOT EXISTS (SELECT 1 FROM booked b WHERE b.score_rf_bin = r.score_rf_bin AND b.risk_score_rf_bin = r.risk_score_rf_bin AND b.segment_cut_off = r.segment_cut_off AND b.se_decision_id = r.se_decision_id AND b.early_bad = r.early_bad)")
def jn7(spark, d):
    from ..operators.recent import unseen_cells

    return unseen_cells(booked(spark, d), booked(spark, d, pop.RECENT), ["segment_cut_off", "se_decision_id", "early_bad", *cl.CELL])


@query("jn3_full_outer", "SELECT score_rf_bin, coalesce(b, 0) AS n_booked, coalesce(r, 0) AS n_recent FROM (SELECT score_rf_bin, count(*) AS b FROM booked GROUP BY 1) FULL JOIN (SELECT score_rf_bin, count(*) AS r FROM recent_booked GROUP BY 1) USING (score_rf_bin)")
def jn3(spark, d):
    n = lambda x, name: x.groupBy("score_rf_bin").agg(F.count("*").alias(name))
    return n(booked(spark, d), "n_booked").join(n(booked(spark, d, pop.RECENT), "n_recent"), "score_rf_bin", "full").na.fill(0)


@query("jn2_left_default", "SELECT c.authorization_id, coalesce(acceptance_rate, 1.0) AS acceptance_rate FROM recent_demand c LEFT JOIN rates USING (score_rf_bin, risk_score_rf_bin)", CELLS_SQL)
def jn2(spark, d):
    r = cl.acceptance_rates(demand(spark, d)).select(*cl.CELL, "acceptance_rate")
    j = demand(spark, d, pop.RECENT).join(F.broadcast(r), list(cl.CELL), "left")
    return j.select("authorization_id", F.coalesce("acceptance_rate", F.lit(1.0)).alias("acceptance_rate"))


@query("win6_cell_prefix_sums", "SELECT score_rf_bin, risk_score_rf_bin, (sum(oa_amt_h0_boo::DECIMAL(20,4)) OVER w)::DOUBLE AS production, (sum(todu_30ever_h6_boo::DECIMAL(20,4)) OVER w)::DOUBLE AS arrears FROM boo WINDOW w AS (PARTITION BY score_rf_bin ORDER BY risk_score_rf_bin)", CELLS_SQL)
def win6(spark, d):
    w = Window.partitionBy("score_rf_bin").orderBy("risk_score_rf_bin")
    total = lambda c: F.sum(F.col(c).cast("decimal(20,4)")).over(w).cast("double")
    return cl.booked_cells(booked(spark, d)).select(*cl.CELL, total("oa_amt_h0_boo").alias("production"), total("todu_30ever_h6_boo").alias("arrears"))
