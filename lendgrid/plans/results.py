"""Queries on audit, consolidation, resampling and fitted models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit as au, cells as cl, consolidate as co, cutoffs as cut, population as pop, risk_models as rm
from ..operators.resampling import weights_sql
from ..plans.scores import ALERTS_SQL, REPORT_SQL
from ..sources import applications as src
from ..sources.shared import new_path
from .cuts import FIXED_SQL, ORDER, fixed_cuts, frontier, solutions
from .portfolio import CELLS_SQL, rounded
from .registry import COMMON_SQL, booked, clean, demand, query

AUDIT_SQL = COMMON_SQL + f""",
fx AS ({FIXED_SQL} WHERE TRUE),
fc AS (SELECT * FROM fx WHERE score_rf_bin <> 1),
au0 AS (SELECT d.*, cut, risk_score_rf_bin <= cut AS passes FROM demand d LEFT JOIN fc USING (score_rf_bin)),
au AS (SELECT *, oa_amt_h0 AS amount, oa_amt_h0 * CASE WHEN classification = 'swap_in' THEN 0.8::DOUBLE ELSE 1.0 END AS amount_adjusted FROM (SELECT *, CASE WHEN cut IS NULL THEN 'unknown' WHEN status_name = 'booked' AND passes THEN 'keep' WHEN status_name = 'booked' THEN 'swap_out' WHEN status_name = 'rejected' AND reject_reason = '09-score' AND passes THEN 'swap_in' WHEN status_name = 'rejected' AND reject_reason = '09-score' THEN 'rejected' ELSE 'rejected_other' END AS classification FROM au0)),
sm AS (SELECT classification, count(*) AS n, sum(amount::DECIMAL(20,4))::DOUBLE AS amount, sum(amount_adjusted::DECIMAL(20,4))::DOUBLE AS amount_adjusted FROM au GROUP BY 1)"""


def audited(spark, d):
    return au.audit_records(demand(spark, d), fixed_cuts(spark).where("score_rf_bin <> 1"), financing_rate=0.8)


@query("cut14_audit_records", "SELECT authorization_id, passes, classification, amount, round(amount_adjusted, 4) AS amount_adjusted FROM au", AUDIT_SQL)
def cut14(spark, d):
    return audited(spark, d).select("authorization_id", "passes", "classification", "amount", F.round("amount_adjusted", 4).alias("amount_adjusted"))


@query("agg11_audit_summary", "SELECT * FROM sm", AUDIT_SQL)
def agg11(spark, d):
    return au.audit_summary(audited(spark, d))


@query("cut15_audit_reconcile", """
WITH b AS (SELECT (sum(oa_amt_h0::DECIMAL(20,4)) FILTER (risk_score_rf_bin > cut))::DOUBLE AS so, (sum(amount_adjusted::DECIMAL(20,4)) FILTER (classification = 'swap_in'))::DOUBLE AS si FROM au WHERE cut IS NOT NULL AND (status_name = 'booked' OR classification = 'swap_in'))
SELECT classification, round(reported, 4) AS reported, audited, round(abs(audited - reported) / greatest(reported, 1), 9) AS gap, abs(audited - reported) / greatest(reported, 1) <= 0.01 AS agrees FROM (
 SELECT 'swap_in' AS classification, 1.05::DOUBLE * si AS reported, (SELECT amount_adjusted FROM sm WHERE classification = 'swap_in') AS audited FROM b UNION ALL SELECT 'swap_out', so, (SELECT amount_adjusted FROM sm WHERE classification = 'swap_out') FROM (SELECT (sum(oa_amt_h0::DECIMAL(20,4)) FILTER (status_name = 'booked' AND NOT passes))::DOUBLE AS so FROM au0))""", AUDIT_SQL)
def cut15(spark, d):
    a = audited(spark, d)
    s = au.audit_summary(a)
    reported = s.where("classification IN ('swap_in', 'swap_out')").select(
        F.when(F.col("classification") == "swap_in", "Swap-in").otherwise("Swap-out").alias("metric"),
        (F.col("amount_adjusted") * F.when(F.col("classification") == "swap_in", 1.05).otherwise(1.0)).alias("production"),
    )
    r = au.audit_reconcile(s, reported)
    return r.select("classification", F.round("reported", 4).alias("reported"), "audited", F.round("gap", 9).alias("gap"), "agrees")


@query("cut17_bootstrap_kpis", f"""
WITH f AS ({FIXED_SQL}), k AS (SELECT authorization_id, oa_amt_h0, todu_30ever_h6, todu_amt_pile_h6 FROM booked JOIN f USING (score_rf_bin) WHERE risk_score_rf_bin <= cut),
w AS ({weights_sql("k", "kpi", "authorization_id", 1000, "oa_amt_h0, todu_30ever_h6, todu_amt_pile_h6")}),
s AS (SELECT b, sum(oa_amt_h0::DECIMAL(20,4) * w)::DOUBLE AS p, 7.0::DOUBLE * sum(todu_30ever_h6::DECIMAL(20,4) * w)::DOUBLE / sum(todu_amt_pile_h6::DECIMAL(20,4) * w)::DOUBLE * 100 AS r FROM w WHERE w > 0 GROUP BY 1)
SELECT round(quantile_cont(p, 0.025), 4) AS production_low, round(quantile_cont(p, 0.975), 4) AS production_high, round(quantile_cont(r, 0.025), 6) AS risk_low, round(quantile_cont(r, 0.975), 6) AS risk_high FROM s""")
def cut17(spark, d):
    b = au.bootstrap_kpis(booked(spark, d), fixed_cuts(spark), 1000)
    return b.select(F.round("production_low", 4).alias("production_low"), F.round("production_high", 4).alias("production_high"), F.round("risk_low", 6).alias("risk_low"), F.round("risk_high", 6).alias("risk_high"))


SCENARIOS = [("tight", -1), ("base", 0)]

METRICS_SQL = COMMON_SQL + """,
sc AS (SELECT unnest(['tight', 'base']) AS scenario, unnest([-1, 0]) AS shift),
x AS (SELECT scenario, 'main' AS period, shift, * FROM booked, sc UNION ALL SELECT scenario, 'recent', shift, * FROM recent_booked, sc),
ms0 AS (SELECT scenario, period, segment_cut_off AS segment, CASE WHEN segment_cut_off IN ('machinery', 'automobile') THEN 'durables' END AS supersegment, oa_amt_h0, todu_30ever_h6, todu_amt_pile_h6, risk_score_rf_bin <= score_rf_bin + shift AS ok FROM x),
ms AS (SELECT scenario, period, segment, supersegment, 'Actual' AS metric, sum(oa_amt_h0::DECIMAL(20,4))::DOUBLE AS production, sum(todu_30ever_h6::DECIMAL(20,4))::DOUBLE AS todu_30ever_h6, sum(todu_amt_pile_h6::DECIMAL(20,4))::DOUBLE AS todu_amt_pile_h6 FROM ms0 GROUP BY 1, 2, 3, 4
 UNION ALL SELECT scenario, period, segment, supersegment, 'Optimum selected', sum(oa_amt_h0::DECIMAL(20,4))::DOUBLE, sum(todu_30ever_h6::DECIMAL(20,4))::DOUBLE, sum(todu_amt_pile_h6::DECIMAL(20,4))::DOUBLE FROM ms0 WHERE ok GROUP BY 1, 2, 3, 4),
lvl AS (SELECT 'segment' AS level, segment AS name, * FROM ms UNION ALL SELECT 'supersegment', supersegment, * FROM ms WHERE supersegment IS NOT NULL UNION ALL SELECT 'total', 'TOTAL', * FROM ms),
con AS (SELECT scenario, period, level, name, metric, production, todu_30ever_h6, todu_amt_pile_h6, round_even(7.0::DOUBLE * todu_30ever_h6 / nullif(todu_amt_pile_h6, 0) * 100, 2) AS risk FROM (SELECT scenario, period, level, name, metric, sum(production::DECIMAL(20,4))::DOUBLE AS production, sum(todu_30ever_h6::DECIMAL(20,4))::DOUBLE AS todu_30ever_h6, sum(todu_amt_pile_h6::DECIMAL(20,4))::DOUBLE AS todu_amt_pile_h6 FROM lvl GROUP BY 1, 2, 3, 4, 5))"""


def metrics(spark, d):
    """A metric table per scenario, period and segment: everything booked, and what the scenario's cutoff accepts."""
    sc = spark.createDataFrame(SCENARIOS, "scenario string, shift int")
    b = booked(spark, d).withColumn("period", F.lit("main")).union(booked(spark, d, pop.RECENT).withColumn("period", F.lit("recent"))).crossJoin(F.broadcast(sc))
    top = F.when(F.col("segment_cut_off").isin(*pop.SUPERSEGMENTS["durables"]), "durables")
    b = b.select("scenario", "period", F.col("segment_cut_off").alias("segment"), top.alias("supersegment"), *cl.INDICATORS, (F.col("risk_score_rf_bin") <= F.col("score_rf_bin") + F.col("shift")).alias("ok"))
    from ..functions.scalars import money_sum

    def total(x, name):
        g = x.groupBy("scenario", "period", "segment", "supersegment").agg(money_sum("oa_amt_h0").alias("production"), money_sum("todu_30ever_h6").alias("todu_30ever_h6"), money_sum("todu_amt_pile_h6").alias("todu_amt_pile_h6"))
        return g.withColumn("metric", F.lit(name))

    return co.union_all([total(b, "Actual"), total(b.where("ok"), "Optimum selected")])


@query("agg12_consolidate", "SELECT * FROM con", METRICS_SQL)
def agg12(spark, d):
    return co.consolidate(metrics(spark, d))


@query("agg12b_consolidated_deltas", """
SELECT *, round(optimum_production - actual_production, 4) AS delta_production, round((optimum_production - actual_production) / actual_production * 100, 9) AS delta_production_pct, round(optimum_risk - actual_risk, 4) AS delta_risk FROM (
 SELECT scenario, period, level, name, max(production) FILTER (metric = 'Actual') AS actual_production, max(production) FILTER (metric <> 'Actual') AS optimum_production, max(risk) FILTER (metric = 'Actual') AS actual_risk, max(risk) FILTER (metric <> 'Actual') AS optimum_risk FROM con GROUP BY 1, 2, 3, 4)""", METRICS_SQL)
def agg12b(spark, d):
    r = co.with_deltas(co.consolidate(metrics(spark, d)))
    return r.withColumn("delta_production_pct", F.round("delta_production_pct", 9))


@query("agg13_combine_ci", "SELECT scenario, period, level, name, metric, round(mid, 4) AS mid, round(se, 4) AS se, round(mid - 1.96 * se, 4) AS low, round(mid + 1.96 * se, 4) AS high FROM (SELECT scenario, period, level, name, metric, sum((production * 0.9::DOUBLE + production * 1.2::DOUBLE) / 2) AS mid, sqrt(sum(pow((production * 1.2::DOUBLE - production * 0.9::DOUBLE) / 3.92, 2))) AS se FROM lvl GROUP BY 1, 2, 3, 4, 5)", METRICS_SQL)
def agg13(spark, d):
    m = metrics(spark, d).withColumn("low", F.col("production") * 0.9).withColumn("high", F.col("production") * 1.2)
    return rounded(co.combine_ci(m))


@query("agg13b_combine_risk_ci", """
WITH r AS (SELECT *, 7.0::DOUBLE * todu_30ever_h6 / todu_amt_pile_h6 * 100 AS risk FROM lvl),
i AS (SELECT *, CASE WHEN metric = 'Actual' THEN risk ELSE risk * 0.9::DOUBLE END AS lo, CASE WHEN metric = 'Actual' THEN risk ELSE risk * 1.2::DOUBLE END AS hi FROM r),
c AS (SELECT scenario, period, level, name, metric, sum((lo + hi) / 2) AS mid, sqrt(sum(pow((hi - lo) / 3.92, 2))) AS se FROM i GROUP BY 1, 2, 3, 4, 5)
SELECT scenario, period, level, name, metric, CASE WHEN se > 0 THEN round(mid - 1.96 * se, 4) ELSE 0 END AS risk_ci_lower, CASE WHEN se > 0 THEN round(mid + 1.96 * se, 4) ELSE 0 END AS risk_ci_upper FROM c""", METRICS_SQL)
def agg13b(spark, d):
    from ..functions.scalars import risk_ratio

    m = metrics(spark, d).withColumn("risk", risk_ratio(F.col("todu_30ever_h6"), F.col("todu_amt_pile_h6"), percent=True, decimals=None))
    wide = lambda f: F.when(F.col("metric") == "Actual", F.col("risk")).otherwise(F.col("risk") * f)
    return rounded(co.combine_risk_ci(m.withColumns({"risk_low": wide(0.9), "risk_high": wide(1.2)})))


@query("cut21_scenario_comparison", "SELECT scenario, level, name, max(risk) FILTER (period = 'main') AS main_risk, max(production) FILTER (period = 'main') AS main_production, max(risk) FILTER (period = 'recent') AS recent_risk, max(production) FILTER (period = 'recent') AS recent_production, round(max(risk) FILTER (period = 'recent') - max(risk) FILTER (period = 'main'), 4) AS delta_risk FROM con WHERE metric = 'Optimum selected' GROUP BY 1, 2, 3", METRICS_SQL)
def cut21(spark, d):
    return co.scenario_comparison(co.consolidate(metrics(spark, d)))


@query("set1_union_all", "SELECT segment, metric, production FROM ms WHERE scenario = 'base' AND period = 'main' UNION ALL SELECT segment, 'extra', NULL FROM (SELECT DISTINCT segment FROM ms)", METRICS_SQL)
def set1(spark, d):
    m = metrics(spark, d)
    return co.union_all([m.where("scenario = 'base' AND period = 'main'").select("segment", "metric", "production"), m.select("segment").distinct().withColumn("metric", F.lit("extra"))])


CUTSUM_SQL = """
WITH t AS (SELECT unnest(['strict', 'base', 'loose']) AS scenario, unnest([10.5, 11.0, 11.5])::DOUBLE AS target),
s AS (SELECT scenario, solution, risk, oa_amt_h0 FROM (SELECT *, row_number() OVER (PARTITION BY scenario ORDER BY (risk <= target) DESC, CASE WHEN risk <= target THEN -risk ELSE risk END, solution) AS k FROM fr, t) WHERE k = 1)"""


def chosen(spark, d):
    t = spark.createDataFrame([("strict", 10.5), ("base", 11.0), ("loose", 11.5)], "scenario string, target double")
    s = cut.select_scenario(frontier(spark, d), t).select("scenario", "solution", "risk", "oa_amt_h0")
    cuts = cut.solution_cuts(solutions(spark, d), ORDER).join(F.broadcast(s.select("scenario", "solution")), "solution")
    return cuts.select("scenario", "score_rf_bin", "level"), s


def _register_cutoff_summary():
    from .cuts import LEVELS_SQL

    @query("cut16_cutoff_summary", CUTSUM_SQL + " SELECT scenario, score_rf_bin, level::INT AS level, risk, oa_amt_h0 FROM s JOIN cuts USING (solution)", LEVELS_SQL)
    def cut16(spark, d):
        c, s = chosen(spark, d)
        return co.cutoff_summary(c, s.drop("solution"))

    @query("cut16b_cutoffs_wide", CUTSUM_SQL + " SELECT scenario, " + ", ".join(f"max(level) FILTER (score_rf_bin = {b})::INT AS bin_{b}" for b in (1, 2, 3, 4)) + " FROM s JOIN cuts USING (solution) GROUP BY 1", LEVELS_SQL)
    def cut16b(spark, d):
        return co.cutoffs_wide(chosen(spark, d)[0], [1, 2, 3, 4], "score_rf_bin")


_register_cutoff_summary()


@query("jn6_map_lookup", f"WITH f AS ({FIXED_SQL}) SELECT authorization_id, cut::DOUBLE AS cut FROM recent_demand LEFT JOIN f USING (score_rf_bin)")
def jn6(spark, d):
    return demand(spark, d, pop.RECENT).join(F.broadcast(fixed_cuts(spark)), "score_rf_bin", "left").select("authorization_id", "cut")


@query("jn8_segment_patterns", "SELECT authorization_id, p AS pattern FROM clean JOIN (SELECT unnest(['mach', 'auto', 'buil']) AS p) ON starts_with(segment_cut_off, p)")
def jn8(spark, d):
    return pop.match_patterns(clean(spark, d), ["mach", "auto", "buil"]).select("authorization_id", "pattern")


def _folder(spark):
    return new_path(spark, "results")


@query("src2_read_results", "SELECT segment, scenario, period, production FROM ms WHERE metric = 'Actual'", METRICS_SQL)
def src2(spark, d):
    base = _folder(spark)
    src.write_results(metrics(spark, d).where("metric = 'Actual'").select("segment", "scenario", "period", "production"), base, "summary")
    return src.read_results(spark, base, "summary").select("segment", "scenario", "period", "production")


@query("src3_write_results_csv", "SELECT segment, scenario, period, metric FROM ms", METRICS_SQL)
def src3(spark, d):
    base = _folder(spark)
    src.write_results(metrics(spark, d).select("segment", "scenario", "period", "metric"), base, "metrics", "csv")
    return spark.read.schema("metric string, segment string, scenario string, period string").csv(f"{base}/metrics").select("segment", "scenario", "period", "metric")


@query("src4_write_alerts", ALERTS_SQL, REPORT_SQL)
def src4(spark, d):
    from .registry import QUERIES  # the alert table that is written

    path = _folder(spark)
    src.write_alerts(QUERIES["psi7_drift_alerts"](spark, d), path)
    return spark.read.json(path)


@query("ml1_exposure_model", """
WITH m AS (SELECT avg(oa_amt_h0_boo) AS mx, stddev_pop(oa_amt_h0_boo) AS sx, avg(todu_amt_pile_h6_boo * (1 + score_rf_bin / 50.0::DOUBLE)) AS my, stddev_pop(todu_amt_pile_h6_boo * (1 + score_rf_bin / 50.0::DOUBLE)) AS sy FROM boo),
k AS (SELECT oa_amt_h0_boo AS x, todu_amt_pile_h6_boo * (1 + score_rf_bin / 50.0::DOUBLE) AS y FROM boo, m WHERE abs(oa_amt_h0_boo - mx) < 3 * sx AND abs(todu_amt_pile_h6_boo * (1 + score_rf_bin / 50.0::DOUBLE) - my) < 3 * sy),
f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_r2(y, x) AS r2, avg(x) AS ax, avg(y) AS ay, regr_sxx(y, x) AS sxx, count(*) AS n FROM k)
SELECT round(b, 6) AS slope, round(a, 2) AS intercept, round(r2, 6) AS r2, round(1 - sum(pow((y - a - b * x) / (1 - (1.0 / n + pow(x - ax, 2) / sxx)), 2)) / sum(pow(y - ay, 2)), 6) AS loo_r2, n FROM k, f GROUP BY b, a, r2, n""", CELLS_SQL)
def ml1(spark, d):
    c = cl.booked_cells(booked(spark, d)).withColumn("exposure", F.col("todu_amt_pile_h6_boo") * (1 + F.col("score_rf_bin") / 50))
    r = rm.exposure_model(c, "oa_amt_h0_boo", "exposure")
    return r.select(F.round("slope", 6).alias("slope"), F.round("intercept", 2).alias("intercept"), F.round("r2", 6).alias("r2"), F.round("loo_r2", 6).alias("loo_r2"), "n")


def model_cells(spark, d):
    return pop.poly_features(cl.cell_target(booked(spark, d)), *cl.CELL)


def predicted(model, c):
    return model.transform(c).select(*cl.CELL, "target", F.round("prediction", 6).alias("prediction"))


def least_squares_sql(source: str, keys: str = "", alpha: str = "0") -> str:
    """Intercept and two slopes of y on x and z, weighted by w, with a ridge penalty, for each of ``keys``, as b0, b1, b2."""
    k, by = (f"{keys}, ", f" GROUP BY {keys}") if keys else ("", "")
    on = f" USING ({keys})" if keys else " ON TRUE"
    return f"""SELECT {k}my - b1 * mx - b2 * mz AS b0, b1, b2 FROM (
  SELECT {k}mx, mz, my, (sxy * (szz + al) - szy * sxz) / ((sxx + al) * (szz + al) - sxz * sxz) AS b1, (szy * (sxx + al) - sxy * sxz) / ((sxx + al) * (szz + al) - sxz * sxz) AS b2 FROM (
   SELECT {k}any_value(mx) AS mx, any_value(mz) AS mz, any_value(my) AS my, any_value({alpha})::DOUBLE AS al, sum(w*(x-mx)*(x-mx)) AS sxx, sum(w*(z-mz)*(z-mz)) AS szz, sum(w*(x-mx)*(z-mz)) AS sxz, sum(w*(x-mx)*(y-my)) AS sxy, sum(w*(z-mz)*(y-my)) AS szy
   FROM {source} JOIN (SELECT {k}sum(w*x)/sum(w) AS mx, sum(w*z)/sum(w) AS mz, sum(w*y)/sum(w) AS my FROM {source}{by}) m{on}{by}))"""


MODEL_SQL = COMMON_SQL + """,
t0 AS (SELECT *, round_even(7.0::DOUBLE * a / nullif(w, 0), 2) AS y FROM (SELECT score_rf_bin AS x, risk_score_rf_bin AS z, sum(todu_30ever_h6::DECIMAL(20,4))::DOUBLE AS a, sum(todu_amt_pile_h6::DECIMAL(20,4))::DOUBLE AS w FROM booked GROUP BY 1, 2)),
t1 AS (SELECT quantile_cont(y, 0.5) AS mid FROM t0), t2 AS (SELECT quantile_cont(abs(y - mid), 0.5) AS mad FROM t0, t1),
mc AS (SELECT x, z, w, y FROM t0, t1, t2 WHERE y IS NOT NULL AND (mad = 0 OR 0.6745 * abs(y - mid) < 3 * mad)),
mk AS (SELECT 'linear' AS kind, 0.0 AS alpha, * FROM mc UNION ALL SELECT 'ridge', 10.0, * FROM mc),
lb AS (""" + least_squares_sql("mk", "kind", "alpha") + """),
lp AS (SELECT kind, x AS score_rf_bin, z AS risk_score_rf_bin, w, y AS target, b0 + b1 * x + b2 * z AS p FROM mk JOIN lb USING (kind))"""
FOLDS_SQL = COMMON_SQL + """,
f0 AS (SELECT floor(('0x' || substr(md5('17|' || authorization_id), 1, 8))::BIGINT::DOUBLE / 4294967296.0 * 3)::INT AS fold, score_rf_bin AS x, risk_score_rf_bin AS z, sum(todu_30ever_h6::DECIMAL(20,4))::DOUBLE AS va, sum(todu_amt_pile_h6::DECIMAL(20,4))::DOUBLE AS vt FROM booked GROUP BY 1, 2, 3),
f1 AS (SELECT x, z, sum(va::DECIMAL(20,4))::DOUBLE AS a, sum(vt::DECIMAL(20,4))::DOUBLE AS t FROM f0 GROUP BY 1, 2),
f2 AS (SELECT i::INT AS fold, f1.*, coalesce(va, 0) AS va, coalesce(vt, 0) AS vt FROM f1 CROSS JOIN range(3) r(i) LEFT JOIN f0 ON f0.fold = i AND f0.x = f1.x AND f0.z = f1.z),
f3 AS (SELECT fold, x, z, vt, 7.0::DOUBLE * va / nullif(vt, 0) AS v, t - vt AS w, 7.0::DOUBLE * (a - va) / nullif(t - vt, 0) AS y FROM f2),
f4 AS (SELECT * FROM f3 WHERE y IS NOT NULL AND w > 0),
fb AS (""" + least_squares_sql("f4", "fold") + """),
fp AS (SELECT fold, x AS score_rf_bin, z AS risk_score_rf_bin, vt, v, b0 + b1 * x + b2 * z AS p FROM f3 JOIN fb USING (fold))"""
LINEAR = [("linear", "linear", list(cl.CELL), 0.0, 0.0)]


@query("ml2_linear_risk_model", "SELECT kind, score_rf_bin, risk_score_rf_bin, target, round(p, 6) AS prediction FROM lp", MODEL_SQL)
def ml2(spark, d):
    c = model_cells(spark, d)
    return co.union_all([predicted(rm.linear_risk_model(c, list(cl.CELL), k, s), c).withColumn("kind", F.lit(k)) for k, s in (("linear", 0.0), ("ridge", 10.0))])


@query("ml2b_weighted_r2", "SELECT kind, CASE WHEN count(*) >= 2 AND min(target) < max(target) THEN round(1 - sum(w * (target - p) * (target - p)) / (sum(w * target * target) - sum(w * target) * sum(w * target) / sum(w)), 6) END AS r2 FROM lp GROUP BY 1", MODEL_SQL)
def ml2b(spark, d):
    c = model_cells(spark, d)
    kinds = [rm.linear_risk_model(c, list(cl.CELL), k, s).transform(c).withColumn("kind", F.lit(k)) for k, s in (("linear", 0.0), ("ridge", 10.0))]
    return rounded(rm.weighted_r2(co.union_all(kinds), ["kind"]), 6)


@query("ml2c_sparse_linear_models")
def ml2c(spark, d):
    c = model_cells(spark, d)
    return co.union_all([predicted(rm.linear_risk_model(c, list(cl.CELL), k, 0.001, 0.5), c).withColumn("kind", F.lit(k)) for k in ("lasso", "elastic_net")])


@query("ml3_tweedie_model")
def ml3(spark, d):
    c = model_cells(spark, d)
    return predicted(rm.tweedie_model(c, list(cl.CELL)), c)


@query("ml4_hurdle_model")
def ml4(spark, d):
    c = model_cells(spark, d)
    return rm.hurdle_predictions(c, list(cl.CELL)).select(*cl.CELL, "target", F.round("prediction", 6).alias("prediction"))


@query("ml5_monotone_tree_surface")
def ml5(spark, d):
    return rm.monotone_tree_surface(model_cells(spark, d)).select(*cl.CELL, "target", F.round("prediction", 6).alias("prediction"))


@query("ml6_folded_cv", "SELECT 'linear' AS name, fold, round(sqrt(sum(vt * (p - v) * (p - v)) / sum(vt)), 6) AS rmse FROM fp WHERE v IS NOT NULL GROUP BY 2", FOLDS_SQL)
def ml6(spark, d):
    return rounded(rm.fold_scores(rm.grid_cv(rm.fold_cells(booked(spark, d), 3), LINEAR)), 6)


@query("ml7_hyperparameter_search")
def ml7(spark, d):
    return rounded(rm.hyperparameter_search(booked(spark, d), 5, rm.FEATURE_SETS["base"]), 6)


@query("ml8_one_se_select", """
WITH r AS (SELECT segment_cut_off AS name, count(DISTINCT mis_date) AS complexity, avg(risk_score_rf::DECIMAL(20,4))::DOUBLE AS mean, 2.0::DOUBLE AS se FROM booked GROUP BY 1), b AS (SELECT mean + se AS bar FROM r ORDER BY mean, complexity, name LIMIT 1)
SELECT name, complexity, mean, se FROM r, b WHERE mean <= bar ORDER BY complexity, mean, name LIMIT 1""")
def ml8(spark, d):
    r = booked(spark, d).groupBy(F.col("segment_cut_off").alias("name")).agg(F.count_distinct("mis_date").alias("complexity"), F.avg(F.col("risk_score_rf").cast("decimal(20,4)")).cast("double").alias("mean"))
    return rm.one_se_select(r.withColumn("se", F.lit(2.0)))


@query("ml9_feature_set_cv")
def ml9(spark, d):
    return rounded(rm.feature_set_cv(rm.fold_cells(booked(spark, d), 5)), 6)


@query("ml10_cell_prediction_ci", "SELECT score_rf_bin, risk_score_rf_bin, round(avg(p), 6) AS mean, round(stddev_samp(p), 6) AS std, count(*) AS n_folds, round(avg(p) - 1.96 * stddev_samp(p), 6) AS low, round(avg(p) + 1.96 * stddev_samp(p), 6) AS high FROM fp GROUP BY 1, 2", FOLDS_SQL)
def ml10(spark, d):
    return rounded(rm.cell_prediction_ci(rm.grid_cv(rm.fold_cells(booked(spark, d), 3), LINEAR)), 6)


@query("ml11_linear_attribution", "WITH m AS (SELECT avg(score_rf_bin) AS a, avg(risk_score_rf_bin) AS b FROM boo) SELECT 'score_rf_bin' AS feature, round(avg(abs(-0.03 * (score_rf_bin - a))), 9) AS mean_abs FROM boo, m UNION ALL SELECT 'risk_score_rf_bin', round(avg(abs(0.05 * (risk_score_rf_bin - b))), 9) FROM boo, m", CELLS_SQL)
def ml11(spark, d):
    return rounded(rm.linear_attribution(cl.booked_cells(booked(spark, d)), {"score_rf_bin": -0.03, "risk_score_rf_bin": 0.05}), 9)


BEST_EDGE = """(SELECT edge FROM (SELECT (x + nx) / 2 AS edge, round((bt - bt::DOUBLE * bt / nt) - (bl - bl::DOUBLE * bl / nl) - ((bt - bl) - (bt - bl)::DOUBLE * (bt - bl) / (nt - nl)), 9) AS gain FROM (
 SELECT x, lead(x) OVER w AS nx, sum(n) OVER w AS nl, sum(bad) OVER w AS bl, sum(n) OVER (PARTITION BY leaf) AS nt, sum(bad) OVER (PARTITION BY leaf) AS bt FROM (SELECT *, {leaf} AS leaf FROM sc) WINDOW w AS (PARTITION BY leaf ORDER BY x))
 WHERE nx IS NOT NULL AND nl >= 200 AND nt - nl >= 200) WHERE gain > 0 ORDER BY gain DESC, edge LIMIT 1)"""
BINS_SQL = "WITH sc AS (SELECT score_rf AS x, count(*) AS n, sum(early_bad)::BIGINT AS bad FROM clean GROUP BY 1)" + "".join(
    f", e{i} AS (SELECT {BEST_EDGE.format(leaf=' + '.join(['1', *[f'coalesce((x > (SELECT edge FROM e{j}))::INT, 0)' for j in range(i)]]))} AS edge)" for i in range(3)
)


@query("ml12_supervised_bins", BINS_SQL + " SELECT (1 + coalesce((score_rf > (SELECT edge FROM e0))::INT, 0) + coalesce((score_rf > (SELECT edge FROM e1))::INT, 0) + coalesce((score_rf > (SELECT edge FROM e2))::INT, 0))::INT AS score_rf_bin, min(score_rf) AS low, max(score_rf) AS high, count(*) AS n FROM clean GROUP BY 1")
def ml12(spark, d):
    c = clean(spark, d)
    edges = rm.supervised_bins(c, "score_rf", "early_bad", 4, 200)
    return pop.bin_scores(c.drop("score_rf_bin"), {"score_rf": edges}).groupBy("score_rf_bin").agg(F.min("score_rf").alias("low"), F.max("score_rf").alias("high"), F.count("*").alias("n"))


@query("ml16_batch_score", "SELECT score_rf_bin, risk_score_rf_bin, round(p, 6) AS prediction FROM lp WHERE kind = 'linear'", MODEL_SQL)
def ml16(spark, d):
    path, c = _folder(spark), model_cells(spark, d)
    rm.save_model(rm.linear_risk_model(c, list(cl.CELL)), path, cl.CELL, kind="linear")
    return rm.batch_score(path, c).select(*cl.CELL, F.round("prediction", 6).alias("prediction"))


@query("met9_combined_score")
def met9(spark, d):
    b = booked(spark, d).select("authorization_id", "score_rf", "risk_score_rf", "early_bad")
    return rm.combined_score(b, ["score_rf", "risk_score_rf"], "early_bad").select("authorization_id", F.round("combined", 6).alias("combined"))


@query("cells_by_segment_frontier_kpis", "SELECT segment_cut_off, count(*) AS n_cells, sum(oa_amt_h0::DECIMAL(20,4))::DOUBLE AS production FROM (SELECT segment_cut_off, score_rf_bin, risk_score_rf_bin, sum(oa_amt_h0::DECIMAL(20,4)) AS oa_amt_h0 FROM booked GROUP BY 1, 2, 3) GROUP BY 1")
def segment_cells(spark, d):
    c = cl.booked_cells(booked(spark, d), 1.0, ["segment_cut_off", *cl.CELL])
    return c.groupBy("segment_cut_off").agg(F.count("*").alias("n_cells"), F.sum(F.col("oa_amt_h0_boo").cast("decimal(20,4)")).cast("double").alias("production"))


