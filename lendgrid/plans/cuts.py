"""Queries on cutoffs, frontiers, sensitivity and allocation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import allocation as al, cells as cl, cutoffs as cut
from .portfolio import CELLS_SQL, cells, rounded
from .registry import booked, demand, query

ORDER = [4, 3, 2, 1]  # bins of the first variable, safest first
TARGETS = [9.5, 10.5, 11.0, 11.5, 12.0, 13.0]
FIXED = {4: 4, 3: 3, 2: 2, 1: 1}

LEVELS_SQL = CELLS_SQL + """,
g AS (SELECT score_rf_bin, risk_score_rf_bin, oa_amt_h0::DECIMAL(20,4) AS p, todu_30ever_h6::DECIMAL(20,4) AS a, todu_amt_pile_h6::DECIMAL(20,4) AS t, oa_amt_h0_boo::DECIMAL(20,4) AS pb, todu_30ever_h6_boo::DECIMAL(20,4) AS ab, todu_amt_pile_h6_boo::DECIMAL(20,4) AS tb, oa_amt_h0_rep::DECIMAL(20,4) AS pr, todu_30ever_h6_rep::DECIMAL(20,4) AS ar, todu_amt_pile_h6_rep::DECIMAL(20,4) AS tr FROM cells),
lv AS (SELECT b AS score_rf_bin, l AS level, coalesce(sum(p), 0) AS p, coalesce(sum(a), 0) AS a, coalesce(sum(t), 0) AS t, coalesce(sum(pb), 0) AS pb, coalesce(sum(ab), 0) AS ab, coalesce(sum(tb), 0) AS tb, coalesce(sum(pr), 0) AS pr, coalesce(sum(ar), 0) AS ar, coalesce(sum(tr), 0) AS tr FROM range(1, 5) x(b) CROSS JOIN range(0, 5) y(l) LEFT JOIN g ON score_rf_bin = b AND risk_score_rf_bin <= l GROUP BY 1, 2),
sols AS (SELECT a AS l4, b AS l3, c AS l2, d AS l1, a || '-' || b || '-' || c || '-' || d AS solution FROM range(0, 5) w(a), range(0, 5) x(b), range(0, 5) y(c), range(0, 5) z(d) WHERE a >= b AND b >= c AND c >= d),
cuts AS (SELECT solution, 4 AS score_rf_bin, l4 AS level FROM sols UNION ALL SELECT solution, 3, l3 FROM sols UNION ALL SELECT solution, 2, l2 FROM sols UNION ALL SELECT solution, 1, l1 FROM sols),
kpi AS (SELECT solution, sum(p)::DOUBLE AS oa_amt_h0, sum(a)::DOUBLE AS todu_30ever_h6, sum(t)::DOUBLE AS todu_amt_pile_h6, sum(pb)::DOUBLE AS oa_amt_h0_boo, sum(ab)::DOUBLE AS todu_30ever_h6_boo, sum(tb)::DOUBLE AS todu_amt_pile_h6_boo, sum(pr)::DOUBLE AS oa_amt_h0_rep, sum(ar)::DOUBLE AS todu_30ever_h6_rep, sum(tr)::DOUBLE AS todu_amt_pile_h6_rep FROM cuts JOIN lv USING (score_rf_bin, level) GROUP BY 1),
pt AS (SELECT *, round_even(7.0::DOUBLE * todu_30ever_h6 / nullif(todu_amt_pile_h6, 0) * 100, 4) AS risk FROM kpi),
fr AS (SELECT * EXCLUDE (mx) FROM (SELECT *, max(oa_amt_h0) OVER (ORDER BY risk, oa_amt_h0 DESC, solution ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx FROM pt WHERE risk IS NOT NULL) WHERE mx IS NULL OR oa_amt_h0 > mx)"""

ALL = [f"{m}{s}" for s in ("", "_boo", "_rep") for m in cl.INDICATORS]


def levels(spark, d, measures=cut.MEASURES):
    return cut.prefix_levels(cells(spark, d), measures)


def solutions(spark, d):
    return cut.monotone_cutoffs(spark.range(5).select(F.col("id").cast("int").alias("level")), ORDER)


def kpis(spark, d):
    return cut.solution_kpis(cut.solution_cuts(solutions(spark, d), ORDER), levels(spark, d))


def frontier(spark, d):
    return cut.pareto_filter(kpis(spark, d))


def fixed_cuts(spark):
    return spark.createDataFrame([(k, float(v)) for k, v in FIXED.items()], "score_rf_bin int, cut double")


FIXED_SQL = "SELECT unnest([4, 3, 2, 1]) AS score_rf_bin, unnest([4, 3, 2, 1]) AS cut"


@query("cut3_monotone_cutoffs", "SELECT solution, score_rf_bin, level::INT AS level FROM cuts", LEVELS_SQL)
def cut3(spark, d):
    bins = [r[0] for r in booked(spark, d).select("score_rf_bin").distinct().orderBy(F.desc("score_rf_bin")).collect()]
    return cut.solution_cuts(cut.monotone_cutoffs(levels(spark, d), bins), bins)


@query("agg16_solution_kpis", """
SELECT kpi.*, round_even(7.0::DOUBLE * todu_30ever_h6 / nullif(todu_amt_pile_h6, 0) * 100, 4) AS risk, round_even(7.0::DOUBLE * todu_30ever_h6_boo / nullif(todu_amt_pile_h6_boo, 0) * 100, 4) AS risk_boo, round_even(7.0::DOUBLE * todu_30ever_h6_rep / nullif(todu_amt_pile_h6_rep, 0) * 100, 4) AS risk_rep,
 greatest(round(tp - oa_amt_h0_boo, 4), 0) AS oa_amt_h0_cut, greatest(round(ta - todu_30ever_h6_boo, 4), 0) AS todu_30ever_h6_cut, greatest(round(tt - todu_amt_pile_h6_boo, 4), 0) AS todu_amt_pile_h6_cut
FROM kpi, (SELECT sum(pb)::DOUBLE AS tp, sum(ab)::DOUBLE AS ta, sum(tb)::DOUBLE AS tt FROM g)""", LEVELS_SQL)
def agg16(spark, d):
    c = cells(spark, d)
    return cut.solution_kpis(cut.solution_cuts(solutions(spark, d), ORDER), cut.prefix_levels(c, ALL), c, measures=ALL)


@query("win4_pareto_filter", "SELECT solution, oa_amt_h0, todu_30ever_h6, todu_amt_pile_h6, risk FROM fr", LEVELS_SQL)
def win4(spark, d):
    return frontier(spark, d)


#: 50 targets from a hundredth of a percent to 1.1 times the highest risk of a cell.
GRID_SQL = "SELECT round(0.01::DOUBLE + i * (1.1::DOUBLE * mx - 0.01) / 49, 6) AS target FROM (SELECT max(7.0::DOUBLE * a::DOUBLE / nullif(t::DOUBLE, 0) * 100) AS mx FROM g), range(50) r(i)"


def target_grid(spark, d, n=50):
    mx = cells(spark, d).agg(F.max(F.lit(7.0) * F.col("todu_30ever_h6").cast(cut.MONEY).cast("double") / F.expr(f"nullif(double(cast(todu_amt_pile_h6 AS {cut.MONEY})), 0)") * 100).alias("mx"))
    i = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    return mx.select("mx", i.alias("i")).select(F.round(F.lit(0.01) + F.col("i") * (F.lit(1.1) * F.col("mx") - 0.01) / (n - 1), 6).alias("target"))


def best_sql(extra="TRUE", targets=f"SELECT unnest({TARGETS})::DOUBLE AS target"):
    return f""",
ts AS ({targets}),
lt AS (SELECT target, score_rf_bin, level, p, round(7.0::DOUBLE * a::DOUBLE - target / 100 * t::DOUBLE, 4)::DECIMAL(20,4) AS s FROM lv, ts WHERE {extra}),
mk AS (SELECT target, solution AS path, sum(p) AS production, sum(s) AS slack FROM cuts JOIN lt USING (score_rf_bin, level) GROUP BY 1, 2 HAVING count(*) = 4),
best AS (SELECT target, path, production::DOUBLE AS production, slack::DOUBLE AS slack FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY production DESC, slack, path) AS k FROM mk WHERE slack <= 0) WHERE k = 1)"""


def targets(spark, values=TARGETS):
    return spark.createDataFrame([(t,) for t in values], "target double")


@query("cut4_frontier_by_target", "SELECT * FROM best", LEVELS_SQL + best_sql(targets=GRID_SQL))
def cut4(spark, d):
    return cut.frontier_by_target(levels(spark, d), target_grid(spark, d), ORDER)


PINS = [(2, 4, 0), (4, 1, 1), (3, 3, 0)]


@query("cut5_frontier_with_pins", "SELECT * FROM best", LEVELS_SQL + best_sql("NOT (score_rf_bin = 2 AND level > 3) AND NOT (score_rf_bin = 4 AND level < 1) AND NOT (score_rf_bin = 3 AND level > 2)"))
def cut5(spark, d):
    pins = spark.createDataFrame(PINS, "score_rf_bin int, risk_score_rf_bin int, accept int")
    return cut.frontier_by_target(levels(spark, d), targets(spark), ORDER, allowed=cut.allowed_levels(pins))


@query("cut6_mask_to_cutoffs", "SELECT solution, score_rf_bin, CASE WHEN level = 0 THEN '-inf' ELSE level::VARCHAR END AS cut FROM cuts", LEVELS_SQL)
def cut6(spark, d):
    m = cut.masks(cut.solution_cuts(solutions(spark, d), ORDER), cells(spark, d))
    c = cut.mask_to_cutoffs(m)
    return c.select("solution", "score_rf_bin", F.when(F.col("cut") == float("-inf"), "-inf").otherwise(F.col("cut").cast("int").cast("string")).alias("cut"))


@query("cut6b_mask_projections", """
WITH m AS (SELECT score_rf_bin, risk_score_rf_bin, early_bad, (sum(oa_amt_h0::DECIMAL(20,4)) > 3 * sum(todu_30ever_h6::DECIMAL(20,4)) * 20)::INT AS accept FROM booked GROUP BY 1, 2, 3)
SELECT 'score_rf_bin' AS dimension, score_rf_bin::DOUBLE AS bin, max(accept)::DOUBLE AS accepted FROM m GROUP BY 2 UNION ALL SELECT 'risk_score_rf_bin', risk_score_rf_bin::DOUBLE, max(accept)::DOUBLE FROM m GROUP BY 2
UNION ALL SELECT 'early_bad', early_bad::DOUBLE, max(accept)::DOUBLE FROM m GROUP BY 2""")
def cut6b(spark, d):
    c = booked(spark, d).groupBy("score_rf_bin", "risk_score_rf_bin", "early_bad").agg(F.sum(cut.money("oa_amt_h0")).alias("p"), F.sum(cut.money("todu_30ever_h6")).alias("a"))
    return cut.mask_projections(c.withColumn("accept", F.expr("int(p > 3 * a * 20)")), ["score_rf_bin", "risk_score_rf_bin", "early_bad"], ())


@query("cut7_monotonicity_violations", """
WITH m AS (SELECT score_rf_bin, risk_score_rf_bin, (100 * todu_30ever_h6_boo * 7 / todu_amt_pile_h6_boo < 11)::INT AS accept FROM cells)
SELECT 'score_rf_bin' AS dimension, s.score_rf_bin, s.risk_score_rf_bin FROM m s JOIN m r ON r.risk_score_rf_bin = s.risk_score_rf_bin AND r.score_rf_bin = s.score_rf_bin - 1 WHERE s.accept = 0 AND r.accept = 1
UNION ALL SELECT 'risk_score_rf_bin', s.score_rf_bin, s.risk_score_rf_bin FROM m s JOIN m r ON r.score_rf_bin = s.score_rf_bin AND r.risk_score_rf_bin = s.risk_score_rf_bin + 1 WHERE s.accept = 0 AND r.accept = 1""", CELLS_SQL)
def cut7(spark, d):
    m = cells(spark, d).withColumn("accept", F.when(F.lit(100) * F.col("todu_30ever_h6_boo") * 7 / F.col("todu_amt_pile_h6_boo") < 11, 1).otherwise(0))
    return cut.monotonicity_violations(m, {"score_rf_bin": False, "risk_score_rf_bin": True}, keys=())


@query("cut8_fixed_cutoffs", """
WITH c AS (SELECT unnest([5, 4, 2, 1]) AS score_rf_bin, unnest([3, 2, 3, 9]) AS level), w AS (SELECT 5 - i AS score_rf_bin, i FROM range(1, 5) x(i)),
j AS (SELECT i, w.score_rf_bin, level FROM w LEFT JOIN c USING (score_rf_bin))
SELECT 'missing' AS problem, score_rf_bin FROM j WHERE level IS NULL UNION ALL SELECT 'out of range', score_rf_bin FROM j WHERE level NOT BETWEEN 0 AND 4
UNION ALL SELECT 'not monotone', score_rf_bin FROM (SELECT *, lag(level) OVER (ORDER BY i) AS b FROM j WHERE level IS NOT NULL) WHERE level > b""")
def cut8(spark, d):
    bins = [r[0] for r in booked(spark, d).select("score_rf_bin").distinct().orderBy(F.desc("score_rf_bin")).collect()]
    c = spark.createDataFrame([(5, 3), (4, 2), (2, 3), (1, 9)], "score_rf_bin int, level int")
    return cut.fixed_cutoff_problems(c, bins, 4)


METRICS_SQL = f"""
WITH f AS ({FIXED_SQL}), c AS (SELECT *, risk_score_rf_bin <= cut AS ok FROM cells JOIN f USING (score_rf_bin)),
s AS (SELECT sum(oa_amt_h0_boo::DECIMAL(20,4))::DOUBLE AS a0, sum(todu_30ever_h6_boo::DECIMAL(20,4))::DOUBLE AS a1, sum(todu_amt_pile_h6_boo::DECIMAL(20,4))::DOUBLE AS a2,
 (sum(oa_amt_h0_rep::DECIMAL(20,4)) FILTER (ok))::DOUBLE AS i0, (sum(todu_30ever_h6_rep::DECIMAL(20,4)) FILTER (ok))::DOUBLE AS i1, (sum(todu_amt_pile_h6_rep::DECIMAL(20,4)) FILTER (ok))::DOUBLE AS i2,
 (sum(oa_amt_h0_boo::DECIMAL(20,4)) FILTER (NOT ok))::DOUBLE AS o0, (sum(todu_30ever_h6_boo::DECIMAL(20,4)) FILTER (NOT ok))::DOUBLE AS o1, (sum(todu_amt_pile_h6_boo::DECIMAL(20,4)) FILTER (NOT ok))::DOUBLE AS o2 FROM c),
r AS (SELECT 'Actual' AS metric, a0 AS production, a0, a1 AS n, a2 AS t FROM s UNION ALL SELECT 'Swap-in', i0, a0, i1, i2 FROM s UNION ALL SELECT 'Swap-out', o0, a0, o1, o2 FROM s
 UNION ALL SELECT 'Optimum selected', round(a0 - o0 + i0, 4), a0, round(a1 - o1 + i1, 4), round(a2 - o2 + i2, 4) FROM s)"""


@query("cut9_apply_cuts", METRICS_SQL + " SELECT metric, production, round(production / a0, 9) AS production_share, n AS todu_30ever_h6, t AS todu_amt_pile_h6, round_even(7.0::DOUBLE * n / t * 100, 2) AS risk FROM r", CELLS_SQL)
def cut9(spark, d):
    return rounded(cut.apply_cuts(cells(spark, d), fixed_cuts(spark)), 9)


@query("cut10_perturb_risk", "SELECT score_rf_bin, risk_score_rf_bin, l AS level_pct, round(todu_30ever_h6_rep * (1 + l / 100), 4) AS todu_30ever_h6_rep, round(todu_30ever_h6_boo + todu_30ever_h6_rep * (1 + l / 100), 4) AS todu_30ever_h6 FROM cells, (SELECT unnest([-10.0, 10.0, 25.0])::DOUBLE AS l)", CELLS_SQL)
def cut10(spark, d):
    return rounded(cut.perturb_risk(cells(spark, d), [-10, 10, 25]).select("score_rf_bin", "risk_score_rf_bin", "level_pct", "todu_30ever_h6_rep", "todu_30ever_h6"))


PERTURBED = [-30.0, -15.0, -5.0, 5.0, 15.0, 30.0]
PERT_SQL = LEVELS_SQL + f""",
pl AS (SELECT unnest({sorted([0.0, *PERTURBED])})::DOUBLE AS level_pct),
pc AS (SELECT level_pct, score_rf_bin, risk_score_rf_bin, oa_amt_h0::DECIMAL(20,4) AS p, (todu_30ever_h6_boo + todu_30ever_h6_rep * (1 + level_pct / 100))::DECIMAL(20,4) AS a, todu_amt_pile_h6::DECIMAL(20,4) AS t FROM cells, pl),
plv AS (SELECT k.level_pct, b AS score_rf_bin, l AS level, coalesce(sum(p), 0) AS p, round(7.0::DOUBLE * coalesce(sum(a), 0)::DOUBLE - 11.0::DOUBLE / 100 * coalesce(sum(t), 0)::DOUBLE, 4)::DECIMAL(20,4) AS s FROM pl k CROSS JOIN range(1, 5) x(b) CROSS JOIN range(0, 5) y(l) LEFT JOIN pc ON pc.level_pct = k.level_pct AND score_rf_bin = b AND risk_score_rf_bin <= l GROUP BY 1, 2, 3),
pm AS (SELECT level_pct, solution, sum(p) AS production, sum(s) AS slack FROM cuts JOIN plv USING (score_rf_bin, level) GROUP BY 1, 2),
pb AS (SELECT level_pct, solution, production::DOUBLE AS production FROM (SELECT *, row_number() OVER (PARTITION BY level_pct ORDER BY production DESC, slack, solution) AS k FROM pm WHERE slack <= 0) WHERE k = 1),
pa AS (SELECT pb.level_pct, pb.solution, pb.production, c.score_rf_bin, v AS risk_score_rf_bin, (v <= level)::INT AS accept FROM pb JOIN cuts c USING (solution) CROSS JOIN range(1, 5) z(v)),
pd AS (SELECT pa.*, b.accept AS base FROM pa JOIN pa b ON b.level_pct = 0 AND b.score_rf_bin = pa.score_rf_bin AND b.risk_score_rf_bin = pa.risk_score_rf_bin)"""


@query("cut11_sensitivity", "SELECT level_pct, count(*) FILTER (base <> accept) AS n_flips, count(*) FILTER (base = 1 AND accept = 0) AS accept_to_reject, count(*) FILTER (base = 0 AND accept = 1) AS reject_to_accept, any_value(production) AS production, any_value(solution) AS path FROM pd GROUP BY 1", PERT_SQL)
def cut11(spark, d):
    return cut.sensitivity(cells(spark, d), PERTURBED, 11.0, ORDER)


@query("cut12_cell_flip_threshold", """
SELECT score_rf_bin, risk_score_rf_bin, base, t AS threshold, CASE WHEN t IS NULL THEN 'stable' WHEN base = 1 THEN 'to_reject' ELSE 'to_accept' END AS direction FROM (
 SELECT score_rf_bin, risk_score_rf_bin, base, (list(level_pct ORDER BY abs(level_pct), level_pct) FILTER (accept <> base))[1] AS t FROM pd GROUP BY 1, 2, 3)""", PERT_SQL)
def cut12(spark, d):
    return cut.cell_flip_threshold(cells(spark, d), PERTURBED, 11.0, ORDER)


@query("cut13_marginal_impact", f"""
WITH f AS ({FIXED_SQL}), c AS (SELECT *, (risk_score_rf_bin <= cut)::INT AS accept, CASE WHEN risk_score_rf_bin <= cut THEN -1.0 ELSE 1.0 END::DOUBLE AS s FROM cells JOIN f USING (score_rf_bin)),
t AS (SELECT (sum(todu_30ever_h6::DECIMAL(20,4)) FILTER (accept = 1))::DOUBLE AS a, (sum(todu_amt_pile_h6::DECIMAL(20,4)) FILTER (accept = 1))::DOUBLE AS e FROM c)
SELECT score_rf_bin, risk_score_rf_bin, accept, round(s * oa_amt_h0, 4) AS delta_production, round(round_even(7.0::DOUBLE * (a + s * todu_30ever_h6) / (e + s * todu_amt_pile_h6) * 100, 2) - round_even(7.0::DOUBLE * a / e * 100, 2), 2) AS delta_risk, round(oa_amt_h0, 4) AS cell_production, round_even(7.0::DOUBLE * todu_30ever_h6 / todu_amt_pile_h6 * 100, 2) AS cell_risk FROM c, t""", CELLS_SQL)
def cut13(spark, d):
    c = cells(spark, d)
    m = cut.masks(fixed_cuts(spark).select(F.lit("fixed").alias("solution"), "score_rf_bin", F.col("cut").cast("int").alias("level")), c)
    return rounded(cut.marginal_impact(c, m))


@query("top1_select_scenario", """
WITH t AS (SELECT unnest(['strict', 'base', 'loose', 'none']) AS scenario, unnest([10.5, 11.0, 11.5, 1.0])::DOUBLE AS target)
SELECT scenario, target, solution, oa_amt_h0, risk FROM (SELECT *, row_number() OVER (PARTITION BY scenario ORDER BY (risk <= target) DESC, CASE WHEN risk <= target THEN -risk ELSE risk END, solution) AS k FROM fr, t) WHERE k = 1""", LEVELS_SQL)
def top1(spark, d):
    t = spark.createDataFrame([("strict", 10.5), ("base", 11.0), ("loose", 11.5), ("none", 1.0)], "scenario string, target double")
    return cut.select_scenario(frontier(spark, d), t).select("scenario", "target", "solution", "oa_amt_h0", "risk")


@query("top2_nearest_point", "SELECT solution, oa_amt_h0, risk FROM fr ORDER BY abs(risk - 11.2), solution LIMIT 1", LEVELS_SQL)
def top2(spark, d):
    return cut.nearest_point(frontier(spark, d), 11.2).select("solution", "oa_amt_h0", "risk")


@query("top4_sample_solutions", "SELECT solution, oa_amt_h0 FROM kpi WHERE solution NOT IN (SELECT solution FROM fr) ORDER BY md5('sample' || solution) LIMIT 20", LEVELS_SQL)
def top4(spark, d):
    k = kpis(spark, d)
    return cut.sample_solutions(k.join(F.broadcast(cut.pareto_filter(k).select("solution")), "solution", "left_anti"), 20).select("solution", "oa_amt_h0")


@query("jn1_solutions_with_frontier", "SELECT solution, score_rf_bin, level::INT AS level, risk FROM cuts JOIN fr USING (solution)", LEVELS_SQL)
def jn1(spark, d):
    return cut.solution_cuts(solutions(spark, d), ORDER).join(frontier(spark, d).select("solution", "risk"), "solution")


@query("jn5_theta_accepted_cells", "SELECT solution, count(*) AS n_cells, sum(p)::DOUBLE AS production FROM cuts c JOIN g ON g.score_rf_bin = c.score_rf_bin AND g.risk_score_rf_bin <= c.level GROUP BY 1", LEVELS_SQL)
def jn5(spark, d):
    c, s = cells(spark, d), cut.solution_cuts(solutions(spark, d), ORDER)
    j = s.join(F.broadcast(c), (s.score_rf_bin == c.score_rf_bin) & (c.risk_score_rf_bin <= s.level))
    return j.groupBy("solution").agg(F.count("*").alias("n_cells"), F.sum(cut.money("oa_amt_h0")).cast("double").alias("production"))


@query("jn4_cross_grid", "SELECT a.score_rf_bin, b.risk_score_rf_bin FROM (SELECT DISTINCT score_rf_bin FROM clean) a CROSS JOIN (SELECT DISTINCT risk_score_rf_bin FROM clean) b")
def jn4(spark, d):
    c = demand(spark, d)
    return c.select("score_rf_bin").distinct().crossJoin(F.broadcast(c.select("risk_score_rf_bin").distinct()))


SEGMENTS = ["automobile", "building", "furniture", "household", "machinery"]
SEG_SQL = LEVELS_SQL + """,
sg AS (SELECT segment_cut_off, score_rf_bin, risk_score_rf_bin, sum(oa_amt_h0::DECIMAL(20,4)) AS p, sum(todu_30ever_h6::DECIMAL(20,4)) AS a, sum(todu_amt_pile_h6::DECIMAL(20,4)) AS t FROM booked GROUP BY 1, 2, 3),
sl AS (SELECT s.segment_cut_off, b AS score_rf_bin, l AS level, coalesce(sum(p), 0) AS p, coalesce(sum(a), 0) AS a, coalesce(sum(t), 0) AS t FROM (SELECT DISTINCT segment_cut_off FROM booked) s CROSS JOIN range(1, 5) x(b) CROSS JOIN range(0, 5) y(l) LEFT JOIN sg ON sg.segment_cut_off = s.segment_cut_off AND score_rf_bin = b AND risk_score_rf_bin <= l GROUP BY 1, 2, 3),
sk AS (SELECT segment_cut_off, solution, sum(p)::DOUBLE AS oa_amt_h0, sum(a)::DOUBLE AS todu_30ever_h6, sum(t)::DOUBLE AS todu_amt_pile_h6 FROM cuts JOIN sl USING (score_rf_bin, level) GROUP BY 1, 2),
sr AS (SELECT *, round_even(7.0::DOUBLE * todu_30ever_h6 / nullif(todu_amt_pile_h6, 0) * 100, 4) AS risk FROM sk),
sf AS (SELECT segment_cut_off, solution, oa_amt_h0, risk FROM (SELECT *, max(oa_amt_h0) OVER (PARTITION BY segment_cut_off ORDER BY risk, oa_amt_h0 DESC, solution ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx FROM sr WHERE risk IS NOT NULL) WHERE mx IS NULL OR oa_amt_h0 > mx)"""


def segment_frontiers(spark, d):
    c = cl.booked_cells(booked(spark, d), 1.0, ["segment_cut_off", *cl.CELL])
    c = cl.complete_grid(c, {"score_rf_bin": range(1, 5), "risk_score_rf_bin": range(1, 5)}, ["segment_cut_off"])
    c = c.select("segment_cut_off", *cl.CELL, *[F.col(f"{i}_boo").alias(i) for i in cl.INDICATORS])
    lv = cut.prefix_levels(c, keys=["segment_cut_off"])
    k = cut.solution_kpis(cut.solution_cuts(solutions(spark, d), ORDER), lv, keys=["segment_cut_off"])
    return cut.strict_frontier(k).select("segment_cut_off", "solution", "oa_amt_h0", "risk")


@query("win5_strict_frontier", "SELECT * FROM sf", SEG_SQL)
def win5(spark, d):
    return segment_frontiers(spark, d)


@query("set2_distinct_bin_limits", "SELECT DISTINCT score_rf_bin, level::INT AS level FROM sf JOIN cuts USING (solution)", SEG_SQL)
def set2(spark, d):
    """The limits of single bins that the frontiers of all segments use, each once."""
    f = segment_frontiers(spark, d).select("solution")
    return f.join(cut.solution_cuts(solutions(spark, d), ORDER), "solution").select("score_rf_bin", "level").distinct()


EXACT_SQL = ("WITH " + ", ".join(f"f{i} AS (SELECT solution, oa_amt_h0::DECIMAL(20,4) AS p, round(oa_amt_h0 * (risk - 11.0::DOUBLE), 4)::DECIMAL(20,4) AS s FROM sf WHERE segment_cut_off = '{s}')" for i, s in enumerate(SEGMENTS)) + """,
a0 AS (SELECT f0.solution || '|' || f1.solution AS path, f0.p + f1.p AS p, f0.s + f1.s AS s FROM f0, f1),
a1 AS (SELECT f2.solution || '|' || f3.solution || '|' || f4.solution AS path, f2.p + f3.p + f4.p AS p, f2.s + f3.s + f4.s AS s FROM f2, f3, f4),
pick AS (SELECT a0.path || '|' || a1.path AS path FROM a0, a1 WHERE a0.s + a1.s <= 0 ORDER BY a0.p + a1.p DESC, a0.s + a1.s, a0.path || '|' || a1.path LIMIT 1),
chosen AS (SELECT unnest(""" + str(SEGMENTS) + """) AS segment_cut_off, unnest(string_split(path, '|')) AS solution FROM pick)""")


@query("cut18_allocate_exact", EXACT_SQL + " SELECT sf.* FROM sf JOIN chosen USING (segment_cut_off, solution)", SEG_SQL)
def cut18(spark, d):
    return al.allocate_exact(segment_frontiers(spark, d), 11.0, SEGMENTS)


@query("cut18b_allocate_tree", EXACT_SQL + " SELECT sf.* FROM sf JOIN chosen USING (segment_cut_off, solution)", SEG_SQL)
def cut18b(spark, d):
    return al.allocate_tree(segment_frontiers(spark, d), 11.0)


RANKED_SQL = """
WITH f AS (SELECT *, row_number() OVER w AS k, oa_amt_h0 - coalesce(lag(oa_amt_h0) OVER w, 0) AS dp, oa_amt_h0 * risk - coalesce(lag(oa_amt_h0 * risk) OVER w, 0) AS dm FROM sf WINDOW w AS (PARTITION BY segment_cut_off ORDER BY risk, solution)),
h AS (SELECT *, round(dm - dp * 11.0::DOUBLE, 4)::DECIMAL(20,4) AS ds, CASE WHEN k > 1 THEN dp / CASE WHEN dm > 0 THEN dm END END AS e0 FROM f),
i AS (SELECT *, CASE WHEN k = 1 THEN 'infinity'::DOUBLE ELSE min(coalesce(e0, 1e308)) OVER (PARTITION BY segment_cut_off ORDER BY risk, solution) END AS e FROM h),
j AS (SELECT *, sum(ds) OVER (ORDER BY e DESC, segment_cut_off, k) AS run FROM i),
m AS (SELECT *, max(CASE WHEN k > 1 THEN run END) OVER (ORDER BY e DESC, segment_cut_off, k) AS worst FROM j),
chosen AS (SELECT segment_cut_off, solution, oa_amt_h0, risk FROM (SELECT *, row_number() OVER (PARTITION BY segment_cut_off ORDER BY k DESC) AS z FROM m WHERE k = 1 OR worst <= 0) WHERE z = 1)"""


@query("cut19_allocate_ranked", RANKED_SQL + " SELECT * FROM chosen", SEG_SQL)
def cut19(spark, d):
    return al.allocate_ranked(segment_frontiers(spark, d), 11.0)


@query("cut20_allocation_table", RANKED_SQL + """ SELECT segment_cut_off, production, mass / production AS risk, production / max(production) OVER () AS share FROM (
 SELECT segment_cut_off, sum(oa_amt_h0::DECIMAL(28,4))::DOUBLE AS production, sum(round(oa_amt_h0 * risk, 4)::DECIMAL(28,4))::DOUBLE AS mass FROM chosen GROUP BY ROLLUP (1))""", SEG_SQL)
def cut20(spark, d):
    return al.allocation_table(al.allocate_ranked(segment_frontiers(spark, d), 11.0))


DIR_SQL = """
WITH b AS (SELECT VAR AS x, round_even(7.0::DOUBLE * sum(todu_30ever_h6::DECIMAL(20,4))::DOUBLE / nullif(sum(todu_amt_pile_h6::DECIMAL(20,4))::DOUBLE, 0), 2) AS y, sum(oa_amt::DECIMAL(20,4))::DOUBLE AS w FROM booked GROUP BY 1),
r AS (SELECT x, w, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0::DOUBLE AS rx, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0::DOUBLE AS ry FROM b),
p AS (SELECT r.*, b, row_number() OVER (PARTITION BY b ORDER BY x) AS i, CASE WHEN b = 0 THEN row_number() OVER (PARTITION BY b ORDER BY x) ELSE row_number() OVER (PARTITION BY b ORDER BY md5('direction|' || b || '|' || x)) END AS j FROM r, range(0, 1001) z(b)),
q AS (SELECT p.b, sum(p.w * p.rx * y.ry) / sum(p.w) - sum(p.w * p.rx) / sum(p.w) * sum(p.w * y.ry) / sum(p.w) AS cov, count(*) AS n FROM p JOIN p y ON y.b = p.b AND y.i = p.j GROUP BY 1),
o AS (SELECT cov AS covariance, n FROM q WHERE b = 0),
d AS (SELECT (count(*) FILTER (abs(cov) >= abs(covariance) - 1e-12) + 1)::DOUBLE / (count(*) + 1) AS p_value FROM q, o WHERE b > 0)
SELECT 'VAR' AS variable, round(covariance, 6) AS covariance, round(p_value, 6) AS p_value, CASE WHEN n >= 2 AND abs(covariance) > 1e-8 AND p_value <= 0.1 AND covariance < 0 THEN -1 ELSE 1 END AS direction FROM o, d"""


@query("cut2_infer_direction", DIR_SQL.replace("VAR", "risk_score_rf_bin"))
def cut2(spark, d):
    return rounded(cut.infer_direction(booked(spark, d), "risk_score_rf_bin"), 6)
