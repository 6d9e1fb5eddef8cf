"""Queries on models of every segment, the cells and frontiers that they give, and monitoring from stored sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cells as cl, cutoffs as cut, isotonic as iso, population as pop, risk_models as rm, segment_models as sm, sketches as sk
from ..sources.shared import new_path
from .cuts import ORDER
from .portfolio import rounded
from .registry import COMMON_SQL, booked, clean, demand, query
from .results import least_squares_sql

FEATURES = list(cl.CELL)
LEAST_CELLS, LEAST_RECORDS, FINANCING = 15, 5, 0.8
TARGETS = [10.0, 12.0, 14.0, 17.0, 20.0]

_SUMS = ", ".join(f"sum({i}::DECIMAL(20,4))::DOUBLE AS {i}" for i in cl.INDICATORS)
SEGMENTS_SQL = COMMON_SQL + f""",
sc AS (SELECT segment_cut_off, score_rf_bin, risk_score_rf_bin, {_SUMS}, count(*) AS n FROM booked GROUP BY 1, 2, 3),
named AS (SELECT 'segment:' || segment_cut_off AS name, * FROM sc UNION ALL SELECT 'supersegment:durables', * FROM sc WHERE segment_cut_off IN ('machinery', 'automobile') UNION ALL SELECT 'all:all', * FROM sc),
nc AS (SELECT name, score_rf_bin AS x, risk_score_rf_bin AS z, {_SUMS}, sum(n) AS n FROM named GROUP BY 1, 2, 3),
nt AS (SELECT name, x, z, oa_amt_h0 AS o, todu_amt_pile_h6 AS w, round_even(7.0::DOUBLE * todu_30ever_h6 / nullif(todu_amt_pile_h6, 0), 2) AS y FROM nc WHERE n >= {LEAST_RECORDS}),
nm AS (SELECT name, quantile_cont(y, 0.5) AS mid, count(*) AS k FROM nt WHERE y IS NOT NULL GROUP BY 1),
nd AS (SELECT name, quantile_cont(abs(y - mid), 0.5) AS mad FROM nt JOIN nm USING (name) WHERE y IS NOT NULL GROUP BY 1),
kept AS (SELECT nt.* FROM nt JOIN nm USING (name) JOIN nd USING (name) WHERE y IS NOT NULL AND (k <= 2 OR mad = 0 OR 0.6745 * abs(y - mid) < 3 * mad)),
rb AS ({least_squares_sql("kept", "name")}),
eb AS (SELECT name, regr_intercept(w, o) AS e0, regr_slope(w, o) AS e1 FROM kept GROUP BY 1),
nn AS (SELECT name, count(*) AS n_cells FROM kept GROUP BY 1),
opt AS (SELECT segment_cut_off, 1 AS k, 'segment:' || segment_cut_off AS name FROM sc UNION SELECT segment_cut_off, 2, 'supersegment:durables' FROM sc WHERE segment_cut_off IN ('machinery', 'automobile') UNION SELECT segment_cut_off, 9, 'all:all' FROM sc),
used AS (SELECT segment_cut_off, name, n_cells FROM (SELECT *, row_number() OVER (PARTITION BY segment_cut_off ORDER BY k) AS r FROM opt JOIN nn USING (name) WHERE n_cells >= {LEAST_CELLS} OR k = 9) WHERE r = 1),
model AS (SELECT segment_cut_off, split_part(name, ':', 1) AS level, split_part(name, ':', 2) AS name, b0, b1, b2, e0, e1, n_cells FROM used JOIN rb USING (name) JOIN eb USING (name)),
sq AS (SELECT segment_cut_off, quantile_cont(score_rf, 0.05) AS q FROM booked GROUP BY 1),
st AS (SELECT segment_cut_off, coalesce((sum(todu_30ever_h6::DECIMAL(20,4)) FILTER (score_rf <= q))::DOUBLE / (sum(todu_amt_pile_h6::DECIMAL(20,4)) FILTER (score_rf <= q))::DOUBLE / nullif(sum(todu_30ever_h6::DECIMAL(20,4))::DOUBLE / sum(todu_amt_pile_h6::DECIMAL(20,4))::DOUBLE, 0), 1.0) AS stress FROM booked JOIN sq USING (segment_cut_off) GROUP BY 1),
srate AS (SELECT segment_cut_off, score_rf_bin, risk_score_rf_bin, CASE WHEN b + r > 0 THEN b::DOUBLE / (b + r) ELSE 1.0 END AS rate FROM (SELECT segment_cut_off, score_rf_bin, risk_score_rf_bin, count(*) FILTER (status_name = 'booked') AS b, count(*) FILTER (status_name = 'rejected' AND reject_reason = '09-score') AS r FROM demand GROUP BY 1, 2, 3)),
srej AS (SELECT segment_cut_off, score_rf_bin, risk_score_rf_bin, sum(oa_amt::DECIMAL(20,4))::DOUBLE AS o FROM demand WHERE status_name = 'rejected' AND reject_reason = '09-score' GROUP BY 1, 2, 3),
ssc AS (SELECT segment_cut_off, score_rf_bin, risk_score_rf_bin, o, e0 + e1 * o AS t, greatest(coalesce(stress, 1.0) * (b0 + b1 * score_rf_bin + b2 * risk_score_rf_bin), 0.0) AS ratio, least(greatest(1.0::DOUBLE + 1.5::DOUBLE * (1 - coalesce(rate, 1.0)), 1.0), 3.0) AS up
  FROM srej LEFT JOIN model USING (segment_cut_off) LEFT JOIN st USING (segment_cut_off) LEFT JOIN srate USING (segment_cut_off, score_rf_bin, risk_score_rf_bin)),
srep AS (SELECT segment_cut_off, score_rf_bin, risk_score_rf_bin, ratio * t / 7.0::DOUBLE * up * {FINANCING}::DOUBLE AS todu_30ever_h6_rep, t * {FINANCING}::DOUBLE AS todu_amt_pile_h6_rep, o * {FINANCING}::DOUBLE AS oa_amt_h0_rep FROM ssc),
scells AS (SELECT segment_cut_off, score_rf_bin, risk_score_rf_bin, {", ".join(f"round(coalesce({i}, 0), 2) AS {i}_boo, round(coalesce({i}_rep, 0), 2) AS {i}_rep, round(coalesce({i}, 0) + coalesce({i}_rep, 0), 2) AS {i}" for i in cl.INDICATORS)}
  FROM sc FULL JOIN srep USING (segment_cut_off, score_rf_bin, risk_score_rf_bin))"""


def models(spark, d):
    return sm.segment_models(booked(spark, d), FEATURES, pop.SUPERSEGMENTS, LEAST_CELLS, LEAST_RECORDS)


def segment_cells(spark, d):
    return rounded(sm.segment_cell_summary(demand(spark, d), models(spark, d), FEATURES, FINANCING), 2)


@query("ml14b_segment_models", """
SELECT segment_cut_off, level, name, 'risk' AS kind, unnest(['(intercept)', 'score_rf_bin', 'risk_score_rf_bin']) AS feature, round(unnest([b0, b1, b2]), 6) AS coefficient, n_cells FROM model
UNION ALL SELECT segment_cut_off, level, name, 'exposure', unnest(['(intercept)', 'oa_amt_h0']), round(unnest([abs(round(e0, 2)), e1]), 6), n_cells FROM model""", SEGMENTS_SQL)
def ml14b(spark, d):
    is_offset = (F.col("kind") == "exposure") & (F.col("feature") == sm.INTERCEPT)
    value = F.when(is_offset, F.abs(F.round("coefficient", 2))).otherwise(F.col("coefficient"))  # an intercept of about 0 may come out as -0.0
    return models(spark, d).withColumn("coefficient", F.round(value, 6))


@query("agg3b_segment_cells", "SELECT * FROM scells", SEGMENTS_SQL)
def agg3b(spark, d):
    return segment_cells(spark, d)


@query("cut4b_segment_frontier", f"""
WITH g AS (SELECT segment_cut_off, score_rf_bin, risk_score_rf_bin, oa_amt_h0::DECIMAL(20,4) AS p, todu_30ever_h6::DECIMAL(20,4) AS a, todu_amt_pile_h6::DECIMAL(20,4) AS t FROM scells),
lv AS (SELECT s.segment_cut_off, b AS bin, l AS level, coalesce(sum(p), 0) AS p, coalesce(sum(a), 0) AS a, coalesce(sum(t), 0) AS t FROM (SELECT DISTINCT segment_cut_off FROM g) s CROSS JOIN range(1, 5) x(b) CROSS JOIN range(0, 5) y(l) LEFT JOIN g ON g.segment_cut_off = s.segment_cut_off AND score_rf_bin = b AND risk_score_rf_bin <= l GROUP BY 1, 2, 3),
lt AS (SELECT segment_cut_off, target, bin, level, p, round(7.0::DOUBLE * a::DOUBLE - target / 100 * t::DOUBLE, 4)::DECIMAL(20,4) AS s FROM lv, (SELECT unnest({TARGETS})::DOUBLE AS target)),
so AS (SELECT a || '-' || b || '-' || c || '-' || d AS path, [d, c, b, a] AS cuts_of FROM range(0, 5) w(a), range(0, 5) x(b), range(0, 5) y(c), range(0, 5) z(d) WHERE a >= b AND b >= c AND c >= d),
cu AS (SELECT path, k AS bin, cuts_of[k] AS level FROM so, range(1, 5) r(k)),
mk AS (SELECT segment_cut_off, target, path, sum(p) AS production, sum(s) AS slack FROM cu JOIN lt USING (bin, level) GROUP BY 1, 2, 3)
SELECT segment_cut_off, target, path, production::DOUBLE AS production, slack::DOUBLE AS slack FROM (SELECT *, row_number() OVER (PARTITION BY segment_cut_off, target ORDER BY production DESC, slack, path) AS k FROM mk WHERE slack <= 0) WHERE k = 1""", SEGMENTS_SQL)
def cut4b(spark, d):
    grid = cl.complete_grid(segment_cells(spark, d), {"score_rf_bin": range(1, 5), "risk_score_rf_bin": range(1, 5)}, ["segment_cut_off"])
    targets = spark.createDataFrame([(t,) for t in TARGETS], "target double")
    return cut.frontier_by_target(cut.prefix_levels(grid, keys=["segment_cut_off"]), targets, ORDER, keys=["segment_cut_off"])


VARIABLES = ["score_rf", "risk_score_rf", "oa_amt"]
SKETCH_SQL = COMMON_SQL + """,
xs AS (SELECT unnest(['score_rf', 'risk_score_rf', 'oa_amt']) AS variable, mis_date AS period, unnest([score_rf, risk_score_rf, oa_amt]) AS x FROM clean WHERE status_name = 'booked' AND mis_date BETWEEN DATE '1998-07-01' AND DATE '1999-12-01'),
xe AS (SELECT variable, period, x, abs(x) AS a, floor(log2(nullif(abs(x), 0))) AS e0 FROM xs WHERE x IS NOT NULL),
xf AS (SELECT variable, period, x, a, e0 + CASE WHEN a >= pow(2.0::DOUBLE, e0 + 1) THEN 1 ELSE 0 END - CASE WHEN a < pow(2.0::DOUBLE, e0) THEN 1 ELSE 0 END AS e FROM xe),
xb AS (SELECT variable, period, x, CASE WHEN x = 0 THEN 0 ELSE sign(x)::BIGINT * ((e::BIGINT + 1100) * 1024 + least(floor((a / pow(2.0::DOUBLE, e) - 1) * 1024), 1023)::BIGINT + 1) END AS bin FROM xf),
sk AS (SELECT variable, period, bin, count(*) AS n, min(x) AS lo, max(x) AS hi FROM xb GROUP BY 1, 2, 3),
rf AS (SELECT *, sum(n) OVER (PARTITION BY variable ORDER BY bin) AS cum, sum(n) OVER (PARTITION BY variable) AS total FROM (SELECT variable, bin, sum(n) AS n, min(lo) AS lo, max(hi) AS hi FROM sk WHERE period <= DATE '1999-06-01' GROUP BY 1, 2))"""


def stored_sketches(spark, d):
    """The reference year and each month after it are sketched on their own, as they would come in."""
    path = new_path(spark, "sketches")
    for period in (pop.MAIN, pop.RECENT):
        sk.write_sketches(sk.sketch(booked(spark, d, period), VARIABLES), path)
    return sk.read_sketches(spark, path)


@query("psi3b_sketch_quantiles", "SELECT variable, p, min(hi) AS quantile FROM (SELECT variable, hi, cum, total, unnest([0.05, 0.5, 0.95])::DOUBLE AS p FROM rf) WHERE cum >= ceil(p * total) GROUP BY 1, 2", SKETCH_SQL)
def psi3b(spark, d):
    p = [0.05, 0.5, 0.95]
    q = sk.sketch_quantiles(sk.merged(stored_sketches(spark, d).where(F.col("period") <= pop.MAIN[1])), p)
    return q.select("variable", F.inline(F.arrays_zip(F.array(*map(F.lit, p)).alias("p"), F.col("quantiles").alias("quantile"))))


@query("psi5b_sketch_monitor", """
WITH ed AS (SELECT variable, i, min(bin) AS edge FROM rf, range(1, 10) r(i) WHERE cum * 10 >= i * total GROUP BY 1, 2),
ds AS (SELECT variable, list_sort(list_distinct(list(edge))) AS edges FROM ed GROUP BY 1),
ex AS (SELECT variable, len(list_filter(edges, lambda e: e < bin)) + 1 AS part, sum(n)::DOUBLE AS expected FROM rf JOIN ds USING (variable) GROUP BY 1, 2),
ac AS (SELECT variable, period, len(list_filter(edges, lambda e: e < bin)) + 1 AS part, sum(n)::DOUBLE AS actual FROM sk JOIN ds USING (variable) WHERE period > DATE '1999-06-01' GROUP BY 1, 2, 3),
fu AS (SELECT variable, period, unnest(range(1, len(edges) + 2)) AS part FROM ds JOIN (SELECT DISTINCT variable, period FROM ac) USING (variable)),
ct AS (SELECT variable, period, coalesce(expected, 0) AS e, coalesce(actual, 0) AS a FROM fu LEFT JOIN ex USING (variable, part) LEFT JOIN ac USING (variable, period, part)),
s1 AS (SELECT variable, period, greatest(e / sum(e) OVER w, 1e-4) AS e, greatest(a / sum(a) OVER w, 1e-4) AS a FROM ct WINDOW w AS (PARTITION BY variable, period)),
s2 AS (SELECT variable, period, e / sum(e) OVER w AS e, a / sum(a) OVER w AS a FROM s1 WINDOW w AS (PARTITION BY variable, period)),
s3 AS (SELECT variable, period, sum((a - e) * ln(a / e)) AS psi FROM s2 GROUP BY 1, 2)
SELECT variable, period, round(psi, 6) AS psi, CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'moderate' ELSE 'unstable' END AS status, CASE WHEN psi < 0.1 THEN 'info' WHEN psi < 0.25 THEN 'warning' ELSE 'critical' END AS severity FROM s3""", SKETCH_SQL)
def psi5b(spark, d):
    return rounded(sk.psi_from_sketches(stored_sketches(spark, d), pop.MAIN, pop.RECENT), 6)


@query("ml5b_monotone_surface", """
WITH so AS (SELECT row_number() OVER () AS id, [d, c, b, a] AS st FROM range(0, 5) w(a), range(0, 5) x(b), range(0, 5) y(c), range(0, 5) z(d) WHERE a >= b AND b >= c AND c >= d),
gr AS (SELECT segment_cut_off, score_rf_bin AS x, risk_score_rf_bin AS z, 7.0::DOUBLE * todu_30ever_h6 AS a, todu_amt_pile_h6 AS w FROM sc WHERE todu_amt_pile_h6 > 0),
pf AS (SELECT s.segment_cut_off, k AS x, l AS z, coalesce(sum(a), 0) AS a, coalesce(sum(w), 0) AS w FROM (SELECT DISTINCT segment_cut_off FROM gr) s CROSS JOIN range(1, 5) r(k) CROSS JOIN range(0, 5) q(l) LEFT JOIN gr ON gr.segment_cut_off = s.segment_cut_off AND gr.x = k AND gr.z <= l GROUP BY 1, 2, 3),
pr AS (SELECT u.id AS u, l.id AS l, u.st AS us, l.st AS ls FROM so u, so l WHERE u.id <> l.id),
bt AS (SELECT segment_cut_off, u, l, sum(hi.a - lo.a) / nullif(sum(hi.w - lo.w), 0) AS av FROM pr, range(1, 5) r(k) JOIN pf lo ON lo.x = k AND lo.z = us[k] JOIN pf hi USING (segment_cut_off) WHERE hi.x = k AND hi.z = ls[k] AND ls[k] > us[k] GROUP BY 1, 2, 3),
mn AS (SELECT gr.segment_cut_off, gr.x, gr.z, pr.u, min(av) AS low FROM gr JOIN pr ON us[gr.x] < gr.z AND gr.z <= ls[gr.x] JOIN bt ON bt.segment_cut_off = gr.segment_cut_off AND bt.u = pr.u AND bt.l = pr.l GROUP BY 1, 2, 3, 4),
mx AS (SELECT segment_cut_off, x, z, max(low) AS fitted FROM mn GROUP BY 1, 2, 3)
SELECT segment_cut_off, x AS score_rf_bin, z AS risk_score_rf_bin, round(a / w, 6) AS ratio, round(fitted, 6) AS fitted FROM gr JOIN mx USING (segment_cut_off, x, z)""", SEGMENTS_SQL)
def ml5b(spark, d):
    c = cl.booked_cells(booked(spark, d), 1.0, ["segment_cut_off", *cl.CELL])
    return rounded(iso.monotone_surface(c, ORDER, [1, 2, 3, 4], "todu_30ever_h6_boo", "todu_amt_pile_h6_boo", ["segment_cut_off"]), 6)


BINNED = ["score_rf", "risk_score_rf", "early_amount"]


def _splits_sql(rounds: int, least: int) -> str:
    """Best-first splits of all variables; values have few bits, so each is a bin of its own."""
    parts = ["""WITH xv AS (SELECT unnest(['score_rf', 'risk_score_rf', 'early_amount']) AS variable, unnest([score_rf, risk_score_rf, floor(oa_amt / 1000)]) AS x, early_bad AS y FROM clean),
hs AS (SELECT variable, x, count(*) AS n, sum(y) AS bad FROM xv WHERE x IS NOT NULL GROUP BY 1, 2), e0 AS (SELECT NULL::VARCHAR AS variable, NULL::DOUBLE AS edge WHERE FALSE)"""]
    for r in range(rounds):
        parts.append(f"""l{r} AS (SELECT hs.*, (SELECT count(*) FROM e{r} WHERE e{r}.variable = hs.variable AND edge < x) AS leaf FROM hs),
c{r} AS (SELECT variable, x, lead(x) OVER w AS nx, sum(n) OVER w AS nl, sum(bad) OVER w AS bl, sum(n) OVER g AS nt, sum(bad) OVER g AS bt FROM l{r} WINDOW w AS (PARTITION BY variable, leaf ORDER BY x), g AS (PARTITION BY variable, leaf)),
g{r} AS (SELECT variable, (x + nx) / 2 AS edge, round((bt - bt::DOUBLE * bt / nt) - (bl - bl::DOUBLE * bl / nl) - ((bt - bl) - (bt - bl)::DOUBLE * (bt - bl) / (nt - nl)), 9) AS gain FROM c{r} WHERE nx IS NOT NULL AND nl >= {least} AND nt - nl >= {least}),
e{r + 1} AS (SELECT * FROM e{r} UNION ALL SELECT variable, edge FROM (SELECT *, row_number() OVER (PARTITION BY variable ORDER BY gain DESC, edge) AS k FROM g{r} WHERE gain > 0) WHERE k = 1)""")
    return ",\n".join(parts) + f"\nSELECT variable, edge FROM e{rounds}"


@query("ml12b_supervised_bins_of", _splits_sql(4, 200))
def ml12b(spark, d):
    c = clean(spark, d).withColumn("early_amount", F.floor(F.col("oa_amt") / 1000).cast("double"))
    return rm.supervised_bins_of(c, BINNED, "early_bad", 5, 200).select("variable", F.explode("edges").alias("edge"))
