"""Queries on score discrimination and stability."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import discrimination as dis, population as pop, stability as st
from ..operators.resampling import weights_sql
from .portfolio import rounded
from .registry import COMMON_SQL, booked, clean, query

SCORES = {"score_rf": True, "risk_score_rf": False}

LONG_SQL = COMMON_SQL + """,
long AS (SELECT 'score_rf' AS score_name, early_bad AS y, -score_rf AS s, authorization_id AS id FROM booked UNION ALL SELECT 'risk_score_rf', early_bad, risk_score_rf, authorization_id FROM booked),
counts AS (SELECT score_name, s, count(*) AS n, sum(y) AS bad FROM long GROUP BY 1, 2),
roc AS (SELECT score_name, s, n, bad, (sum(bad) OVER w)::DOUBLE / sum(bad) OVER a AS tpr, (sum(n - bad) OVER w)::DOUBLE / sum(n - bad) OVER a AS fpr, sum(n) OVER w AS cn, sum(bad) OVER w AS cb FROM counts WINDOW w AS (PARTITION BY score_name ORDER BY s DESC), a AS (PARTITION BY score_name)),
ag AS (SELECT score_name, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS n_bad, sum(bad * (coalesce(below, 0) + (n - bad) / 2.0))::DOUBLE / (max(b) * max(g))::DOUBLE AS auc FROM (SELECT *, sum(n - bad) OVER (PARTITION BY score_name ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below, sum(bad) OVER (PARTITION BY score_name) AS b, sum(n - bad) OVER (PARTITION BY score_name) AS g FROM counts) GROUP BY 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY score_name ORDER BY s DESC, id) AS r, count(*) OVER (PARTITION BY score_name) AS n_all FROM long)"""
AUC_SQL = "SELECT ag.score_name, n, n_bad, round(auc, 9) AS auc, round(2 * auc - 1, 9) AS gini, round(ks, 9) AS ks FROM ag JOIN (SELECT score_name, greatest(max(tpr - fpr), 0) AS ks FROM roc GROUP BY 1) k USING (score_name)"


def long(spark, d):
    return dis.long_scores(booked(spark, d), SCORES, "early_bad")


@query("met1_roc_points", "SELECT score_name, s, tpr, fpr FROM roc", LONG_SQL)
def met1(spark, d):
    return dis.roc_points(long(spark, d))


@query("met2_auc_gini_ks", AUC_SQL, LONG_SQL)
def met2(spark, d):
    return rounded(dis.auc_gini_ks(long(spark, d)), 9)


@query("met3_rejection_capture", "SELECT score_name, t::INT AS share, 100.0::DOUBLE * (sum(y) FILTER (r <= floor(n_all * t / 100)))::DOUBLE / sum(y) AS capture FROM ranked CROSS JOIN (SELECT unnest([5, 10, 15, 20]) AS t) GROUP BY 1, 2", LONG_SQL)
def met3(spark, d):
    return dis.rejection_capture(long(spark, d))


@query("met4_precision_recall", "SELECT score_name, s, round(p, 9) AS precision, round(tpr, 9) AS recall, round(sum(p * (tpr - lag0)) OVER (PARTITION BY score_name), 9) AS average_precision FROM (SELECT *, cb::DOUBLE / cn AS p, coalesce(lag(tpr) OVER (PARTITION BY score_name ORDER BY s DESC), 0) AS lag0 FROM roc)", LONG_SQL)
def met4(spark, d):
    return rounded(dis.precision_recall(long(spark, d)), 9)


@query("met5_lift_table", """
WITH b AS (SELECT score_name, ceil(r * 10 / n_all)::INT AS bin, count(*) AS n_records, sum(y)::BIGINT AS n_bads FROM ranked GROUP BY 1, 2),
c AS (SELECT *, sum(n_records) OVER w AS cn, sum(n_bads) OVER w AS cb, sum(n_records) OVER a AS n, sum(n_bads) OVER a AS bad FROM b WINDOW w AS (PARTITION BY score_name ORDER BY bin), a AS (PARTITION BY score_name))
SELECT score_name, bin, n_records, n_bads, round(n_bads::DOUBLE / n_records, 4) AS bad_rate, round(n_records::DOUBLE / n, 4) AS pct_population, round(n_bads::DOUBLE / bad, 4) AS pct_bads, round(cb::DOUBLE / bad, 4) AS cumulative_pct_bads, round(cn::DOUBLE / n, 4) AS cumulative_pct_population, round((n_bads::DOUBLE / n_records) / (bad::DOUBLE / n), 4) AS lift, round((cb::DOUBLE / cn) / (bad::DOUBLE / n), 4) AS cumulative_lift FROM c""", LONG_SQL)
def met5(spark, d):
    return dis.lift_table(long(spark, d))


@query("win7_midrank", "SELECT score_name, s, coalesce(sum(n) OVER w, 0) + (n + 1) / 2.0::DOUBLE AS rank, coalesce(sum(bad) OVER w, 0) + (bad + 1) / 2.0::DOUBLE AS rank_bad, coalesce(sum(n - bad) OVER w, 0) + (n - bad + 1) / 2.0::DOUBLE AS rank_good FROM counts WINDOW w AS (PARTITION BY score_name ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)", LONG_SQL)
def win7(spark, d):
    return dis.midranks(long(spark, d))


@query("win8_cumulative_gains", "SELECT score_name, id, r, sum(y) OVER (PARTITION BY score_name ORDER BY r)::BIGINT AS bads FROM ranked", LONG_SQL)
def win8(spark, d):
    return dis.cumulative_gains(long(spark, d))


@query("met6_delong", """
WITH c AS (SELECT score_name, s, coalesce(sum(n) OVER w, 0) + (n + 1) / 2.0 AS rk, coalesce(sum(bad) OVER w, 0) + (bad + 1) / 2.0 AS rb, coalesce(sum(n - bad) OVER w, 0) + (n - bad + 1) / 2.0 AS rg FROM counts WINDOW w AS (PARTITION BY score_name ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT sum(y) AS m, sum(1 - y) AS k FROM long WHERE score_name = 'score_rf'),
v AS (SELECT id, y, score_name, CASE WHEN y = 1 THEN (rk - rb)::DOUBLE / k ELSE 1 - (rk - rg)::DOUBLE / m END AS v FROM long JOIN c USING (score_name, s), t),
p AS (SELECT id, y, max(v) FILTER (score_name = 'score_rf') AS a, max(v) FILTER (score_name = 'risk_score_rf') AS b FROM v GROUP BY 1, 2),
g AS (SELECT avg(a) FILTER (y = 1) AS auc_first, avg(b) FILTER (y = 1) AS auc_second, var_samp(a - b) FILTER (y = 1) / max(m) + var_samp(a - b) FILTER (y = 0) / max(k) AS var FROM p, t),
z AS (SELECT *, (auc_first - auc_second) / sqrt(var) AS z, 1.0 / (1.0 + 0.3275911 * abs((auc_first - auc_second) / sqrt(var)) / sqrt(2.0)) AS t FROM g)
SELECT round(auc_first, 8) AS auc_first, round(auc_second, 8) AS auc_second, round(auc_first - auc_second, 8) AS difference, round(sqrt(var), 8) AS standard_error, round(z, 8) AS z,
 round(t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * exp(-z * z / 2), 8) AS p_value FROM z""", LONG_SQL)
def met6(spark, d):
    return rounded(dis.delong(long(spark, d), "score_rf", "risk_score_rf"), 8)


THREE = {"score_rf": True, "risk_score_rf": False, "oa_amt": False}


@query("met6b_delong_matrix", """
WITH l AS (SELECT segment_cut_off AS g, authorization_id AS id, early_bad AS y, unnest([0, 1, 2]) AS i, unnest([-score_rf, risk_score_rf, oa_amt]) AS s FROM booked),
r AS (SELECT *, rank() OVER (PARTITION BY g, i ORDER BY s) + (count(*) OVER (PARTITION BY g, i, s) - 1) / 2.0 AS ra, rank() OVER (PARTITION BY g, i, y ORDER BY s) + (count(*) OVER (PARTITION BY g, i, y, s) - 1) / 2.0 AS rc,
      sum(y) OVER (PARTITION BY g, i) AS m, sum(1 - y) OVER (PARTITION BY g, i) AS k FROM l),
v AS (SELECT g, id, y, i, m, k, CASE WHEN y = 1 THEN (ra - rc)::DOUBLE / k ELSE 1 - (ra - rc)::DOUBLE / m END AS v FROM r),
c AS (SELECT a.g, a.i, b.i AS j, avg(a.v) FILTER (a.y = 1) AS auc_first, avg(b.v) FILTER (a.y = 1) AS auc_second, covar_samp(a.v, b.v) FILTER (a.y = 1) / max(a.m) + covar_samp(a.v, b.v) FILTER (a.y = 0) / max(a.k) AS cov,
      CASE WHEN a.i = b.i THEN 0.0 ELSE var_samp(a.v - b.v) FILTER (a.y = 1) / max(a.m) + var_samp(a.v - b.v) FILTER (a.y = 0) / max(a.k) END AS var FROM v a JOIN v b ON a.g = b.g AND a.id = b.id AND a.i <= b.i GROUP BY 1, 2, 3),
z AS (SELECT *, (auc_first - auc_second) / sqrt(nullif(var, 0)) AS z FROM c),
t AS (SELECT *, 1.0 / (1.0 + 0.3275911 * abs(z) / sqrt(2.0)) AS t FROM z)
SELECT g AS segment_cut_off, ['score_rf', 'risk_score_rf', 'oa_amt'][i + 1] AS first, ['score_rf', 'risk_score_rf', 'oa_amt'][j + 1] AS second, round(auc_first, 8) AS auc_first, round(auc_second, 8) AS auc_second, round(cov, 8) AS covariance,
 round(auc_first - auc_second, 8) AS difference, round(sqrt(var), 8) AS standard_error, round(z, 6) AS z, coalesce(round(t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * exp(-z * z / 2), 8), 1.0) AS p_value FROM t""")
def met6b(spark, d):
    m = dis.delong_matrix(booked(spark, d), THREE, "early_bad", ["segment_cut_off"])
    return m.select(*[F.round(c, 6 if c == "z" else 8).alias(c) if t == "double" else F.col(c) for c, t in m.dtypes])


BOOT_SQL = LONG_SQL + f""",
w AS ({weights_sql("long", "boot", "id", 1000, "score_name, s, y")}),
bc AS (SELECT score_name, b, s, sum(w) AS n, sum(w * y) AS bad FROM w WHERE w > 0 GROUP BY 1, 2, 3),
bw AS (SELECT *, coalesce(sum(n - bad) OVER (PARTITION BY score_name, b ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below, sum(bad) OVER (PARTITION BY score_name, b ORDER BY s DESC) AS cb, sum(n - bad) OVER (PARTITION BY score_name, b ORDER BY s DESC) AS cg, sum(bad) OVER (PARTITION BY score_name, b) AS tb, sum(n - bad) OVER (PARTITION BY score_name, b) AS tg FROM bc),
bm AS (SELECT score_name, b, 2 * (sum(bad * (below + (n - bad) / 2.0))::DOUBLE / (max(tb) * max(tg))::DOUBLE) - 1 AS gini, greatest(max(cb::DOUBLE / tb - cg::DOUBLE / tg), 0) AS ks FROM bw GROUP BY 1, 2),
boot AS (SELECT score_name, count(*) AS n_replicates, round(quantile_cont(gini, 0.025), 9) AS gini_low, round(quantile_cont(gini, 0.975), 9) AS gini_high, round(quantile_cont(ks, 0.025), 9) AS ks_low, round(quantile_cont(ks, 0.975), 9) AS ks_high FROM bm WHERE gini IS NOT NULL GROUP BY 1)"""


@query("met7_bootstrap_gini_ks", "SELECT * FROM boot", BOOT_SQL)
def met7(spark, d):
    return rounded(dis.bootstrap_gini_ks(long(spark, d), 1000), 9)


@query("met8_information_value", """
WITH c AS (SELECT segment_cut_off AS level, sum(early_bad) AS bad, count(*) AS n FROM booked GROUP BY 1),
p AS (SELECT level, greatest(bad::DOUBLE / sum(bad) OVER (), 1e-4) AS pb, greatest((n - bad)::DOUBLE / sum(n - bad) OVER (), 1e-4) AS pg FROM c),
q AS (SELECT level, pb / sum(pb) OVER () AS pb, pg / sum(pg) OVER () AS pg FROM p)
SELECT level, round(ln(pg / pb), 9) AS woe, round((pg - pb) * ln(pg / pb), 9) AS iv, round(sum((pg - pb) * ln(pg / pb)) OVER (), 9) AS total_iv FROM q""")
def met8(spark, d):
    return rounded(dis.information_value(booked(spark, d), "segment_cut_off", "early_bad"), 9)


@query("met10_discriminance_report", """
WITH x AS (SELECT * FROM booked UNION ALL SELECT * FROM recent_booked),
lv AS (SELECT 'segment' AS level, segment_cut_off AS name, * FROM x UNION ALL SELECT 'supersegment', 'durables', * FROM x WHERE segment_cut_off IN ('machinery', 'automobile')),
lo AS (SELECT level, name, CASE WHEN mis_date <= DATE '1999-06-01' THEN 'main' ELSE 'recent' END AS period, 'score_rf' AS score_name, early_bad AS y, -score_rf AS s FROM lv UNION ALL SELECT level, name, CASE WHEN mis_date <= DATE '1999-06-01' THEN 'main' ELSE 'recent' END, 'risk_score_rf', early_bad, risk_score_rf FROM lv),
c AS (SELECT level, name, period, score_name, s, count(*) AS n, sum(y) AS bad FROM lo GROUP BY ALL),
w AS (SELECT *, coalesce(sum(n - bad) OVER (PARTITION BY level, name, period, score_name ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below, sum(bad) OVER (PARTITION BY level, name, period, score_name ORDER BY s DESC) AS cb, sum(n - bad) OVER (PARTITION BY level, name, period, score_name ORDER BY s DESC) AS cg, sum(bad) OVER k AS tb, sum(n - bad) OVER k AS tg FROM c WINDOW k AS (PARTITION BY level, name, period, score_name)),
m AS (SELECT level, name, period, score_name, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS n_bad, sum(bad * (below + (n - bad) / 2.0))::DOUBLE / (max(tb) * max(tg))::DOUBLE AS auc, greatest(max(cb::DOUBLE / tb - cg::DOUBLE / tg), 0) AS ks FROM w GROUP BY 1, 2, 3, 4)
SELECT level, name, period, score_name, n, n_bad, round(auc, 9) AS auc, round(2 * auc - 1, 9) AS gini, round(ks, 9) AS ks, round(n_bad::DOUBLE / n, 9) AS bad_rate FROM m""")
def met10(spark, d):
    c = pop.assign_segments(clean(spark, d).where("status_name = 'booked'"))
    c = c.where(F.col("mis_date").between(pop.MAIN[0], pop.RECENT[1])).withColumn("period", F.when(F.col("mis_date") <= F.lit(pop.MAIN[1]).cast("date"), "main").otherwise("recent"))
    keys = ["level", "name", "period"]
    return rounded(dis.discriminance_report(dis.long_scores(c, SCORES, "early_bad", keys), [*keys, "score_name"]), 9)


@query("met11_model_summary", f"""
WITH a AS ({AUC_SQL}), r AS (SELECT score_name, {', '.join(f'round(100.0 * (sum(y) FILTER (r <= floor(n_all * {t} / 100)))::DOUBLE / sum(y), 9) AS capture_{t}' for t in (5, 10, 15, 20))} FROM ranked GROUP BY 1)
SELECT * FROM a JOIN r USING (score_name) LEFT JOIN boot USING (score_name)""", BOOT_SQL)
def met11(spark, d):
    return rounded(dis.model_summary(long(spark, d), 1000), 9)


@query("met12_score_histogram", """
WITH e AS (SELECT score_name, y, min(s) AS lo, max(s) AS hi, count(*) AS total, (max(s) - min(s)) / 50 AS width FROM long GROUP BY 1, 2)
SELECT score_name, y, least(floor((s - lo) / width) + 1, 50)::INT AS bin, count(*) AS n, round(count(*)::DOUBLE / max(total) / max(width), 9) AS density FROM long JOIN e USING (score_name, y) GROUP BY 1, 2, 3""", LONG_SQL)
def met12(spark, d):
    return rounded(dis.score_histogram(long(spark, d)), 9)


def psi_sql(columns, bins):
    """Bins of several variables from baseline quantiles (a number) or given inner edges (a list)."""
    x = lambda t: " UNION ALL ".join(f"SELECT '{c}' AS variable, {c}::DOUBLE AS x FROM {t} WHERE {c} IS NOT NULL" for c in columns)
    q = f"list_distinct(list_sort(quantile_cont(x, {[i / bins for i in range(bins + 1)]})))" if isinstance(bins, int) else str(list(map(float, bins)))
    return f""",
ex AS ({x('booked')}), ac AS ({x('recent_booked')}),
ed AS (SELECT variable, list_sort({q}) AS e FROM ex GROUP BY 1),
ei AS (SELECT variable, e[2:len(e) - 1] AS inner_e FROM ed),
bn AS (SELECT variable, len(list_filter(inner_e, lambda v: v < x)) + 1 AS bin, sum(f)::BIGINT AS expected, sum(1 - f)::BIGINT AS actual FROM (SELECT *, 1 AS f FROM ex UNION ALL SELECT *, 0 FROM ac) JOIN ei USING (variable) GROUP BY 1, 2),
fu AS (SELECT variable, unnest(range(1, len(inner_e) + 2)) AS bin FROM ei),
sh AS (SELECT variable, bin, coalesce(expected, 0) AS expected, coalesce(actual, 0) AS actual FROM fu LEFT JOIN bn USING (variable, bin)),
s1 AS (SELECT *, greatest(expected::DOUBLE / sum(expected) OVER w, 1e-4) AS b0, greatest(actual::DOUBLE / sum(actual) OVER w, 1e-4) AS c0 FROM sh WINDOW w AS (PARTITION BY variable)),
psi AS (SELECT variable, bin, expected, actual, b0 / sum(b0) OVER w AS baseline_pct, c0 / sum(c0) OVER w AS comparison_pct, (c0 / sum(c0) OVER w - b0 / sum(b0) OVER w) * ln((c0 / sum(c0) OVER w) / (b0 / sum(b0) OVER w)) AS component FROM s1 WINDOW w AS (PARTITION BY variable))"""


PSI_ROWS = "SELECT variable, bin::INT AS bin, expected, actual, round(baseline_pct, 9) AS baseline_pct, round(comparison_pct, 9) AS comparison_pct, round(component, 9) AS component FROM psi"
VARS = ["score_rf", "risk_score_rf", "oa_amt"]


def pair(spark, d):
    return booked(spark, d), booked(spark, d, pop.RECENT)


@query("psi1_quantile_bins", PSI_ROWS, COMMON_SQL + psi_sql(VARS, 10))
def psi1(spark, d):
    return rounded(st.psi_bins(*pair(spark, d), VARS, 10), 9)


@query("psi2_given_edges", PSI_ROWS, COMMON_SQL + psi_sql(["score_rf"], [0, 350, 400, 450, 999]))
def psi2(spark, d):
    return rounded(st.psi_bins(*pair(spark, d), ["score_rf"], [0, 350, 400, 450, 999]), 9)


@query("psi3_by_period", """
WITH d AS (SELECT CASE WHEN mis_date <= DATE '1999-06-01' THEN 1 ELSE 0 END AS e, score_rf AS x FROM (SELECT * FROM booked UNION ALL SELECT * FROM recent_booked)),
q AS (SELECT quantile_cont(x, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS ed FROM d WHERE e = 1),
b AS (SELECT e, CASE WHEN x >= ed[1] AND x <= ed[6] THEN len(list_filter(ed[1:5], lambda v: v <= x)) END AS bucket FROM d, q),
t AS (SELECT sum(e) AS te, sum(1 - e) AS ta FROM d),
c AS (SELECT k AS bucket, ed[k + 1] AS breakpoint, (SELECT count(*) FROM b WHERE e = 1 AND bucket = k) AS expected, (SELECT count(*) FROM b WHERE e = 0 AND bucket = k) AS actual FROM q, range(1, 6) r(k)),
s AS (SELECT *, CASE WHEN expected = 0 THEN 1e-4 ELSE expected::DOUBLE / te END AS b0, CASE WHEN actual = 0 THEN 1e-4 ELSE actual::DOUBLE / ta END AS c0 FROM c, t),
n AS (SELECT *, b0 / sum(b0) OVER () AS bp, c0 / sum(c0) OVER () AS cp FROM s)
SELECT bucket::INT AS bucket, round(breakpoint, 9) AS breakpoint, expected, actual, round(bp, 9) AS baseline_pct, round(cp, 9) AS comparison_pct, round((cp - bp) * ln(cp / bp), 9) AS component FROM n""")
def psi3(spark, d):
    return rounded(st.psi_by_period(clean(spark, d).where("status_name = 'booked'"), "score_rf", pop.MAIN, pop.RECENT, 5), 9)


@query("psi4_csi", """
WITH n AS (SELECT segment_cut_off AS category, sum(f) AS e, sum(1 - f) AS a FROM (SELECT segment_cut_off, 1 AS f FROM booked UNION ALL SELECT segment_cut_off, 0 FROM recent_booked) GROUP BY 1),
s AS (SELECT category, greatest(e::DOUBLE / sum(e) OVER (), 1e-4) AS b0, greatest(a::DOUBLE / sum(a) OVER (), 1e-4) AS c0 FROM n),
p AS (SELECT category, b0 / sum(b0) OVER () AS bp, c0 / sum(c0) OVER () AS cp FROM s)
SELECT category, round(bp, 9) AS baseline_pct, round(cp, 9) AS comparison_pct, round((cp - bp) * ln(cp / bp), 9) AS component, round(sum((cp - bp) * ln(cp / bp)) OVER (), 9) AS csi FROM p""")
def psi4(spark, d):
    return rounded(st.csi(*pair(spark, d), "segment_cut_off"), 9)


def _status(x):
    return f"CASE WHEN {x} < 0.1 THEN 'stable' WHEN {x} < 0.25 THEN 'moderate' ELSE 'unstable' END"


def _severity(x):
    return f"CASE WHEN {x} < 0.1 THEN 'info' WHEN {x} < 0.25 THEN 'warning' ELSE 'critical' END"


OVERALL = psi_sql(["score_rf"], 20).replace("ex AS", "ex2 AS").replace("ac AS", "ac2 AS")
for _n in ("ed", "ei", "bn", "fu", "sh", "s1", "psi"):
    OVERALL = OVERALL.replace(f"\n{_n} AS (", f"\n{_n}2 AS (")
OVERALL = OVERALL.replace("FROM ex GROUP", "FROM ex2 GROUP").replace("FROM ed)", "FROM ed2)").replace("FROM ex UNION", "FROM ex2 UNION").replace("FROM ac)", "FROM ac2)").replace("JOIN ei USING", "JOIN ei2 USING").replace("FROM ei)", "FROM ei2)").replace("FROM fu LEFT JOIN bn", "FROM fu2 LEFT JOIN bn2").replace("FROM sh WINDOW", "FROM sh2 WINDOW").replace("FROM s1 WINDOW", "FROM s12 WINDOW")
REPORT_SQL = COMMON_SQL + psi_sql(VARS, 10) + OVERALL + ",\nrep AS (SELECT variable, sum(component) AS psi FROM psi GROUP BY 1 UNION ALL SELECT '__overall__', sum(component) FROM psi2)"


@query("psi5_stability_report", f"SELECT variable, round(psi, 9) AS psi, {_status('psi')} AS status, {_severity('psi')} AS severity FROM rep", REPORT_SQL)
def psi5(spark, d):
    return rounded(st.stability_report(*pair(spark, d), VARS, "score_rf"), 9)


NUMERIC = ["score_rf", "risk_score_rf", "early_bad", "oa_amt", "oa_amt_h0", "todu_amt_pile_h6", "todu_30ever_h6", "acct_booked_h0", "score_rf_bin", "risk_score_rf_bin"]


@query("psi6_main_vs_recent", f"SELECT variable, round(sum(component), 9) AS psi, {_status('sum(component)')} AS status, {_severity('sum(component)')} AS severity FROM psi GROUP BY 1", COMMON_SQL + psi_sql(NUMERIC, 10))
def psi6(spark, d):
    return rounded(st.main_vs_recent(*pair(spark, d)), 9)


ALERTS_SQL = f"SELECT 'all' AS segment, 'recent' AS period, variable, {_severity('psi')} AS severity, {_status('psi')} AS status, round(psi, 9) AS psi_value, CASE WHEN variable = '__overall__' THEN printf('overall score PSI is %.4f, %s', psi, {_status('psi')}) ELSE printf('%s: PSI is %.4f, %s', variable, psi, {_status('psi')}) END AS message FROM rep"


@query("psi7_drift_alerts", ALERTS_SQL, REPORT_SQL)
def psi7(spark, d):
    return rounded(st.drift_alerts(st.stability_report(*pair(spark, d), VARS, "score_rf"), "all", "recent"), 9)


@query("agg17_alert_counts", f"SELECT severity, coalesce(n, 0) AS n FROM (SELECT unnest(['info', 'warning', 'critical']) AS severity) LEFT JOIN (SELECT {_severity('psi')} AS severity, count(*) AS n FROM rep GROUP BY 1) USING (severity)", REPORT_SQL)
def agg17(spark, d):
    return st.alert_counts(st.drift_alerts(st.stability_report(*pair(spark, d), VARS, "score_rf"), "all", "recent"))
