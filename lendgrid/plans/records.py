"""Queries over application records: sources, projections, data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as fn
from ..operators import population as pop, quality as dq
from ..sources import applications as src
from ..sources.shared import prepared as applications
from .registry import booked, clean, demand, query

INDICATORS = ["oa_amt", "oa_amt_h0", "todu_30ever_h6", "todu_amt_pile_h6"]


@query("src1_ingest", "SELECT o_orderkey, lower(replace(o_orderstatus, ' ', '_')) AS o_orderstatus, lower(replace(o_orderpriority, ' ', '_')) AS o_orderpriority, o_totalprice FROM orders")
def src1(spark, d):
    return src.ingest(spark, f"{d}/orders.parquet").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")


@query("prj1_schema_violations", """
SELECT * FROM (SELECT unnest(['status_name in set', 'mis_date not null', 'segment_cut_off not null', 'oa_amt not negative', 'oa_amt_h0 not negative', 'todu_30ever_h6 not negative', 'todu_amt_pile_h6 not negative']) AS rule,
 unnest([count(*) FILTER (coalesce(status_name NOT IN ('booked','rejected','canceled'), true)), count(*) FILTER (mis_date IS NULL), count(*) FILTER (segment_cut_off IS NULL), count(*) FILTER (oa_amt < 0), count(*) FILTER (oa_amt_h0 < 0), count(*) FILTER (todu_30ever_h6 < 0), count(*) FILTER (todu_amt_pile_h6 < 0)]) AS n_rows FROM applications)""")
def prj1(spark, d):
    return pop.schema_violations(applications(spark, d))


@query("prj2_base_population", "SELECT authorization_id, nature_holder, fuera_norma, fraud_flag FROM base")
def prj2(spark, d):
    return pop.base_population(applications(spark, d)).select("authorization_id", "nature_holder", "fuera_norma", "fraud_flag")


@query("prj3_segment_filter", "SELECT authorization_id, segment_cut_off, 'equal' AS kind FROM applications WHERE segment_cut_off = 'building' UNION ALL SELECT authorization_id, segment_cut_off, 'pattern' FROM applications WHERE segment_cut_off LIKE 'mach%' OR segment_cut_off LIKE 'auto%'")
def prj3(spark, d):
    a = applications(spark, d)
    out = lambda x, kind: x.select("authorization_id", "segment_cut_off", F.lit(kind).alias("kind"))
    return out(pop.segment_filter(a, "building"), "equal").union(out(pop.segment_filter(a, "mach|auto"), "pattern"))


@query("prj4_assign_segments", "SELECT level, name, count(*) AS n, sum(oa_amt::DECIMAL(20,4))::DOUBLE AS amount FROM (SELECT 'segment' AS level, segment_cut_off AS name, oa_amt FROM clean UNION ALL SELECT 'supersegment', 'durables', oa_amt FROM clean WHERE segment_cut_off IN ('machinery', 'automobile')) GROUP BY 1, 2")
def prj4(spark, d):
    return pop.assign_segments(clean(spark, d)).groupBy("level", "name").agg(F.count("*").alias("n"), fn.money_sum("oa_amt").alias("amount"))


@query("prj5_prune_columns", "SELECT authorization_id, status_name, m_ct_direct_sc_a, m_ct_direct_other FROM applications")
def prj5(spark, d):
    return pop.prune_columns(applications(spark, d), ["authorization_id", "status_name"])


@query("prj6_filter_by_date", "SELECT authorization_id, mis_date FROM applications WHERE mis_date BETWEEN DATE '1998-07-01' AND DATE '1999-06-01'")
def prj6(spark, d):
    return pop.filter_by_date(applications(spark, d), *pop.MAIN).select("authorization_id", "mis_date")


@query("prj7_split_booked_demand", "SELECT 'booked' AS part, authorization_id FROM booked UNION ALL SELECT 'demand', authorization_id FROM demand")
def prj7(spark, d):
    b, all_ = pop.split_booked_demand(clean(spark, d))
    return b.select(F.lit("booked").alias("part"), "authorization_id").union(all_.select(F.lit("demand"), "authorization_id"))


@query("prj8_bin_scores", "SELECT authorization_id, score_rf_bin, risk_score_rf_bin FROM clean")
def prj8(spark, d):
    return pop.bin_scores(pop.base_population(applications(spark, d))).select("authorization_id", "score_rf_bin", "risk_score_rf_bin")


@query("prj8b_outside_share", "SELECT 'score_rf' AS \"column\", avg((score_rf IS NULL OR score_rf < 300 OR score_rf > 500)::INT)::DOUBLE AS outside FROM base")
def prj8b(spark, d):
    return pop.outside_share(pop.base_population(applications(spark, d)), "score_rf", 300.0, 500.0)


@query("prj9_patch_amount", "SELECT authorization_id, CASE WHEN status_name <> 'booked' THEN oa_amt ELSE oa_amt_h0 END AS oa_amt_h0 FROM applications")
def prj9(spark, d):
    return pop.patch_amount(applications(spark, d)).select("authorization_id", "oa_amt_h0")


@query("prj10_update_status", "SELECT authorization_id, status_name, reject_reason FROM clean")
def prj10(spark, d):
    return clean(spark, d).select("authorization_id", "status_name", "reject_reason")


@query("prj11_drop_incomplete", "SELECT authorization_id FROM applications WHERE oa_amt_h0 IS NOT NULL AND todu_30ever_h6 IS NOT NULL")
def prj11(spark, d):
    return pop.drop_incomplete(applications(spark, d), ["oa_amt_h0", "todu_30ever_h6"]).select("authorization_id")


@query("prj12_risk_ratio", "SELECT authorization_id, round_even(7.0::DOUBLE * todu_30ever_h6 / nullif(todu_amt_pile_h6, 0), 2) AS ratio, round_even(7.0::DOUBLE * todu_30ever_h6 / nullif(todu_amt_pile_h6, 0) * 100, 4) AS percent FROM booked")
def prj12(spark, d):
    n, t = F.col("todu_30ever_h6"), F.col("todu_amt_pile_h6")
    return booked(spark, d).select("authorization_id", fn.risk_ratio(n, t).alias("ratio"), fn.risk_ratio(n, t, percent=True, decimals=4).alias("percent"))


@query("prj13_arrears_from_ratio", "SELECT authorization_id, round(round_even(7.0::DOUBLE * todu_30ever_h6 / nullif(todu_amt_pile_h6, 0), 2) * todu_amt_pile_h6 / 7.0, 4) AS arrears FROM booked")
def prj13(spark, d):
    n, t = F.col("todu_30ever_h6"), F.col("todu_amt_pile_h6")
    return booked(spark, d).select("authorization_id", F.round(fn.arrears_from_ratio(fn.risk_ratio(n, t), t), 4).alias("arrears"))


@query("prj14_annual_coef", "SELECT segment_cut_off, 12.0::DOUBLE / (datediff('month', min(mis_date), max(mis_date)) + 1) AS coefficient FROM demand GROUP BY 1")
def prj14(spark, d):
    x = demand(spark, d).groupBy("segment_cut_off").agg(F.min("mis_date").alias("a"), F.max("mis_date").alias("b"))
    return x.select("segment_cut_off", fn.annual_coefficient(F.col("a"), F.col("b")).alias("coefficient"))


@query("prj15_poly_features", """
SELECT authorization_id, a*b AS score_rf_bin_x_risk_score_rf_bin, a*a AS score_rf_bin_2, b*b AS risk_score_rf_bin_2, a*a*b AS score_rf_bin_2_x_risk_score_rf_bin,
 a*b*b AS score_rf_bin_x_risk_score_rf_bin_2, a*a*a AS score_rf_bin_3, b*b*b AS risk_score_rf_bin_3 FROM (SELECT authorization_id, score_rf_bin::DOUBLE AS a, risk_score_rf_bin::DOUBLE AS b FROM booked)""")
def prj15(spark, d):
    p = pop.poly_features(booked(spark, d).select("authorization_id", "score_rf_bin", "risk_score_rf_bin"), "score_rf_bin", "risk_score_rf_bin")
    return p.drop("score_rf_bin", "risk_score_rf_bin")


MONOMIALS = fn.monomials(["score_rf_bin", "risk_score_rf_bin", "early_bad"], 3)


@query("prj15b_monomials", "SELECT authorization_id, " + ", ".join(f"{' * '.join(f'{v}::DOUBLE' for v in m)} AS {fn.monomial_name(m)}" for m in MONOMIALS if len(m) > 1) + " FROM booked")
def prj15b(spark, d):
    p = pop.monomial_features(booked(spark, d).select("authorization_id", "score_rf_bin", "risk_score_rf_bin", "early_bad"), ["score_rf_bin", "risk_score_rf_bin", "early_bad"], 3)
    return p.drop("score_rf_bin", "risk_score_rf_bin", "early_bad")


@query("prj16_cell_label", "SELECT score_rf_bin, risk_score_rf_bin, printf('%.2fM %.2f%%', round_even(sum(oa_amt_h0::DECIMAL(20,4))::DOUBLE / 1e6, 2), round_even(700.0::DOUBLE * sum(todu_30ever_h6::DECIMAL(20,4))::DOUBLE / sum(todu_amt_pile_h6::DECIMAL(20,4))::DOUBLE, 2)) AS label FROM booked GROUP BY 1, 2")
def prj16(spark, d):
    c = booked(spark, d).groupBy("score_rf_bin", "risk_score_rf_bin").agg(*[fn.money_sum(x).alias(x) for x in INDICATORS[1:]])
    return c.select("score_rf_bin", "risk_score_rf_bin", pop.cell_label(F.col("oa_amt_h0"), F.lit(700.0) * F.col("todu_30ever_h6") / F.col("todu_amt_pile_h6")).alias("label"))


@query("prj17_stability_status", "SELECT authorization_id, CASE WHEN x < 0.1 THEN 'stable' WHEN x < 0.25 THEN 'moderate' ELSE 'unstable' END AS status, CASE WHEN x < 0.1 THEN 'info' WHEN x < 0.25 THEN 'warning' ELSE 'critical' END AS severity FROM (SELECT authorization_id, risk_score_rf / 300 AS x FROM booked)")
def prj17(spark, d):
    x = F.col("risk_score_rf") / 300
    return booked(spark, d).select("authorization_id", fn.stability_status(x).alias("status"), fn.severity(x).alias("severity"))


@query("dq1_check_missing", """
SELECT "column", share, CASE WHEN share > 0.2 THEN 'fail' WHEN share > 0.05 THEN 'warn' ELSE 'pass' END AS status FROM (
 SELECT unnest(['oa_amt', 'oa_amt_h0', 'todu_30ever_h6', 'reject_reason']) AS "column",
 unnest([avg((oa_amt IS NULL)::INT), avg((oa_amt_h0 IS NULL)::INT), avg((todu_30ever_h6 IS NULL)::INT), avg((reject_reason IS NULL)::INT)])::DOUBLE AS share FROM applications)""")
def dq1(spark, d):
    return dq.check_missing(applications(spark, d), ["oa_amt", "oa_amt_h0", "todu_30ever_h6", "reject_reason"])


@query("dq2_check_segment_exists", "SELECT segment_cut_off AS segment, count(*) AS n_rows, false AS found FROM applications GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def dq2(spark, d):
    return dq.check_segment_exists(applications(spark, d), "unknown")


@query("dq3_check_segment_size", "SELECT segment_cut_off AS segment, count(*) AS n_rows, CASE WHEN count(*) < 100 THEN 'fail' WHEN count(*) < 1000 THEN 'warn' ELSE 'pass' END AS status FROM demand GROUP BY 1")
def dq3(spark, d):
    return dq.check_segment_size(demand(spark, d))


@query("dq4_check_date_range", "SELECT min(mis_date) AS \"first\", max(mis_date) AS \"last\", greatest(datediff('day', DATE '1990-01-01', min(mis_date)), 0)::INT AS gap_start, greatest(datediff('day', max(mis_date), DATE '2005-01-01'), 0)::INT AS gap_end FROM applications")
def dq4(spark, d):
    return dq.check_date_range(applications(spark, d), "1990-01-01", "2005-01-01")


OUTLIERS_SQL = """
WITH x AS (SELECT unnest(['oa_amt', 'oa_amt_h0', 'todu_30ever_h6']) AS variable, unnest([oa_amt, oa_amt_h0, todu_30ever_h6]) AS x FROM applications),
m AS (SELECT variable, quantile_cont(x, 0.5) AS mid FROM x GROUP BY 1),
v AS (SELECT x.variable, abs(x - mid) AS dev FROM x JOIN m USING (variable) WHERE x IS NOT NULL),
s AS (SELECT variable, CASE WHEN quantile_cont(dev, 0.5) > 0 THEN quantile_cont(dev, 0.5) ELSE avg(dev) END AS scale FROM v GROUP BY 1)
SELECT variable, count(*) AS n, count(*) FILTER (0.6745 * dev / scale > 5) AS n_outliers, count(*) FILTER (0.6745 * dev / scale > 5)::DOUBLE / count(*) AS share,
 CASE WHEN count(*) FILTER (0.6745 * dev / scale > 5)::DOUBLE / count(*) > 0.01 THEN 'warn' ELSE 'pass' END AS status
FROM v JOIN s USING (variable) WHERE scale > 0 GROUP BY 1"""


@query("dq5_check_outliers", OUTLIERS_SQL)
def dq5(spark, d):
    return dq.check_outliers(applications(spark, d), ["oa_amt", "oa_amt_h0", "todu_30ever_h6"])


@query("dq6_check_indicator_values", "SELECT unnest(['oa_amt', 'score_rf']) AS \"column\", unnest([count(*) FILTER (oa_amt < 0), count(*) FILTER (score_rf < 0)]) AS n_negative FROM applications")
def dq6(spark, d):
    return dq.check_indicator_values(applications(spark, d), ["oa_amt", "score_rf"])


@query("dq7_check_booked_ratio", "SELECT avg((status_name = 'booked')::INT)::DOUBLE AS share, 'pass' AS status FROM applications")
def dq7(spark, d):
    return dq.check_booked_ratio(applications(spark, d))


@query("dq8_check_duplicates", "SELECT count(*) AS n_rows, count(*) - count(DISTINCT (o_custkey, o_orderpriority)) AS n_duplicates, (count(*) - count(DISTINCT (o_custkey, o_orderpriority)))::DOUBLE / count(*) AS share, 'warn' AS status FROM orders")
def dq8(spark, d):
    return dq.check_duplicates(src.table(spark, d, "orders"), ["o_custkey", "o_orderpriority"])


@query("dq9_report", OUTLIERS_SQL.replace("SELECT variable, count(*) AS n, count(*) FILTER (0.6745 * dev / scale > 5) AS n_outliers", ", o AS (SELECT variable, count(*) AS n, count(*) FILTER (0.6745 * dev / scale > 5) AS n_outliers", 1).replace("['oa_amt', 'oa_amt_h0', 'todu_30ever_h6']", "['oa_amt', 'oa_amt_h0', 'todu_30ever_h6', 'todu_amt_pile_h6']").replace("[oa_amt, oa_amt_h0, todu_30ever_h6]", "[oa_amt, oa_amt_h0, todu_30ever_h6, todu_amt_pile_h6]") + """),
n AS (SELECT max(CASE WHEN s < 100 THEN 2 WHEN s < 1000 THEN 1 ELSE 0 END) AS worst FROM (SELECT count(*) AS s FROM applications GROUP BY segment_cut_off)),
k AS (SELECT greatest(avg((oa_amt_h0 IS NULL)::INT), avg((todu_30ever_h6 IS NULL)::INT), avg((todu_amt_pile_h6 IS NULL)::INT)) AS share, avg((status_name = 'booked')::INT) AS b FROM applications)
SELECT 'columns' AS name, 'pass' AS status UNION ALL SELECT 'missing', CASE WHEN share > 0.2 THEN 'fail' WHEN share > 0.05 THEN 'warn' ELSE 'pass' END FROM k
UNION ALL SELECT 'segment_size', CASE worst WHEN 2 THEN 'fail' WHEN 1 THEN 'warn' ELSE 'pass' END FROM n UNION ALL SELECT 'segment_exists', 'pass'
UNION ALL SELECT 'date_range', CASE WHEN min(mis_date) > DATE '1990-01-01' OR max(mis_date) < DATE '2005-01-01' THEN 'warn' ELSE 'pass' END FROM applications
UNION ALL SELECT 'outliers', CASE WHEN max(share) > 0.01 THEN 'warn' ELSE 'pass' END FROM o UNION ALL SELECT 'negative', 'pass'
UNION ALL SELECT 'booked_ratio', CASE WHEN b < 0.01 THEN 'fail' WHEN b < 0.05 THEN 'warn' ELSE 'pass' END FROM k UNION ALL SELECT 'duplicates', 'pass'""")
def dq9(spark, d):
    return dq.dq_report(applications(spark, d), INDICATORS, ("1990-01-01", "2005-01-01"), ["authorization_id", "mis_date", *INDICATORS])


@query("dq10_profile", """
SELECT unnest(['status_name', 'score_rf', 'oa_amt_h0']) AS "column", unnest(['string', 'double', 'double']) AS type,
 unnest([count(DISTINCT status_name), count(DISTINCT score_rf), count(DISTINCT oa_amt_h0)]) AS n_distinct, unnest([count(*) - count(status_name), count(*) - count(score_rf), count(*) - count(oa_amt_h0)]) AS n_null,
 unnest([(count(*) - count(status_name))::DOUBLE / count(*), (count(*) - count(score_rf))::DOUBLE / count(*), (count(*) - count(oa_amt_h0))::DOUBLE / count(*)]) AS null_share FROM applications""")
def dq10(spark, d):
    return dq.profile(applications(spark, d).select("status_name", "score_rf", "oa_amt_h0"))


@query("dq11_bin_summary", "SELECT score_rf_bin AS bin, min(score_rf) AS low, max(score_rf) AS high, count(*) AS n FROM clean GROUP BY 1")
def dq11(spark, d):
    return dq.bin_summary(clean(spark, d), "score_rf_bin", "score_rf")


@query("dq12_distribution", "SELECT 'status' AS of, status_name AS value, count(*) AS n FROM clean GROUP BY 2 UNION ALL SELECT 'reason', reject_reason, count(*) FROM clean GROUP BY 2 UNION ALL SELECT 'month', mis_date::VARCHAR, count(*) FROM clean GROUP BY 2")
def dq12(spark, d):
    c = clean(spark, d)
    part = lambda name, col: dq.distribution(c, col).select(F.lit(name).alias("of"), "value", "n")
    return part("status", "status_name").union(part("reason", "reject_reason")).union(part("month", "mis_date"))


@query("top3_top_values", "SELECT segment_cut_off AS value, count(*) AS n FROM clean GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3")
def top3(spark, d):
    return dq.top_values(clean(spark, d), "segment_cut_off", 3)
