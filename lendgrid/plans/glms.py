"""Queries on Tweedie, logistic and hurdle models and their search, each with the same steps unrolled in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import money_sum, risk_ratio
from ..operators import cells as cl, glm, risk_models as rm
from ..sources.shared import written
from .portfolio import rounded
from .registry import COMMON_SQL, booked, query
from .results import least_squares_sql

FEATURES, SEGMENT = list(cl.CELL), "segment_cut_off"
STRENGTH, K, SEEDS = 0.001, 3, (17, 18)

_ETA = f"least(greatest(b0 + b1 * x + b2 * z, -{glm.LIMIT}::DOUBLE), {glm.LIMIT}::DOUBLE)"


def mean_sql(family: str) -> str:
    return {"gaussian": "b0 + b1 * x + b2 * z", "tweedie": f"exp({_ETA})", "logistic": f"1 / (1 + exp(-{_ETA}))"}[family]


def glm_sql(source: str, name: str, keys: str, family: str, steps: int = glm.STEPS) -> str:
    """Views up to ``name``: b0, b1, b2 of every key of ``source`` (keys, x, z, y, w, al: the penalty), a view a step. Kept as tables, since each is read twice."""
    if family == "gaussian":
        return f"{name} AS MATERIALIZED ({least_squares_sql(source, keys, 'al')})"
    first = f"ln(greatest(sum(w * y) / sum(w), {glm.LEAST}::DOUBLE))" if family == "tweedie" else "0.0::DOUBLE"
    views = [f"{name}_0 AS MATERIALIZED (SELECT {keys}, {first} AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2 FROM {source} GROUP BY {keys})"]
    variance = "mu" if family == "tweedie" else f"greatest(mu * (1 - mu), {glm.LEAST}::DOUBLE)"
    share = "pow(mu, 0.5::DOUBLE)" if family == "tweedie" else variance
    for i in range(steps):
        views.append(f"""{name}_w{i} AS MATERIALIZED (SELECT {keys}, x, z, al, eta + (y - mu) / {variance} AS y, w * {share} AS w
  FROM (SELECT s.*, {_ETA} AS eta, {mean_sql(family)} AS mu FROM {source} s JOIN {name}_{i} USING ({keys})))""")
        views.append(f"{name}{'' if i == steps - 1 else f'_{i + 1}'} AS MATERIALIZED ({least_squares_sql(f'{name}_w{i}', keys, 'al')})")
    return ",\n".join(views)


def targets_sql(month: str = "") -> str:
    """View ``gt``: each segment's cells, by month if asked, with exposure w and rounded ratio y."""
    return f"""gt AS MATERIALIZED (SELECT segment_cut_off, {month}x, z, w, round_even(7.0::DOUBLE * a / nullif(w, 0), 2) AS y FROM (
  SELECT segment_cut_off, {month}score_rf_bin AS x, risk_score_rf_bin AS z, sum(todu_30ever_h6::DECIMAL(20,4))::DOUBLE AS a, sum(todu_amt_pile_h6::DECIMAL(20,4))::DOUBLE AS w FROM booked GROUP BY ALL) WHERE w <> 0)"""


_PENALTY = f"{STRENGTH}::DOUBLE * sum(w) OVER (PARTITION BY segment_cut_off) AS al"
TWEEDIE_SQL = f"{COMMON_SQL},\n{targets_sql()},\ngs AS MATERIALIZED (SELECT *, {_PENALTY} FROM gt),\n{glm_sql('gs', 'gb', SEGMENT, 'tweedie')}"
HURDLE_SQL = f"""{COMMON_SQL},
{targets_sql("mis_date, ")},
gz AS MATERIALIZED (SELECT segment_cut_off, x, z, w, CASE WHEN y > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y, {_PENALTY} FROM gt),
gh AS MATERIALIZED (SELECT segment_cut_off, avg(y) AS share FROM gz GROUP BY 1),
go AS MATERIALIZED (SELECT gz.* FROM gz JOIN gh USING (segment_cut_off) WHERE share > 0 AND share < 1),
gp AS MATERIALIZED (SELECT *, 1.0::DOUBLE AS al FROM gt WHERE y > 0),
{glm_sql("go", "gl", SEGMENT, "logistic")},
{glm_sql("gp", "gq", SEGMENT, "gaussian")},
pl AS (SELECT segment_cut_off, mis_date, x, z, y, CASE WHEN b0 IS NULL THEN share ELSE {mean_sql("logistic")} END AS p FROM gt JOIN gh USING (segment_cut_off) LEFT JOIN gl USING (segment_cut_off)),
ps AS (SELECT pl.*, greatest(coalesce({mean_sql("gaussian")}, 0), 0) AS s FROM pl LEFT JOIN gq USING (segment_cut_off))"""


def folds_sql(name: str, seed: int) -> str:
    """Views ``name``: fold, x, z, vt, v (validation), w and y (train), records dealt to folds by ``seed``."""
    return f"""{name}_0 AS (SELECT floor(('0x' || substr(md5('{seed}|' || authorization_id), 1, 8))::BIGINT::DOUBLE / 4294967296.0 * {K})::INT AS fold, score_rf_bin AS x, risk_score_rf_bin AS z, sum(todu_30ever_h6::DECIMAL(20,4))::DOUBLE AS va, sum(todu_amt_pile_h6::DECIMAL(20,4))::DOUBLE AS vt FROM booked GROUP BY 1, 2, 3),
{name}_1 AS (SELECT x, z, sum(va::DECIMAL(20,4))::DOUBLE AS a, sum(vt::DECIMAL(20,4))::DOUBLE AS t FROM {name}_0 GROUP BY 1, 2),
{name}_2 AS (SELECT i::INT AS fold, u.x, u.z, a, t, coalesce(va, 0) AS va, coalesce(vt, 0) AS vt FROM {name}_1 u CROSS JOIN range({K}) r(i) LEFT JOIN {name}_0 f ON f.fold = i AND f.x = u.x AND f.z = u.z),
{name} AS MATERIALIZED (SELECT fold, x, z, vt, 7.0::DOUBLE * va / nullif(vt, 0) AS v, t - vt AS w, 7.0::DOUBLE * (a - va) / nullif(t - vt, 0) AS y FROM {name}_2)"""


def search_sql(name: str, seed: int) -> str:
    """Views ``name``: name, family, mean, se of every point of the grid on the folds of a seed."""
    views, points = [folds_sql(f"{name}f", seed)], []
    for family in dict.fromkeys(kind for _, kind, _ in glm.GLM_GRID):
        named = ", ".join(f"('{label} {s:g}', '{label}', {float(s)}::DOUBLE)" for label, kind, strengths in glm.GLM_GRID if kind == family for s in strengths)
        at, scaled = f"{name}{family[0]}", "1" if family == "gaussian" else "sum(w) OVER (PARTITION BY name, fold)"
        views.append(f"{at}s AS MATERIALIZED (SELECT *, strength * {scaled} AS al FROM {name}f CROSS JOIN (VALUES {named}) q(name, family, strength) WHERE y IS NOT NULL AND w > 0)")
        views.append(glm_sql(f"{at}s", f"{at}b", "name, fold", family))
        points.append(f"SELECT name, family, fold, vt, v, {mean_sql(family)} AS p FROM {name}f JOIN {at}b USING (fold) JOIN (VALUES {named}) q(name, family, strength) USING (name)")
    views.append(f"{name}r AS (SELECT name, family, fold, sqrt(sum(vt * (p - v) * (p - v)) / sum(vt)) AS rmse FROM ({' UNION ALL '.join(points)}) WHERE v IS NOT NULL GROUP BY 1, 2, 3)")
    views.append(f"{name} AS (SELECT name, family, avg(rmse) AS mean, stddev_samp(rmse) / sqrt(count(*)) AS se FROM {name}r GROUP BY 1, 2)")
    return ",\n".join(views)


SEARCH_SQL = COMMON_SQL + ",\n" + ",\n".join(search_sql(n, s) for n, s in zip(("first", "again"), SEEDS, strict=True))


def segment_targets(records, *also):
    """Each segment's cells with their rounded ratio, where there is exposure."""
    c = records.groupBy(SEGMENT, *also, *cl.CELL).agg(*[money_sum(i).alias(i) for i in ("todu_30ever_h6", "todu_amt_pile_h6")])
    return c.withColumn("target", risk_ratio(F.col("todu_30ever_h6"), F.col("todu_amt_pile_h6"))).where("target IS NOT NULL")


def folds(spark, d, seed):
    return written(rm.fold_cells(booked(spark, d), K, seed))


@query("ml3b_tweedie_by_segment", f"SELECT segment_cut_off, x AS score_rf_bin, z AS risk_score_rf_bin, y AS target, round({mean_sql('tweedie')}, 6) AS prediction FROM gs JOIN gb USING (segment_cut_off)", TWEEDIE_SQL)
def ml3b(spark, d):
    c = segment_targets(booked(spark, d))
    models = glm.fit_glm(c, FEATURES, [SEGMENT], "tweedie", strength=STRENGTH)
    return rounded(glm.predict_glm(c, models, [SEGMENT], FEATURES, "tweedie").select(SEGMENT, *cl.CELL, "target", "prediction"), 6)


@query("ml4b_hurdle_by_segment", "SELECT segment_cut_off, mis_date, x AS score_rf_bin, z AS risk_score_rf_bin, y AS target, round(p, 6) AS probability, round(s, 6) AS size, round(p * s, 6) AS prediction FROM ps", HURDLE_SQL)
def ml4b(spark, d):
    c = segment_targets(booked(spark, d), "mis_date")
    p = glm.hurdle_glm(c, FEATURES, [SEGMENT], strength=STRENGTH)
    return rounded(p.select(SEGMENT, "mis_date", *cl.CELL, "target", "probability", "size", "prediction"), 6)


@query("ml7b_glm_search", """
WITH best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY round(mean, 9), name) AS k FROM first) WHERE k = 1)
SELECT best.family, name, round(best.mean, 6) AS mean, round(best.se, 6) AS se, round(again.mean, 6) AS fresh_mean, round(again.se, 6) AS fresh_se FROM best JOIN again USING (name)""", SEARCH_SQL)
def ml7b(spark, d):
    return rounded(glm.glm_search(*[folds(spark, d, s) for s in SEEDS], FEATURES), 6)


@query("ml8b_one_se_of_search", """
WITH cx AS (SELECT name, CASE WHEN family = 'tweedie' THEN 2 ELSE 1 END AS complexity, round(mean, 9) AS mean, round(se, 9) AS se FROM first), b AS (SELECT mean + coalesce(se, 0) AS bar FROM cx ORDER BY mean, complexity, name LIMIT 1)
SELECT name, complexity, round(mean, 6) AS mean, round(se, 6) AS se FROM cx, b WHERE mean <= bar ORDER BY complexity, mean, name LIMIT 1""", SEARCH_SQL)
def ml8b(spark, d):
    scores = rm.fold_scores(glm.glm_cv(folds(spark, d, SEEDS[0]), FEATURES))
    r = rm.cv_results(scores).withColumn("complexity", F.when(F.col("name").startswith("tweedie"), 2).otherwise(1))
    return rounded(rm.one_se_select(rounded(r, 9)).select("name", "complexity", "mean", "se"), 6)
