"""Risk and exposure models of every segment at once: fitted by key, kept as rows, joined to the cells they score.

A model is a weighted least-squares fit over a grid's cells. All keys are fitted in one grouped job: sums of products per key, then a
sweep over a small array. A segment with too few cells takes its supersegment's model, and failing that the whole portfolio's.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import arrears_from_ratio, money_sum, risk_ratio
from .cells import CELL, INDICATORS, acceptance_rates, booked_cells, rejected_cells, reject_uplift, with_totals, without_outlying
from .monitoring import stress_factor

SEGMENT = "segment_cut_off"
INTERCEPT = "(intercept)"
#: A diagonal element that a sweep has shrunk below this share of itself belongs to a feature that depends on those before it.
SINGULAR = 1e-10


def fit_keyed(cells: DataFrame, features: Sequence[str], keys: Sequence[str], target: str, weight: Column | str, ridge: float = 0.0) -> DataFrame:
    """keys, feature, coefficient, n_cells: a weighted least-squares model of each key as rows, the intercept as ``(intercept)``.

    ``ridge`` penalises the squares of the coefficients but not the intercept. Rows without target, features or a positive weight
    take no part. A feature that others determine gets the coefficient 0, a constant one as well.
    """
    w = F.col(weight) if isinstance(weight, str) else weight
    k, xs = len(features), [f"__x{i}" for i in range(len(features))]
    c = cells.select(*keys, F.col(target).cast("double").alias("__y"), w.cast("double").alias("__w"), *[F.col(f).cast("double").alias(x) for f, x in zip(features, xs, strict=True)])
    c = c.na.drop(subset=["__y", "__w", *xs]).where("__w > 0")
    mean = lambda v: (F.sum(F.col("__w") * F.col(v)) / F.sum("__w")).alias(f"{v}_m")
    means = c.groupBy(*keys).agg(mean("__y"), *[mean(x) for x in xs], F.count("*").alias("n_cells"))
    d = lambda v: F.col(v) - F.col(f"{v}_m")
    product = {(i, j): F.sum(F.col("__w") * d(xs[i]) * d(xs[j])).alias(f"__g{i}_{j}") for i in range(k) for j in range(i, k)}
    to_y = [F.sum(F.col("__w") * d(x) * d("__y")).alias(f"__b{i}") for i, x in enumerate(xs)]
    g = c.join(means, list(keys)).groupBy(*means.columns).agg(*product.values(), *to_y)
    entry = lambda i, j: F.col(f"__g{min(i, j)}_{max(i, j)}") + (ridge if i == j else 0.0)
    g = g.withColumn("__m", F.array(*[F.array(*[entry(i, j) for j in range(k)], F.col(f"__b{i}")) for i in range(k)]))
    for p in range(k):
        row, pivot = F.col("__m")[p], F.col("__m")[p][p]
        sound = pivot > F.lit(SINGULAR) * entry(p, p)
        g = g.withColumn("__r", F.when(sound, F.transform(row, lambda v: v / pivot)).otherwise(F.transform(row, lambda v: F.lit(0.0))))  # noqa: B023
        g = g.withColumn("__m", F.transform("__m", lambda r, i: F.when(i == p, F.col("__r")).otherwise(F.zip_with(r, "__r", lambda a, b: a - r[p] * b))))  # noqa: B023
    slopes = [F.col("__m")[i][k] for i in range(k)]
    intercept = F.col("__y_m")
    for b, x in zip(slopes, xs, strict=True):
        intercept = intercept - b * F.col(f"{x}_m")
    rows = [F.struct(F.lit(name).alias("feature"), b.alias("coefficient")) for name, b in zip([INTERCEPT, *features], [intercept, *slopes], strict=True)]
    return g.select(*keys, "n_cells", F.inline(F.array(*rows)))


def predict_keyed(df: DataFrame, models: DataFrame, keys: Sequence[str], features: Sequence[str], name: str = "prediction") -> DataFrame:
    """``df`` with the prediction of its key's model; keys without a model get null."""
    entries = F.collect_list(F.struct("feature", "coefficient"))  # as many as a model has features
    wide = models.groupBy(*keys).agg(F.map_from_entries(entries).alias("__model"))
    p = F.col("__model")[INTERCEPT]
    for f in features:
        p = p + F.col("__model")[f] * F.col(f)
    return df.join(wide, list(keys), "left").withColumn(name, p).drop("__model")


def level_cells(booked: DataFrame, supersegments: Mapping[str, Sequence[str]], keys: Sequence[str] = CELL, segment: str = SEGMENT) -> DataFrame:
    """level, name, keys, sums of the indicators, n_observations: the cells of every segment, supersegment and of all.

    Records are summed per segment and cell once; what lies above is summed from these.
    """
    own = booked.groupBy(segment, *keys).agg(*[money_sum(i).alias(i) for i in INDICATORS], F.count("*").alias("n_observations"))
    above = [F.when(F.col(segment).isin(*members), F.struct(F.lit("supersegment").alias("level"), F.lit(name).alias("name"))) for name, members in supersegments.items()]
    at = F.array(F.struct(F.lit("segment").alias("level"), F.col(segment).alias("name")), F.struct(F.lit("all").alias("level"), F.lit("all").alias("name")), *above)
    each = own.select(F.inline(F.filter(at, lambda s: s.isNotNull())), *keys, *INDICATORS, "n_observations")
    return each.groupBy("level", "name", *keys).agg(*[money_sum(i).alias(i) for i in INDICATORS], F.sum("n_observations").alias("n_observations"))


def segment_models(
    booked: DataFrame, features: Sequence[str], supersegments: Mapping[str, Sequence[str]], least_cells: int = 12, least_records: int = 1, ridge: float = 0.0,
    keys: Sequence[str] = CELL, segment: str = SEGMENT, multiplier: float = 7.0,
) -> DataFrame:
    """segment, level, name, kind (risk, exposure), feature, coefficient, n_cells: the two models that each segment of ``booked`` uses.

    Risk: the rounded ratio of a cell on ``features``, weighted by exposure, without cells whose ratio lies far from the others of the same name.
    Exposure: the cell's exposure on its amount. Cells count that hold ``least_records`` records or more. A segment with fewer than ``least_cells`` of
    them takes both models of its first supersegment that has so many, or else those of all.
    """
    c = level_cells(booked, supersegments, keys, segment).where(F.col("n_observations") >= least_records)
    c = c.withColumn("target", risk_ratio(F.col("todu_30ever_h6"), F.col("todu_amt_pile_h6"), multiplier)).where("target IS NOT NULL")
    c = without_outlying(c, "target", ["level", "name"])
    at = ["level", "name"]
    risk = fit_keyed(c, features, at, "target", "todu_amt_pile_h6", ridge).withColumn("kind", F.lit("risk"))
    exposure = fit_keyed(c, ["oa_amt_h0"], at, "todu_amt_pile_h6", F.lit(1.0)).withColumn("kind", F.lit("exposure"))
    rank = {name: i + 2 for i, name in enumerate(supersegments)}
    enough = c.groupBy(*at).agg(F.count("*").alias("n")).where((F.col("n") >= least_cells) | (F.col("level") == "all"))
    parents = booked.sparkSession.createDataFrame([(m, "supersegment", name, rank[name]) for name, members in supersegments.items() for m in members] or [(None, None, None, 0)], f"{segment} string, level string, name string, rank int")
    segments = booked.select(segment).distinct()
    options = segments.select(segment, F.lit("segment").alias("level"), F.col(segment).alias("name"), F.lit(1).alias("rank")).unionByName(parents.join(segments, segment, "left_semi"))
    options = options.unionByName(segments.select(segment, F.lit("all").alias("level"), F.lit("all").alias("name"), F.lit(1_000_000).alias("rank")))
    best = Window.partitionBy(segment).orderBy("rank")  # as many rows as a segment has levels above it
    used = options.join(enough.select(*at), at).withColumn("__k", F.row_number().over(best)).where("__k = 1").select(segment, *at)
    return used.join(risk.unionByName(exposure), at).select(segment, *at, "kind", "feature", "coefficient", "n_cells")


def segment_cell_summary(
    demand: DataFrame, models: DataFrame, features: Sequence[str], financing_rate: float = 1.0, coefficient: float = 1.0, method: str = "linear", factor: float = 1.5, cap: float = 3.0,
    stress: DataFrame | None = None, keys: Sequence[str] = CELL, segment: str = SEGMENT, multiplier: float = 7.0,
) -> DataFrame:
    """One row per segment and cell: indicators of booked (``_boo``), of swap-in candidates scored by the segment's models (``_rep``), and both.

    ``models``: what ``segment_models`` gives. ``stress`` (segment, stress_factor): by default that of the booked records of each segment; 1 where it can't be told.
    """
    on = [segment, *keys]
    booked = demand.where("status_name = 'booked'")
    stress = stress_factor(booked, keys=[segment]).select(segment, "stress_factor") if stress is None else stress
    rep = rejected_cells(demand, coefficient, on)
    rep = predict_keyed(rep, models.where("kind = 'risk'"), [segment], features, "ratio_rep")
    rep = predict_keyed(rep.withColumn("oa_amt_h0", F.col("oa_amt_h0_rep")), models.where("kind = 'exposure'"), [segment], ["oa_amt_h0"], "todu_amt_pile_h6_rep")
    rep = rep.join(stress, segment, "left").withColumn("ratio_rep", F.greatest(F.coalesce("stress_factor", F.lit(1.0)) * F.col("ratio_rep"), F.lit(0.0)))
    rep = rep.withColumn("todu_30ever_h6_rep", arrears_from_ratio(F.col("ratio_rep"), F.col("todu_amt_pile_h6_rep"), multiplier))
    rep = reject_uplift(rep, acceptance_rates(demand, on), method, factor, cap, keys=on)
    rep = rep.select(*on, *[(F.col(f"{i}_rep") * F.lit(float(financing_rate))).alias(f"{i}_rep") for i in INDICATORS])
    both = booked_cells(booked, coefficient, on).join(rep, on, "full")
    return with_totals(both.na.fill(0.0, [f"{i}_{s}" for i in INDICATORS for s in ("boo", "rep")]))
