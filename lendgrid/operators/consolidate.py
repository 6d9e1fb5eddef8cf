"""Results over segments, supersegments, scenarios and periods."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import risk_ratio

KEYS = ("scenario", "period")


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Stack tables by column name; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _grouped(metrics: DataFrame, aggregates: list, keys: Sequence[str]) -> DataFrame:
    """Sums per segment, per supersegment and in total, in one pass of grouping sets: level, name, then aggregates."""
    sets = [[*keys, "supersegment", "metric"], [*keys, "segment", "metric"], [*keys, "metric"]]
    g = metrics.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in [*keys, "segment", "supersegment", "metric"]])
    g = g.agg(F.grouping("segment").alias("__gs"), F.grouping("supersegment").alias("__gp"), *aggregates)
    level = F.when(F.col("__gs") == 0, "segment").when(F.col("__gp") == 0, "supersegment").otherwise("total")
    name = F.when(F.col("__gs") == 0, F.col("segment")).when(F.col("__gp") == 0, F.col("supersegment")).otherwise("TOTAL")
    return g.withColumn("level", level).withColumn("name", name).where("name IS NOT NULL").drop("__gs", "__gp", "segment", "supersegment")


def consolidate(metrics: DataFrame, keys: Sequence[str] = KEYS, multiplier: float = 7.0) -> DataFrame:
    """keys, level, name, metric, summed production and amounts, risk from the sums.

    ``metrics``: keys, segment, supersegment (null: none), metric, production, todu_30ever_h6, todu_amt_pile_h6.
    """
    sums = [F.sum(F.col(c).cast("decimal(20,4)")).cast("double").alias(c) for c in ("production", "todu_30ever_h6", "todu_amt_pile_h6")]
    g = _grouped(metrics, sums, keys)
    return g.withColumn("risk", risk_ratio(F.col("todu_30ever_h6"), F.col("todu_amt_pile_h6"), multiplier, True))


def combine_ci(metrics: DataFrame, keys: Sequence[str] = KEYS, z: float = 1.96) -> DataFrame:
    """Intervals of independent sums: middles add, standard errors in quadrature. For risks see ``combine_risk_ci``."""
    se = (F.col("high") - F.col("low")) / (2 * z)
    g = _grouped(metrics, [F.sum((F.col("low") + F.col("high")) / 2).alias("mid"), F.sqrt(F.sum(se * se)).alias("se")], keys)
    return g.withColumn("low", F.col("mid") - F.lit(z) * F.col("se")).withColumn("high", F.col("mid") + F.lit(z) * F.col("se"))


def combine_risk_ci(metrics: DataFrame, keys: Sequence[str] = KEYS, z: float = 1.96) -> DataFrame:
    """The same of risk intervals (risk_low, risk_high); where no part is uncertain both bounds are 0."""
    c = combine_ci(metrics.withColumns({"low": F.col("risk_low"), "high": F.col("risk_high")}), keys, z)
    bound = lambda b: F.when(F.col("se") > 0, F.col(b)).otherwise(F.lit(0.0))
    return c.withColumns({"risk_ci_lower": bound("low"), "risk_ci_upper": bound("high")}).drop("mid", "se", "low", "high")


def with_deltas(consolidated: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per level and name: actual and optimum side by side with their differences."""
    pick = lambda m, c: F.max(F.when(F.col("metric") == m, F.col(c)))
    g = consolidated.groupBy(*keys, "level", "name").agg(
        pick("Actual", "production").alias("actual_production"), pick("Optimum selected", "production").alias("optimum_production"),
        pick("Actual", "risk").alias("actual_risk"), pick("Optimum selected", "risk").alias("optimum_risk"),
    )
    d = F.col("optimum_production") - F.col("actual_production")
    return g.withColumns({
        "delta_production": F.round(d, 4), "delta_production_pct": d / F.when(F.col("actual_production") != 0, F.col("actual_production")) * 100,
        "delta_risk": F.round(F.col("optimum_risk") - F.col("actual_risk"), 4),
    })


def cutoff_summary(cuts: DataFrame, kpis: DataFrame, on: Sequence[str] = ("scenario",)) -> DataFrame:
    """Cutoffs in long form with their solution's risk and production."""
    return cuts.join(F.broadcast(kpis), list(on))


def cutoffs_wide(cuts: DataFrame, bins: Sequence[int], bin_column: str, value: str = "level", keys: Sequence[str] = ("scenario",)) -> DataFrame:
    """One column per bin; the bins are given, so no extra pass finds them."""
    w = cuts.groupBy(*keys).pivot(bin_column, list(bins)).agg(F.first(value))
    return w.select(*keys, *[F.col(f"`{b}`").alias(f"bin_{b}") for b in bins])


def scenario_comparison(consolidated: DataFrame, metric: str = "Optimum selected") -> DataFrame:
    """Per scenario and name: risk and production in both periods and the change."""
    c = consolidated.where(F.col("metric") == metric)
    p = c.groupBy("scenario", "level", "name").pivot("period", ["main", "recent"]).agg(F.first("risk").alias("risk"), F.first("production").alias("production"))
    return p.withColumn("delta_risk", F.round(F.col("recent_risk") - F.col("main_risk"), 4))
