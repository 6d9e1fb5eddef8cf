"""Grid cells: sums per cell, reject inference and the cell summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import arrears_from_ratio, money_sum, risk_ratio

CELL = ("score_rf_bin", "risk_score_rf_bin")
INDICATORS = ("todu_30ever_h6", "todu_amt_pile_h6", "oa_amt_h0")


def booked_cells(booked: DataFrame, coefficient: Column | float = 1.0, keys: Sequence[str] = CELL, indicators: Sequence[str] = INDICATORS) -> DataFrame:
    """Annualised sums of each indicator per cell, suffixed ``_boo``."""
    k = coefficient if isinstance(coefficient, Column) else F.lit(float(coefficient))
    return booked.groupBy(*keys).agg(*[(money_sum(i) * k).alias(f"{i}_boo") for i in indicators])


def without_outlying(df: DataFrame, value: str, keys: Sequence[str] = (), limit: float = 3.0) -> DataFrame:
    """Drop rows whose modified z score reaches ``limit``; groups of one or two rows stay whole."""
    one = [F.lit(1).alias("__all"), *keys]
    mid = df.groupBy(*one).agg(F.percentile(value, F.lit(0.5)).alias("__mid"), F.count("*").alias("__n"))
    on = ["__all", *keys]
    d = df.withColumn("__all", F.lit(1)).join(F.broadcast(mid), on).withColumn("__dev", F.abs(F.col(value) - F.col("__mid")))
    mad = d.groupBy(*on).agg(F.percentile("__dev", F.lit(0.5)).alias("__mad"))
    d = d.join(F.broadcast(mad), on)
    keep = (F.col("__n") <= 2) | (F.col("__mad") == 0) | (F.lit(0.6745) * F.col("__dev") < F.lit(limit) * F.col("__mad"))
    return d.where(keep).select(*df.columns)


def cell_target(booked: DataFrame, keys: Sequence[str] = CELL, multiplier: float = 7.0) -> DataFrame:
    """Per cell: sums, n_observations and the rounded ratio; cells without one or with an outlying one go."""
    c = booked.groupBy(*keys).agg(*[money_sum(i).alias(i) for i in INDICATORS], F.count("*").alias("n_observations"))
    c = c.withColumn("target", risk_ratio(F.col("todu_30ever_h6"), F.col("todu_amt_pile_h6"), multiplier)).where("target IS NOT NULL")
    return without_outlying(c, "target")


def acceptance_rates(demand: DataFrame, keys: Sequence[str] = CELL) -> DataFrame:
    """Booked over booked and score-rejected, per cell."""
    b = F.sum(F.when(F.col("status_name") == "booked", 1).otherwise(0))
    r = F.sum(F.when((F.col("status_name") == "rejected") & (F.col("reject_reason") == "09-score"), 1).otherwise(0))
    c = demand.groupBy(*keys).agg(b.alias("n_booked"), r.alias("n_rejected"))
    total = F.col("n_booked") + F.col("n_rejected")
    return c.withColumn("acceptance_rate", F.when(total > 0, F.col("n_booked") / F.when(total > 0, total)).otherwise(1.0))


def reject_uplift(cells: DataFrame, rates: DataFrame, method: str = "linear", factor: float = 1.5, cap: float = 3.0, column: str = "todu_30ever_h6_rep", keys: Sequence[str] = CELL) -> DataFrame:
    """Scale modelled arrears of rejects by how selective the cell was; unknown cells count as accepting all."""
    j = cells.join(rates.select(*keys, "acceptance_rate"), list(keys), "left").withColumn("acceptance_rate", F.coalesce("acceptance_rate", F.lit(1.0)))
    a = F.col("acceptance_rate")
    m = F.lit(1.0) + F.lit(float(factor)) * (1 - a) if method == "linear" else F.pow(F.lit(1.0) / F.greatest(a, F.lit(0.01)), F.lit(float(factor)))
    return j.withColumn("uplift", F.least(F.greatest(m, F.lit(1.0)), F.lit(float(cap)))).withColumn(column, F.col(column) * F.col("uplift"))


def score_rejects(cells: DataFrame, risk: Column, exposure: tuple[float, float], stress: float | Column = 1.0, multiplier: float = 7.0) -> DataFrame:
    """Rejected cells (oa_amt per cell) -> modelled exposure, ratio and arrears, suffixed ``_rep``.

    ``risk`` is any column expression of the cell's variables (a fitted model's prediction, say);
    ``exposure`` is slope and intercept of exposure on amount.
    """
    c = cells.withColumn("todu_amt_pile_h6_rep", F.lit(float(exposure[0])) * F.col("oa_amt_h0_rep") + F.lit(float(exposure[1])))
    c = c.withColumn("ratio_rep", F.greatest((F.lit(stress) if not isinstance(stress, Column) else stress) * risk, F.lit(0.0)))
    return c.withColumn("todu_30ever_h6_rep", arrears_from_ratio(F.col("ratio_rep"), F.col("todu_amt_pile_h6_rep"), multiplier))


def rejected_cells(demand: DataFrame, coefficient: float = 1.0, keys: Sequence[str] = CELL) -> DataFrame:
    """Annualised amount of score rejects per cell."""
    r = demand.where("status_name = 'rejected' AND reject_reason = '09-score'")
    return r.groupBy(*keys).agg((money_sum("oa_amt") * F.lit(float(coefficient))).alias("oa_amt_h0_rep"))


def cell_summary(
    demand: DataFrame, risk: Column, exposure: tuple[float, float], stress: float = 1.0, financing_rate: float = 1.0,
    coefficient: float = 1.0, method: str = "linear", factor: float = 1.5, cap: float = 3.0, keys: Sequence[str] = CELL,
) -> DataFrame:
    """One row per cell: indicators of booked (``_boo``), of swap-in candidates (``_rep``) and both."""
    boo = booked_cells(demand.where("status_name = 'booked'"), coefficient, keys)
    rep = score_rejects(rejected_cells(demand, coefficient, keys), risk, exposure, stress)
    rep = reject_uplift(rep, acceptance_rates(demand, keys), method, factor, cap, keys=keys)
    rep = rep.select(*keys, *[(F.col(f"{i}_rep") * F.lit(float(financing_rate))).alias(f"{i}_rep") for i in INDICATORS])
    j = boo.join(rep, list(keys), "full").na.fill(0.0, [f"{i}_{s}" for i in INDICATORS for s in ("boo", "rep")])
    return with_totals(j)


def with_totals(cells: DataFrame) -> DataFrame:
    return cells.withColumns({i: F.col(f"{i}_boo") + F.col(f"{i}_rep") for i in INDICATORS})


def complete_grid(cells: DataFrame, bins: dict[str, Sequence[int]], keys: Sequence[str] = ()) -> DataFrame:
    """Every combination of the bins (of each group of ``keys``), missing cells with zeros."""
    spark = cells.sparkSession
    grid = cells.select(*keys).distinct() if keys else None
    for name, values in bins.items():
        one = spark.createDataFrame([(v,) for v in values], f"{name} int")
        grid = one if grid is None else grid.crossJoin(F.broadcast(one))
    numbers = [c for c in cells.columns if c not in bins and c not in keys]
    return grid.join(cells, [*keys, *bins], "left").na.fill(0.0, numbers)


def marginalise(cells: DataFrame, keep: Sequence[str], multiplier: float = 7.0) -> DataFrame:
    """Sum cells down to the variables in ``keep`` and take the ratio anew."""
    c = cells.groupBy(*keep).agg(*[money_sum(i).alias(i) for i in INDICATORS])
    return c.withColumn("ratio", risk_ratio(F.col("todu_30ever_h6"), F.col("todu_amt_pile_h6"), multiplier, decimals=6))
