"""The recent period: risk from the training period's cells, from the model where a cell is new."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import arrears_from_ratio, money_sum, risk_ratio
from .cells import CELL


def unseen_cells(training: DataFrame, recent: DataFrame, keys: Sequence[str] = CELL) -> DataFrame:
    return recent.select(*keys).distinct().join(training.select(*keys).distinct(), list(keys), "left_anti")


def recent_period_cells(training: DataFrame, recent: DataFrame, model_risk: Column, exposure: tuple[float, float], keys: Sequence[str] = CELL) -> DataFrame:
    """Per cell of the recent booked: production, modelled exposure, training risk (rounded) or the model's, arrears."""
    seen = training.groupBy(*keys).agg(money_sum("todu_30ever_h6").alias("a"), money_sum("todu_amt_pile_h6").alias("t"))
    seen = seen.select(*keys, risk_ratio(F.col("a"), F.col("t")).alias("known"))
    now = recent.groupBy(*keys).agg(money_sum("oa_amt_h0").alias("production"))
    j = now.join(F.broadcast(seen), list(keys), "left").withColumn("exposure", F.lit(float(exposure[0])) * F.col("production") + F.lit(float(exposure[1])))
    j = j.withColumn("unseen", F.col("known").isNull()).withColumn("risk", F.coalesce("known", model_risk)).drop("known")
    return j.withColumn("arrears", arrears_from_ratio(F.col("risk"), F.col("exposure")))
