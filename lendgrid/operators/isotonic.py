"""Monotone least-squares surfaces over a grid of two variables, for every key at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..sources.shared import written
from .cells import CELL

#: A split must gain more than this share of the block's absolute numerators, or it is rounding.
SLACK = 1e-10


def monotone_surface(cells: DataFrame, order: Sequence[int], levels: Sequence[int], numerator: str, weight: str, keys: Sequence[str] = (), v0: str = CELL[0], v1: str = CELL[1], multiplier: float = 7.0) -> DataFrame:
    """keys, v0, v1, ratio, fitted: the weighted least-squares surface that never falls from a safer to a riskier bin of either variable.

    ``order``: bins of v0, safest first; ``levels``: bins of v1, safest first. The fit minimises the squared distance to ``multiplier * numerator / weight``, weighted
    by ``weight``; it is exact and unique. It starts from one block, the whole grid at its mean, and splits each block where it gains most: the cells above a staircase,
    for which the mean is too low, from those below. The best staircase is a fold over the bins of v0 inside one row, with a state per level of v1; blocks of all keys are
    split in one job a round, until none gains. A block holds a grid's cells at most. Cells without weight have no row.
    """
    n0, n1 = len(order), len(levels)
    at = lambda c, values: F.array_position(F.array(*map(F.lit, values)), F.col(c)).cast("int")
    c = cells.select(*keys, v0, v1, at(v0, order).alias("i"), at(v1, levels).alias("j"), (F.lit(float(multiplier)) * F.col(numerator)).alias("a"), F.col(weight).alias("w"))
    state = written(c.where("w > 0 AND i > 0 AND j > 0").withColumns({"block": F.lit("b"), "open": F.lit(True)}))
    on = [*keys, "block"]
    while not (still := state.where("open")).isEmpty():
        sums = still.groupBy(*on).agg((F.sum("a") / F.sum("w")).alias("mean"), F.collect_list(F.struct("i", "j", "a", "w")).alias("cells"))  # a grid's cells at most
        off = F.transform("cells", lambda x: F.struct(x["i"].alias("i"), x["j"].alias("j"), (x["a"] - F.col("mean") * x["w"]).alias("d")))
        sums = sums.withColumn("off", off)
        for k in range(1, n0 + 1):
            upto = lambda l: F.aggregate(F.filter("off", lambda x: (x["i"] == k) & (x["j"] <= l)), F.lit(0.0), lambda s, x: s + x["d"])  # noqa: B023, E731, E741
            if k == 1:
                step = F.transform(F.sequence(F.lit(0), F.lit(n1)), lambda l: F.struct(upto(l).alias("sum"), F.array(l).alias("path")))  # noqa: B023, E741
            else:
                least = lambda l: F.array_min(F.slice("best", l + 1, F.lit(n1 + 1) - l))  # noqa: E731, E741
                step = F.transform(F.sequence(F.lit(0), F.lit(n1)), lambda l: F.struct((upto(l) + least(l)["sum"]).alias("sum"), F.concat(least(l)["path"], F.array(l)).alias("path")))  # noqa: B023, E741
            sums = sums.withColumn("best", step)
        size = F.aggregate("cells", F.lit(0.0), lambda s, x: s + F.abs(x["a"]))
        cut = sums.select(*on, F.array_min("best").alias("least"), size.alias("size"))
        cut = cut.select(*on, F.when(F.col("least.sum") < -SLACK * F.col("size"), F.col("least.path")).alias("path"))
        j = still.join(cut, on)
        above = F.col("j") > F.element_at("path", F.col("i"))
        name = F.when(F.col("path").isNull(), F.col("block")).otherwise(F.concat("block", F.when(above, "1").otherwise("0")))
        j = j.select(*keys, v0, v1, "i", "j", "a", "w", name.alias("block"), F.col("path").isNotNull().alias("open"))
        state = written(state.where("NOT open").unionByName(j))
    fit = state.groupBy(*on).agg((F.sum("a") / F.sum("w")).alias("fitted"))
    return state.join(fit, on).select(*keys, v0, v1, (F.col("a") / F.col("w")).alias("ratio"), "fitted")
