"""Allocation of one portfolio risk budget over the segments' frontiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..sources.shared import written
from .cutoffs import MONEY, prune_dominated

SEGMENT = "segment_cut_off"


def allocate_exact(frontiers: DataFrame, target: float, segments: Sequence[str], bounds: DataFrame | None = None) -> DataFrame:
    """segment, solution, production, risk: one point a segment, most production with production-weighted risk <= target.

    A fold over the segments joins each frontier to the partial sums and prunes dominated ones: exact. ``bounds``
    (segment, low, high) restrict risks. Without a feasible choice there are no rows. The states of a step, one per
    undominated sum, are pruned in one window: meant for frontiers, not for records.
    """
    frontiers = written(frontiers)  # a row per frontier point, read once for each segment
    f = frontiers
    if bounds is not None:
        f = f.join(F.broadcast(bounds), SEGMENT, "left").where("(low IS NULL OR risk >= low) AND (high IS NULL OR risk <= high)")
    slack = F.round(F.col("oa_amt_h0") * (F.col("risk") - F.lit(float(target))), 4).cast(MONEY)
    f = f.select(SEGMENT, "solution", F.col("oa_amt_h0").cast(MONEY).alias("p"), slack.alias("s"))
    state = frontiers.sparkSession.createDataFrame([("",)], "path string").select("path", F.lit(0).cast(MONEY).alias("production"), F.lit(0).cast(MONEY).alias("slack"))
    for seg in segments:
        step = f.where(F.col(SEGMENT) == seg).select("solution", "p", "s")
        state = state.crossJoin(F.broadcast(step)).select(
            F.concat_ws("|", F.when(F.col("path") != "", F.col("path")), "solution").alias("path"),
            (F.col("production") + F.col("p")).cast(MONEY).alias("production"), (F.col("slack") + F.col("s")).cast(MONEY).alias("slack"),
        )
        state = prune_dominated(state.withColumn("__all", F.lit(1)), ["__all"]).drop("__all")
    best = state.where("slack <= 0").orderBy(F.desc("production"), "slack", "path").limit(1)
    names = F.array(*[F.lit(s) for s in segments])
    chosen = best.select(F.posexplode(F.split("path", "\\|")).alias("i", "solution")).select(names[F.col("i")].alias(SEGMENT), "solution")
    return frontiers.join(F.broadcast(chosen), [SEGMENT, "solution"]).select(SEGMENT, "solution", "oa_amt_h0", "risk")


def allocate_ranked(frontiers: DataFrame, target: float) -> DataFrame:
    """A heuristic: from each segment's least risky point, steps are taken in order of production per unit of risk mass.

    A step counts with the least efficiency up to it in its segment, so no step comes before an earlier one. Steps are
    taken while the running slack stays at 0 or less. It never beats the exact allocation.
    """
    w = Window.partitionBy(SEGMENT).orderBy("risk", "solution")
    f = frontiers.withColumn("k", F.row_number().over(w)).withColumn("dp", F.col("oa_amt_h0") - F.coalesce(F.lag("oa_amt_h0").over(w), F.lit(0.0)))
    mass = F.col("oa_amt_h0") * F.col("risk")
    f = f.withColumn("dm", mass - F.coalesce(F.lag(mass).over(w), F.lit(0.0))).withColumn("ds", F.round(F.col("dm") - F.col("dp") * F.lit(float(target)), 4).cast(MONEY))
    f = f.withColumn("e", F.when(F.col("k") > 1, F.col("dp") / F.when(F.col("dm") > 0, F.col("dm"))))
    f = f.withColumn("e", F.when(F.col("k") == 1, F.lit(float("inf"))).otherwise(F.min(F.coalesce("e", F.lit(1e308))).over(w)))
    order = Window.orderBy(F.desc("e"), SEGMENT, "k")
    f = f.withColumn("run", F.sum("ds").over(order))
    worst = F.max(F.when(F.col("k") > 1, F.col("run"))).over(order)
    taken = f.withColumn("worst", worst).where("k = 1 OR worst <= 0")
    last = Window.partitionBy(SEGMENT).orderBy(F.desc("k"))
    return taken.withColumn("__k", F.row_number().over(last)).where("__k = 1").select(SEGMENT, "solution", "oa_amt_h0", "risk")


def allocation_table(choice: DataFrame) -> DataFrame:
    """Per segment and in total (null segment): production, production-weighted risk, share."""
    money = lambda c: F.sum(c.cast("decimal(28,4)")).cast("double")
    r = choice.rollup(SEGMENT).agg(money(F.col("oa_amt_h0")).alias("production"), money(F.round(F.col("oa_amt_h0") * F.col("risk"), 4)).alias("mass"))
    total = F.max("production").over(Window.partitionBy())
    return r.select(SEGMENT, "production", (F.col("mass") / F.when(F.col("production") != 0, F.col("production"))).alias("risk"), (F.col("production") / total).alias("share"))


def _lagrangian(points: DataFrame, prices: Sequence[float]) -> list:
    """price, value, production, slack: what the segments choose together when a unit of slack costs ``price``. A row a price."""
    at = points.sparkSession.createDataFrame([(float(v),) for v in prices], "price double")
    worth = F.col("p").cast("double") - F.col("price") * F.col("s").cast("double")
    best = points.crossJoin(F.broadcast(at)).groupBy("node", "price").agg(F.max(F.struct(worth.alias("value"), (-F.col("s")).alias("less"), "p")).alias("b"))
    return best.groupBy("price").agg(F.sum("b.value").alias("value"), F.sum("b.p").cast("double").alias("production"), F.sum(-F.col("b.less")).alias("slack")).collect()


def allocate_tree(frontiers: DataFrame, target: float) -> DataFrame:
    """segment, solution, production, risk: the choice of ``allocate_exact``, for hundreds of segments at once.

    Segments are paired, their points summed and dominated sums pruned, then the pairs are paired, and so on: a round a level of the tree, all nodes of a level in one job. Sums that
    can't be part of the best choice go early: when slack has a price, the total value of the best points bounds every choice from above, and the best affordable choice found at any
    price bounds it from below. A sum that loses more against its node's best than lies between the two bounds is out, whatever the others choose. This is exact; without it sums would multiply.
    Points without production or risk take no part. Without a feasible choice there are no rows. What goes through the driver is a row a price.
    """
    slack = F.round(F.col("oa_amt_h0") * (F.col("risk") - F.lit(float(target))), 4).cast(MONEY)
    known = frontiers.where("oa_amt_h0 IS NOT NULL AND risk IS NOT NULL")
    names = known.select(SEGMENT).distinct().withColumn("node", F.row_number().over(Window.orderBy(SEGMENT)) - 1)  # a row a segment
    points = written(known.join(names, SEGMENT).select(SEGMENT, "solution", "oa_amt_h0", "risk", "node", F.col("oa_amt_h0").cast(MONEY).alias("p"), slack.alias("s")))
    spare = points.groupBy("node").agg(F.min(F.struct("s", (-F.col("p")).alias("q"))).alias("b")).agg(F.sum("b.s").alias("s"), F.sum("b.q").cast("double").alias("q"), F.count("*").alias("n")).first()
    if not spare["n"] or spare["s"] > 0:
        return points.where("false").select(SEGMENT, "solution", "oa_amt_h0", "risk")
    least, prices, tried = -spare["q"], [0.0, *(10.0 ** (k / 5) for k in range(-30, 31))], []
    for _ in range(3):
        tried = sorted({r["price"]: r for r in [*tried, *_lagrangian(points, prices)]}.values(), key=lambda r: r["price"])
        least = max([least, *(r["production"] for r in tried if r["slack"] <= 0)])
        k = min(range(len(tried)), key=lambda i: tried[i]["value"])
        low, high = tried[max(k - 1, 0)]["price"], tried[min(k + 1, len(tried) - 1)]["price"]
        prices = [low + (high - low) * i / 32 for i in range(1, 32)]
    price, most = tried[k]["price"], tried[k]["value"]
    gap = most - least + 1e-9 * max(abs(most), 1.0)

    def kept(state: DataFrame) -> DataFrame:
        worth = F.col("production").cast("double") - F.lit(price) * F.col("slack").cast("double")
        s = state.withColumn("__worth", worth)
        s = s.withColumn("__best", F.max("__worth").over(Window.partitionBy("node"))).where(F.col("__best") - F.col("__worth") <= F.lit(gap)).drop("__worth", "__best")
        return written(prune_dominated(s, ["node"]))

    state, n = kept(points.select("node", F.array("solution").alias("path"), F.col("p").alias("production"), F.col("s").alias("slack"))), spare["n"]
    while n > 1:
        half = lambda odd: state.where(F.col("node") % 2 == odd).withColumn("node", F.floor(F.col("node") / 2))  # noqa: B023, E731
        right = half(1).select("node", *[F.col(c).alias(f"r_{c}") for c in ("path", "production", "slack")])
        j = half(0).join(right, "node", "left")  # an odd one out goes up alone
        state = kept(j.select(
            "node", F.concat("path", F.coalesce("r_path", F.array().cast("array<string>"))).alias("path"),
            (F.col("production") + F.coalesce("r_production", F.lit(0).cast(MONEY))).cast(MONEY).alias("production"), (F.col("slack") + F.coalesce("r_slack", F.lit(0).cast(MONEY))).cast(MONEY).alias("slack"),
        ))
        n = (n + 1) // 2
    best = state.where("slack <= 0").orderBy(F.desc("production"), "slack", "path").limit(1)
    chosen = best.select(F.posexplode("path").alias("node", "solution"))
    return points.join(F.broadcast(chosen), ["node", "solution"]).select(SEGMENT, "solution", "oa_amt_h0", "risk")
