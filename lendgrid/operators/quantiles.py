"""Exact quantiles of any number of variables and keys by refining histograms.

Each pass counts the records that can still matter into the bins of a histogram, with each bin's least and largest value, and goes on inside the bins
that hold a wanted rank until a bin holds one value only. State is a histogram per key and open range, never a list of a key's values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ..sources.shared import written

#: Bins of a power of two in the first pass, and bins of an open range in those that follow.
PER_BINADE, BINS = 1 << 10, 1 << 12
#: Values of an open range that are put in order in a task, once no range holds more.
HELD = 1 << 16


def value_bin(x: Column) -> Column:
    """The bin of a double: its sign, its power of two and which of ``PER_BINADE`` equal parts of that it lies in. It never falls as x grows."""
    a = F.abs(x)
    e = F.greatest(F.least(F.floor(F.log2(a)), F.lit(1023)), F.lit(-1080))
    power = lambda k: F.pow(F.lit(2.0), k.cast("double"))
    e = e + F.when(a >= power(e + 1), 1).otherwise(0) - F.when(a < power(e), 1).otherwise(0)  # logarithms round
    part = F.floor(F.least(F.greatest((a / power(e) - 1) * PER_BINADE, F.lit(0.0)), F.lit(float(PER_BINADE - 1))))
    b = (e + 1100) * PER_BINADE + part + 1
    return F.when(x == 0, F.lit(0).cast("long")).when(x > 0, b).otherwise(-b)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """A join on ``keys`` in which nulls are equal; the keys of the left stay."""
    right = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return left.join(right, on, how).drop(*[f"__r_{k}" for k in keys])


def _located(hist: DataFrame, within: Sequence[str], keys: Sequence[str], ranks: Column, base: Column) -> DataFrame:
    """keys, n, rank, base, lo, hi, c: the bin of each wanted rank and its count; ``base`` is how many values stand below the histogram."""
    w = Window.partitionBy(*within).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # a row a bin
    h = hist.withColumn("below", base + F.coalesce(F.sum("c").over(w), F.lit(0)))
    mine = F.filter(ranks, lambda r: (r >= F.col("below")) & (r < F.col("below") + F.col("c")))
    return h.select(*keys, "n", F.explode(F.array_distinct(mine)).alias("rank"), F.col("below").alias("base"), "lo", "hi", "c")


def _kept(state: DataFrame) -> tuple[DataFrame, int | None]:
    """The state, written, and the count of its largest open range, which is observed while it is written."""
    seen = Observation()
    kept = written(state.observe(seen, F.max(F.when(F.col("lo") < F.col("hi"), F.col("c"))).alias("largest")))
    return kept, seen.get["largest"]


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """keys, quantiles: the exact quantiles of ``column``, in the order of ``probabilities``, by interpolation between neighbours.

    Nulls and NaN take no part; a key without values has no row. The number of passes depends on how close the values around a quantile lie, not on how
    many there are: one for values that differ in their first three digits, six at most for any doubles, and the next is the last once every open range holds ``HELD`` values or fewer, as
    these are then ordered where they are. ``df`` is read once a pass.
    """
    probabilities = [float(p) for p in probabilities]
    on = [*keys, "__every"]
    d = df.select(*keys, F.lit(1).alias("__every"), F.col(column).cast("double").alias("x")).where("x IS NOT NULL AND NOT isnan(x)")
    count = [F.count("*").alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi")]
    hist = d.groupBy(*on, value_bin(F.col("x")).alias("bin")).agg(*count).withColumn("n", F.sum("c").over(Window.partitionBy(*on)))
    low = [F.floor(F.lit(p) * (F.col("n") - 1)) for p in probabilities]
    wanted = F.array(*low, *[F.least(r + 1, F.col("n") - 1) for r in low])
    state, largest = _kept(_located(hist, on, on, wanted, F.lit(0).cast("long")))
    while largest is not None:
        still = state.where("lo < hi")
        ranges = still.groupBy(*on).agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))  # at most two a probability
        near = F.explode(F.filter("ranges", lambda r: (F.col("x") >= r["lo"]) & (F.col("x") <= r["hi"])))
        inside = _same(d, ranges, on).select(*on, "x", near.alias("range"))
        asked = still.groupBy(*on, F.struct("lo", "hi").alias("range")).agg(F.collect_set("rank").alias("ranks"), F.first("base").alias("base"), F.first("n").alias("n"))
        if largest <= HELD:
            place = F.col("base") + F.row_number().over(Window.partitionBy(*on, "range").orderBy("x")) - 1
            placed = _same(inside, asked, [*on, "range"]).withColumn("rank", place).where(F.array_contains("ranks", F.col("rank")))
            finer = placed.select(*on, "n", "rank", "base", F.col("x").alias("lo"), F.col("x").alias("hi"), F.lit(1).cast("long").alias("c"))
        else:
            share = (F.col("x") - F.col("range.lo")) / (F.col("range.hi") - F.col("range.lo"))
            bins = inside.groupBy(*on, "range", F.least(F.floor(share * BINS), F.lit(BINS - 1)).alias("bin")).agg(*count)
            finer = _located(_same(bins, asked, [*on, "range"]), [*on, "range"], on, F.col("ranks"), F.col("base"))
        state, largest = _kept(state.where("lo = hi").unionByName(finer))
    at = state.groupBy(*on).agg(F.map_from_entries(F.collect_set(F.struct("rank", "lo"))).alias("at"), F.first("n").alias("n"))
    values = []
    for p in probabilities:
        place = F.lit(p) * (F.col("n") - 1)
        below, above = F.floor(place), F.ceil(place)
        a, b = F.col("at")[below], F.col("at")[above]
        values.append(F.when(below == above, a).otherwise((above - place) * a + (place - below) * b))
    return at.select(*keys, F.array(*values).alias("quantiles"))
