"""Stored histograms of every variable and period: small, mergeable, and enough to compare a new period without old records.

Values fall into bins of a fixed grid (``quantiles.value_bin``), narrower than a thousandth of the value, so the sketches of different periods, segments or
files add up bin by bin. Counts at the grid's edges are exact; a quantile is off by less than one bin, values of up to ten significant bits not at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.scalars import severity, stability_status
from .quality import long_numbers
from .quantiles import value_bin
from .stability import psi_shares


def sketch(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), date: str = "mis_date") -> DataFrame:
    """keys, variable, period (month), bin, n, lo, hi: the histogram of each column, from one pass. Nulls and NaN are left out."""
    period = F.trunc(date, "month").alias("period")
    d = long_numbers(df.select(*keys, period, *columns), columns, *keys, "period").where("NOT isnan(x)")
    return d.groupBy(*keys, "variable", "period", value_bin(F.col("x")).alias("bin")).agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))


def write_sketches(sketches: DataFrame, path: str) -> None:
    """Store sketches by period. Periods that are there already are replaced, all others stay: a late month is written again alone."""
    sketches.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("period").parquet(path)


def read_sketches(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Stored sketches; only the folders of the wanted periods are read."""
    s = spark.read.parquet(path)
    if first:
        s = s.where(F.col("period") >= F.lit(first).cast("date"))
    return s.where(F.col("period") <= F.lit(last).cast("date")) if last else s


def merged(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The sketch of all periods together."""
    return sketches.groupBy(*keys, "variable", "bin").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def _cumulated(sketches: DataFrame, on: Sequence[str]) -> DataFrame:
    """With cum, the values up to each bin, and total. A window holds the bins of one variable."""
    return sketches.withColumns({"cum": F.sum("n").over(Window.partitionBy(*on).orderBy("bin")), "total": F.sum("n").over(Window.partitionBy(*on))})


def sketch_quantiles(sketches: DataFrame, probabilities: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """keys, variable, quantiles: for each p the largest value of the bin that holds rank ceil(p n), the least value for 0.

    ``sketches`` are merged ones. The value is at least the quantile, and above it by less than the width of its bin.
    """
    on = [*keys, "variable"]
    c = _cumulated(sketches, on)
    at = [F.min("lo") if p == 0 else F.min(F.when(F.col("cum") >= F.ceil(F.lit(float(p)) * F.col("total")), F.col("hi"))) for p in probabilities]
    return c.groupBy(*on).agg(F.array(*at).alias("quantiles"))


def psi_from_sketches(sketches: DataFrame, reference: tuple[str, str], periods: tuple[str, str], bins: int = 10, keys: Sequence[str] = ()) -> DataFrame:
    """keys, variable, period, psi, status, severity: each of ``periods`` against the reference periods together, for all variables in one job.

    Edges are the reference's quantiles on the grid, repeated ones dropped, so the counts on both sides of an edge are exact. No records are read.
    """
    on = [*keys, "variable"]
    between = lambda p: F.col("period").between(F.lit(p[0]).cast("date"), F.lit(p[1]).cast("date"))
    base = _cumulated(merged(sketches.where(between(reference)), keys), on)
    cuts = [F.min(F.when(F.col("cum") * bins >= F.lit(i) * F.col("total"), F.col("bin"))) for i in range(1, bins)]
    edges = base.groupBy(*on).agg(F.array_distinct(F.array(*cuts)).alias("edges"))
    part = (F.size(F.filter("edges", lambda e: e < F.col("bin"))) + 1).alias("part")
    expected = base.join(edges, on).groupBy(*on, part).agg(F.sum("n").alias("expected"))
    actual = sketches.where(between(periods)).join(edges, on).groupBy(*on, "period", part).agg(F.sum("n").alias("actual"))
    full = actual.select(*on, "period").distinct().join(edges, on).select(*on, "period", F.explode(F.sequence(F.lit(1), F.size("edges") + 1)).alias("part"))
    counts = full.join(expected, [*on, "part"], "left").join(actual, [*on, "period", "part"], "left").na.fill(0, ["expected", "actual"])
    r = psi_shares(counts, by=[*on, "period"]).groupBy(*on, "period").agg(F.sum("component").alias("psi"))
    return r.withColumns({"status": stability_status(F.col("psi")), "severity": severity(F.col("psi"))})
