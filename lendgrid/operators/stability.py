"""Population and characteristic stability, and the alerts drawn from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.scalars import severity, stability_status
from .quality import long_numbers, numeric_columns
from .quantiles import exact_quantiles

LEAST = 1e-4


def psi_shares(counts: DataFrame, clip: bool = True, by: Sequence[str] = ("variable",), e_total=None, a_total=None) -> DataFrame:
    """bin counts (expected, actual) -> shares without zeros that sum to 1, and the component of each bin."""
    w = Window.partitionBy(*by)
    e = F.col("expected") / (F.sum("expected").over(w) if e_total is None else e_total)
    a = F.col("actual") / (F.sum("actual").over(w) if a_total is None else a_total)
    safe = (lambda x: F.greatest(x, F.lit(LEAST))) if clip else (lambda x: F.when(x == 0, F.lit(LEAST)).otherwise(x))
    c = counts.withColumn("baseline_pct", safe(e)).withColumn("comparison_pct", safe(a))
    c = c.withColumn("baseline_pct", F.col("baseline_pct") / F.sum("baseline_pct").over(w)).withColumn("comparison_pct", F.col("comparison_pct") / F.sum("comparison_pct").over(w))
    return c.withColumn("component", (F.col("comparison_pct") - F.col("baseline_pct")) * F.ln(F.col("comparison_pct") / F.col("baseline_pct")))


def quantile_edges(df: DataFrame, column: str, n: int, keys: Sequence[str] = (), approximate: bool = False) -> DataFrame:
    """keys, edges: the n + 1 quantiles of ``column`` that cut it into ``n`` equal parts."""
    p = [i / n for i in range(n + 1)]
    if approximate:
        return df.groupBy(*keys).agg(F.percentile_approx(column, p, 10_000).alias("edges"))
    return exact_quantiles(df, column, p, keys).withColumnRenamed("quantiles", "edges")


def psi_bins(baseline: DataFrame, comparison: DataFrame, columns: Sequence[str], bins: int | Sequence[float] = 10, approximate: bool = False) -> DataFrame:
    """variable, bin, expected, actual, shares, component.

    ``bins``: a number of baseline quantiles, repeated ones dropped, or given edges; outer edges are
    infinite, bins are (a, b]. All variables go through one long table; a bin that neither period
    fills doesn't exist here, as no record is in it. Quantiles are exact, by refining histograms; ``approximate``
    takes them from a sketch in one pass.
    """
    e, a = long_numbers(baseline, columns), long_numbers(comparison, columns)
    if isinstance(bins, int):
        edges = quantile_edges(e, "x", bins, ["variable"], approximate).withColumn("edges", F.array_distinct("edges"))
    else:
        edges = e.select("variable").distinct().withColumn("edges", F.array(*[F.lit(float(v)) for v in bins]))
    inner = F.slice("edges", F.lit(2), F.greatest(F.size("edges") - 2, F.lit(0)))
    edges = edges.select("variable", inner.alias("inner"))
    both = e.withColumn("e", F.lit(1)).unionByName(a.withColumn("e", F.lit(0))).join(F.broadcast(edges), "variable")
    both = both.withColumn("bin", F.size(F.filter("inner", lambda v: v < F.col("x"))) + 1)
    n = both.groupBy("variable", "bin").agg(F.sum("e").alias("expected"), F.sum(1 - F.col("e")).alias("actual"))
    full = edges.select("variable", F.explode(F.sequence(F.lit(1), F.size("inner") + 1)).alias("bin"))
    return psi_shares(full.join(n, ["variable", "bin"], "left").na.fill(0, ["expected", "actual"]))


def psi(baseline: DataFrame, comparison: DataFrame, columns: Sequence[str], bins: int | Sequence[float] = 10, approximate: bool = False) -> DataFrame:
    """variable, psi."""
    return psi_bins(baseline, comparison, columns, bins, approximate).groupBy("variable").agg(F.sum("component").alias("psi"))


def psi_by_period(df: DataFrame, column: str, reference: tuple[str, str], actual: tuple[str, str], buckets: int | None = None, breakpoints: Sequence[float] | None = None, date: str = "mis_date", approximate: bool = False) -> DataFrame:
    """bucket, breakpoint, counts, shares, component.

    Buckets are [a, b), the last one [a, b]; values outside count in the total only; just zero shares are replaced.
    """
    if buckets is None and breakpoints is None:
        raise ValueError("either buckets or breakpoints are needed")
    inside = lambda p: F.col(date).between(F.lit(p[0]).cast("date"), F.lit(p[1]).cast("date"))
    d = df.select(F.when(inside(reference), 1).otherwise(0).alias("e"), F.when(inside(actual), 1).otherwise(0).alias("a"), F.col(column).cast("double").alias("x"))
    d = d.where("e = 1 OR a = 1")
    edges = quantile_edges(d.where("e = 1"), "x", buckets, (), approximate) if breakpoints is None else d.sparkSession.createDataFrame([([float(b) for b in breakpoints],)], "edges array<double>")
    n = F.size("edges") - 1
    low = F.size(F.filter(F.slice("edges", F.lit(1), n), lambda v: v <= F.col("x")))
    bucket = F.when((F.col("x") >= F.col("edges")[0]) & (F.col("x") <= F.element_at("edges", -1)), low)
    d = d.crossJoin(F.broadcast(edges)).withColumn("bucket", bucket)
    totals = d.agg(F.sum("e").alias("te"), F.sum("a").alias("ta"))
    c = d.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("e").alias("expected"), F.sum("a").alias("actual"))
    full = edges.select(F.posexplode(F.slice("edges", F.lit(2), n)).alias("i", "breakpoint")).select((F.col("i") + 1).alias("bucket"), "breakpoint")
    c = full.join(c, "bucket", "left").na.fill(0, ["expected", "actual"]).crossJoin(F.broadcast(totals)).withColumn("__all", F.lit(1))
    return psi_shares(c, False, ["__all"], F.col("te"), F.col("ta")).drop("__all", "te", "ta")


def csi(baseline: DataFrame, comparison: DataFrame, column: str) -> DataFrame:
    """category, shares, component, csi."""
    both = baseline.select(F.col(column).alias("category"), F.lit(1).alias("e")).union(comparison.select(F.col(column), F.lit(0)))
    n = both.where("category IS NOT NULL").groupBy("category").agg(F.sum("e").alias("expected"), F.sum(1 - F.col("e")).alias("actual")).withColumn("__all", F.lit(1))
    c = psi_shares(n, by=["__all"])
    return c.select("category", "baseline_pct", "comparison_pct", "component", F.sum("component").over(Window.partitionBy("__all")).alias("csi"))


def stability_report(baseline: DataFrame, comparison: DataFrame, variables: Sequence[str], score: str | None = None, bins: int = 10, approximate: bool = False) -> DataFrame:
    """variable, psi, status, severity; the score once more as ``__overall__`` over 20 bins."""
    r = psi(baseline, comparison, variables, bins, approximate)
    if score:
        r = r.union(psi(baseline, comparison, [score], 20, approximate).select(F.lit("__overall__"), "psi"))
    return r.select("variable", "psi", stability_status(F.col("psi")).alias("status"), severity(F.col("psi")).alias("severity"))


def main_vs_recent(main: DataFrame, recent: DataFrame, but: Sequence[str] = ("authorization_id",), approximate: bool = False) -> DataFrame:
    shared = [c for c in numeric_columns(main, but) if c in recent.columns]
    return stability_report(main, recent, shared, approximate=approximate)


def drift_alerts(report: DataFrame, segment: str, period: str) -> DataFrame:
    """One alert row per variable and for the overall score."""
    overall = F.format_string("overall score PSI is %.4f, %s", F.col("psi"), F.col("status"))
    text = F.when(F.col("variable") == "__overall__", overall).otherwise(F.format_string("%s: PSI is %.4f, %s", F.col("variable"), F.col("psi"), F.col("status")))
    return report.select(F.lit(segment).alias("segment"), F.lit(period).alias("period"), "variable", "severity", "status", F.col("psi").alias("psi_value"), text.alias("message"))


def alert_counts(alerts: DataFrame) -> DataFrame:
    """severity, n for all three levels, zeros included."""
    levels = alerts.sparkSession.createDataFrame([("info",), ("warning",), ("critical",)], "severity string")
    return levels.join(alerts.groupBy("severity").agg(F.count("*").alias("n")), "severity", "left").na.fill(0, ["n"])
