"""Data-quality checks and profiles: one pass each, results as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.scalars import quantile
from .quantiles import exact_quantiles

ID_COLUMNS = ("authorization_id", "reject_reason")


def null_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, share: nulls in each column, from one aggregation."""
    one = df.agg(*[F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)).alias(f"c{i}") for i, c in enumerate(columns)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("share")) for i, c in enumerate(columns)])))


def grade(value, warn: float, fail: float):
    return F.when(value > fail, "fail").when(value > warn, "warn").otherwise("pass")


def check_missing(df: DataFrame, columns: Sequence[str], warn: float = 0.05, fail: float = 0.20) -> DataFrame:
    """column, share, status of each column; the check as a whole takes the largest share."""
    return null_shares(df, columns).withColumn("status", grade(F.col("share"), warn, fail))


def check_segment_exists(df: DataFrame, segment: str, column: str = "segment_cut_off", k: int = 10) -> DataFrame:
    """If rows match: one row with their number. If none do: the k most frequent segments."""
    counts = df.groupBy(F.col(column).alias("segment")).agg(F.count("*").alias("n_rows")).withColumn("found", F.col("segment") == segment)
    any_found = counts.agg(F.max(F.coalesce("found", F.lit(False))).alias("any"))
    shown = counts.crossJoin(F.broadcast(any_found)).where(F.when(F.col("any"), F.col("found")).otherwise(True))
    return shown.select("segment", "n_rows", F.col("any").alias("found")).orderBy(F.desc("n_rows"), "segment").limit(k)


def check_segment_size(df: DataFrame, column: str = "segment_cut_off", warn: int = 1000, fail: int = 100) -> DataFrame:
    n = df.groupBy(F.col(column).alias("segment")).agg(F.count("*").alias("n_rows"))
    return n.withColumn("status", F.when(F.col("n_rows") < fail, "fail").when(F.col("n_rows") < warn, "warn").otherwise("pass"))


def check_date_range(df: DataFrame, first: str, last: str, column: str = "mis_date") -> DataFrame:
    """First and last date there are, and the days missing at either end of the wanted range."""
    d = df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    return d.withColumn("gap_start", F.greatest(F.datediff("first", F.lit(first).cast("date")), F.lit(0))).withColumn(
        "gap_end", F.greatest(F.datediff(F.lit(last).cast("date"), "last"), F.lit(0))
    )


def long_numbers(df: DataFrame, columns: Sequence[str], *keys: str) -> DataFrame:
    """One row per value: keys, variable, x. Nulls are left out."""
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("x")) for c in columns])
    return df.select(*keys, F.inline(pairs)).where("x IS NOT NULL")


def _medians(long: DataFrame, column: str, approximate: bool) -> DataFrame:
    """variable, median: a row for each of the columns that ``long`` was made of."""
    if approximate:
        return long.groupBy("variable").agg(quantile(column, 0.5, True).alias("median"))
    return exact_quantiles(long, column, [0.5], ["variable"]).select("variable", F.col("quantiles")[0].alias("median"))


def check_outliers(df: DataFrame, columns: Sequence[str], limit: float = 5.0, warn: float = 0.01, approximate: bool = False) -> DataFrame:
    """variable, n, n_outliers, share, status by the modified z score.

    The scale is the median absolute deviation, the mean one where that is 0; where both are 0 the
    variable is skipped. All variables go through the same two medians, as one long table. Exact medians refine histograms,
    a pass each; ``approximate`` takes sketches, one pass for both.
    """
    x = long_numbers(df, columns)
    mid = _medians(x, "x", approximate).withColumnRenamed("median", "mid")
    dev = x.join(F.broadcast(mid), "variable").select("variable", F.abs(F.col("x") - F.col("mid")).alias("dev"))
    scale = dev.groupBy("variable").agg(F.avg("dev").alias("mean")).join(_medians(dev, "dev", approximate).withColumnRenamed("median", "mad"), "variable")
    scale = scale.select("variable", F.when(F.col("mad") > 0, F.col("mad")).otherwise(F.col("mean")).alias("scale")).where("scale > 0")
    z = F.lit(0.6745) * F.col("dev") / F.col("scale")
    out = dev.join(F.broadcast(scale), "variable").groupBy("variable").agg(
        F.count("*").alias("n"), F.sum(F.when(z > limit, 1).otherwise(0)).cast("long").alias("n_outliers")
    )
    share = F.col("n_outliers") / F.col("n")
    return out.withColumn("share", share).withColumn("status", F.when(share > warn, "warn").otherwise("pass"))


def check_indicator_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, n_negative."""
    one = df.agg(*[F.sum(F.when(F.col(c) < 0, 1).otherwise(0)).cast("long").alias(f"c{i}") for i, c in enumerate(columns)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("n_negative")) for i, c in enumerate(columns)])))


def check_booked_ratio(df: DataFrame, warn: float = 0.05, fail: float = 0.01) -> DataFrame:
    r = df.agg(F.avg(F.when(F.lower("status_name") == "booked", 1.0).otherwise(0.0)).alias("share"))
    return r.withColumn("status", F.when(F.col("share") < fail, "fail").when(F.col("share") < warn, "warn").otherwise("pass"))


def check_duplicates(df: DataFrame, keys: Sequence[str] | None = None, warn: float = 0.01) -> DataFrame:
    """n_rows, n_duplicates (rows beyond the first of each key), share, status."""
    per = df.groupBy(*(keys or df.columns)).agg(F.count("*").alias("n"))
    d = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"))
    d = d.withColumn("share", F.col("n_duplicates") / F.when(F.col("n_rows") > 0, F.col("n_rows")))
    return d.withColumn("status", F.when(F.col("share") > warn, "warn").otherwise("pass"))


def dq_report(df: DataFrame, indicators: Sequence[str], period: tuple[str, str], required: Sequence[str], exempt: Sequence[str] = ID_COLUMNS, date: str = "mis_date", approximate: bool = False) -> DataFrame:
    """name, status: one row for each of the nine checks.

    Whatever is a plain aggregate comes from one pass; segment sizes, duplicates and outliers have groupings of their own.
    """
    worst = lambda c: F.max(F.when(c == "fail", 2).when(c == "warn", 1).otherwise(0))
    word = lambda n: F.when(n == 2, "fail").when(n == 1, "warn").otherwise("pass")
    absent = [c for c in required if c not in df.columns]
    checked = [c for c in df.columns if c not in exempt]
    nulls = [F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)) for c in checked]
    one = df.agg(
        F.count("*").alias("n"), F.array_max(F.array(*nulls)).alias("nulls"), F.min(date).alias("first"), F.max(date).alias("last"),
        F.avg(F.when(F.lower("status_name") == "booked", 1.0).otherwise(0.0)).alias("booked"),
        F.sum(F.when(F.least(F.lit(0.0), *[F.col(c) for c in indicators]) < 0, 1).otherwise(0)).alias("negative"),
    )
    bound = lambda d: F.lit(d).cast("date")
    row = lambda name, status: F.struct(F.lit(name).alias("name"), status.alias("status"))
    plain = one.select(F.inline(F.array(
        row("columns", F.lit("fail" if absent else "pass")), row("missing", grade(F.col("nulls"), 0.05, 0.20)), row("segment_exists", F.when(F.col("n") > 0, "pass").otherwise("fail")),
        row("date_range", F.when((F.col("first") > bound(period[0])) | (F.col("last") < bound(period[1])), "warn").otherwise("pass")),
        row("negative", F.when(F.col("negative") > 0, "warn").otherwise("pass")), row("booked_ratio", F.when(F.col("booked") < 0.01, "fail").when(F.col("booked") < 0.05, "warn").otherwise("pass")),
    )))
    named = lambda d, name: d.agg(word(worst(F.col("status"))).alias("status")).select(F.lit(name).alias("name"), "status")
    return plain.union(named(check_segment_size(df), "segment_size")).union(named(check_outliers(df, indicators, approximate=approximate), "outliers")).union(named(check_duplicates(df, ["authorization_id"]), "duplicates"))


def validate_or_fail(report: DataFrame) -> DataFrame:
    failed = [r.name for r in report.where("status = 'fail'").collect()]
    if failed:
        raise ValueError(f"data quality: {', '.join(failed)}")
    return report


def profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """column, type, n_distinct, n_null, null_share for every column.

    Exact distinct counts of all columns at once expand every row by their number; ``approximate`` takes
    sketches instead, which need one pass and no exchange of values.
    """
    cols = df.columns
    distinct = (lambda c: F.approx_count_distinct(c, 0.01)) if approximate else F.count_distinct
    one = df.agg(F.count("*").alias("n"), *[distinct(F.col(c)).alias(f"d{i}") for i, c in enumerate(cols)], *[F.count(F.col(c)).alias(f"k{i}") for i, c in enumerate(cols)])
    rows = [
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f"d{i}").alias("n_distinct"), (F.col("n") - F.col(f"k{i}")).alias("n_null"), ((F.col("n") - F.col(f"k{i}")) / F.when(F.col("n") > 0, F.col("n"))).alias("null_share"))
        for i, f in enumerate(df.schema.fields)
    ]
    return one.select(F.inline(F.array(*rows)))


def bin_summary(df: DataFrame, bin_column: str, source: str) -> DataFrame:
    return df.groupBy(F.col(bin_column).alias("bin")).agg(F.min(source).alias("low"), F.max(source).alias("high"), F.count("*").alias("n"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"))


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(k)


def numeric_columns(df: DataFrame, but: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in but]
