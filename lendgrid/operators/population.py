"""Projections, filters and predicates over application records."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import bin_right_closed, monomial_name, monomials

SCORE_BINS = {"score_rf": (350.0, 400.0, 450.0), "risk_score_rf": (20.0, 50.0, 80.0)}
MAIN, RECENT = ("1998-07-01", "1999-06-01"), ("1999-07-01", "1999-12-01")
SUPERSEGMENTS = {"durables": ("machinery", "automobile")}


def schema_rules() -> dict[str, Column]:
    amounts = ["oa_amt", "oa_amt_h0", "todu_30ever_h6", "todu_amt_pile_h6"]
    rules = {
        "status_name in set": ~F.coalesce(F.col("status_name").isin("booked", "rejected", "canceled"), F.lit(False)),
        "mis_date not null": F.col("mis_date").isNull(),
        "segment_cut_off not null": F.col("segment_cut_off").isNull(),
    }
    return rules | {f"{c} not negative": F.coalesce(F.col(c) < 0, F.lit(False)) for c in amounts}


def schema_violations(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """rule, n_rows: how many rows break each rule, all counted in one pass."""
    rules = dict(rules or schema_rules())
    one = df.agg(*[F.coalesce(F.sum(F.when(bad, 1).otherwise(0)), F.lit(0)).cast("long").alias(f"r{i}") for i, bad in enumerate(rules.values())])
    pairs = [F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("n_rows")) for i, name in enumerate(rules)]
    return one.select(F.inline(F.array(*pairs)))


def base_population(df: DataFrame) -> DataFrame:
    return df.where("fuera_norma = 'n' AND fraud_flag = 'n' AND nature_holder <> 'legal'")


def segment_filter(df: DataFrame, wanted: str, column: str = "segment_cut_off") -> DataFrame:
    """Equality; with a pipe in ``wanted`` a pattern that must match from the start."""
    return df.where(F.col(column).rlike(f"^(?:{wanted})") if "|" in wanted else F.col(column) == wanted)


def assign_segments(df: DataFrame, supersegments: Mapping[str, Sequence[str]] = SUPERSEGMENTS, column: str = "segment_cut_off") -> DataFrame:
    """Each row once per segment and supersegment it belongs to, as ``level`` and ``name``.

    Membership is by equality, so the definitions join as a hash join on a table as small as the configuration.
    """
    spark = df.sparkSession
    members = spark.createDataFrame([(s, m) for s, ms in supersegments.items() for m in ms] or [(None, None)], "name string, member string")
    own = df.select(F.lit("segment").alias("level"), F.col(column).alias("name"), "*")
    above = df.join(F.broadcast(members), F.col(column) == F.col("member")).select(F.lit("supersegment").alias("level"), "name", *df.columns)
    return own.unionByName(above)


def match_patterns(df: DataFrame, patterns: Sequence[str], column: str = "segment_cut_off") -> DataFrame:
    """Each row once per pattern that its ``column`` matches from the start, with ``pattern`` added. Nulls match nothing.

    Alternatives without special characters are prefixes: they meet the column's distinct values, cut to the prefixes' lengths, in an equi join. Only other expressions are tried
    one by one, on distinct values as well; records then join what their value matches.
    """
    parts = [(p, p.split("|")) for p in dict.fromkeys(patterns)]
    plain = {p: all(re.fullmatch(r"[\w \-]*", a) for a in alts) for p, alts in parts}
    spark, value = df.sparkSession, F.col(column)
    values = df.select(column).where(value.isNotNull()).distinct()
    keys = [(p, a) for p, alts in parts if plain[p] for a in alts]
    prefixes = spark.createDataFrame(keys or [(None, None)], "pattern string, __prefix string")
    cut = F.array(*[F.when(F.length(value) >= n, F.substring(value, 1, n)) for n in sorted({len(a) for _, a in keys})] or [F.lit(None).cast("string")])
    hits = values.select(column, F.explode(cut).alias("__prefix")).join(prefixes, "__prefix").select(column, "pattern").distinct()
    others = [(p,) for p, _ in parts if not plain[p]]
    if others:
        tried = values.crossJoin(F.broadcast(spark.createDataFrame(others, "pattern string")))
        hits = hits.unionByName(tried.where(F.rlike(value, F.concat(F.lit("^(?:"), F.col("pattern"), F.lit(")")))))
    return df.join(hits, column).select(*df.columns, "pattern")


def prune_columns(df: DataFrame, keep: Sequence[str], prefix: str = "m_ct_direct") -> DataFrame:
    return df.select(*[c for c in df.columns if c in keep or c.startswith(prefix)])


def filter_by_date(df: DataFrame, first: str, last: str, column: str = "mis_date") -> DataFrame:
    if first > last:
        raise ValueError(f"first date {first} is after last date {last}")
    return df.where(F.col(column).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def split_booked_demand(df: DataFrame, period: tuple[str, str] = MAIN) -> tuple[DataFrame, DataFrame]:
    demand = filter_by_date(df, *period)
    return demand.where("status_name = 'booked'"), demand


def bin_scores(df: DataFrame, bins: Mapping[str, Sequence[float]] = SCORE_BINS, suffix: str = "_bin") -> DataFrame:
    """Add ``<source>_bin`` for each source; rows with a null source go. Edges are inner ones, outer are infinite."""
    df = df.na.drop(subset=list(bins))
    return df.withColumns({f"{c}{suffix}": bin_right_closed(F.col(c), edges) for c, edges in bins.items()})


def outside_share(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Share of rows that are null or outside [low, high]: the quota that binning with finite edges checks. The first bin holds its lower edge."""
    bad = F.col(column).isNull() | (F.col(column) < low) | (F.col(column) > high)
    return df.agg(F.lit(column).alias("column"), F.avg(F.when(bad, 1.0).otherwise(0.0)).alias("outside"))


def bin_scores_clamped(df: DataFrame, column: str, edges: Sequence[float], quota: float = 0.01) -> DataFrame:
    """Right-closed bins with finite outer edges: rows outside go to the first or last bin, up to a quota."""
    share = outside_share(df, column, edges[0], edges[-1]).first()["outside"]
    if share is not None and share > quota:
        raise ValueError(f"{share:.2%} of {column} lie outside {edges[0]} .. {edges[-1]}")
    return bin_scores(df, {column: edges[1:-1]})


def patch_amount(df: DataFrame) -> DataFrame:
    return df.withColumn("oa_amt_h0", F.when(F.col("status_name") != "booked", F.col("oa_amt")).otherwise(F.col("oa_amt_h0")))


def update_status(df: DataFrame, score_measures: Sequence[str] = ("m_ct_direct_sc_a",), prefix: str = "m_ct_direct") -> DataFrame:
    """Any measure set: rejected for another reason; then any score measure set: for its score."""
    measures = [c for c in df.columns if c.startswith(prefix)]
    any_of = lambda cs: F.greatest(F.lit(0), *[F.when(F.col(c) == "y", 1).otherwise(0) for c in cs]) == 1
    hit, score = any_of(measures), any_of(score_measures)
    return df.withColumns({
        "status_name": F.when(hit, "rejected").otherwise(F.col("status_name")),
        "reject_reason": F.when(score, "09-score").when(hit, "08-other").otherwise(F.col("reject_reason")),
    })


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def clean(df: DataFrame, bins: Mapping[str, Sequence[float]] = SCORE_BINS) -> DataFrame:
    """Base population, binned, amounts patched, then statuses updated: in this order."""
    return update_status(patch_amount(bin_scores(base_population(df), bins)))


def poly_features(df: DataFrame, a: str, b: str) -> DataFrame:
    """The product, squares, cubes and mixed cubics of two variables."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    return df.withColumns({f"{a}_x_{b}": x * y, f"{a}_2": x * x, f"{b}_2": y * y, f"{a}_2_x_{b}": x * x * y, f"{a}_x_{b}_2": x * y * y, f"{a}_3": x * x * x, f"{b}_3": y * y * y})


def monomial_features(df: DataFrame, variables: Sequence[str], degree: int = 3) -> DataFrame:
    """All products of up to ``degree`` of any number of variables, as ``a_2_x_b``; the variables themselves stay as they are."""
    product = lambda m: reduce(lambda x, y: x * y, [F.col(v).cast("double") for v in m])
    return df.withColumns({monomial_name(m): product(m) for m in monomials(list(variables), degree) if len(m) > 1})


def cell_label(production: Column, risk: Column) -> Column:
    """Production in millions and risk in percent, as in ``1.23M 4.56%``."""
    return F.format_string("%.2fM %.2f%%", F.bround(production / 1e6, 2), F.bround(risk, 2))
