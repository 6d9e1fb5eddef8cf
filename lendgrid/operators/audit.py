"""Record-level audit of a cutoff, and resampled intervals of what it accepts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import money_sum, risk_ratio
from .cutoffs import V0, V1
from .resampling import resampled_sums


def audit_records(demand: DataFrame, cuts: DataFrame, coefficient: float = 1.0, financing_rate: float = 1.0, v0: str = V0, v1: str = V1, low_is_safe: bool = True) -> DataFrame:
    """Each record with passes, classification, annual amount and the amount adjusted for financing of swap-ins.

    ``cuts``: v0, cut. Bins without a cut: unknown.
    """
    passes = (F.col(v1) <= F.col("cut")) if low_is_safe else (F.col(v1) >= F.col("cut"))
    d = demand.join(F.broadcast(cuts.select(v0, "cut")), v0, "left").withColumn("passes", passes)
    booked = F.col("status_name") == "booked"
    by_score = (F.col("status_name") == "rejected") & F.coalesce(F.col("reject_reason") == "09-score", F.lit(False))
    kind = (
        F.when(F.col("cut").isNull(), "unknown").when(booked & F.col("passes"), "keep").when(booked, "swap_out")
        .when(by_score & F.col("passes"), "swap_in").when(by_score, "rejected").otherwise("rejected_other")
    )
    d = d.withColumn("classification", kind).withColumn("amount", F.col("oa_amt_h0") * F.lit(float(coefficient)))
    return d.withColumn("amount_adjusted", F.col("amount") * F.when(F.col("classification") == "swap_in", F.lit(float(financing_rate))).otherwise(1.0))


def audit_summary(audit: DataFrame) -> DataFrame:
    return audit.groupBy("classification").agg(F.count("*").alias("n"), money_sum("amount").alias("amount"), money_sum("amount_adjusted").alias("amount_adjusted"))


def audit_reconcile(summary: DataFrame, metrics: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """classification, audited, reported, gap, agrees for swap-ins and swap-outs."""
    names = F.when(F.col("metric") == "Swap-in", "swap_in").when(F.col("metric") == "Swap-out", "swap_out")
    m = metrics.select(names.alias("classification"), F.col("production").alias("reported")).where("classification IS NOT NULL")
    j = m.join(summary.select("classification", F.col("amount_adjusted").alias("audited")), "classification", "left").na.fill(0.0, ["audited"])
    gap = F.abs(F.col("audited") - F.col("reported")) / F.greatest(F.col("reported"), F.lit(1.0))
    return j.withColumn("gap", gap).withColumn("agrees", gap <= tolerance)


def bootstrap_kpis(booked: DataFrame, cuts: DataFrame, replicates: int = 200, seed: str = "kpi", alpha: float = 0.05, model_se: float = 0.0, coefficient: float = 1.0, v0: str = V0, v1: str = V1, multiplier: float = 7.0) -> DataFrame:
    """Percentile intervals of production and risk of the accepted booked records.

    Every record draws a Poisson weight per replicate and is read once for all of them. ``model_se``
    widens the risk interval by a model's own standard error.
    """
    ok = booked.join(F.broadcast(cuts.select(v0, "cut")), v0).where(F.col(v1) <= F.col("cut"))
    # Amounts as whole ten-thousandths: sums are exact.
    whole = [(F.col(c).cast("decimal(20,4)") * 10_000).cast("long").alias(c) for c in ("oa_amt_h0", "todu_30ever_h6", "todu_amt_pile_h6")]
    s = resampled_sums(ok.select("authorization_id", *whole), "authorization_id", ["oa_amt_h0", "todu_30ever_h6", "todu_amt_pile_h6"], replicates, seed)
    part = lambda c: F.col(c).cast("double") / 10_000
    s = s.select((part("oa_amt_h0") * F.lit(float(coefficient))).alias("production"), part("todu_30ever_h6").alias("a"), part("todu_amt_pile_h6").alias("t"))
    s = s.withColumn("risk", risk_ratio(F.col("a"), F.col("t"), multiplier, True, None))
    q = lambda c, p: F.percentile(c, F.lit(p))
    r = s.agg(q("production", alpha / 2).alias("production_low"), q("production", 1 - alpha / 2).alias("production_high"), q("risk", alpha / 2).alias("lo"), q("risk", 1 - alpha / 2).alias("hi"))
    mid, half = (F.col("lo") + F.col("hi")) / 2, (F.col("hi") - F.col("lo")) / 2
    wide = F.sqrt(half * half + F.lit((1.96 * model_se) ** 2))
    return r.select("production_low", "production_high", (mid - wide).alias("risk_low"), (mid + wide).alias("risk_high"))
