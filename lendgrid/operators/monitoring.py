"""Portfolio rates, monthly series, windows over them and anomalies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.scalars import money_sum, quantile, risk_ratio
from .quantiles import exact_quantiles


def stress_factor(booked: DataFrame, score: str = "score_rf", fraction: float = 0.05, low_is_bad: bool = True, keys: Sequence[str] = (), approximate: bool = False) -> DataFrame:
    """Risk of the worst ``fraction`` by score over the risk of all; ``approximate`` takes the limit from a sketch."""
    on, p = ["__all", *keys], fraction if low_is_bad else 1 - fraction
    b = booked.withColumn("__all", F.lit(1))
    cut = b.groupBy(*on).agg(quantile(score, p, True).alias("__cut")) if approximate else exact_quantiles(b, score, [p], on).select(*on, F.col("quantiles")[0].alias("__cut"))
    b = b.join(cut, on)
    tail = F.col(score) <= F.col("__cut") if low_is_bad else F.col(score) >= F.col("__cut")
    part = lambda c: money_sum(F.when(tail, F.col(c)).otherwise(0.0))
    s = b.groupBy(*on).agg(part("todu_30ever_h6").alias("a"), part("todu_amt_pile_h6").alias("b"), money_sum("todu_30ever_h6").alias("c"), money_sum("todu_amt_pile_h6").alias("d"))
    worst, overall = F.col("a") / F.when(F.col("b") != 0, F.col("b")), F.col("c") / F.when(F.col("d") != 0, F.col("d"))
    return s.select(*keys, worst.alias("worst"), overall.alias("overall"), (worst / F.when(overall != 0, overall)).alias("stress_factor"))


def _last_months(df: DataFrame, months: int, date: str) -> DataFrame:
    last = df.agg(F.max(date).alias("__last"))
    return df.crossJoin(F.broadcast(last)).where(F.col(date) > F.add_months("__last", -months)).drop("__last")


def transformation_rate(df: DataFrame, months: int = 12, date: str = "mis_date") -> DataFrame:
    """month (null: all), eligible, booked, rate: amount booked over amount with decision ok or rv."""
    e = _last_months(df.where("se_decision_id IN ('ok', 'rv')"), months, date)
    r = e.rollup(F.trunc(date, "month").alias("month")).agg(
        money_sum("oa_amt").alias("eligible"), money_sum(F.when(F.col("status_name") == "booked", F.col("oa_amt")).otherwise(0.0)).alias("booked")
    )
    return r.withColumn("rate", F.col("booked") / F.when(F.col("eligible") != 0, F.col("eligible")))


def financing_rate(df: DataFrame, last_months: int = 6, since: str | None = None, date: str = "mis_date") -> DataFrame:
    """mean_rate: mean of the last monthly rates in percent, one decimal; weighted_rate: by amount since a date."""
    ok = df.where("se_decision_id = 'ok'")
    booked = money_sum(F.when(F.col("status_name") == "booked", F.col("oa_amt")).otherwise(0.0))
    m = ok.groupBy(F.trunc(date, "month").alias("month")).agg(booked.alias("b"), money_sum("oa_amt").alias("e"))
    m = last_n(m, "month", last_months)
    mean = m.agg(F.bround(F.avg(F.col("b") / F.when(F.col("e") != 0, F.col("e"))) * 100, 1).alias("mean_rate"))
    since_rows = ok.where(F.col(date) >= F.lit(since).cast("date")) if since else ok
    weighted = since_rows.agg(booked.alias("b"), money_sum("oa_amt").alias("e")).select((F.col("b") / F.when(F.col("e") != 0, F.col("e"))).alias("weighted_rate"))
    return mean.crossJoin(weighted)


def last_n(series: DataFrame, order: str, n: int, keys: Sequence[str] = ()) -> DataFrame:
    """The last ``n`` rows of each ordered series (a series has a row per period, not per record)."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return series.withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= n).drop("__k")


def monthly_metrics(df: DataFrame, keys: Sequence[str] = (), date: str = "mis_date", multiplier: float = 7.0) -> DataFrame:
    """Per month: records, booked, approval rate, production, risk and mean scores of what was booked."""
    b = F.col("status_name") == "booked"
    if_booked = lambda c: F.when(b, F.col(c))
    m = df.groupBy(*keys, F.trunc(date, "month").alias("month")).agg(
        F.count("*").alias("n_records"), F.sum(F.when(b, 1).otherwise(0)).alias("n_booked"),
        money_sum(if_booked("oa_amt_h0")).alias("production"), F.count(if_booked("oa_amt_h0")).alias("__n"),
        money_sum(if_booked("todu_30ever_h6")).alias("__a"), money_sum(if_booked("todu_amt_pile_h6")).alias("__t"),
        money_sum(if_booked("score_rf")).alias("__s"), F.count(if_booked("score_rf")).alias("__sn"),
    )
    div = lambda a, b_: F.col(a) / F.when(F.col(b_) != 0, F.col(b_))
    return m.select(
        *keys, "month", "n_records", "n_booked", div("n_booked", "n_records").alias("approval_rate"), "production",
        div("production", "__n").alias("mean_production"), risk_ratio(F.col("__a"), F.col("__t"), multiplier, percent=True).alias("risk"),
        div("__s", "__sn").alias("mean_score_rf"),
    )


def rolling_sum(column: str, order: str, n: int = 6, keys: Sequence[str] = ()):
    """Sum of the last ``n`` rows; null until there are so many."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(1 - n, 0)
    return F.when(F.count(F.lit(1)).over(w) == n, F.sum(F.col(column).cast("decimal(20,4)")).over(w).cast("double"))


def risk_production_series(booked: DataFrame, limits: DataFrame | None = None, n: int = 6, multiplier: float = 7.0) -> DataFrame:
    """Per date: sums, ratio, ratio of the last ``n`` dates, and the year's limit (year, limit) if given."""
    s = booked.groupBy("mis_date").agg(money_sum("oa_amt_h0").alias("production"), money_sum("todu_30ever_h6").alias("arrears"), money_sum("todu_amt_pile_h6").alias("exposure"))
    s = s.withColumns({
        "risk": risk_ratio(F.col("arrears"), F.col("exposure"), multiplier, True),
        "rolling_risk": risk_ratio(rolling_sum("arrears", "mis_date", n), rolling_sum("exposure", "mis_date", n), multiplier, True),
    })
    if limits is None:
        return s
    return s.join(F.broadcast(limits), F.year("mis_date") == F.col("year"), "left").drop("year")


#: The two-sided 97.5 % quantile of Student's t by degrees of freedom 1 to 19.
T_975 = [12.7062, 4.3027, 3.1824, 2.7764, 2.5706, 2.4469, 2.3646, 2.3060, 2.2622, 2.2281, 2.2010, 2.1788, 2.1604, 2.1448, 2.1314, 2.1199, 2.1098, 2.1009, 2.0930]


def spc_anomalies(series: DataFrame, value: str, order: str = "month", window: int = 6, n_sigma: float = 2.0, keys: Sequence[str] = ()) -> DataFrame:
    """Flags values outside median +- s * scale of the ``window`` rows before.

    The scale is the median absolute deviation over 0.6745, the sample deviation where that is 0. For
    windows under 20 rows s is ``n_sigma`` stretched by the t quantile over the normal one. Rows with
    fewer than ``window`` rows before have no bounds.
    """
    s = n_sigma * (T_975[window - 2] / 1.959964 if 2 <= window < 20 else 1.0)
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-window, -1)
    half = lambda a: (F.element_at(a, F.floor((F.size(a) + 1) / 2).cast("int")) + F.element_at(a, F.floor((F.size(a) + 2) / 2).cast("int"))) / 2
    d = series.withColumn("__w", F.sort_array(F.collect_list(value).over(w))).withColumn("__sd", F.stddev_samp(value).over(w))
    enough = F.size("__w") == window
    d = d.withColumn("center", F.when(enough, half(F.col("__w"))))
    d = d.withColumn("__dev", F.when(enough, F.sort_array(F.transform("__w", lambda x: F.abs(x - F.col("center"))))))
    mad = F.when(enough, half(F.col("__dev")))
    scale = F.when(mad > 0, mad / 0.6745).otherwise(F.when(enough, F.col("__sd")))
    d = d.withColumn("lower", F.col("center") - F.lit(s) * scale).withColumn("upper", F.col("center") + F.lit(s) * scale)
    flag = F.when(F.col(value) > F.col("upper"), "above").when(F.col(value) < F.col("lower"), "below").otherwise("none")
    return d.withColumn("anomaly", flag).drop("__w", "__sd", "__dev")


def trend_line(series: DataFrame, value: str, order: str = "month", keys: Sequence[str] = ()) -> DataFrame:
    """Least-squares line over the row's position in its series."""
    x = series.withColumn("x", (F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1).cast("double"))
    fit = x.groupBy(F.lit(1).alias("__all"), *keys).agg(F.regr_slope(value, "x").alias("slope"), F.regr_intercept(value, "x").alias("intercept"))
    j = x.withColumn("__all", F.lit(1)).join(F.broadcast(fit), ["__all", *keys])
    return j.withColumn("trend", F.col("intercept") + F.col("slope") * F.col("x")).drop("__all")


def group_stats(df: DataFrame, group: str, target: str) -> DataFrame:
    return df.groupBy(F.col(group).alias("group")).agg(F.avg(F.col(target).cast("decimal(20,4)")).cast("double").alias("mean"), F.count(target).alias("n"))
