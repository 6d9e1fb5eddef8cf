"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def money_sum(c: Column | str) -> Column:
    """Sum of an amount, exact to four decimals, so it doesn't depend on the order of rows."""
    return F.sum((F.col(c) if isinstance(c, str) else c).cast("decimal(20,4)")).cast("double")


def risk_ratio(num: Column, den: Column, multiplier: float = 7.0, percent: bool = False, decimals: int | None = 2) -> Column:
    """``multiplier * num / den``, as a percentage if asked; a zero denominator gives null. Half to even."""
    x = F.lit(float(multiplier)) * num / F.when(den != 0, den)
    x = x * 100 if percent else x
    return x if decimals is None else F.bround(x, decimals)


def arrears_from_ratio(ratio: Column, den: Column, multiplier: float = 7.0) -> Column:
    """The arrears that ``risk_ratio`` turned into ``ratio``."""
    return ratio * den / float(multiplier)


def annual_coefficient(first: Column, last: Column) -> Column:
    """12 over the number of months from first to last, both counted."""
    return F.lit(12.0) / (F.year(last) * 12 + F.month(last) - F.year(first) * 12 - F.month(first) + 1)


def bin_right_closed(x: Column, inner_edges: Sequence[float]) -> Column:
    """1-based bin of x among (-inf, e1], (e1, e2], ..., (en, inf); null stays null."""
    n = F.lit(1)
    for e in inner_edges:
        n = n + F.when(x > F.lit(float(e)), 1).otherwise(0)
    return F.when(x.isNotNull(), n).cast("int")


def stability_status(psi: Column, moderate: float = 0.1, unstable: float = 0.25) -> Column:
    return F.when(psi < moderate, "stable").when(psi < unstable, "moderate").otherwise("unstable")


def severity(psi: Column, moderate: float = 0.1, unstable: float = 0.25) -> Column:
    return F.when(psi < moderate, "info").when(psi < unstable, "warning").otherwise("critical")


def normal_two_sided_p(z: Column) -> Column:
    """erfc(|z| / sqrt 2) by the rational approximation 7.1.26 of Abramowitz and Stegun (error below 1.5e-7)."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.3275911) * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return poly * F.exp(-x * x)


def hash_fraction(*parts: Column) -> Column:
    """A fraction in [0, 1) from the md5 of its parts: the same in every engine and run."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 8), 16, 10).cast("double") / float(2**32)


def quantile(c: Column | str, p: float, approximate: bool = False) -> Column:
    """Quantile by interpolation between all distinct values of a group, or from a sketch of bounded size."""
    return F.percentile_approx(c, F.lit(p), F.lit(10_000)) if approximate else F.percentile(c, F.lit(p))


def monomial_name(m: Sequence[str]) -> str:
    """``a_2_x_b`` for the product of a, a and b."""
    return "_x_".join(v if m.count(v) == 1 else f"{v}_{m.count(v)}" for v in dict.fromkeys(m))


def monomials(names: Sequence[str], degree: int) -> list[tuple[str, ...]]:
    """All products of up to ``degree`` names, lower degrees first."""
    from itertools import combinations_with_replacement

    return [m for k in range(1, degree + 1) for m in combinations_with_replacement(names, k)]
