"""Cutoff search on the grid: levels, enumeration, frontiers, evaluation and sensitivity.

A cutoff accepts, in each bin of the first variable, the ``level`` safest bins of the second. Levels run from 0
(none) to the number of bins; along the first variable from safest to riskiest they must not rise. Both
variables' directions are parameters, so inversion never changes the arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import risk_ratio
from ..sources.shared import written

#: Levels of all keys together up to which the frontier fold stays in one partition.
FEW = 20_000
V0, V1 = "score_rf_bin", "risk_score_rf_bin"
MEASURES = ("oa_amt_h0", "todu_30ever_h6", "todu_amt_pile_h6")
MONEY = "decimal(20,4)"


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def prefix_levels(cells: DataFrame, measures: Sequence[str] = MEASURES, v0: str = V0, v1: str = V1, low_is_safe: bool = True, keys: Sequence[str] = ()) -> DataFrame:
    """keys, v0, level, and each measure summed over the ``level`` safest bins; the grid must be complete."""
    w = Window.partitionBy(*keys, v0).orderBy(F.col(v1) if low_is_safe else F.desc(v1))
    sums = cells.select(*keys, v0, F.row_number().over(w).alias("level"), *[F.sum(money(m)).over(w).cast(MONEY).alias(m) for m in measures])
    zero = cells.select(*keys, v0).distinct().select(*keys, v0, F.lit(0).alias("level"), *[F.lit(0).cast(MONEY).alias(m) for m in measures])
    return zero.unionByName(sums)


def monotone_cutoffs(levels: DataFrame, order: Sequence[int]) -> DataFrame:
    """All non-increasing level sequences along ``order`` (bins of v0, safest first): path, by one join a bin.

    ``levels`` has the column level. The result is exponential in the grid; the folds below don't need it.
    """
    lv = levels.select("level").distinct()
    out = lv.select(F.array("level").alias("path"), F.col("level").alias("last"))
    for _ in order[1:]:
        out = out.join(F.broadcast(lv), F.col("level") <= F.col("last")).select(F.concat("path", F.array("level")).alias("path"), F.col("level").alias("last"))
    return out.select(F.array_join("path", "-").alias("solution"), "path")


def solution_cuts(solutions: DataFrame, order: Sequence[int], v0: str = V0) -> DataFrame:
    """solution, path -> solution, v0, level: the long form."""
    bins = F.array(*[F.lit(b) for b in order])
    return solutions.select("solution", F.posexplode("path").alias("i", "level")).select("solution", bins[F.col("i")].alias(v0), "level")


def solution_kpis(cuts: DataFrame, levels: DataFrame, cells: DataFrame | None = None, v0: str = V0, keys: Sequence[str] = (), measures: Sequence[str] = MEASURES, multiplier: float = 7.0) -> DataFrame:
    """keys, solution, the summed measures of accepted cells and their risk in percent.

    Cells are never joined one by one: a cut meets the prefix sum of its level.
    """
    j = cuts.join(levels, [v0, "level"]).groupBy(*keys, "solution").agg(*[F.sum(m).cast("double").alias(m) for m in measures])
    for s in ("", "_boo", "_rep"):
        if f"todu_30ever_h6{s}" in measures:
            j = j.withColumn(f"risk{s}", risk_ratio(F.col(f"todu_30ever_h6{s}"), F.col(f"todu_amt_pile_h6{s}"), multiplier, True, 4))
    if cells is not None and "oa_amt_h0_boo" in measures:
        total = cells.agg(*[F.sum(money(f"{m}_boo")).cast("double").alias(f"__{m}") for m in MEASURES])
        j = j.crossJoin(F.broadcast(total))
        j = j.withColumns({f"{m}_cut": F.greatest(F.round(F.col(f"__{m}") - F.col(f"{m}_boo"), 4), F.lit(0.0)) for m in MEASURES}).drop(*[f"__{m}" for m in MEASURES])
    return j


def pareto_filter(points: DataFrame, risk: str = "risk", production: str = "oa_amt_h0", keys: Sequence[str] = (), tie: str = "solution") -> DataFrame:
    """Points without a risk go; of the rest those whose production exceeds that of every less risky one stay."""
    w = Window.partitionBy(*keys).orderBy(F.col(risk), F.desc(production), F.col(tie)).rowsBetween(Window.unboundedPreceding, -1)
    p = points.where(F.col(risk).isNotNull()).withColumn("__max", F.max(production).over(w))
    return p.where(F.col("__max").isNull() | (F.col(production) > F.col("__max"))).drop("__max")


def strict_frontier(points: DataFrame, risk: str = "risk", production: str = "oa_amt_h0", keys: Sequence[str] = ("segment_cut_off",), tie: str = "solution") -> DataFrame:
    """Strictly increasing production per segment, for allocation."""
    return pareto_filter(points, risk, production, keys, tie)


def _slack(target: Column, multiplier: float) -> Column:
    return F.round(F.lit(float(multiplier)) * F.col("todu_30ever_h6").cast("double") - target / 100 * F.col("todu_amt_pile_h6").cast("double"), 4).cast(MONEY)


def prune_dominated(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Within ``keys`` keep rows that produce more than every row with as little or less slack."""
    w = Window.partitionBy(*keys).orderBy("slack", F.desc("production"), "path").rowsBetween(Window.unboundedPreceding, -1)
    s = state.withColumn("__max", F.max("production").over(w))
    return s.where(F.col("__max").isNull() | (F.col("production") > F.col("__max"))).drop("__max")


def frontier_by_target(levels: DataFrame, targets: DataFrame, order: Sequence[int], v0: str = V0, keys: Sequence[str] = (), allowed: DataFrame | None = None, multiplier: float = 7.0) -> DataFrame:
    """keys, target, path, production, slack: for each risk target the monotone cutoffs that produce most.

    A fold over the bins of v0, safest first. A state is (keys, target, last level) with production and
    slack; each step joins the levels not above the last and prunes dominated states, which is exact.
    ``targets`` has ``target`` and, if wanted, ``keys``; ``allowed`` (v0, low, high) pins levels. Slack is multiplier *
    arrears - target * exposure and must end at 0 or less; ties: less slack, then path.
    """
    # A few numbers per cell, read once for each bin: written, so that the records behind them are read once.
    lv = written(levels.select(*keys, v0, "level", F.col("oa_amt_h0").alias("p"), "todu_30ever_h6", "todu_amt_pile_h6"))
    few = lv.limit(FEW + 1).count() <= FEW
    if allowed is not None:
        lv = lv.join(F.broadcast(allowed), v0, "left").where("(low IS NULL OR level >= low) AND (high IS NULL OR level <= high)").drop("low", "high")
    if keys and "target" in targets.columns and not set(keys) <= set(targets.columns):
        targets = lv.select(*keys).distinct().crossJoin(F.broadcast(targets))
    top = 10**6
    state = targets.select(*keys, "target", F.lit(top).alias("last"), F.lit("").alias("path"), F.lit(0).cast(MONEY).alias("production"), F.lit(0).cast(MONEY).alias("slack"))
    for b in order:
        step = lv.where(F.col(v0) == b).drop(v0)
        step = F.broadcast(step) if few else step
        # With few levels all states fit in one partition, where the windows below need no exchange.
        state = state.coalesce(1) if few else state
        j = state.join(step, list(keys)) if keys else state.crossJoin(step)
        state = j.where("level <= last").select(
            *keys, "target", F.col("level").alias("last"), F.concat_ws("-", F.when(F.col("path") != "", F.col("path")), F.col("level")).alias("path"),
            (F.col("production") + F.col("p")).cast(MONEY).alias("production"), (F.col("slack") + _slack(F.col("target"), multiplier)).cast(MONEY).alias("slack"),
        )
        state = prune_dominated(state, [*keys, "target", "last"])
    w = Window.partitionBy(*keys, "target").orderBy(F.desc("production"), "slack", "path")
    best = state.where("slack <= 0").withColumn("__k", F.row_number().over(w)).where("__k = 1")
    return best.select(*keys, "target", "path", F.col("production").cast("double").alias("production"), F.col("slack").cast("double").alias("slack"))


def allowed_levels(pins: DataFrame, v0: str = V0, v1: str = V1) -> DataFrame:
    """(v0, v1, accept) -> (v0, low, high): what forced cells leave of the levels."""
    return pins.groupBy(v0).agg(F.max(F.when(F.col("accept") == 1, F.col(v1))).alias("low"), (F.min(F.when(F.col("accept") == 0, F.col(v1))) - 1).alias("high"))


def masks(cuts: DataFrame, cells: DataFrame, v0: str = V0, v1: str = V1, low_is_safe: bool = True) -> DataFrame:
    """solution, v0, v1, accept for every cell (theta condition within each bin of v0)."""
    rank = F.row_number().over(Window.partitionBy(v0).orderBy(F.col(v1) if low_is_safe else F.desc(v1)))
    return cuts.join(F.broadcast(cells.select(v0, v1, rank.alias("__r"))), v0).select("solution", v0, v1, F.when(F.col("__r") <= F.col("level"), 1).otherwise(0).alias("accept"))


def mask_to_cutoffs(mask: DataFrame, v0: str = V0, v1: str = V1, inverted: bool = False, keys: Sequence[str] = ("solution",)) -> DataFrame:
    """Per bin of v0 the last accepted bin of v1; none: minus (inverted: plus) infinity."""
    hit = F.when(F.col("accept") == 1, F.col(v1).cast("double"))
    cut = F.coalesce(F.min(hit), F.lit(float("inf"))) if inverted else F.coalesce(F.max(hit), F.lit(float("-inf")))
    return mask.groupBy(*keys, v0).agg(cut.alias("cut"))


def mask_projections(mask: DataFrame, dims: Sequence[str], keys: Sequence[str] = ("solution",)) -> DataFrame:
    """keys, dimension, bin, accepted: for grids of any number of dimensions, whether a bin has an accepted cell.

    All dimensions are aggregated in one pass.
    """
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("double").alias("bin")) for d in dims])
    return mask.select(*keys, "accept", F.inline(pairs)).groupBy(*keys, "dimension", "bin").agg(F.max("accept").cast("double").alias("accepted"))


def monotonicity_violations(mask: DataFrame, dims: dict[str, bool], keys: Sequence[str] = ("solution",)) -> DataFrame:
    """Neighbours of which the riskier is accepted and the safer isn't, in any dimension (name -> low is safe)."""
    out = None
    for name, low in dims.items():
        others = [*keys, *[d for d in dims if d != name]]
        w = Window.partitionBy(*others).orderBy(F.col(name) if low else F.desc(name))
        v = mask.withColumn("next", F.lead("accept").over(w)).where("accept = 0 AND next = 1").select(*keys, F.lit(name).alias("dimension"), *dims)
        out = v if out is None else out.unionByName(v)
    return out


def fixed_cutoff_problems(cuts: DataFrame, bins: Sequence[int], top: int, v0: str = V0) -> DataFrame:
    """problem, v0: bins without a cut, cuts out of range, and levels that rise towards risk (bins safest first)."""
    spark = cuts.sparkSession
    want = spark.createDataFrame([(i, b) for i, b in enumerate(bins)], f"i int, {v0} int")
    j = want.join(F.broadcast(cuts), v0, "left")
    rise = j.where("level IS NOT NULL").withColumn("before", F.lag("level").over(Window.orderBy("i"))).where("level > before")
    pick = lambda d, name: d.select(F.lit(name).alias("problem"), v0)
    return pick(j.where("level IS NULL"), "missing").union(pick(j.where(~F.col("level").between(0, top)), "out of range")).union(pick(rise, "not monotone"))


def apply_cuts(cells: DataFrame, cuts: DataFrame, v0: str = V0, v1: str = V1, low_is_safe: bool = True, keys: Sequence[str] = (), multiplier: float = 7.0) -> DataFrame:
    """keys, metric (Actual, Swap-in, Swap-out, Optimum selected), production, share, sums, risk. ``cuts``: v0, cut."""
    passes = (F.col(v1) <= F.col("cut")) if low_is_safe else (F.col(v1) >= F.col("cut"))
    c = cells.join(F.broadcast(cuts), [*[k for k in keys if k in cuts.columns], v0], "left").withColumn("__ok", F.coalesce(passes, F.lit(False)))
    total = lambda s, cond: [F.coalesce(F.sum(money(F.when(cond, F.col(f"{m}{s}")).otherwise(0.0))).cast("double"), F.lit(0.0)) for m in MEASURES]
    parts = {"a": total("_boo", F.lit(True)), "i": total("_rep", F.col("__ok")), "o": total("_boo", ~F.col("__ok"))}
    g = c.groupBy(F.lit(1).alias("__all"), *keys).agg(*[e.alias(f"{p}{k}") for p, es in parts.items() for k, e in enumerate(es)])
    col = lambda p, k: F.col(f"{p}{k}") if p != "s" else F.round(F.col(f"a{k}") - F.col(f"o{k}") + F.col(f"i{k}"), 4)
    row = lambda name, p: F.struct(
        F.lit(name).alias("metric"), col(p, 0).alias("production"), F.coalesce(col(p, 0) / F.when(F.col("a0") != 0, F.col("a0")), F.lit(0.0)).alias("production_share"),
        col(p, 1).alias("todu_30ever_h6"), col(p, 2).alias("todu_amt_pile_h6"), F.coalesce(risk_ratio(col(p, 1), col(p, 2), multiplier, True), F.lit(0.0)).alias("risk"),
    )
    return g.select(*keys, F.inline(F.array(row("Actual", "a"), row("Swap-in", "i"), row("Swap-out", "o"), row("Optimum selected", "s"))))


def perturb_risk(cells: DataFrame, levels: Sequence[float]) -> DataFrame:
    """Each cell once per level (percent), its modelled arrears scaled and its total taken anew."""
    lv = cells.sparkSession.createDataFrame([(float(x),) for x in levels], "level_pct double")
    c = cells.crossJoin(F.broadcast(lv)).withColumn("todu_30ever_h6_rep", F.col("todu_30ever_h6_rep") * (1 + F.col("level_pct") / 100))
    return c.withColumn("todu_30ever_h6", F.col("todu_30ever_h6_boo") + F.col("todu_30ever_h6_rep"))


def perturbed_masks(cells: DataFrame, levels: Sequence[float], target: float, order: Sequence[int]) -> DataFrame:
    """level_pct, v0, v1, accept: the best mask under each perturbation, all levels in one fold."""
    p = perturb_risk(cells, levels)
    lv = prefix_levels(p, keys=["level_pct"])
    t = cells.sparkSession.createDataFrame([(float(target),)], "target double")
    best = frontier_by_target(lv, t, order, keys=["level_pct"])
    parts = F.split("path", "-")
    m = p.select("level_pct", V0, V1).join(F.broadcast(best.select("level_pct", "path", "production")), "level_pct")
    at = F.array_position(F.array(*[F.lit(b) for b in order]), F.col(V0)).cast("int")
    return m.select("level_pct", V0, V1, F.when(F.col(V1) <= F.element_at(parts, at).cast("int"), 1).otherwise(0).alias("accept"), "path", "production")


def sensitivity(cells: DataFrame, levels: Sequence[float], target: float, order: Sequence[int]) -> DataFrame:
    """Per level: cells that flip against level 0, both ways, new production and cutoffs."""
    m = perturbed_masks(cells, sorted({0.0, *map(float, levels)}), target, order)
    base = m.where("level_pct = 0").select(V0, V1, F.col("accept").alias("base"))
    j = m.join(F.broadcast(base), [V0, V1])
    flip = lambda a, b: F.sum(F.when((F.col("base") == a) & (F.col("accept") == b), 1).otherwise(0))
    return j.groupBy("level_pct").agg((flip(1, 0) + flip(0, 1)).alias("n_flips"), flip(1, 0).alias("accept_to_reject"), flip(0, 1).alias("reject_to_accept"), F.first("production").alias("production"), F.first("path").alias("path"))


def cell_flip_threshold(cells: DataFrame, levels: Sequence[float], target: float, order: Sequence[int]) -> DataFrame:
    """Per cell the level nearest to 0 that flips it (of equals the negative one); null: none does."""
    m = perturbed_masks(cells, sorted({0.0, *map(float, levels)}), target, order)
    base = m.where("level_pct = 0").select(V0, V1, F.col("accept").alias("base"))
    j = m.join(F.broadcast(base), [V0, V1]).groupBy(V0, V1, "base").agg(
        F.min(F.when(F.col("accept") != F.col("base"), F.struct(F.abs("level_pct").alias("size"), F.col("level_pct").alias("level")))).alias("f")
    )
    return j.select(V0, V1, "base", F.col("f.level").alias("threshold"), F.when(F.col("f").isNull(), "stable").when(F.col("base") == 1, "to_reject").otherwise("to_accept").alias("direction"))


def marginal_impact(cells: DataFrame, mask: DataFrame, v0: str = V0, v1: str = V1, multiplier: float = 7.0) -> DataFrame:
    """Per cell what flipping it does to production and risk; totals once, then arithmetic."""
    c = cells.join(F.broadcast(mask.select(v0, v1, "accept")), [v0, v1])
    tot = c.where("accept = 1").agg(*[F.coalesce(F.sum(money(m)).cast("double"), F.lit(0.0)).alias(f"__{m}") for m in MEASURES])
    c = c.crossJoin(F.broadcast(tot))
    sign = F.when(F.col("accept") == 1, -1.0).otherwise(1.0)
    after = lambda m: F.col(f"__{m}") + sign * F.col(m)
    ratio = lambda a, b: risk_ratio(a, b, multiplier, True)
    now, new = ratio(F.col("__todu_30ever_h6"), F.col("__todu_amt_pile_h6")), ratio(after("todu_30ever_h6"), after("todu_amt_pile_h6"))
    return c.select(
        v0, v1, "accept", (sign * F.col("oa_amt_h0")).alias("delta_production"), F.coalesce(F.round(new - now, 2), F.lit(0.0)).alias("delta_risk"),
        F.col("oa_amt_h0").alias("cell_production"), ratio(F.col("todu_30ever_h6"), F.col("todu_amt_pile_h6")).alias("cell_risk"),
    )


def select_scenario(frontier: DataFrame, targets: DataFrame, keys: Sequence[str] = (), risk: str = "risk", tie: str = "solution") -> DataFrame:
    """For each scenario the riskiest point within its target; if none is, the least risky point."""
    j = frontier.crossJoin(F.broadcast(targets))
    ok = F.col(risk) <= F.col("target")
    w = Window.partitionBy(*keys, "scenario").orderBy(F.desc(ok), F.when(ok, -F.col(risk)).otherwise(F.col(risk)), tie)
    return j.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k")


def nearest_point(frontier: DataFrame, wanted: float, keys: Sequence[str] = (), risk: str = "risk", tie: str = "solution") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.abs(F.col(risk) - F.lit(float(wanted))), tie)
    return frontier.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k")


def sample_solutions(solutions: DataFrame, n: int, seed: str = "sample") -> DataFrame:
    """``n`` rows in the order of a hash: a sample that reruns agree on."""
    return solutions.withColumn("__h", F.md5(F.concat(F.lit(seed), "solution"))).orderBy("__h").limit(n).drop("__h")


def infer_direction(cells: DataFrame, var: str, permutations: int = 1000, seed: str = "direction", alpha: float = 0.10) -> DataFrame:
    """covariance, p_value, direction of a binned variable: covariance of the ranks of bins and of their risks, weighted by ``oa_amt``.

    Risks are rounded to two decimals before they are ranked, as everywhere.
    Permutations order the bins by a hash of replicate and bin, so that they rerun alike. Under two bins, a zero
    covariance or a p above ``alpha``: 1.
    """
    b = cells.groupBy(F.col(var).alias("x")).agg(F.sum(money("todu_30ever_h6")).cast("double").alias("a"), F.sum(money("todu_amt_pile_h6")).cast("double").alias("t"), F.sum(money("oa_amt")).cast("double").alias("w"))
    b = b.withColumn("y", risk_ratio(F.col("a"), F.col("t"))).where("y IS NOT NULL")
    mid = lambda c: F.rank().over(Window.orderBy(c)) + (F.count("*").over(Window.partitionBy(c)) - 1) / 2
    r = b.select("x", "w", mid("x").alias("rx"), mid("y").alias("ry"))
    reps = cells.sparkSession.range(permutations + 1).select(F.col("id").alias("b"))
    p = r.crossJoin(F.broadcast(reps)).withColumn("h", F.md5(F.concat_ws("|", F.lit(seed), "b", "x")))
    pos = F.row_number().over(Window.partitionBy("b").orderBy("h"))
    own = F.row_number().over(Window.partitionBy("b").orderBy("x"))
    p = p.withColumn("i", own).withColumn("j", F.when(F.col("b") == 0, own).otherwise(pos))
    y = p.select("b", F.col("i").alias("j"), F.col("ry").alias("py"))
    q = p.drop("ry").join(y, ["b", "j"]).groupBy("b").agg(
        (F.sum(F.col("w") * F.col("rx") * F.col("py")) / F.sum("w") - F.sum(F.col("w") * F.col("rx")) / F.sum("w") * F.sum(F.col("w") * F.col("py")) / F.sum("w")).alias("cov"), F.count("*").alias("n")
    )
    obs = q.where("b = 0").select(F.col("cov").alias("covariance"), "n")
    d = q.where("b > 0").crossJoin(F.broadcast(obs.select("covariance"))).agg(((F.sum(F.when(F.abs("cov") >= F.abs("covariance") - 1e-12, 1).otherwise(0)) + 1) / (F.count("*") + 1)).alias("p_value"))
    sure = (F.col("n") >= 2) & (F.abs("covariance") > 1e-8) & (F.col("p_value") <= alpha)
    return obs.crossJoin(d).select(F.lit(var).alias("variable"), "covariance", "p_value", F.when(sure & (F.col("covariance") < 0), -1).otherwise(1).alias("direction"))
