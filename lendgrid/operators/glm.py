"""Tweedie, logistic and hurdle models of every key at once, by a fixed number of reweighted least-squares steps on Spark columns.

A key is whatever a model is fitted for: a segment, a fold, a point of a search, or several of these. The cells of a key's grid are gathered once, one
shuffle for all keys, and every step is a sum over them and the solution of a small linear system, both as array expressions. Models are rows, as those of ``segment_models``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .risk_models import cv_results, fold_scores
from .segment_models import INTERCEPT, SINGULAR, fit_keyed, predict_keyed

#: Steps of every fit. Newton's method doubles its digits near the optimum, so these suffice from the plain mean; SQL can say the same number.
STEPS = 12
#: Linear predictors are held within these bounds, so that no step overflows.
LIMIT = 30.0
#: Least variance that a logistic step divides by.
LEAST = 1e-12
FAMILIES = ("gaussian", "tweedie", "logistic")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _held(eta: Column) -> Column:
    return F.least(F.greatest(eta, F.lit(-LIMIT)), F.lit(LIMIT))


def mean_of(eta: Column, family: str) -> Column:
    """The mean that a linear predictor stands for; null for null, which bounds alone would turn into a number."""
    if family == "gaussian":
        return eta
    return F.when(eta.isNotNull(), F.exp(_held(eta)) if family == "tweedie" else 1 / (1 + F.exp(-_held(eta))))


def _working(family: str, power: float, eta: Column, y: Column, w: Column) -> tuple[Column, Column]:
    """Working response and weight of a record at a linear predictor."""
    if family == "gaussian":
        return y, w
    held, mu = _held(eta), mean_of(eta, family)
    if family == "tweedie":
        return held + (y - mu) / mu, w * F.pow(mu, F.lit(2.0 - power))
    v = F.greatest(mu * (1 - mu), F.lit(LEAST))
    return held + (y - mu) / v, w * v


def _solved(rows: Column, size: int, penalty: Column) -> Column:
    """The solution of a symmetric system whose rows end with their right side; a row that others determine gets 0. The first is never penalised."""
    rows = F.transform(rows, lambda r, i: F.transform(r, lambda v, j: v + F.when((i == j) & (i > 0), penalty).otherwise(F.lit(0.0))))
    diagonal = F.transform(rows, lambda r, i: F.element_at(r, i + 1))

    def swept(state: Column, p: Column) -> Column:
        pivot = state["m"][p][p]
        row = F.when(pivot > F.lit(SINGULAR) * state["d"][p], F.transform(state["m"][p], lambda v: v / pivot)).otherwise(F.transform(state["m"][p], lambda v: F.lit(0.0)))
        of = lambda row: F.transform(state["m"], lambda r, i: F.when(i == p, row).otherwise(F.zip_with(r, row, lambda a, b: a - r[p] * b)))
        return F.struct(_let(row, of).alias("m"), state["d"].alias("d"))

    start = F.struct(rows.alias("m"), diagonal.alias("d"))
    order = F.array(*[F.lit(i) for i in range(size)])
    return F.aggregate(order, start, swept, lambda s: F.transform(s["m"], lambda r: r[size]))


def fit_glm(
    cells: DataFrame, features: Sequence[str], keys: Sequence[str], family: str, target: str = "target", weight: str = "todu_amt_pile_h6", strength: Column | float = 0.0, power: float = 1.5, steps: int = STEPS
) -> DataFrame:
    """keys, feature, coefficient, n_cells: one weighted model per key as rows, the intercept as ``(intercept)``.

    Families: ``gaussian`` (identity), ``tweedie`` (log link, variance that grows with ``power``), ``logistic`` (target 0 or 1). ``strength``, a number or a
    column that is constant within a key, penalises the squares of the slopes, times the key's weight for the last two. A key's cells are gathered in one row, as many as
    its grid has; rows without target, features or a positive weight take no part, and a key without any has no model. A feature that others determine gets 0; null keys get a model, but `predict_glm` finds none for them.
    """
    if family not in FAMILIES:
        raise ValueError(f"unknown family: {family}")
    k, xs = len(features) + 1, [f"__x{i}" for i in range(len(features))]
    of = strength if isinstance(strength, Column) else F.lit(float(strength))
    c = cells.select(*keys, F.col(target).cast("double").alias("__y"), F.col(weight).cast("double").alias("__w"), of.cast("double").alias("__s"), *[F.col(f).cast("double").alias(x) for f, x in zip(features, xs, strict=True)])
    c = c.na.drop(subset=["__y", "__w", *xs]).where("__w > 0")
    cell = F.struct(F.array(F.lit(1.0), *xs).alias("x"), F.col("__y").alias("y"), F.col("__w").alias("w"))
    # In order, so that sums don't depend on the order of arrival.
    g = c.groupBy(*keys).agg(F.array_sort(F.collect_list(cell)).alias("__c"), F.sum("__w").alias("__n"), (F.sum(F.col("__w") * F.col("__y")) / F.sum("__w")).alias("__m"), F.max("__s").alias("__s"), F.count("*").alias("n_cells"))
    penalty = F.col("__s") if family == "gaussian" else F.col("__s") * F.col("__n")
    first = F.log(F.greatest(F.col("__m"), F.lit(LEAST))) if family == "tweedie" else F.lit(0.0)
    zeros = F.array_repeat(F.array_repeat(F.lit(0.0), k + 1), k)

    def step(b: Column, _: Column) -> Column:
        def add(rows: Column, r: Column) -> Column:
            eta = F.aggregate(F.zip_with(b, r["x"], lambda u, v: u * v), F.lit(0.0), lambda u, v: u + v)

            def at(e: Column) -> Column:
                z, w = _working(family, power, e, r["y"], r["w"])
                side = F.concat(r["x"], F.array(z))
                return F.zip_with(rows, r["x"], lambda row, v: F.zip_with(row, side, lambda s, t: s + w * v * t))

            return _let(eta, at)

        return _solved(F.aggregate("__c", zeros, add), k, penalty)

    start = F.array(first, *[F.lit(0.0)] * (k - 1))
    g = g.withColumn("__b", F.aggregate(F.sequence(F.lit(1), F.lit(1 if family == "gaussian" else steps)), start, step))
    rows = [F.struct(F.lit(name).alias("feature"), F.col("__b")[i].alias("coefficient")) for i, name in enumerate([INTERCEPT, *features])]
    return g.select(*keys, "n_cells", F.inline(F.array(*rows)))


def predict_glm(df: DataFrame, models: DataFrame, keys: Sequence[str], features: Sequence[str], family: str, name: str = "prediction") -> DataFrame:
    """``df`` with the mean that its key's model gives; null without a model."""
    return predict_keyed(df, models, keys, features, name).withColumn(name, mean_of(F.col(name), family))


def hurdle_glm(cells: DataFrame, features: Sequence[str], keys: Sequence[str], target: str = "target", weight: str = "todu_amt_pile_h6", strength: float = 1e-3, ridge: float = 1.0) -> DataFrame:
    """``cells`` with probability, size and prediction, of every key at once: the probability of a target above 0 times its size where it is, never below 0.

    The probability is a logistic model of all cells of the key, or their share if all or none are above 0; the size a least-squares model of those
    above 0. Cells without a target take no part in the fit and are predicted; keys without any target have nulls.
    """
    c = cells.withColumn("__nz", F.when(F.col(target) > 0, 1.0).when(F.col(target).isNotNull(), 0.0))
    share = c.groupBy(*keys).agg(F.avg("__nz").alias("__share"))
    size = fit_keyed(c.where("__nz = 1"), features, keys, target, weight, ridge)
    some = c.join(share.where("__share > 0 AND __share < 1"), list(keys), "left_semi")
    out = predict_glm(c, fit_glm(some, features, keys, "logistic", "__nz", weight, strength), keys, features, "logistic", "probability")
    out = predict_keyed(out, size, keys, features, "size").join(share, list(keys), "left")
    out = out.withColumns({"probability": F.coalesce("probability", "__share"), "size": F.when(F.col("__share").isNotNull(), F.greatest(F.coalesce("size", F.lit(0.0)), F.lit(0.0)))})
    return out.withColumn("prediction", F.col("probability") * F.col("size")).drop("__nz", "__share")


#: The points that ``glm_search`` compares: family as named in its result, family of the fit, strengths.
GLM_GRID: Sequence[tuple[str, str, Sequence[float]]] = (("linear", "gaussian", (0.0,)), ("ridge", "gaussian", (0.01, 0.1, 1.0, 10.0)), ("tweedie", "tweedie", (0.0, 0.01, 0.1, 1.0)))


def glm_cv(folds: DataFrame, features: Sequence[str], grid: Sequence[tuple[str, str, Sequence[float]]] = GLM_GRID) -> DataFrame:
    """name, family, fold, features, vt, validation, prediction: every point of the grid in every fold (as ``fold_cells`` gives them), a keyed fit a family."""
    out = None
    for family in dict.fromkeys(kind for _, kind, _ in grid):
        points = [(f"{name} {s:g}", name, float(s)) for name, kind, strengths in grid if kind == family for s in strengths]
        named = folds.sparkSession.createDataFrame(points, "name string, family string, strength double")
        f = folds.crossJoin(F.broadcast(named))  # as many rows as the grid has points
        models = fit_glm(f, features, ["name", "fold"], family, strength=F.col("strength"))
        p = predict_glm(f, models, ["name", "fold"], features, family).select("name", "family", "fold", *features, "vt", "validation", "prediction")
        out = p if out is None else out.unionByName(p)
    return out


def glm_search(folds: DataFrame, fresh: DataFrame, features: Sequence[str], grid: Sequence[tuple[str, str, Sequence[float]]] = GLM_GRID) -> DataFrame:
    """family, name, mean, se, fresh_mean, fresh_se: the best point of each family on ``folds``, ties by name, scored again on ``fresh``, dealt otherwise.

    No record is read for a point: folds are cells, train sums are total minus fold.
    """
    family = {f"{name} {s:g}": name for name, _, strengths in grid for s in strengths}
    named: Mapping[str, str] = family
    kinds = folds.sparkSession.createDataFrame(list(named.items()), "name string, family string")
    of = lambda f: cv_results(fold_scores(glm_cv(f, features, grid)))
    best = Window.partitionBy("family").orderBy(F.round("mean", 9), "name")  # as many rows as a family has points
    first = of(folds).join(F.broadcast(kinds), "name").withColumn("k", F.row_number().over(best)).where("k = 1")
    again = of(fresh).select("name", F.col("mean").alias("fresh_mean"), F.col("se").alias("fresh_se"))
    return first.join(again, "name").select("family", "name", "mean", "se", "fresh_mean", "fresh_se")
