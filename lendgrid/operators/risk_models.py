"""Risk and exposure models on cells and records, fitted by Spark."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression, LinearRegression
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import bin_right_closed, hash_fraction, money_sum, risk_ratio
from ..sources.shared import written
from .cells import CELL
from .population import poly_features
from .quality import long_numbers
from .quantiles import value_bin

_X, _Y = CELL
_BASE = [_Y, _X, f"{_X}_x_{_Y}"]
_SQUARED, _CUBIC, _MIXED = [f"{_Y}_2", f"{_X}_2"], [f"{_Y}_3", f"{_X}_3"], [f"{_X}_2_x_{_Y}", f"{_X}_x_{_Y}_2"]
#: Fixed names of the feature sets that are compared.
FEATURE_SETS: Mapping[str, Sequence[str]] = {
    "original": [_X, _Y], "simple": [_Y, _X], "base": _BASE, "base + squared": [*_BASE, *_SQUARED], "base + cubic": [*_BASE, *_CUBIC],
    "base + all_poly": [*_BASE, *_SQUARED, *_CUBIC], "base + interactions": [*_BASE, *_MIXED], "full": [*_BASE, *_SQUARED, *_CUBIC, *_MIXED],
}
#: The grid that ``hyperparameter_search`` goes over: family, strengths, shares of the L1 penalty.
GRID: Sequence[tuple[str, Sequence[float], Sequence[float]]] = (
    ("linear", (0.0,), (0.0,)), ("ridge", (0.01, 0.1, 1.0, 10.0), (0.0,)), ("lasso", (0.001, 0.01, 0.1, 1.0), (1.0,)),
    ("elastic_net", (0.001, 0.01, 0.1, 1.0), (0.1, 0.5, 0.9)), ("tweedie", (0.0, 0.01, 0.1, 1.0), (0.0,)),
)


def exposure_model(cells: DataFrame, x: str = "oa_amt_h0", y: str = "todu_amt_pile_h6", limit: float = 3.0) -> DataFrame:
    """slope, intercept, r2, loo_r2, n: least squares of exposure on amount over cells, outlying cells left out.

    Outlying: absolute z of either at ``limit`` or more (population deviation). Leave-one-out residuals are e / (1 - h).
    """
    z = cells.select(F.col(x).alias("x"), F.col(y).alias("y")).na.drop()
    m = z.agg(F.avg("x").alias("mx"), F.stddev_pop("x").alias("sx"), F.avg("y").alias("my"), F.stddev_pop("y").alias("sy"))
    near = lambda v: (F.col(f"s{v}") == 0) | (F.abs(F.col(v) - F.col(f"m{v}")) < F.lit(limit) * F.col(f"s{v}"))
    k = z.crossJoin(F.broadcast(m)).where(near("x") & near("y")).select("x", "y")
    fit = k.agg(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"), F.regr_r2("y", "x").alias("r2"), F.avg("x").alias("ax"), F.avg("y").alias("ay"), F.regr_sxx("y", "x").alias("sxx"), F.count("*").alias("n"))
    e = F.col("y") - F.col("intercept") - F.col("slope") * F.col("x")
    h = F.lit(1.0) / F.col("n") + (F.col("x") - F.col("ax")) * (F.col("x") - F.col("ax")) / F.col("sxx")
    loo = k.crossJoin(F.broadcast(fit)).groupBy("slope", "intercept", "r2", "n").agg(F.sum(F.pow(e / (1 - h), F.lit(2.0))).alias("press"), F.sum(F.pow(F.col("y") - F.col("ay"), F.lit(2.0))).alias("sst"))
    return loo.select("slope", "intercept", "r2", (1 - F.col("press") / F.col("sst")).alias("loo_r2"), "n")


def _assembled(features: Sequence[str], estimator, prediction: str | None = None) -> Pipeline:
    estimator = estimator.setFeaturesCol("features")
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), estimator.setPredictionCol(prediction) if prediction else estimator])


def linear_risk_model(cells: DataFrame, features: Sequence[str], kind: str = "linear", strength: float = 0.0, l1: float = 0.0, target: str = "target", weight: str = "todu_amt_pile_h6") -> PipelineModel:
    """Exposure-weighted linear, ridge, lasso or elastic net with the penalties of the usual single-machine scaling.

    The L2 penalty of Spark is relative to the label's weighted deviation, hence the factor.
    """
    s = cells.agg(F.sum(weight).alias("w"), F.sum(F.col(weight) * F.col(target)).alias("wy"), F.sum(F.col(weight) * F.col(target) * F.col(target)).alias("wyy")).first()
    sd = max((s.wyy / s.w - (s.wy / s.w) ** 2), 0.0) ** 0.5
    reg, mix = {"linear": (0.0, 0.0), "ridge": (strength * sd / s.w, 0.0), "lasso": (strength, 1.0)}.get(kind, (strength * (l1 + (1 - l1) * sd), 0.0))
    if kind == "elastic_net" and reg:
        mix = strength * l1 / reg
    lr = LinearRegression(labelCol=target, weightCol=weight, regParam=reg, elasticNetParam=mix, standardization=False, solver="normal" if mix == 0 else "auto")
    return _assembled(features, lr).fit(cells)


def linear_score(intercept: float, coefficients: Sequence[float], columns: Sequence[Column | str]) -> Column:
    """The linear score of a fitted model from its numbers.

    A logistic model's own transform ships its training summary, and with it the session, to the tasks;
    that fails as soon as the session has observed a query.
    """
    return sum((F.lit(float(b)) * (F.col(c) if isinstance(c, str) else c) for b, c in zip(coefficients, columns)), F.lit(float(intercept)))


def tweedie_model(cells: DataFrame, features: Sequence[str], power: float = 1.5, target: str = "target", weight: str = "todu_amt_pile_h6") -> PipelineModel:
    """Tweedie regression with log link."""
    g = GeneralizedLinearRegression(labelCol=target, weightCol=weight, family="tweedie", variancePower=power, linkPower=0.0, regParam=1e-6)
    return _assembled(features, g).fit(cells)


def hurdle_predictions(cells: DataFrame, features: Sequence[str], target: str = "target", weight: str = "todu_amt_pile_h6") -> DataFrame:
    """prediction = probability of a nonzero target x its size if nonzero; one class only: its share as probability."""
    c = cells.withColumn("__nz", F.when(F.col(target) > 0, 1.0).otherwise(0.0))
    share = c.agg(F.avg("__nz")).first()[0]
    size = _assembled(features, LinearRegression(labelCol=target, weightCol=weight, solver="normal", regParam=1e-6), "__size").fit(c.where("__nz = 1"))
    out = size.transform(c).drop("features")
    if 0 < share < 1:
        p = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), LogisticRegression(labelCol="__nz", weightCol=weight, featuresCol="features", regParam=1e-3)]).fit(out).stages[-1]
        out = out.withColumn("__prob", 1 / (1 + F.exp(-linear_score(p.intercept, p.coefficients, features))))
    else:
        out = out.withColumn("__prob", F.lit(float(share or 0.0)))
    return out.withColumn("prediction", F.col("__prob") * F.greatest("__size", F.lit(0.0))).drop("__prob", "__size", "__nz")


def monotone_tree_surface(cells: DataFrame, target: str = "target", weight: str = "todu_amt_pile_h6", v0: str = CELL[0], v1: str = CELL[1], v0_low_is_safe: bool = False) -> DataFrame:
    """Boosted trees, then running maxima along both axes from safe to risky, so risk never falls towards risk."""
    t = _assembled([v0, v1], GBTRegressor(labelCol=target, weightCol=weight, maxIter=20, maxDepth=3, seed=7), "prediction").fit(cells).transform(cells).drop("features")
    along = Window.partitionBy(v0).orderBy(v1)
    t = t.withColumn("prediction", F.max("prediction").over(along))
    across = Window.partitionBy(v1).orderBy(F.col(v0) if v0_low_is_safe else F.desc(v0))
    return t.withColumn("prediction", F.max("prediction").over(across))


def fold_cells(records: DataFrame, k: int = 5, seed: int = 17, keys: Sequence[str] = CELL, ident: str = "authorization_id") -> DataFrame:
    """fold, cell, train and validation sums: records are dealt to folds by hash, train is total minus fold.

    One aggregation serves all folds, feature sets and models.
    """
    fold = F.floor(hash_fraction(F.lit(seed), F.col(ident)) * k).cast("int")
    f = records.groupBy(fold.alias("fold"), *keys).agg(money_sum("todu_30ever_h6").alias("va"), money_sum("todu_amt_pile_h6").alias("vt"))
    cells = f.groupBy(*keys).agg(money_sum("va").alias("a"), money_sum("vt").alias("t"))
    folds = records.sparkSession.range(k).select(F.col("id").cast("int").alias("fold"))
    g = cells.crossJoin(F.broadcast(folds)).join(f, ["fold", *keys], "left").na.fill(0.0, ["va", "vt"])
    ratio = lambda a, b: risk_ratio(a, b, decimals=None)
    return g.select("fold", *keys, "vt", ratio(F.col("va"), F.col("vt")).alias("validation"), (F.col("t") - F.col("vt")).alias("todu_amt_pile_h6"), ratio(F.col("a") - F.col("va"), F.col("t") - F.col("vt")).alias("target"))


def fit_cells(kind: str, x: np.ndarray, y: np.ndarray, w: np.ndarray, strength: float = 0.0, l1: float = 0.0, power: float = 1.5) -> tuple[float, np.ndarray]:
    """Intercept and coefficients of one weighted model of a grid's cells; the intercept is never penalised.

    Ridge adds strength * |b|^2 to the weighted squares; lasso and elastic net penalise half their weighted mean; tweedie
    has a log link and a variance that grows with ``power``.
    """
    if kind == "tweedie":
        b = np.append(np.log(max(np.average(y, weights=w), 1e-12)), np.zeros(x.shape[1]))
        full, penalty = np.column_stack([np.ones(len(x)), x]), np.diag([1e-9, *[strength * w.sum() + 1e-9] * x.shape[1]])
        for _ in range(100):
            eta = np.clip(full @ b, -30, 30)
            mu = np.exp(eta)
            v = w * mu ** (2 - power)
            new = np.linalg.solve(full.T @ (v[:, None] * full) + penalty, full.T @ (v * (eta + (y - mu) / mu)))
            if np.abs(new - b).max() < 1e-10:
                break
            b = new
        return float(b[0]), b[1:]
    mx, my = np.average(x, axis=0, weights=w), float(np.average(y, weights=w))
    c, r = x - mx, y - my
    if kind in ("linear", "ridge"):
        gram = c.T @ (w[:, None] * c)
        b = np.linalg.lstsq(gram + strength * np.eye(len(gram)), c.T @ (w * r), rcond=1e-12)[0]
    else:
        v, b = w / w.sum(), np.zeros(x.shape[1])
        square, left = (v[:, None] * c * c).sum(axis=0), r.copy()
        for _ in range(20_000):
            most = 0.0
            for j in np.flatnonzero(square > 0):
                rho = (v * c[:, j] * left).sum() + square[j] * b[j]
                new = np.sign(rho) * max(abs(rho) - strength * l1, 0.0) / (square[j] + strength * (1 - l1))
                left += c[:, j] * (b[j] - new)
                most, b[j] = max(most, abs(new - b[j])), new
            if most < 1e-10:
                break
    return my - float(mx @ b), b


def grid_cv(folds: DataFrame, models: Sequence[tuple], least_cells: int = 3) -> DataFrame:
    """name, fold, cell, vt, validation, prediction of every model in every fold, in one grouped job.

    ``models``: (name, kind, features, strength, l1). A group is one model and fold with the cells of the grid;
    cells without a training target count for prediction only; folds with under ``least_cells`` training cells have no rows.
    """
    import pandas as pd

    every = list(dict.fromkeys(f for m in models for f in m[2]))
    spec = {m[0]: (m[1], [every.index(f) for f in m[2]], float(m[3]), float(m[4])) for m in models}
    named = folds.sparkSession.createDataFrame([(m[0],) for m in models], "name string")
    f = poly_features(folds, *CELL).crossJoin(F.broadcast(named))
    f = f.select("name", "fold", *CELL, "vt", "validation", "target", F.col("todu_amt_pile_h6").alias("w"), F.array(*[F.col(c).cast("double") for c in every]).alias("x"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        kind, own, strength, l1 = spec[pdf["name"].iloc[0]]
        pdf = pdf.sort_values(list(CELL), kind="stable")
        x, y, w = np.stack(pdf["x"].to_numpy())[:, own], pdf["target"].to_numpy(float), pdf["w"].to_numpy(float)
        train = np.isfinite(y) & (w > 0)
        out = pdf[["name", "fold", *CELL, "vt", "validation"]]
        if train.sum() < least_cells:
            return out.iloc[:0].assign(prediction=pd.Series(dtype=float))
        a, b = fit_cells(kind, x[train], y[train], w[train], strength, l1)
        return out.assign(prediction=np.exp(np.clip(a + x @ b, -30, 30)) if kind == "tweedie" else a + x @ b)

    cells = ", ".join(f"{c} int" for c in CELL)
    return f.groupBy("name", "fold").applyInPandas(fit, f"name string, fold int, {cells}, vt double, validation double, prediction double")


def fold_scores(predictions: DataFrame) -> DataFrame:
    """name, fold, rmse: the error of each fold's validation cells, weighted by their exposure."""
    e = F.col("prediction") - F.col("validation")
    return predictions.where("validation IS NOT NULL").groupBy("name", "fold").agg(F.sqrt(F.sum(F.col("vt") * e * e) / F.sum("vt")).alias("rmse"))


def cv_results(scores: DataFrame) -> DataFrame:
    """name, mean, se over folds."""
    return scores.groupBy("name").agg(F.avg("rmse").alias("mean"), (F.stddev_samp("rmse") / F.sqrt(F.count("*"))).alias("se"))


def grid_models(features: Sequence[str], grid: Sequence[tuple[str, Sequence[float], Sequence[float]]] = GRID) -> list[tuple]:
    """(name, kind, features, strength, l1) for every point of the grid."""
    return [(f"{kind} {s:g}" + (f" {x:g}" if kind == "elastic_net" else ""), kind, list(features), s, x) for kind, strengths, shares in grid for s in strengths for x in shares]


def hyperparameter_search(records: DataFrame, k: int, features: Sequence[str], grid: Sequence[tuple[str, Sequence[float], Sequence[float]]] = GRID, seed: int = 17, fresh_seed: int = 18) -> DataFrame:
    """family, name, mean, se, fresh_mean, fresh_se: the best point of each family, scored again on folds dealt by another seed.

    The choice is made on the first folds, so the fresh scores aren't favoured by it.
    """
    models = grid_models(features, grid)
    kinds = records.sparkSession.createDataFrame([(m[0], m[1]) for m in models], "name string, family string")
    of = lambda s: cv_results(fold_scores(grid_cv(fold_cells(records, k, s), models)))
    first = of(seed).join(F.broadcast(kinds), "name")
    best = first.withColumn("k", F.row_number().over(Window.partitionBy("family").orderBy("mean", "name"))).where("k = 1")
    fresh = of(fresh_seed).select("name", F.col("mean").alias("fresh_mean"), F.col("se").alias("fresh_se"))
    return best.join(fresh, "name").select("family", "name", "mean", "se", "fresh_mean", "fresh_se")


def feature_set_cv(folds: DataFrame, sets: Mapping[str, Sequence[str]] = FEATURE_SETS) -> DataFrame:
    """name, complexity (number of features), mean, se of a linear model for each named feature set."""
    models = [(name, "linear", list(features), 0.0, 0.0) for name, features in sets.items()]
    size = folds.sparkSession.createDataFrame([(name, len(features)) for name, features in sets.items()], "name string, complexity int")
    return cv_results(fold_scores(grid_cv(folds, models))).join(F.broadcast(size), "name").select("name", "complexity", "mean", "se")


def weighted_r2(predictions: DataFrame, keys: Sequence[str] = (), target: str = "target", weight: str = "todu_amt_pile_h6") -> DataFrame:
    """keys, r2: one less the weighted squared error over the weighted squares around the weighted mean; null under two cells and where all targets are equal."""
    w, y, e = F.col(weight), F.col(target), F.col(target) - F.col("prediction")
    g = predictions.groupBy(*keys).agg(F.sum(w).alias("sw"), F.sum(w * y).alias("swy"), F.sum(w * y * y).alias("swyy"), F.sum(w * e * e).alias("see"), F.count("*").alias("n"), (F.min(y) < F.max(y)).alias("varied"))
    around = F.col("swyy") - F.col("swy") * F.col("swy") / F.col("sw")
    return g.select(*keys, F.when((F.col("n") >= 2) & F.col("varied") & (around > 0), 1 - F.col("see") / around).alias("r2"))


def one_se_select(results: DataFrame) -> DataFrame:
    """Of the results within one standard error of the best mean the simplest, then the better, then by name."""
    best = results.orderBy("mean", "complexity", "name").limit(1).select((F.col("mean") + F.coalesce("se", F.lit(0.0))).alias("bar"))
    return results.crossJoin(F.broadcast(best)).where("mean <= bar").orderBy("complexity", "mean", "name").limit(1).drop("bar")


def cell_prediction_ci(predictions: DataFrame, keys: Sequence[str] = CELL, z: float = 1.96) -> DataFrame:
    """Per cell mean and deviation of the folds' predictions, with a normal interval; under two folds none."""
    p = predictions.groupBy(*keys).agg(F.avg("prediction").alias("mean"), F.stddev_samp("prediction").alias("std"), F.count("*").alias("n_folds"))
    half = F.when(F.col("n_folds") >= 2, F.lit(z) * F.col("std"))
    return p.withColumn("low", F.col("mean") - half).withColumn("high", F.col("mean") + half)


def linear_attribution(cells: DataFrame, coefficients: Mapping[str, float]) -> DataFrame:
    """feature, mean_abs: mean absolute exact contribution of each feature of a linear model."""
    means = cells.agg(*[F.avg(f).alias(f"m_{f}") for f in coefficients])
    c = cells.crossJoin(F.broadcast(means))
    one = c.agg(*[F.avg(F.abs(F.lit(float(b)) * (F.col(f) - F.col(f"m_{f}")))).alias(f) for f, b in coefficients.items()])
    return one.select(F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("mean_abs")) for f in coefficients])))


def supervised_bins(df: DataFrame, x: str, y: str, leaves: int = 5, least_leaf: int = 500) -> list[float]:
    """Inner edges of at most ``leaves`` bins of x, split where the Gini impurity of the 0/1 column y falls most.

    Each step splits, of all bins, the one that gains most, at the middle between two values, with ``least_leaf`` rows
    or more on both sides; ties go to the lower edge. Rows are first counted per distinct value, so that a step is one pass
    over these counts; a bin's counts are cumulated in one window, so x is meant to be a score, not an id.
    """
    counts = written(df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(x).cast("double").alias("x")).agg(F.count("*").alias("n"), F.sum(F.col(y).cast("long")).alias("bad")))
    edges: list[float] = []
    for _ in range(leaves - 1):
        c = counts.withColumn("leaf", bin_right_closed(F.col("x"), edges))
        up, whole = Window.partitionBy("leaf").orderBy("x"), Window.partitionBy("leaf")
        c = c.select("x", F.lead("x").over(up).alias("next"), *[F.sum(v).over(up).alias(f"{v}_l") for v in ("n", "bad")], *[F.sum(v).over(whole).alias(f"{v}_t") for v in ("n", "bad")])
        c = c.withColumns({"n_r": F.col("n_t") - F.col("n_l"), "bad_r": F.col("bad_t") - F.col("bad_l")}).where(f"next IS NOT NULL AND n_l >= {int(least_leaf)} AND n_r >= {int(least_leaf)}")
        rest = lambda s: F.col(f"bad_{s}") - F.col(f"bad_{s}").cast("double") * F.col(f"bad_{s}") / F.col(f"n_{s}")
        edge = ((F.col("x") + F.col("next")) / 2).alias("edge")
        best = c.select(edge, F.round(rest("t") - rest("l") - rest("r"), 9).alias("gain")).where("gain > 0").orderBy(F.desc("gain"), "edge").first()
        if best is None:
            break
        edges = sorted([*edges, best.edge])
    return edges


def supervised_bins_of(df: DataFrame, columns: Sequence[str], y: str, leaves: int = 5, least_leaf: int = 500) -> DataFrame:
    """variable, edges: inner edges of at most ``leaves`` bins of each column, all columns at once, split as ``supervised_bins`` does.

    Records are read once, into a histogram of each column on the fixed grid of ``quantiles.value_bin``; each of the ``leaves`` - 1 rounds is one job over the histograms
    that splits the best leaf of every variable. Splits lie between bins of the grid, so they are those of the values themselves where these have
    up to ten significant bits, and within a thousandth of them otherwise. Columns without a split have an empty list.
    """
    target = F.col(y).cast("long").alias("__y")
    x = long_numbers(df.where(F.col(y).isNotNull()).select(target, *columns), columns, "__y").where("NOT isnan(x)")
    hist = written(x.groupBy("variable", value_bin(F.col("x")).alias("bin")).agg(F.count("*").alias("n"), F.sum("__y").alias("bad"), F.min("x").alias("lo"), F.max("x").alias("hi")))
    edges = df.sparkSession.createDataFrame([(c, []) for c in columns], "variable string, edges array<double>")
    for _ in range(leaves - 1):
        c = hist.join(edges, "variable").withColumn("leaf", F.size(F.filter("edges", lambda e: e < F.col("lo"))))
        up, whole = Window.partitionBy("variable", "leaf").orderBy("bin"), Window.partitionBy("variable", "leaf")  # rows are bins
        c = c.select("variable", "hi", F.lead("lo").over(up).alias("next"), *[F.sum(v).over(up).alias(f"{v}_l") for v in ("n", "bad")], *[F.sum(v).over(whole).alias(f"{v}_t") for v in ("n", "bad")])
        c = c.withColumns({"n_r": F.col("n_t") - F.col("n_l"), "bad_r": F.col("bad_t") - F.col("bad_l")}).where(f"next IS NOT NULL AND n_l >= {int(least_leaf)} AND n_r >= {int(least_leaf)}")
        rest = lambda s: F.col(f"bad_{s}") - F.col(f"bad_{s}").cast("double") * F.col(f"bad_{s}") / F.col(f"n_{s}")
        split = F.struct(F.round(rest("t") - rest("l") - rest("r"), 9).alias("gain"), (-(F.col("hi") + F.col("next")) / 2).alias("minus"))
        best = c.select("variable", split.alias("split")).where("split.gain > 0").groupBy("variable").agg(F.max("split").alias("split"))
        grown = F.when(F.col("split").isNull(), F.col("edges")).otherwise(F.array_sort(F.concat("edges", F.array(-F.col("split.minus")))))
        edges = written(edges.join(best, "variable", "left").select("variable", grown.alias("edges")))
    return edges


def combined_score(df: DataFrame, columns: Sequence[str], y: str) -> DataFrame:
    """Standardise, fit a logistic regression and return the linear score beside the columns."""
    n = df.count()
    stages = [
        VectorAssembler(inputCols=list(columns), outputCol="__raw"), StandardScaler(inputCol="__raw", outputCol="__std", withMean=True, withStd=True),
        LogisticRegression(featuresCol="__std", labelCol=y, regParam=1.0 / max(n, 1), standardization=False, tol=1e-10, maxIter=200),
    ]
    _, scale, fit = Pipeline(stages=stages).fit(df).stages  # the penalty is strength 1 on the sum of losses
    standard = [(F.col(c) - F.lit(float(m))) * F.lit(1 / float(s) if s else 0.0) for c, m, s in zip(columns, scale.mean, scale.std)]
    return df.withColumn("combined", linear_score(fit.intercept, fit.coefficients, standard))


def save_model(model: PipelineModel, path: str, features: Sequence[str], **metadata: str) -> None:
    """The fitted pipeline, and beside it one row of metadata."""
    from pyspark.sql import SparkSession

    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.active()
    spark.createDataFrame([(list(features), {k: str(v) for k, v in metadata.items()})], "features array<string>, metadata map<string, string>").write.mode("overwrite").parquet(f"{path}/metadata")


def batch_score(path: str, df: DataFrame) -> DataFrame:
    """Load a saved model, check that its features are there, and predict."""
    wanted = df.sparkSession.read.parquet(f"{path}/metadata").first().features
    missing = [f for f in wanted if f not in df.columns]
    if missing:
        raise ValueError(f"missing features: {missing}")
    return PipelineModel.load(f"{path}/model").transform(df).drop("features")
