"""Exact quantiles by refining histograms against NumPy."""

import numpy as np
import pytest

from lendgrid.operators import quantiles as qt

P = [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0]


def cases():
    rng = np.random.default_rng(4)
    return {
        "normal": rng.normal(size=3000), "money": np.round(rng.lognormal(8, 3, 3000), 2), "scores": rng.integers(300, 500, 4000).astype(float),
        "wide": np.concatenate([10.0 ** rng.uniform(-300, 300, 500), -(10.0 ** rng.uniform(-300, 300, 500)), [0.0, -0.0]]),
        "close": 1.0 + rng.integers(0, 4000, 3000) * 2.0**-52, "powers": 2.0 ** rng.integers(-1074, 1024, 800), "below powers": np.nextafter(2.0 ** rng.integers(-1000, 1023, 800), 0),
        "same": np.full(50, 7.25), "one": np.array([3.0]), "two": np.array([-1.0, 4.0]), "extremes": np.array([-1.7e308, 1.7e308, 5e-324, -5e-324] * 5),
    }


@pytest.mark.parametrize("held", [0, 1 << 16])
def test_against_numpy(spark, monkeypatch, held):
    monkeypatch.setattr(qt, "HELD", held)
    data = cases()
    rows = [(k, float(x)) for k, v in data.items() for x in v] + [("normal", None), ("normal", float("nan")), ("nothing", None)] + [(None, float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    got = {r.k: r.quantiles for r in qt.exact_quantiles(df, "x", P, ["k"]).collect()}
    assert set(got) == {*data, None}
    data[None] = np.arange(10.0)
    for k, v in data.items():
        s = np.sort(v)
        for p, g in zip(P, got[k], strict=True):
            at = p * (len(s) - 1)
            lo, hi = int(np.floor(at)), int(np.ceil(at))
            want = s[lo] if lo == hi else (hi - at) * s[lo] + (at - lo) * s[hi]
            assert g == want, (k, p)


@pytest.mark.parametrize("bins", [2, 64])
def test_few_bins(spark, monkeypatch, bins):
    """However coarse a pass, ranks are found; only the number of passes grows."""
    monkeypatch.setattr(qt, "PER_BINADE", bins)
    monkeypatch.setattr(qt, "BINS", bins)
    monkeypatch.setattr(qt, "HELD", 0)
    v = np.random.default_rng(8).uniform(0, 1, 400)
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    assert qt.exact_quantiles(df, "x", [0.5]).first()[0][0] == np.median(v)


def test_no_values(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert qt.exact_quantiles(df, "x", [0.5]).count() == 0 and qt.exact_quantiles(df.where("false"), "x", [0.5]).count() == 0
