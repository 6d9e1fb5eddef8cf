"""Stored sketches: merged over periods, their error, and the statuses they give."""

import numpy as np
from pyspark.sql import functions as F

from lendgrid.operators import sketches as sk, stability
from lendgrid.operators.quantiles import value_bin

MONTHS = [f"2024-{m:02d}-01" for m in range(1, 7)]


def records(spark, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for m, month in enumerate(MONTHS):
        for _ in range(1500):
            rows.append((month, float(np.round(rng.lognormal(8 + 0.08 * m, 1.5), 2)), float(rng.integers(300, 500)), float(rng.normal(0, 1 + 0.25 * m))))
    rows.append((MONTHS[0], None, float("nan"), None))
    return spark.createDataFrame(rows, "mis_date string, amount double, score double, z double").withColumn("mis_date", F.col("mis_date").cast("date"))


def test_bins_are_monotone_and_narrow(spark):
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.normal(size=500) * 10.0 ** rng.integers(-20, 20, 500), 2.0 ** np.arange(-50, 50), np.nextafter(2.0 ** np.arange(-50, 50), 0), [0.0, 5e-324, 1.7e308, -1.7e308]])
    got = sorted((r.x, r.b) for r in spark.createDataFrame([(float(x),) for x in v], "x double").select("x", value_bin(F.col("x")).alias("b")).collect())
    assert all(b <= c for (_, b), (_, c) in zip(got, got[1:], strict=False))
    assert all(abs(x - y) <= 2.0**-10 * min(abs(x), abs(y)) for (x, b), (y, c) in zip(got, got[1:], strict=False) if b == c)


def test_merged_sketches_and_their_error(spark, tmp_path):
    df, path = records(spark), str(tmp_path / "s")
    for month in MONTHS:
        sk.write_sketches(sk.sketch(df.where(F.col("mis_date") == month), ["amount", "score", "z"]), path)
    sk.write_sketches(sk.sketch(df.where(F.col("mis_date") == MONTHS[2]), ["amount", "score", "z"]), path)  # a month that is written again replaces itself
    s = sk.read_sketches(spark, path)
    assert s.select("period").distinct().count() == 6 and sk.read_sketches(spark, path, MONTHS[1], MONTHS[2]).select("period").distinct().count() == 2
    whole = sk.merged(sk.sketch(df.withColumn("mis_date", F.lit("2024-01-01").cast("date")), ["amount", "score", "z"]))
    assert sorted(map(tuple, sk.merged(s).collect())) == sorted(map(tuple, whole.collect()))
    p = [0.0, 0.01, 0.3, 0.5, 0.99, 1.0]
    got = {r.variable: r.quantiles for r in sk.sketch_quantiles(sk.merged(s), p).collect()}
    for name in ("amount", "score", "z"):
        v = np.sort(np.array([r[0] for r in df.select(name).collect() if r[0] is not None and r[0] == r[0]]))
        for q, g in zip(p, got[name], strict=True):
            true = v[max(int(np.ceil(q * len(v))) - 1, 0)]
            assert true <= g <= true + 2.0**-10 * abs(true) and (name != "score" or g == true)


def test_statuses_are_those_of_the_records(spark):
    df, names = records(spark), ["amount", "score", "z"]
    got = {(r.variable, str(r.period)): (r.psi, r.status) for r in sk.psi_from_sketches(sk.sketch(df, names), (MONTHS[0], MONTHS[1]), (MONTHS[2], MONTHS[5])).collect()}
    base = df.where(F.col("mis_date") <= MONTHS[1])
    for month in MONTHS[2:]:
        for r in stability.stability_report(base, df.where(F.col("mis_date") == month), names).collect():
            psi, status = got[r.variable, month]
            assert status == r.status and abs(psi - r.psi) < 0.01
    assert len(got) == 12 and len({s for _, s in got.values()}) >= 2
    assert sk.psi_from_sketches(sk.sketch(df, names), (MONTHS[0], MONTHS[1]), ("2030-01-01", "2030-02-01")).count() == 0
