"""Resampled sums against draws written out one by one."""

import hashlib
from collections import defaultdict

import numpy as np

from lendgrid.operators import resampling as rs

MASK = (1 << 64) - 1


def weight(seed, ident, b):
    z = int(hashlib.md5(f"{seed}|{ident}".encode()).hexdigest()[:15], 16) + (b + 1) // 2 * rs.STEP & MASK
    z = (z ^ z >> 30) * rs.FACTORS[0] & MASK
    z = (z ^ z >> 27) * rs.FACTORS[1] & MASK
    z ^= z >> 31
    u = (z >> 32 if b % 2 else z & 0xFFFFFFFF) / 2**32
    return sum(u >= p for p in rs.POISSON)


def test_sums_of_groups(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, [None, "a", "b"][i % 3], float(i % 40), None if i % 17 == 0 else int(rng.integers(-5, 10**12))) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, k string, s double, v long").repartition(3)
    want = defaultdict(int)
    for i, k, s, v in rows:
        for b in range(1, 8):
            want[k, s, b] += (v or 0) * weight("x", i, b)
    got = {(r.k, r.s, r.b): int(r.v) for r in rs.resampled_sums(df, "id", ["v"], 7, "x", ["k", "s"]).collect()}
    assert got == want
    monkeypatch.setattr(rs, "GROUPS", 3)
    monkeypatch.setattr(rs, "ROWS", 16)
    assert {(r.k, r.s, r.b): int(r.v) for r in rs.resampled_sums(df, "id", ["v"], 7, "x", ["k", "s"]).collect()} == want
    alone = {r.b: int(r.v) for r in rs.resampled_sums(df, "id", ["v"], 7, "x").collect()}
    assert alone == {b: sum(n for (_, _, c), n in want.items() if c == b) for b in range(1, 8)}
    assert rs.resampled_sums(df.where("false"), "id", ["v"], 7, "x").count() == 0


def test_draws_are_poisson():
    digests = np.random.default_rng(3).integers(0, 1 << 60, 4000)
    w = rs.poisson_weights(digests, 101)
    assert w.shape == (4000, 101) and abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02
    assert np.abs(np.corrcoef(w[:, :20].T) - np.eye(20)).max() < 0.08
