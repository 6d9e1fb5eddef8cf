"""Resampled sums: every record is read once and adds to all replicates in a small array, which alone is shuffled.

Draws come from one digest of a record's id: a 64-bit mixer steps from it and gives two 32-bit draws a step. They are made in NumPy inside the tasks, as Spark's own functions
could only make them by a row per record and replicate.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

#: Cumulative probabilities of a Poisson variable of mean 1 from 0 to 5.
POISSON = [0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183]
#: The step and the two factors of the splitmix64 generator.
STEP, FACTORS = 0x9E3779B97F4A7C15, (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
#: Records whose draws are held at once, and groups whose sums are held before they are passed on.
ROWS, GROUPS = 1 << 10, 1 << 9


def poisson_weights(digests: np.ndarray, replicates: int) -> np.ndarray:
    """Records x replicates: how often each record enters each resample."""
    steps = np.arange(1, (replicates + 1) // 2 + 1, dtype=np.uint64) * np.uint64(STEP)
    z = digests.astype(np.uint64)[:, None] + steps[None, :]
    z = (z ^ (z >> np.uint64(30))) * np.uint64(FACTORS[0])
    z = (z ^ (z >> np.uint64(27))) * np.uint64(FACTORS[1])
    z ^= z >> np.uint64(31)
    draws = np.stack([z >> np.uint64(32), z & np.uint64(0xFFFFFFFF)], axis=2).reshape(len(digests), -1)[:, :replicates]
    weights = np.zeros(draws.shape, dtype=np.int64)
    for p in POISSON:
        weights += draws >= np.uint64(np.ceil(p * 2.0**32))
    return weights


def resampled_sums(df: DataFrame, ident: str, values: Sequence[str], replicates: int, seed: str, keys: Sequence[str] = ()) -> DataFrame:
    """keys, b (1 to ``replicates``), and each of ``values`` (whole numbers) summed with every record's Poisson weight in replicate b.

    A null value adds nothing. A task holds the sums of ``GROUPS`` groups at most and passes them on beyond that, so its memory doesn't depend on how many
    keys there are; what moves is one array a task and group, not a row a record and replicate.
    """
    digest = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col(ident).cast("string"))), 1, 15), 16, 10).cast("long").alias("__digest")
    d = df.select(*keys, digest, *[F.coalesce(F.col(v).cast("long"), F.lit(0)).alias(v) for v in values])
    schema = T.StructType([d.schema[k] for k in keys] + [T.StructField(v, T.ArrayType(T.LongType())) for v in values])

    def run(batches):
        held: dict[tuple, np.ndarray] = {}
        types = None

        def passed_on():
            columns = [pa.array([k[i] for k in held], t) for i, t in enumerate(types)]
            columns += [pa.array([s[i] for s in held.values()], pa.list_(pa.int64())) for i in range(len(values))]
            return pa.RecordBatch.from_arrays(columns, [*keys, *values])

        for batch in batches:
            types = [batch.column(k).type for k in keys]
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                names = list(zip(*[part.column(k).to_pylist() for k in keys], strict=True)) if keys else [()] * part.num_rows
                numbered = {name: i for i, name in enumerate(dict.fromkeys(names))}
                code = np.array([numbered[name] for name in names])
                order = np.argsort(code, kind="stable")
                starts = np.searchsorted(code[order], np.arange(len(numbered)))
                weights = poisson_weights(part.column("__digest").to_numpy()[order], replicates)
                sums = np.stack([np.add.reduceat(weights * part.column(v).to_numpy()[order][:, None], starts, axis=0) for v in values], axis=1)
                for name, i in numbered.items():
                    held[name] = held[name] + sums[i] if name in held else sums[i]
                if len(held) > GROUPS:
                    yield passed_on()
                    held.clear()
        if held:
            yield passed_on()

    partial = d.mapInArrow(run, schema).select(*keys, F.posexplode(F.arrays_zip(*values)).alias("b", "__sums"))
    return partial.groupBy(*keys, (F.col("b") + 1).alias("b")).agg(*[F.sum(F.col(f"__sums.{v}").cast("decimal(38,0)")).alias(v) for v in values])


def weights_sql(source: str, seed: str, ident: str, replicates: int, columns: str) -> str:
    """A query that gives ``columns`` of ``source``, b and w, the weight of every record in every replicate."""
    big, low = "18446744073709551616::UHUGEINT", "4294967296.0"
    times = lambda z, f: f"((({z})::UHUGEINT * {f}::UHUGEINT) % {big})::UBIGINT"
    poisson = " + ".join(f"(u >= {p!r})::INT" for p in POISSON)
    return f"""SELECT {columns}, b, {poisson} AS w FROM (
  SELECT *, (CASE WHEN b % 2 = 1 THEN z >> 32 ELSE z & 4294967295::UBIGINT END)::DOUBLE / {low} AS u FROM (
   SELECT * REPLACE (xor(z, z >> 31) AS z) FROM (SELECT * REPLACE ({times("xor(z, z >> 27)", FACTORS[1])} AS z) FROM (SELECT * REPLACE ({times("xor(z, z >> 30)", FACTORS[0])} AS z) FROM (
    SELECT *, ((('0x' || substr(md5('{seed}|' || {ident}), 1, 15))::BIGINT::UHUGEINT + ((b + 1) // 2)::UHUGEINT * {STEP}::UHUGEINT % {big}) % {big})::UBIGINT AS z FROM {source} CROSS JOIN range(1, {replicates + 1}) x(b))))))"""
