"""Shards in random order by a two-pass external shuffle: rows are scattered into memory-sized buckets, each bucket is shuffled."""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .scratch import Tables, few, written

#: UTF-8 bytes that a row counts for beside its text.
ROW_BYTES = 16
#: Bytes of rows a bucket; one is shuffled in a task's memory.
BUCKET_BYTES = 8 << 20
#: Buckets whose counts are cumulated in one task.
BLOCK = 1 << 12


def fisher_yates(n: int, seed: int) -> list[int]:
    """A uniform order of 0 to n - 1: each place, from the last down, is swapped with one at or below it."""
    order, draw = list(range(n)), random.Random(seed).random
    for i in range(n - 1, 0, -1):
        j = int(draw() * (i + 1))
        order[i], order[j] = order[j], order[i]
    return order


def shuffled(docs: DataFrame, seed: int = 11, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """row (all columns of ``docs``, of any name), size, position: every row once, at a random place among all of them.

    First pass: rows are named by a seeded hash of all their columns, and counted by it. This gives the number of buckets, the rows of each and so its
    first position. Second pass: rows move to the bucket that their hash draws, are put into the order of the hashes there and then through a
    Fisher-Yates shuffle seeded by the bucket's number. The result depends on rows and seed alone, not on how the table was split.

    Equal rows share a hash. One whose copies together exceed half a bucket is collapsed to a count before it moves, and each copy draws
    a bucket of its own, so no bucket grows with the number of copies. A bucket holds ``bucket_bytes`` on average; one row
    larger than that makes its bucket larger. Null text: no bytes. Columns may be null and of any type but maps.
    """
    with Tables() as tables:
        size = F.coalesce(F.octet_length(F.col("text")), F.lit(0)).cast("long") + ROW_BYTES
        columns = [F.col(f"`{c}`") for c in docs.columns]
        d = docs.select(F.struct(*columns).alias("row"), size.alias("size"), F.xxhash64(F.lit(seed), *columns).alias("name"))
        names = tables.written(d.groupBy("name").agg(F.count("*").alias("n"), F.sum("size").alias("size")))
        total = names.agg(F.sum("size").alias("size")).first()["size"] or 0
        buckets = max(1, -(-total // bucket_bytes))
        draw = F.pmod(F.xxhash64(F.lit(seed + 1), "name", "copy"), F.lit(buckets)).alias("bucket")

        heavy = (F.col("n") > 1) & (F.col("size") > bucket_bytes // 2)
        hot = tables.written(names.where(heavy).select("name"))
        d = d.withColumn("copy", F.lit(0).cast("long"))
        if not hot.isEmpty():
            few_hot = few(hot)
            copies = d.join(few_hot, "name", "left_semi").groupBy("row", "size", "name").agg(F.count("*").alias("n"))
            copies = copies.select("row", "size", "name", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
            d = d.join(few_hot, "name", "left_anti").select("row", "size", "name", "copy").unionByName(copies)
        counted = names.select("name", F.when(heavy, 1).otherwise(F.col("n")).alias("n"), F.explode(F.when(heavy, F.sequence(F.lit(1).cast("long"), "n")).otherwise(F.array(F.lit(0).cast("long")))).alias("copy"))
        per = tables.written(counted.groupBy(draw).agg(F.sum("n").alias("n")))

        per = per.withColumn("block", F.floor(F.col("bucket") / BLOCK))
        before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        blocks = per.groupBy("block").agg(F.sum("n").alias("n")).select("block", before(Window.orderBy("block")).alias("base"))
        first = per.join(blocks, "block").select("bucket", (F.col("base") + before(Window.partitionBy("block").orderBy("bucket"))).alias("first"))
        first = tables.written(first)

        moved = d.select("row", "size", "name", "copy", draw).join(few(first), "bucket")
        schema = moved.select("row", "size", F.col("first").alias("position")).schema

        def order(bucket: pa.Table) -> pa.Table:
            bucket = bucket.sort_by([("name", "ascending"), ("copy", "ascending")])
            start, number = bucket.column("first")[0].as_py(), bucket.column("bucket")[0].as_py()
            places = fisher_yates(bucket.num_rows, seed * 0x9E3779B1 + number)
            return bucket.select(["row", "size"]).append_column("position", pa.array([start + p for p in places], pa.int64())).cast(bucket_schema)

        bucket_schema = _arrow(schema)
        return written(moved.groupBy("bucket").applyInArrow(order, schema))


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def sharded(docs: DataFrame, shards: int = 40, seed: int = 11, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """row (all columns of ``docs``), size, shard, slot: the shuffled rows cut into ``shards`` runs whose lengths differ by one at most."""
    mixed = shuffled(docs, seed, bucket_bytes)
    n = mixed.count()
    shard = F.expr(f"position * {int(shards)}L div {max(n, 1)}L").cast("int")
    start = F.expr(f"(shard * {n}L + {int(shards) - 1}L) div {int(shards)}L")
    return mixed.select("row", "size", "position", shard.alias("shard")).select("row", "size", "shard", (F.col("position") - start).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 40, seed: int = 11) -> None:
    """A folder a shard, files in order of slot inside: rows can be read one after the other in training."""
    out = sharded(docs, shards, seed)
    out.select("shard", "slot", "row").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)


def shard_digest(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law (``rows``), shard, slot, grown_shard (null, as the law isn't ``key``).

    Shards hold as many rows as each other or one more, slots are gapless from 0. Equal texts, repeated rows and null ids are rows of their own. Null text: size 16,
    crc32 of nothing. Fewer rows than shards: some shards are empty. An empty table gives an empty one. Other columns are not read.
    """
    out = sharded(docs.select("doc_id", "text"), shards)
    crc = F.crc32(F.coalesce(F.col("row.text"), F.lit("")).cast("binary"))
    return out.select("row.doc_id", "size", crc.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
