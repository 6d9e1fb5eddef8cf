"""SimHash near-dedup by multi-index hashing over two 32-bit segments."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .components import connected_components
from .scratch import Tables, written

LOW = 0xFFFFFFFF
CROWDED = 256
CHUNK = 1 << 15


def fingerprint(text: str | None, words: int = 3) -> int:
    """64 bits; bit k is set if it is set in over half of the XXH64 (seed 42) of the word shingles."""
    w = (text or "").encode("utf-8").lower().split()
    if not w:
        return 0
    joined = b" ".join(w)
    n = max(len(w) - words + 1, 1)
    if n == 1:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = (np.concatenate(([0], ends[:-1] + 1)))[:n].tolist()
    stops = ends[words - 1 :].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[at : at + CHUNK], stops[at : at + CHUNK])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) for whole texts; null or wordless text: 0."""

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _flips(x: Column, bits: int = 32) -> Column:
    """The neighbours of a segment at one bit, only those got by setting a bit that is 0."""
    each = F.sequence(F.lit(0), F.lit(bits - 1))
    one = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)
    return F.transform(F.filter(each, lambda i: x.bitwiseAND(one(i)) == 0), lambda i: x.bitwiseOR(one(i)))


def fingerprint_links(fps: DataFrame, tables: Tables) -> DataFrame:
    """Pairs (a, b) that link all distinct fingerprints at 2 or fewer differing bits.

    Two errors over two segments: either one segment agrees, or both differ in one bit. So the
    table holds each fingerprint under either whole segment, and each probes with the ball of radius
    1 around its high segment (the pair is found by the side whose bit is 0) and of radius 0 around
    the low one. Matches are verified on all 64 bits. Buckets of more than ``CROWDED`` fingerprints
    aren't paired: there the members look each other up by their other segment with two bits
    blanked, a key that at most four distinct values share, so cost stays linear in the bucket.
    """
    d = fps.select("fp").distinct()
    hi = F.shiftrightunsigned("fp", 32)
    lo = F.col("fp").bitwiseAND(F.lit(LOW))
    table = d.select(F.explode(F.array(
        F.struct(F.lit(0).alias("seg"), hi.alias("key"), lo.alias("rest")),
        F.struct(F.lit(1).alias("seg"), lo.alias("key"), hi.alias("rest")),
    )).alias("t"), "fp").select("t.*", "fp")
    crowded = table.groupBy("seg", "key").count().where(F.col("count") > CROWDED).select("seg", "key", F.lit(True).alias("hot"))
    marked = tables.written(table.join(crowded, ["seg", "key"], "left"))
    cool, hot = marked.where("hot is null"), marked.where("hot")
    other = cool.select("seg", "key", F.col("fp").alias("fp2"))
    same = cool.join(other, ["seg", "key"]).where("fp < fp2").where(_distance("fp", "fp2") <= 2).select("fp", "fp2")
    probes = d.select("fp", F.lit(0).alias("seg"), lo.alias("rest"), F.explode(_flips(hi)).alias("key"))
    near = probes.select("seg", "key", "fp").join(other, ["seg", "key"]).where(_distance("fp", "fp2") <= 2).select("fp", "fp2")
    return same.union(near).union(_crowded_links(hot, probes)).select(F.col("fp").alias("a"), F.col("fp2").alias("b")).distinct()


def _crowded_links(hot: DataFrame, probes: DataFrame) -> DataFrame:
    """Links of crowded buckets: equal segment and two bits apart in the other, or one bit in each."""
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)
    x, bits = F.col("rest"), F.sequence(F.lit(0), F.lit(31))
    pairs = F.flatten(F.transform(bits, lambda i: F.transform(F.sequence(i, F.lit(31)), lambda j: bit(i).bitwiseOR(bit(j)))))
    blank = hot.select("seg", "key", "fp", "rest", F.explode(pairs).alias("mask")).where(x.bitwiseAND(F.col("mask")).isNotNull())
    blank = blank.select("seg", "key", "mask", x.bitwiseAND(F.bitwise_not("mask")).alias("left"), "fp")
    least = blank.groupBy("seg", "key", "mask", "left").agg(F.min("fp").alias("fp"), F.max("fp").alias("most"), F.collect_set("fp").alias("fps"))
    two = least.where("fp < most").select("fp", F.explode("fps").alias("fp2")).where("fp <> fp2")
    keys = hot.where("seg = 0").select("key").distinct()
    into = probes.join(keys, "key", "left_semi").select("key", "fp", F.col("rest").alias("r1"))
    singles = F.concat(F.array(F.lit(0).cast("long")), F.transform(bits, bit))
    members = hot.where("seg = 0").select("key", F.col("fp").alias("fp2"), F.explode(singles).alias("mask"), x.alias("r2"))
    members = members.select("key", "mask", F.col("r2").bitwiseAND(F.bitwise_not("mask")).alias("left"), "fp2")
    into = into.select("key", "fp", F.explode(singles).alias("mask"), "r1").select("key", "mask", F.col("r1").bitwiseAND(F.bitwise_not("mask")).alias("left"), "fp")
    one = into.join(members, ["key", "mask", "left"]).where(_distance("fp", "fp2") <= 2).select("fp", "fp2")
    return two.union(one)


def simhash_components(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id reachable over links, the document's own included.

    Documents with equal fingerprints collapse before any search and come back by one join. Null or
    empty texts share fingerprint 0 and link like any other; null doc_ids keep a row and never
    name a component that has another id; repeated rows stay; an empty table gives no rows.
    """
    with Tables() as tables:
        fps = tables.written(fingerprints(docs, words))
        roots = tables.keep(connected_components(fingerprint_links(fps, tables)))
        firsts = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
        named = firsts.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
        least = named.groupBy("root").agg(F.min("first").alias("component_id"))
        return written(fps.join(named.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id"))


def simhash_digest(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id."""
    return simhash_components(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_dedup(docs: DataFrame, words: int = 3) -> DataFrame:
    """The documents whose doc_id names their component; all columns. Rows with null doc_id stay.

    Of rows that repeat the kept doc_id all stay: they can't be told apart by id.
    """
    c = simhash_components(docs, words).where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(c, "doc_id", "left_semi").unionByName(docs.where("doc_id is null"))
