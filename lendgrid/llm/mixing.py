"""Mixing sources to target weights by systematic sampling. Native: no Python on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .scratch import Tables, written

WORD = r"[^\x20\x09-\x0D]+"
#: Salts of a source's documents of about one size, and the rows of the whole table for which these are enough.
SALTS, SALTED = 64, 1 << 26


def _bucket(size: Column) -> Column:
    """Sizes below 100 as they are, others by their number of digits and first two digits."""
    s = size.cast("string")
    return F.when(size < 100, size).otherwise(F.length(s) * 100 + F.substring(s, 1, 2).cast("long"))


def sized(docs: DataFrame) -> DataFrame:
    """row (all columns of ``docs``, of any name), size (the number of words). The generator keeps Spark from evaluating the count wherever it is used."""
    n = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.explode(F.array(n)).alias("size"))


def source_targets(sizes: DataFrame, cap: int = 3, cycle: int = 3) -> DataFrame:
    """(skey, source, size) -> (skey, source_size, target, rate): one row per source.

    Weights 1..cycle repeat over the sources in code point order, null last. The targets share
    the sum of all sizes by weight; one that would exceed ``cap`` times its source stops there and
    the others share the rest. A source is capped exactly if its cap per weight is at most the level
    reached by pouring what is left over those with a larger cap per weight, hence running sums. These
    go over one row per source in one task, so sources are meant to be thousands, not each host of a crawl.
    """
    per = sizes.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = per.select("skey", "source_size", (F.pmod(F.row_number().over(by_name) - 1, F.lit(cycle)) + 1).alias("w"))
    w = w.withColumn("full", F.col("source_size") * cap)
    order = Window.orderBy(F.col("full") / F.col("w"), "skey")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    w = (
        w.withColumn("all", F.sum("source_size").over(everything))
        .withColumn("left", F.col("all") - F.coalesce(F.sum("full").over(before), F.lit(0)))
        .withColumn("weight", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    )
    w = w.withColumn("capped", F.col("full") * F.col("weight") <= F.col("w") * F.col("left"))
    level = F.min(F.when(~F.col("capped"), F.struct((F.col("full") / F.col("w")).alias("by"), "skey", F.col("left").cast("double").alias("left"), "weight"))).over(everything)
    w = w.withColumn("at", level)
    target = F.when(F.col("capped"), F.col("full").cast("double")).otherwise(F.col("w") * (F.col("at.left") / F.col("at.weight")))
    return w.select("skey", "source_size", target.alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    )


def mix_sources(docs: DataFrame, seed: str = "mix", cap: int = 3) -> DataFrame:
    """Give each document its number of copies in the mix: row (its columns), size, source_size, target, copies.

    Within a source documents stand in the order (size bucket, salt of the doc_id, size, doc_id).
    Each expects ``rate = target / source size`` copies; the prefix sum of these, plus one offset per
    source, crosses an integer boundary once per copy. The prefix sum is built in two levels, from
    counts per (source, bucket, salt) and ranks inside those groups, so a source holding a third of
    all rows is spread over thousands of groups; salts are hashes of ids, and more for larger tables. Expected copies
    are at most ``cap``, an integer, so no document is taken more often. The order by size makes the sample
    even over sizes, which keeps the words taken close to the target.

    Null or empty text: size 0. Null source: a source of its own, last. Null doc_id: orders as -1. Repeated rows
    count each. An empty table gives an empty one. Reruns give the same rows. Other columns may have any name.
    """
    return _mixed(sized(docs), docs.count(), seed, cap)


def _mixed(d: DataFrame, rows: int, seed: str = "mix", cap: int = 3) -> DataFrame:
    salts = SALTS * max(1, -(-rows // SALTED))
    d = d.withColumn("skey", F.coalesce(F.concat(F.lit("s"), F.col("row.source")), F.lit("null")))
    d = d.withColumn("id", F.coalesce(F.col("row.doc_id").cast("long"), F.lit(-1)))
    salt = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 8), 16, 10).cast("long") % salts
    d = d.withColumn("bucket", _bucket(F.col("size"))).withColumn("salt", salt)
    slim = d.select("skey", "bucket", "salt", "size", F.col("row.source").alias("source"))
    keys = ["skey", "bucket", "salt"]
    d = d.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy("size", "id")))

    groups = slim.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.first("source").alias("source"))
    before = Window.partitionBy("skey").orderBy("bucket", "salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.select(*keys, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    m = d.join(offsets.join(source_targets(groups.select("skey", "size", "source"), cap), "skey"), keys)
    u = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("skey"))), 1, 8), 16, 10).cast("double") / float(2**32)
    k = (F.col("before") + F.col("rank")).cast("double")
    copies = F.floor(k * F.col("rate") + u) - F.floor((k - 1) * F.col("rate") + u)
    return m.select("row", "size", "source_size", "target", F.least(copies, F.lit(cap)).cast("long").alias("copies"))


def mix_digest(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: the words of each document that the mix takes.

    Nulls, repeats, empty tables and clashing columns as in ``mix_sources``; only doc_id, text and source are read.
    """
    with Tables() as tables:
        slim = tables.written(sized(docs.select("doc_id", "text", "source")).select(F.struct("row.doc_id", "row.source").alias("row"), "size"))
        mixed = _mixed(slim, slim.count())
        return written(mixed.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")))


def emit_mix(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as many times as it is taken, with the columns it came with.

    Documents without words have no share that could be filled; they are taken like others of their source, at its rate.
    Nulls, repeats, empty tables and clashing columns as in ``mix_sources``.
    """
    mixed = mix_sources(docs).where("copies > 0")
    return mixed.select(F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))), "row").select("row.*")


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce('s' || source, 'null') AS skey,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
b AS (
  SELECT *, CASE WHEN size < 100 THEN size ELSE length(size::VARCHAR) * 100 + substr(size::VARCHAR, 1, 2)::BIGINT END AS bucket,
         ('0x' || substr(md5(coalesce(doc_id, -1)::VARCHAR), 1, 8))::BIGINT
           % (64 * greatest(1, ceil((SELECT count(*) FROM d) / 67108864.0)))::BIGINT AS salt FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY skey ORDER BY bucket, salt, size, doc_id) AS k FROM b),
p AS (SELECT skey, any_value(source) AS source, sum(size)::BIGINT AS source_size FROM d GROUP BY skey),
w AS (SELECT skey, source_size, 3 * source_size AS cap,
             (row_number() OVER (ORDER BY (source IS NULL), source) - 1) % 3 + 1 AS w FROM p),
o AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight FROM w),
c AS (SELECT *, cap * weight <= w * rest AS capped FROM o),
l AS (SELECT rest::DOUBLE / weight::DOUBLE AS level FROM c WHERE NOT capped ORDER BY cap / w, skey LIMIT 1),
t AS (SELECT skey, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE w * (SELECT level FROM l) END AS target FROM c),
q AS (
  SELECT r.doc_id, r.size, t.source_size, t.target, r.k::DOUBLE AS k,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('mix' || r.skey), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS u
  FROM r JOIN t USING (skey))
SELECT doc_id, size, source_size, target,
       (least(floor(k * rate + u) - floor((k - 1) * rate + u), 3) * size)::BIGINT AS taken FROM q
"""
