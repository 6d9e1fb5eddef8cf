"""Ingest, and the portfolio of applications that the queries read."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.scalars import money_sum


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def standardise(df: DataFrame) -> DataFrame:
    """Column names and string values in lower case with underscores for spaces; NaN becomes null."""
    names = [re.sub(r"\s+", "_", c.strip()).lower() for c in df.columns]
    df = df.toDF(*names)
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.lower(F.regexp_replace(c, " ", "_"))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        out.append(c.alias(f.name))
    return df.select(*out)


def ingest(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Read a Parquet, CSV, ORC or JSON source and standardise it."""
    reader = spark.read.format(fmt).options(**({"header": "true"} if fmt == "csv" else {}) | options)
    return standardise((reader.schema(schema) if schema else reader).load(path))


def write_results(df: DataFrame, base: str, name: str, fmt: str = "parquet", keys=("segment", "scenario", "period")) -> None:
    """Write a result table partitioned by those of ``keys`` that it has: their combinations in ``df`` are replaced, all others stay. Without keys the table is replaced."""
    w, by = df.write.mode("overwrite").format(fmt), [k for k in keys if k in df.columns]
    (w.option("partitionOverwriteMode", "dynamic").partitionBy(*by) if by else w).save(f"{base}/{name}")


def read_results(spark: SparkSession, base: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Read a result table of all segments, scenarios and periods; the keys are partition columns."""
    return spark.read.format(fmt).load(f"{base}/{name}")


def write_alerts(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per application: order, customer and the per-order sums of its lines."""
    lines = table(spark, sf_dir, "lineitem")
    returned = F.col("l_returnflag") == "R"
    lines = lines.groupBy("l_orderkey").agg(
        F.count("*").alias("n"), F.sum(F.when(returned, 1).otherwise(0)).alias("nr"), money_sum("l_extendedprice").alias("amt"),
        money_sum(F.when(returned, F.col("l_extendedprice") * F.col("l_discount")).otherwise(0.0)).alias("bad"),
    )
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    st, pr, key, cust = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderkey"), F.col("o_custkey")
    flag = lambda c, yes="y", no="n": F.when(c, yes).otherwise(no)
    return o.select(
        key.alias("authorization_id"),
        F.trunc("o_orderdate", "month").alias("mis_date"),
        F.when(st == "F", "booked").when(st == "O", "rejected").when(st == "P", "canceled").alias("status_name"),
        flag((st == "O") & (pr < "4")).alias("m_ct_direct_sc_a"),
        flag((st == "O") & (pr >= "4")).alias("m_ct_direct_other"),
        F.lit(None).cast("string").alias("reject_reason"),
        F.when(F.substring(pr, 1, 1) == "5", "ko").when(F.substring(pr, 1, 1) == "4", "rv").otherwise("ok").alias("se_decision_id"),
        F.lower("c_mktsegment").alias("segment_cut_off"),
        (300 + F.floor((F.col("c_acctbal") + 1000) / 55)).cast("double").alias("score_rf"),
        ((cust * 31 + key * 17) % 100).cast("double").alias("risk_score_rf"),
        F.when(F.col("nr") * 2 > F.col("n"), 1).otherwise(0).alias("early_bad"),
        F.col("o_totalprice").alias("oa_amt"),
        F.col("amt").alias("oa_amt_h0"),
        F.col("amt").alias("todu_amt_pile_h6"),
        F.col("bad").alias("todu_30ever_h6"),
        F.when(st == "F", 1).otherwise(0).alias("acct_booked_h0"),
        flag(key % 50 == 0).alias("fuera_norma"),
        flag(key % 97 == 0).alias("fraud_flag"),
        flag(cust % 40 == 0, "legal", "physical").alias("nature_holder"),
    )


APPLICATIONS_SQL = """
lines AS (
  SELECT l_orderkey, count(*) AS n, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS nr,
         sum(l_extendedprice::DECIMAL(20,4))::DOUBLE AS amt,
         sum((CASE WHEN l_returnflag = 'R' THEN l_extendedprice * l_discount ELSE 0 END)::DECIMAL(20,4))::DOUBLE AS bad
  FROM lineitem GROUP BY 1),
applications AS (
  SELECT o_orderkey AS authorization_id, date_trunc('month', o_orderdate)::DATE AS mis_date,
    CASE o_orderstatus WHEN 'F' THEN 'booked' WHEN 'O' THEN 'rejected' WHEN 'P' THEN 'canceled' END AS status_name,
    CASE WHEN o_orderstatus = 'O' AND o_orderpriority < '4' THEN 'y' ELSE 'n' END AS m_ct_direct_sc_a,
    CASE WHEN o_orderstatus = 'O' AND o_orderpriority >= '4' THEN 'y' ELSE 'n' END AS m_ct_direct_other,
    NULL::VARCHAR AS reject_reason,
    CASE substr(o_orderpriority, 1, 1) WHEN '5' THEN 'ko' WHEN '4' THEN 'rv' ELSE 'ok' END AS se_decision_id,
    lower(c_mktsegment) AS segment_cut_off,
    (300 + floor((c_acctbal + 1000) / 55))::DOUBLE AS score_rf,
    ((o_custkey * 31 + o_orderkey * 17) % 100)::DOUBLE AS risk_score_rf,
    CASE WHEN 2 * nr > n THEN 1 ELSE 0 END AS early_bad,
    o_totalprice AS oa_amt, amt AS oa_amt_h0, amt AS todu_amt_pile_h6, bad AS todu_30ever_h6,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS acct_booked_h0,
    CASE WHEN o_orderkey % 50 = 0 THEN 'y' ELSE 'n' END AS fuera_norma,
    CASE WHEN o_orderkey % 97 = 0 THEN 'y' ELSE 'n' END AS fraud_flag,
    CASE WHEN o_custkey % 40 = 0 THEN 'legal' ELSE 'physical' END AS nature_holder
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN lines ON l_orderkey = o_orderkey)"""
