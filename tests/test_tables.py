"""Patterns of segments, and result tables written segment by segment."""

import re

from pyspark.sql import functions as F

from lendgrid.operators import population as pop
from lendgrid.sources import applications as src
from lendgrid.sources import shared


def test_match_patterns(spark):
    values = ["machinery", "mach", "automobile", "auto x", "a.b", "aXb", "", None, "building-1"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values * 3)], "id long, segment_cut_off string")
    patterns = ["mach", "auto|build", "a.b", "", "nothing", "mach", "machinery and more", "x|(b|c)"] + [f"p{i}" for i in range(300)]
    got = sorted((r.id, r.pattern) for r in pop.match_patterns(df, patterns).collect())
    want = sorted((i, p) for i, v in enumerate(values * 3) if v is not None for p in set(patterns) if re.match(f"(?:{p})", v))
    assert got == want
    plan = pop.match_patterns(df, ["mach", "auto|build"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert pop.match_patterns(df, []).count() == 0 and pop.match_patterns(df, ["m.*y"]).count() == 3


def test_a_segment_is_replaced_alone(spark, tmp_path):
    df = spark.createDataFrame([("a", "base", 1.0), ("b", "base", 2.0)], "segment string, scenario string, v double")
    src.write_results(df, str(tmp_path), "t")
    src.write_results(df.where("segment = 'a'").withColumn("v", F.lit(9.0)), str(tmp_path), "t")
    assert sorted((r.segment, r.v) for r in src.read_results(spark, str(tmp_path), "t").collect()) == [("a", 9.0), ("b", 2.0)]
    for v in (1.0, 2.0):
        src.write_results(spark.createDataFrame([(v,)], "v double"), str(tmp_path), "whole")
    assert [r.v for r in src.read_results(spark, str(tmp_path), "whole").collect()] == [2.0]


def test_file_rows_are_bounded(spark):
    """Small tables get a file a core or more, large ones no small files."""
    cores = spark.sparkContext.defaultParallelism
    low, high = shared.FILE_ROWS
    assert shared.file_rows(spark, 0) == low and shared.file_rows(spark, 10**12) == high
    n = 4 * cores * low
    assert low < shared.file_rows(spark, n) <= n // (2 * cores)
