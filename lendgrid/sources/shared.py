"""Tables written to the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

from .applications import applications


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where that is unset, as in tests, a temporary folder and a warning."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not getattr(spark, "_lendgrid_shared", None):
        warnings.warn("spark.checkpoint.dir is unset: tables go to a local temporary folder", stacklevel=2)
        spark._lendgrid_shared = "file://" + tempfile.mkdtemp(prefix="lendgrid-")
    return spark._lendgrid_shared


def new_path(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet and read it back: what follows starts from files, not from lineage."""
    path = new_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stamp(spark: SparkSession, paths: list[str]) -> tuple:
    """Length and time of every file below the paths, in any store that Spark reads."""
    out = []
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = p.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(p, True)
        while files.hasNext():
            f = files.next()
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


#: Rows of a file of the prepared table, at least and at most.
FILE_ROWS = (1 << 14, 1 << 20)


def file_rows(spark: SparkSession, rows: int) -> int:
    """Rows of a file such that a small table still gives every core one, and a large one no small files."""
    return max(FILE_ROWS[0], min(FILE_ROWS[1], -(-rows // (2 * spark.sparkContext.defaultParallelism))))


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``applications``, joined and written once a session; anew if a file of the tables below it has changed.

    Checks, profiles and models all read this one table, with only the columns they need, instead of
    joining and summing lines each time.
    """
    key = _stamp(spark, [f"{sf_dir}/{t}.parquet" for t in ("orders", "customer", "lineitem")])
    known = spark.__dict__.setdefault("_lendgrid_prepared", {})
    if key not in known:
        path = new_path(spark, "applications")
        rows = spark.read.parquet(f"{sf_dir}/orders.parquet").count()  # an application an order, counted from the footers
        applications(spark, sf_dir).write.option("maxRecordsPerFile", file_rows(spark, rows)).parquet(path)
        known[key] = path
    return spark.read.parquet(known[key])
