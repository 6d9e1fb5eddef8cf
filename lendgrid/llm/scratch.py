"""Written tables that cut lineage, in the folder that every executor shares."""

from __future__ import annotations

import gc
import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession, functions as F

#: A table of up to so many rows of a few numbers is broadcast.
FEW = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where that is unset, as in tests, a temporary folder and a warning."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not getattr(spark, "_lendgrid_scratch", None):
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        warnings.warn("spark.checkpoint.dir is unset: intermediate tables go to a local temporary folder", stacklevel=2)
        spark._lendgrid_scratch = "file://" + tempfile.mkdtemp(prefix="lendgrid-")
    return spark._lendgrid_scratch


def written(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once as Parquet and read it back: later steps restart from files, not from lineage."""
    path = f"{shared_dir(df.sparkSession)}/scratch-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._lendgrid_path = path
    return back


def discard(df: DataFrame) -> None:
    """Delete what ``written`` made, once nothing reads it any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._lendgrid_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Tables:
    """The written tables of one operator, all deleted when the block ends."""

    def __init__(self):
        self.made: list[DataFrame] = []

    def written(self, df: DataFrame, compression: str = "snappy") -> DataFrame:
        self.made.append(written(df, compression))
        return self.made[-1]

    def keep(self, df: DataFrame) -> DataFrame:
        """Take over a table that another operator has written."""
        self.made.append(df)
        return df

    def discard(self, df: DataFrame) -> None:
        self.made = [t for t in self.made if t is not df]
        discard(df)

    def __enter__(self) -> Tables:
        return self

    def __exit__(self, *error) -> None:
        for t in self.made:
            discard(t)


def few(df: DataFrame) -> DataFrame:
    """A written table of a few numbers a row, to be broadcast if its counted rows are at most ``FEW``; otherwise as it is."""
    return F.broadcast(df) if df.limit(FEW + 1).count() <= FEW else df


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores as no column of ``df`` has, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def release(spark: SparkSession) -> None:
    """Let the driver notice that finished steps are gone, so that Spark deletes their shuffle files now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
