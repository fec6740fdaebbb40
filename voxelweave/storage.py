"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

#: Rows of a table of short columns that is broadcast, at most.
FEW = 50_000


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a folder of our own only on a single machine where none is named."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="voxelweave-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write df as Parquet into the shared folder and read it back. The folder goes when the application ends."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few(df: DataFrame, rows: int = FEW) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows, which a scan of no more than that many finds out."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def load(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet table at path, empty where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def replace(rows: DataFrame, path: str, by: list[str]) -> None:
    """Write rows; the partitions that they have are replaced, others stay. No setting of the session is touched."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
