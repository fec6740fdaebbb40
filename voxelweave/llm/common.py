"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only on a single machine where none is configured."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="voxelweave-")
        spark.conf.set("spark.checkpoint.dir", found)
    if spark._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write df as Parquet into the shared folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._voxelweave_path = path
    return out


#: Bytes of the decoded rows of a table that is broadcast, at most.
SMALL = 8 << 20


def small(table: DataFrame, limit: int = SMALL, of: DataFrame | None = None) -> DataFrame:
    """A table of ``materialize``, with a broadcast hint if its rows take at most limit bytes; else a shuffled join does.

    of is the table that a selection of columns comes from.
    """
    of = table if of is None else of
    spark, path = of.sparkSession, of._voxelweave_path
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(jpath).getLength()
    if size <= limit and not hasattr(of, "_voxelweave_bytes"):
        fixed = sum(8 if t in _FIXED else 16 for _, t in of.dtypes) + 16
        varying = [F.octet_length(c) for c, t in of.dtypes if t in ("string", "binary")]
        varying += [F.octet_length(F.to_json(c)) for c, t in of.dtypes if t not in _FIXED and t not in ("string", "binary")]
        extra = sum((F.coalesce(F.sum(v), F.lit(0)) for v in varying), F.lit(0))
        rows, more = of.agg(F.count(F.lit(1)), extra).head()
        of._voxelweave_bytes = rows * fixed + more
    return F.broadcast(table) if size <= limit and of._voxelweave_bytes <= limit else table


_FIXED = {"bigint", "int", "smallint", "tinyint", "boolean", "double", "float", "date", "timestamp", "timestamp_ntz"}


#: Keys with more rows than this, and than the same share of all rows, are hot.
HOT_ROWS, HOT_SHARE = 10_000, 10_000


def spread_join(rows: DataFrame, keys: DataFrame, on: list[str], total: int, count: str = "n") -> DataFrame:
    """Inner join of total rows with keys, a table of ``materialize`` with the number of rows of each key.

    Rows of hot keys stay where they are: at most HOT_SHARE keys can be hot, so those are broadcast.
    """
    most = max(HOT_ROWS, total // HOT_SHARE)
    hot, rest = F.broadcast(keys.where(F.col(count) >= most)), keys.where(F.col(count) < most)
    if hot.isEmpty():
        return rows.join(keys, on)
    return rows.join(hot, on).unionByName(rows.join(hot.select(*on), on, "left_anti").join(rest, on))


def release(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing will read again, and let Spark drop shuffles that nothing refers to."""
    spark = tables[0].sparkSession
    for t in tables:
        drop_path(spark, t._voxelweave_path)
    forget(spark)


def forget(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffles and broadcasts that nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


def only(df: DataFrame, *names: str) -> DataFrame:
    """Just the named columns; a column that differs from another only in case is no ambiguity."""
    ship(df.sparkSession)  # every operator starts here
    bounded_batches(df.sparkSession)
    exact = {c: i for i, c in reversed(list(enumerate(df.columns)))}
    lower = [c.lower() for c in df.columns]
    if len(set(lower)) < len(lower):
        df = df.toDF(*(f"_c{i}" for i in range(len(lower))))
        return df.select(*(F.col(f"_c{exact[n]}").alias(n) for n in names))
    return df.select(*names)


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of so many rows, if the session has Spark's default: rows here are whole documents.

    This holds for the session, as a plan reads it when it runs. Spark itself bounds a batch to 64 MB
    (spark.sql.execution.arrow.maxBytesPerBatch), whatever its rows.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, rows)


def positional(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """df with columns _c0, _c1, ..., and the new name of each: for joins that names in df must not disturb."""
    return df.toDF(*(f"_c{i}" for i in range(len(df.columns)))), {n: f"_c{i}" for i, n in enumerate(df.columns)}


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows whose crc32 of the id as text is divisible by folds; no id: not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


