"""Following a growing catalog: always the newest member against a reference.

Only the newest valid member at each trigger counts. A stream's batch is compared with the last
member in the history table, which is durable, so a restart neither repeats nor goes back. A batch
that fails is retried by Structured Streaming with the history unchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.utils import AnalysisException

from ..functions import names
from ..operators import catalog

KEY = ["collection", "position"]
HISTORY = "collection string, position string, seq int, dataset_name string, file_name string, mtime timestamp_ntz"


def newest(members: DataFrame, reference_seq: int = 0, by: list[str] | None = None, exclude: str | None = None) -> DataFrame:
    """The newest valid file that is not older than the reference, per position (mode same) or collection (mode all)."""
    good = members.where(F.col("valid") & names.is_volume_file(F.col("file_name")) & (F.col("seq") >= reference_seq))
    if exclude is not None:
        good = good.where(F.col("dataset_name") != exclude)
    by = by or KEY
    best = F.max_by(F.struct(*(c for c in ("collection", "position", "seq", "dataset_name", "file_name", "mtime") if c not in by)), F.struct("seq", "mtime", "dataset_name", "file_name"))
    return good.groupBy(*by).agg(best.alias("m")).select(*by, "m.*").select("collection", "position", "seq", "dataset_name", "file_name", "mtime")


def history(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(HISTORY).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], HISTORY)


def unseen(candidates: DataFrame, seen: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Candidates beyond the last one seen: a higher number, or a newer file of the same number."""
    by = by or KEY
    last = seen.groupBy(*by).agg(F.max(F.struct("seq", "mtime")).alias("last"))
    return candidates.join(last, by, "left").where(F.col("last").isNull() | (F.struct("seq", "mtime") > F.col("last"))).drop("last")


def follow(members: DataFrame, path: str, checkpoint: str, show: Callable[[DataFrame], None] | None = None, reference_seq: int = 0, by: list[str] | None = None, exclude: str | None = None, interval: str | None = None) -> StreamingQuery:
    """Start following a stream of catalog rows; each emitted member is shown and appended to the history at path.

    Without interval the query takes what is there and ends.
    """

    def step(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        fresh = unseen(newest(batch, reference_seq, by, exclude), history(spark, path), by).persist()
        try:
            if not fresh.isEmpty():
                if show:
                    show(fresh)
                fresh.select(*(c.split()[0] for c in HISTORY.split(", "))).write.mode("append").parquet(path)
        finally:
            fresh.unpersist()

    writer = members.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


#: What is kept for each key: the last member emitted. Times are text, so that they compare to the microsecond.
_LAST = "seq int, mtime string, file_name string"
_EMITTED = "collection string, position string, seq int, mtime string, file_name string"
_MOMENT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _newer(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    best = last = tuple(state.get) if state.exists else None
    for rows in batches:  # a key's rows of one trigger, in pieces
        top = max(zip(rows["seq"].tolist(), rows["mtime"].tolist(), rows["file_name"].tolist(), strict=True))
        best = top if best is None or top > best else best
    if best != last:
        state.update(best)
        yield pd.DataFrame([(*key, *best)], columns=[c.split()[0] for c in _EMITTED.split(", ")])


def newer_members(members: DataFrame, reference_seq: int = 0) -> DataFrame:
    """Of a stream of catalog rows, at each trigger the newest member of every position that is beyond the last one emitted.

    The last one is state of the stream, a row for each key, and part of its checkpoint: nothing is read again
    for it, and a trigger that fails leaves it as it was. A file that can't be read yet does not count; it does as
    soon as a later listing has it as valid.
    """
    good = members.where(F.col("valid") & names.is_volume_file(F.col("file_name")) & (F.col("seq") >= reference_seq))
    rows = good.select(*KEY, "seq", F.date_format("mtime", _MOMENT).alias("mtime"), "file_name")
    found = rows.groupBy(*KEY).applyInPandasWithState(_newer, _EMITTED, _LAST, "append", GroupStateTimeout.NoTimeout)
    return found.withColumn("mtime", F.to_timestamp_ntz("mtime", F.lit(_MOMENT)))


def follow_with_state(members: DataFrame, path: str, checkpoint: str, reference_seq: int = 0, interval: str | None = None) -> StreamingQuery:
    """Append ``newer_members`` to the table at path. Without interval the query takes what is there and ends."""
    writer = newer_members(members, reference_seq).writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start(path)


def emitted(batches: DataFrame, reference_seq: int = 0) -> DataFrame:
    """What following would emit over numbered batches (batch, and catalog columns), as one query."""
    good = batches.where(F.col("valid") & names.is_volume_file(F.col("file_name")) & (F.col("seq") >= reference_seq))
    per = good.groupBy("batch", *KEY).agg(F.max(F.struct("seq", "mtime", "file_name")).alias("m"))
    before = F.max("m").over(Window.partitionBy(*KEY).orderBy("batch").rowsBetween(Window.unboundedPreceding, -1))
    rows = per.withColumn("before", before).where(F.col("before").isNull() | (F.col("m") > F.col("before")))
    return rows.select("batch", *KEY, "m.*")


def preload(members: DataFrame, current_seq: int, reference_seq: int = 0) -> DataFrame:
    """History entries up to the current member, one per dataset, oldest first."""
    rows = catalog.latest_files(members).where((F.col("seq") >= reference_seq) & (F.col("seq") <= current_seq))
    return rows.orderBy(*KEY, "seq")
