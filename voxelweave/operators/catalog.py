"""Series members, predecessor pairs and audits over a file catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names

SERIES = ["collection", "position"]


def latest_files(files: DataFrame) -> DataFrame:
    """The newest valid volume file of each dataset."""
    good = files.where(F.col("valid") & names.is_volume_file(F.col("file_name")))
    newest = F.max_by(F.struct("file_name", "mtime", "length"), F.struct("mtime", "file_name"))
    return good.groupBy(*SERIES, "seq", "dataset_name").agg(newest.alias("f")).select(*SERIES, "seq", "dataset_name", "f.*")


def in_range(seq: Column, start: int | None, stop: int | None) -> Column:
    """Between the bounds, which may be swapped or missing."""
    if start is not None and stop is not None and start > stop:
        start, stop = stop, start
    out = F.lit(True)
    if start is not None:
        out &= seq >= start
    return out if stop is None else out & (seq <= stop)


def within_series(members: DataFrame, start: int | None, stop: int | None) -> DataFrame:
    """Members between the bounds; a missing bound is the end of the member's series, then bounds may be swapped."""
    series = Window.partitionBy(*SERIES)
    ends = [F.lit(b) if b is not None else f("seq").over(series) for b, f in ((start, F.min), (stop, F.max))]
    rows = members.withColumns({"_low": F.least(*ends), "_high": F.greatest(*ends)})
    return rows.where((F.col("seq") >= F.col("_low")) & (F.col("seq") <= F.col("_high"))).drop("_low", "_high")


def admitted(files: DataFrame, skipped: DataFrame | None = None, start: int | None = None, stop: int | None = None, unique: bool = False) -> DataFrame:
    """Members in range that are not skipped. skipped: (seq). With both bounds the filters stand below the file choice.

    If unique, a number that two members of a series have is an error.
    """
    both = start is not None and stop is not None
    rows = files.where(in_range(F.col("seq"), start, stop)) if both else files
    if skipped is not None and (both or start is None and stop is None):
        rows = rows.join(skipped, "seq", "left_anti")
    rows = latest_files(rows)
    if not both and (start is not None or stop is not None):  # the ends of a series are those of all its members
        rows = within_series(rows, start, stop)
        if skipped is not None:
            rows = rows.join(skipped, "seq", "left_anti").select(rows.columns)
    return single(rows) if unique else rows


def single(members: DataFrame) -> DataFrame:
    """members; an error if two of a series have one number."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*SERIES, "seq"))
    wrong = F.raise_error(F.format_string("%s_%s has more than one member #%04d", *SERIES, "seq")).cast("int")
    return members.withColumn("_n", n).withColumn("seq", F.when(F.col("_n") == 1, F.col("seq")).otherwise(wrong)).drop("_n")


def roots(files: DataFrame) -> DataFrame:
    """All dataset directories, whether or not they hold a valid file."""
    return files.select(*SERIES, "seq", "dataset_name").distinct()


def predecessor_pairs(members: DataFrame) -> DataFrame:
    """Each member with the admitted member before it."""
    order = Window.partitionBy(*SERIES).orderBy("seq")
    rows = members.withColumn("p", F.lag(F.struct("seq", "dataset_name", "file_name")).over(order)).where("p is not null")
    return rows.select(*SERIES, "seq", "dataset_name", "file_name", F.col("p.seq").alias("prev_seq"), F.col("p.dataset_name").alias("prev_dataset_name"), F.col("p.file_name").alias("prev_file_name"))


def described_pairs(members: DataFrame) -> DataFrame:
    """``predecessor_pairs`` by series (collection and position in one name), with the files' times."""
    order = Window.partitionBy("series").orderBy("seq")
    rows = members.withColumn("series", F.concat_ws("_", *SERIES))
    rows = rows.withColumn("p", F.lag(F.struct("seq", "dataset_name", "file_name", "mtime")).over(order)).where("p is not null")
    return rows.select("series", "seq", F.col("p.seq").alias("prev_seq"), "dataset_name", "file_name", "mtime", *(F.col(f"p.{c}").alias(f"prev_{c}") for c in ("dataset_name", "file_name", "mtime")))


def preview_pairs(files: DataFrame) -> DataFrame:
    """Per series, the first pair of neighbouring directories that both have a valid file."""
    order = Window.partitionBy(*SERIES).orderBy("seq")
    known = latest_files(files).select(*SERIES, "seq", "file_name")
    rows = roots(files).join(known, [*SERIES, "seq"], "left").withColumn("p", F.lag(F.struct("seq", "file_name")).over(order))
    good = rows.where("file_name is not null and p.file_name is not null")
    return good.groupBy(*SERIES).agg(F.min_by(F.struct("seq", "file_name", F.col("p.seq").alias("prev_seq"), F.col("p.file_name").alias("prev_file_name")), "seq").alias("f")).select(*SERIES, "f.*")


def duplicates(members: DataFrame) -> DataFrame:
    """Sequence numbers that more than one member of a series has."""
    return members.groupBy(*SERIES, "seq").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("file_name")).alias("file_names")).where("n > 1")


def range_audit(files: DataFrame, skipped: DataFrame, start: int, stop: int) -> DataFrame:
    """Every wanted number of every series: skipped, admitted, missing (no directory) or unresolved (no valid file)."""
    low, high = min(start, stop), max(start, stop)
    wanted = files.select(*SERIES).distinct().withColumn("seq", F.explode(F.sequence(F.lit(low), F.lit(high))))
    there = roots(files).select(*SERIES, "seq", F.lit(True).alias("has_root"))
    good = latest_files(files).select(*SERIES, "seq", F.lit(True).alias("has_file"))
    rows = wanted.join(there, [*SERIES, "seq"], "left").join(good, [*SERIES, "seq"], "left").join(skipped.select("seq", F.lit(True).alias("is_skipped")), "seq", "left")
    status = F.when(F.col("is_skipped"), "skipped").when(F.col("has_file"), "admitted").when(F.col("has_root").isNull(), "missing").otherwise("unresolved")
    return rows.select(*SERIES, "seq", status.alias("status"))


def used_members(pairs: DataFrame) -> DataFrame:
    """The members that take part in any pair."""
    return pairs.select(*SERIES, "seq").union(pairs.select(*SERIES, F.col("prev_seq").alias("seq"))).distinct()


def baseline_pair(pairs: DataFrame) -> DataFrame:
    """The first pair of each series."""
    return pairs.groupBy(*SERIES).agg(F.min_by(F.struct("seq", "prev_seq"), "seq").alias("p")).select(*SERIES, "p.*")


def newest_member(members: DataFrame, by: list[str]) -> DataFrame:
    """The member with the highest (seq, mtime, name) of each group."""
    best = F.max_by(F.struct("seq", "dataset_name", "file_name", "mtime"), F.struct("seq", "mtime", "dataset_name"))
    return members.groupBy(*by).agg(best.alias("m")).select(*by, "m.*")


def numbered(members: DataFrame) -> DataFrame:
    """Members with frame_index 1..N within their series, by sequence number."""
    order = Window.partitionBy(*SERIES).orderBy("seq")
    return members.withColumn("frame_index", F.row_number().over(order))


def picked(members: DataFrame, seq: int | None = None) -> DataFrame:
    """Per series, the member of that number, or the first; an error if no series has it."""
    if seq is None:
        first = F.min_by(F.struct("seq", "dataset_name", "file_name"), "seq")
        return members.groupBy(*SERIES).agg(first.alias("m")).select(*SERIES, "m.*")
    found = members.where(F.col("seq") == seq).select(*SERIES, "seq", "dataset_name", "file_name")
    if found.isEmpty():
        raise ValueError(f"no selected reconstruction #{seq:04d}")
    return found


def with_readability(files: DataFrame, known: DataFrame, key: tuple[str, ...] = ("path", "mtime", "length")) -> DataFrame:
    """files with known (the same path, time and size was readable before) and readable (known, or valid now).

    A file that has changed has another key and counts by its own validity; failures are never remembered.
    """
    before = known.select(*key).distinct().withColumn("known", F.lit(True))
    rows = files.join(before, list(key), "left").withColumn("known", F.coalesce("known", F.lit(False)))
    return rows.withColumn("readable", F.col("known") | F.coalesce("valid", F.lit(False)))


def second_targets(references: DataFrame, members: DataFrame, same_position: bool = True) -> DataFrame:
    """For each reference the newest member of its series (or collection) that is not older, itself perhaps."""
    by = SERIES if same_position else ["collection"]
    newest = newest_member(members, by).drop("mtime")
    newest = newest.withColumnsRenamed({c: f"target_{c}" for c in ("seq", "dataset_name", "file_name")})
    rows = references.select(*SERIES, "seq", "dataset_name", "file_name").join(newest, by)
    return rows.where(F.col("target_seq") >= F.col("seq"))


def not_older(seq: Column, chosen: Column) -> Column:
    """The chosen target's number; an error if it is older than the reference."""
    wrong = F.format_string("comparison #%04d is older than reference #%04d", chosen, seq)
    return F.when(chosen >= seq, chosen).otherwise(F.raise_error(wrong).cast("int"))
