"""Tiled volumes: the Parquet tile table and its voxel view.

A tile is a rectangle of one z plane with its values in raster order. Filters on seq and z reach the
Parquet scan; arithmetic stays on the arrays of tiles, and only voxels that are asked for become rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import few

#: Fixed value: planes, lines and columns that the volumes of a table of vectors are declared with.
SHAPE = (20, 8, 8)
#: Fixed value: members of a series whose tiles share a folder of a store.
SPAN = 128


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def tiles_of_vectors(vectors: DataFrame, depth: int = 20, ny: int = 8, nx: int = 8, series: str = "vectors") -> DataFrame:
    """A volume series from a table of dense vectors: each vector is a plane, depth planes a volume."""
    seq = F.floor(F.col("vec_id") / depth).cast("int")
    return vectors.select(F.lit(series).alias("series"), seq.alias("seq"), (F.col("vec_id") % depth).cast("int").alias("z"), F.lit(0).alias("y0"), F.lit(0).alias("x0"), F.lit(ny).alias("ny"), F.lit(nx).alias("nx"), F.col("embedding").cast("array<float>").alias("data"))


def coordinates(i: Column) -> tuple[Column, Column]:
    """y and x of the value at position i of a tile's data."""
    return (F.col("y0") + F.floor(i / F.col("nx"))).cast("int"), (F.col("x0") + i % F.col("nx")).cast("int")


def voxels(tiles: DataFrame) -> DataFrame:
    """(series, seq, z, y, x, v) rows."""
    y, x = coordinates(F.col("i"))
    return tiles.select("*", F.posexplode("data").alias("i", "v")).select("series", "seq", "z", y.alias("y"), x.alias("x"), "v")


def tiles(voxel_rows: DataFrame, tile_y: int = 256, tile_x: int = 256) -> DataFrame:
    """Voxel rows as tiles of at most tile_y by tile_x; each tile has to be complete."""
    at = voxel_rows.withColumns({"ty": F.floor(F.col("y") / tile_y).cast("int"), "tx": F.floor(F.col("x") / tile_x).cast("int")})
    made = at.groupBy("series", "seq", "z", "ty", "tx").agg(F.min("y").alias("y0"), F.min("x").alias("x0"), (F.max("y") - F.min("y") + 1).alias("ny"), (F.max("x") - F.min("x") + 1).alias("nx"), F.array_sort(F.collect_list(F.struct("y", "x", "v"))).alias("cells"))
    data = F.transform("cells", lambda c: c["v"].cast("float"))
    return made.select("series", "seq", "z", "y0", "x0", "ny", "nx", data.alias("data"))


def shapes(tile_rows: DataFrame) -> DataFrame:
    """Shape and completeness of each volume, from tile metadata alone."""
    out = tile_rows.groupBy("series", "seq").agg((F.max("z") + 1).alias("nz"), F.max(F.col("y0") + F.col("ny")).alias("ny"), F.max(F.col("x0") + F.col("nx")).alias("nx"), F.sum(F.col("ny").cast("bigint") * F.col("nx")).alias("voxels"))
    return out.withColumn("complete", F.col("voxels") == F.col("nz").cast("bigint") * F.col("ny") * F.col("nx"))


def declared(tile_rows: DataFrame, shape: tuple[int, int, int] = SHAPE) -> DataFrame:
    """Shape of each volume as its series declares it, whether or not all planes are there (``shapes`` counts those that are)."""
    extents = [F.lit(n).alias(c) for c, n in zip(("nz", "ny", "nx"), shape, strict=True)]
    return tile_rows.select("series", "seq").distinct().select("series", "seq", *extents)


def write_tiles(tile_rows: DataFrame, path: str, compression: str = "gzip") -> None:
    """The tile table, by volume; z stays sorted within files, so that plane filters skip row groups."""
    tile_rows.repartition("series", "seq").sortWithinPartitions("series", "seq", "z", "y0", "x0").write.partitionBy("seq").option("compression", compression).parquet(path)


def volumes_of_vectors(vectors: DataFrame, series: list[str], depth: int = 20, ny: int = 8, nx: int = 8) -> DataFrame:
    """Like ``tiles_of_vectors``, with the volumes dealt to several series in turn."""
    rows, n = tiles_of_vectors(vectors, depth, ny, nx), len(series)
    name = F.element_at(F.array(*map(F.lit, series)), F.col("seq") % n + 1)
    return rows.withColumns({"series": name, "seq": F.floor(F.col("seq") / n).cast("int")})


def crop_tiles(tile_rows: DataFrame, z: tuple[int, int] | None = None, y: tuple[int, int] | None = None, x: tuple[int, int] | None = None) -> DataFrame:
    """The part of the tiles within [start, stop) of each axis, in coordinates counted from the crop's start.

    Arrays are cut, no voxel becomes a row; bounds on z are a filter that the scan takes.
    """
    if z:
        tile_rows = tile_rows.where((F.col("z") >= z[0]) & (F.col("z") < z[1])).withColumn("z", F.col("z") - z[0])

    def bounds(first: str, n: str, axis: tuple[int, int] | None) -> tuple[Column, Column]:
        """Within the tile: where the part starts, and its extent."""
        if not axis:
            return F.lit(0), F.col(n)
        start = F.greatest(F.lit(axis[0]) - F.col(first), F.lit(0))
        return start, F.least(F.lit(axis[1]) - F.col(first), F.col(n)) - start

    if not y and not x:
        return tile_rows
    (top, high), (left, wide) = bounds("y0", "ny", y), bounds("x0", "nx", x)
    rows = tile_rows.withColumns({"_top": top, "_high": high, "_left": left, "_wide": wide}).where("_high > 0 and _wide > 0")
    # a filter on the arrays may be tried before the one above, so tiles beside the crop give empty ones
    each = F.sequence(F.lit(0), F.greatest(F.col("_high"), F.lit(1)) - 1)
    lines = F.transform(each, lambda i: F.slice("data", ((F.col("_top") + i) * F.col("nx") + F.col("_left") + 1).cast("int"), F.greatest(F.col("_wide"), F.lit(0))))
    at = {"y0": F.col("y0") + F.col("_top") - (y[0] if y else 0), "x0": F.col("x0") + F.col("_left") - (x[0] if x else 0)}
    cut = rows.withColumns({"data": F.flatten(lines), **at})
    return cut.withColumns({"ny": F.col("_high"), "nx": F.col("_wide")}).select(*tile_rows.columns)


def write_store(tile_rows: DataFrame, path: str, table: str, buckets: int = 64, compression: str = "gzip") -> None:
    """A tile store: partitioned by spans of members (span: seq over SPAN), bucketed by the place of tiles within a volume.

    All members hold a place in the same bucket, so differences of members need no exchange; a choice of members
    prunes folders (``of_members``), and files are sorted by member. A span has one file for each bucket at most, so
    files do not grow in number with members as such.
    """
    rows = tile_rows.withColumn("span", F.floor(F.col("seq") / SPAN).cast("int")).repartition(buckets, "z", "y0", "x0")
    writer = rows.write.format("parquet").partitionBy("series", "span").bucketBy(buckets, "z", "y0", "x0").sortBy("seq", "z", "y0", "x0")
    writer.option("path", path).option("compression", compression).saveAsTable(table)


def of_members(tile_rows: DataFrame, members: DataFrame) -> DataFrame:
    """Tiles of the members (series, seq); a catalog that is small is broadcast, and prunes the store's folders when the query runs."""
    some = members.where("seq >= 0").select("series", "seq").distinct()  # folders are pruned by filtered tables only
    if "span" not in tile_rows.columns:
        return tile_rows.join(few(some), ["series", "seq"])
    return tile_rows.join(few(some.withColumn("span", F.floor(F.col("seq") / SPAN).cast("int"))), ["series", "span", "seq"]).drop("span")
