"""Raw float volumes as a Spark data source: a file of little-endian values and a JSON header beside it.

    raw.register(spark)
    spark.read.format("raw_volume").option("path", folder).load()         # every *.json header below it
    spark.read.format("raw_volume").option("path", ".../a_0003.json").load()

The header names the data file and the arrays in it:

    {"file": "a_0003.raw", "series": "a", "seq": 3,
     "arrays": [{"key": "/results/data", "shape": [20, 8, 8], "dtype": "f4", "offset": 0}, ...]}

Of the arrays the first in order of their keys that is a volume (three axes of more than one, a numeric type) is
read, or the one that the option ``key`` names, which then has to be one. Rows are tiles (``schema.TILE``), a
plane each, or bands of at most ``lines`` lines. A partition is a range of planes of one file, read by its byte
range; filters on seq and z leave out files and planes before anything is read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from .. import schema

#: Bytes of a partition, about.
PART_BYTES = 64 << 20
#: Types that are numbers, by their kind.
KINDS = "uif"


def _filesystem(path: str):
    """(file system, path in it) of a uri or a local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass(frozen=True)
class Volume:
    """Where a volume lies in its data file."""

    path: str
    series: str
    seq: int
    shape: tuple[int, int, int]
    dtype: str
    offset: int


def is_volume(entry: dict, singletons: bool = False) -> bool:
    """Three axes of more than one (or of one and more), and a numeric type."""
    try:
        kind, shape = np.dtype(entry["dtype"]).kind, [int(n) for n in entry["shape"]]
    except (KeyError, TypeError, ValueError):
        return False
    return kind in KINDS and len(shape) == 3 and all(n > (0 if singletons else 1) for n in shape)


def chosen(header: dict, key: str | None = None) -> dict:
    """The array to read; an error if there is none."""
    entries = [a for a in header.get("arrays", []) if isinstance(a, dict) and "key" in a]
    if key is not None:
        found = [a for a in entries if a["key"] == key]
        if not found or not is_volume(found[0], singletons=True):
            raise ValueError(f"no volume {key} in {header.get('file')}")
        return found[0]
    found = sorted((a for a in entries if is_volume(a)), key=lambda a: a["key"])
    if not found:
        raise ValueError(f"no volume in {header.get('file')}")
    return found[0]


def _volumes(path: str, key: str | None) -> list[Volume]:
    from pyarrow import fs

    system, place = _filesystem(path)
    info = system.get_file_info(place)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    paths = [place] if info.is_file else sorted(f.path for f in system.get_file_info(fs.FileSelector(place, recursive=True)) if f.is_file and f.path.endswith(".json"))
    prefix, found = path[: path.rindex(place)] if place in path else "", []
    for p in paths:
        with system.open_input_stream(p) as f:
            header = json.loads(f.read())
        entry = chosen(header, key)
        folder = p.rsplit("/", 1)[0]
        found.append(Volume(f"{prefix}{folder}/{header['file']}", header["series"], int(header["seq"]), tuple(map(int, entry["shape"])), np.dtype(entry["dtype"]).newbyteorder("<").str, int(entry.get("offset", 0))))
    return found


@dataclass
class Planes(InputPartition):
    """Planes [first, last) of a volume."""

    volume: Volume
    first: int
    last: int


class RawReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.key = options["path"], options.get("key")
        self.lines, self.part_bytes = int(options.get("lines", 1 << 30)), int(options.get("part_bytes", PART_BYTES))
        self.low, self.high = {"seq": None, "z": None}, {"seq": None, "z": None}
        self.among: dict[str, set[int]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes bounds on seq and z, and hands all other filters back."""
        for f in filters:
            column, value = getattr(f, "attribute", None), getattr(f, "value", None)
            column = column[0] if column and len(column) == 1 else None
            if column not in self.low or isinstance(value, bool) or not (isinstance(value, int) or isinstance(f, In)):
                yield f
            elif isinstance(f, In):
                self._among(column, {v for v in value if isinstance(v, int)})
            elif isinstance(f, EqualTo):
                self._among(column, {value})
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                least = value + isinstance(f, GreaterThan)
                self.low[column] = least if self.low[column] is None else max(least, self.low[column])
            elif isinstance(f, (LessThan, LessThanOrEqual)):
                end = value + isinstance(f, LessThanOrEqual)
                self.high[column] = end if self.high[column] is None else min(end, self.high[column])
            else:
                yield f

    def _among(self, column: str, values: set[int]) -> None:
        self.among[column] = self.among.get(column, values) & values

    def _wanted(self, column: str, n: int) -> bool:
        low, high = self.low[column], self.high[column]
        return (low is None or n >= low) and (high is None or n < high) and (column not in self.among or n in self.among[column])

    def partitions(self) -> list[Planes]:
        parts = []
        for v in _volumes(self.path, self.key):
            if not self._wanted("seq", v.seq):
                continue
            each = max(1, self.part_bytes // (v.shape[1] * v.shape[2] * np.dtype(v.dtype).itemsize))
            planes = [z for z in range(v.shape[0]) if self._wanted("z", z)]
            start = 0
            for i in range(1, len(planes) + 1):  # runs of neighbouring planes
                if i == len(planes) or planes[i] != planes[i - 1] + 1 or i - start == each:
                    parts.append(Planes(v, planes[start], planes[i - 1] + 1))
                    start = i
        return parts or [Planes(Volume("", "", 0, (0, 0, 0), "<f4", 0), 0, 0)]

    def read(self, partition: Planes) -> Iterator[pa.RecordBatch]:
        v, (_, ny, nx) = partition.volume, partition.volume.shape
        size = ny * nx * np.dtype(v.dtype).itemsize
        if partition.first == partition.last:
            return
        system, place = _filesystem(v.path)
        with system.open_input_file(place) as f:
            f.seek(v.offset + partition.first * size)
            for z in range(partition.first, partition.last):
                raw = f.read(size)
                if len(raw) < size:
                    raise ValueError(f"{v.path} ends within plane {z}")
                plane = np.frombuffer(raw, v.dtype).astype(np.float32)
                starts = range(0, ny, min(self.lines, ny))
                data = [plane[y * nx : (y + self.lines) * nx] for y in starts]
                n = len(data)
                cols = [[v.series] * n, [v.seq] * n, [z] * n, list(starts), [0] * n, [len(d) // nx for d in data], [nx] * n]
                arrays = [pa.array(cols[0], pa.string()), *(pa.array(c, pa.int32()) for c in cols[1:]), pa.array(data, pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in schema.TILE.split(", ")])


class RawVolumes(DataSource):
    @classmethod
    def name(cls) -> str:
        return "raw_volume"

    def schema(self) -> str:
        return schema.TILE

    def reader(self, schema) -> RawReader:
        return RawReader(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let Spark hand filters to sources in Python (a setting of the session)."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    spark.dataSource.register(RawVolumes)


def write(tiles: DataFrame, path: str, key: str = "/results/data") -> None:
    """Each member of tiles (whole planes) as a raw file with its header below path. A member is one task; a task holds one plane."""

    def member(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, out, count, shape = None, None, 0, None
        for batch in batches:
            for row in batch.to_pylist():
                system, place = _filesystem(f"{path}/{row['series']}_{row['seq']:04d}")
                if here != (row["series"], row["seq"]):
                    if here:
                        _finish(out, here, count, shape, path, key)
                    here, count, shape = (row["series"], row["seq"]), 0, (row["ny"], row["nx"])
                    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
                    out = system.open_output_stream(f"{place}.raw")
                if (row["ny"], row["nx"]) != shape or row["y0"] or row["x0"] or row["z"] != count:
                    raise ValueError(f"{here} has no whole plane {count} of {shape}")
                out.write(np.array(row["data"], "<f4").tobytes())
                count += 1
        if here:
            _finish(out, here, count, shape, path, key)
        yield from ()

    ordered = tiles.repartition("series", "seq").sortWithinPartitions("series", "seq", "z")
    ordered.mapInArrow(member, "done int").count()


def _finish(out, member: tuple[str, int], planes: int, shape: tuple[int, int], path: str, key: str) -> None:
    out.close()
    name = f"{member[0]}_{member[1]:04d}"
    system, place = _filesystem(f"{path}/{name}.json")
    header = {"file": f"{name}.raw", "series": member[0], "seq": member[1], "arrays": [{"key": key, "shape": [planes, *shape], "dtype": "f4", "offset": 0}]}
    with system.open_output_stream(place) as f:
        f.write(json.dumps(header).encode())
