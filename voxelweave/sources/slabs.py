"""Raw slabs as a Spark data source whose partitions are byte ranges cut along the blocks.

A slab file holds whole slices in C order, little endian. A band is one layer of blocks: the lines ``y0 .. y0 + ny`` of the
slices ``z0 .. z0 + nz``. Its bytes lie in one range per slice, in one file or several, and a task reads just these ranges
and cuts them into finished blocks. So a file may be larger than a row or a task can hold, a block may span
files, and no shuffle is needed. Filters on round, channel and the place of a band choose bands before any byte is read.

Bytes are read through Arrow's file systems (local, HDFS, S3, GCS), as Spark offers tasks no ranged reads of its own.
"""

from __future__ import annotations

import json
import operator
import posixpath
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlsplit

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import types as T

from voxelweave.model import BLOCK_SCHEMA, Shape

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
#: Bytes of raw data that a task reads at most, unless one band is larger.
PARTITION_BYTES = 64 << 20

# Spelled out, as workers have no session that could parse the text.
_TYPES = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
_ARROW = pa.schema([(name, _TYPES[kind]) for name, kind in (field.split() for field in BLOCK_SCHEMA.split(", "))])
_COMPARE = {
    ds.EqualTo: operator.eq,
    ds.GreaterThan: operator.gt,
    ds.GreaterThanOrEqual: operator.ge,
    ds.LessThan: operator.lt,
    ds.LessThanOrEqual: operator.le,
    ds.In: lambda value, among: value in among,
    ds.IsNotNull: lambda value, _: True,
}
_BAND_COLUMNS = ("round", "channel", "bz", "by", "z0", "y0")


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system for a path as Spark writes it, and the path within."""
    scheme = urlsplit(path).scheme
    if scheme in ("", "file"):
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    base, rest = path.split("://", 1)
    found, inner = fs.FileSystem.from_uri(f"{base}://{quote(rest, safe='/:@')}")
    return found, unquote(inner)


def list_slabs(spark: SparkSession, path: str, plane: int) -> list[tuple[str, int, int]]:
    """``(path, z0, nz)`` of the files of a volume, in the order of the number before their extension.

    ``path`` is anything that Spark can list (file, folder, pattern). Each file starts where the one before it ends, whatever
    the numbers are. A file without a number, two files of one number, and a file that is not made of whole slices are errors.
    """
    found = []
    for name, length in spark.read.format("binaryFile").load(path).select("path", "length").collect():
        number = re.search(r"(\d+)\.[^./]*$", name)
        if number is None:
            raise ValueError(f"no slice number in {name}")
        if length % plane:
            raise ValueError(f"not whole slices: {name}")
        found.append((int(number[1]), name, length // plane))
    out, z0, last = [], 0, None
    for number, name, nz in sorted(found):
        if number == last:
            raise ValueError(f"slice number used twice: {name}")
        out.append((name, z0, nz))
        z0, last = z0 + nz, number
    return out


class Bands(ds.InputPartition):
    """Bands ``(bz, by)`` of one volume and the slabs ``(path, z0, nz)`` that hold their slices."""

    def __init__(self, round_name: str, channel: str, bands: list[tuple[int, int]], slabs: list[tuple[str, int, int]]):
        self.round, self.channel, self.bands, self.slabs = round_name, channel, bands, slabs


class RawSlabs(ds.DataSource):
    """``format("raw_slabs")``: options ``volumes`` (JSON list of round, channel, slabs), ``shape``, ``block``, ``dtype``, ``partition_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "raw_slabs"

    def schema(self) -> str:
        return BLOCK_SCHEMA

    def reader(self, schema: T.StructType) -> "RawSlabReader":
        return RawSlabReader(self.options)


class RawSlabReader(ds.DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.volumes = json.loads(options["volumes"])
        self.shape, self.block = Shape(*json.loads(options["shape"])), Shape(*json.loads(options["block"]))
        self.dtype = np.dtype(options["dtype"]).newbyteorder("<")
        self.partition_bytes = int(options["partition_bytes"])
        self.taken: list[ds.Filter] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:
        """Takes comparisons of columns that are the same for a whole band; they then hold exactly."""
        for f in filters:
            if type(f) in _COMPARE and len(f.attribute) == 1 and f.attribute[0] in _BAND_COLUMNS:
                self.taken.append(f)
            else:
                yield f

    def _wanted(self, round_name: str, channel: str, bz: int, by: int) -> bool:
        values = (round_name, channel, bz, by, bz * self.block.nz, by * self.block.ny)
        band = dict(zip(_BAND_COLUMNS, values))
        return all(_COMPARE[type(f)](band[f.attribute[0]], getattr(f, "value", None)) for f in self.taken)

    def partitions(self) -> list[Bands]:
        band_bytes = self.block.nz * self.block.ny * self.shape.nx * self.dtype.itemsize
        at_once = max(1, self.partition_bytes // band_bytes)
        layers = -(-self.shape.ny // self.block.ny)
        out = []
        for round_name, channel, slabs in self.volumes:
            depth = min(self.shape.nz, max((z0 + nz for _, z0, nz in slabs), default=0))
            bands = [
                (bz, by)
                for bz in range(-(-depth // self.block.nz))
                for by in range(layers)
                if self._wanted(round_name, channel, bz, by)
            ]
            for i in range(0, len(bands), at_once):
                some = bands[i : i + at_once]
                lo, hi = some[0][0] * self.block.nz, (some[-1][0] + 1) * self.block.nz
                out.append(Bands(round_name, channel, some, [s for s in slabs if s[1] < hi and s[1] + s[2] > lo]))
        return out

    def read(self, partition: Bands | None) -> Iterator[pa.RecordBatch]:
        for bz, by in partition.bands if partition else ():
            origin = (bz * self.block.nz, by * self.block.ny)
            band = self._band(partition.slabs, *origin)
            rows = []
            for bx in range(-(-self.shape.nx // self.block.nx)):
                x0 = bx * self.block.nx
                part = band[:, :, x0 : x0 + self.block.nx]
                key = (partition.round, partition.channel, bz, by, bx, *origin, x0)
                rows.append((*key, *part.shape, self.dtype.name, part.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    def _band(self, slabs: list[tuple[str, int, int]], z0: int, y0: int) -> np.ndarray:
        """The voxels of a band; slices that no file holds stay 0."""
        nz, ny = min(self.block.nz, self.shape.nz - z0), min(self.block.ny, self.shape.ny - y0)
        band = np.zeros((nz, ny, self.shape.nx), self.dtype)
        line = self.shape.nx * self.dtype.itemsize
        for path, first, n in slabs:
            lo, hi = max(first, z0), min(first + n, z0 + nz)
            if lo >= hi:
                continue
            system, inner = file_system(path)
            with system.open_input_file(inner) as file:
                # Lines of all of y follow each other across slices; else each slice has a range of its own.
                step = hi - lo if ny == self.shape.ny else 1
                for z in range(lo, hi, step):
                    data = file.read_at(step * ny * line, ((z - first) * self.shape.ny + y0) * line)
                    if len(data) != step * ny * line:
                        raise OSError(f"{path} is shorter than when it was listed")
                    band[z - z0 : z - z0 + step] = np.frombuffer(data, self.dtype).reshape(step, ny, self.shape.nx)
        return band


def read_slabs(
    spark: SparkSession, volumes: list[tuple[str, str, list[tuple[str, int, int]]]], shape: Shape, block: Shape,
    dtype: str = "uint16", partition_bytes: int = PARTITION_BYTES,
) -> DataFrame:
    """Blocks of the listed ``(round, channel, slabs)`` volumes; slices beyond ``shape`` are not read.

    Turns on the session's filter push-down for Python sources, which the source needs.
    """
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(RawSlabs)
    options = {
        "volumes": json.dumps(volumes), "shape": json.dumps([*shape]), "block": json.dumps([*block]),
        "dtype": dtype, "partition_bytes": str(partition_bytes),
    }
    return spark.read.format("raw_slabs").options(**options).load()


def slab_writer(folder: str, dtype: str):
    """A ``mapInArrow`` function: sorted strips ``round, channel, slab, data`` of whole slabs become files, one row each.

    A file is streamed under a hidden name and renamed when complete, so a task that is run again or twice leaves one whole file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        system, base = file_system(folder)
        key, out, hidden, length, done = None, None, None, 0, []

        def finish() -> None:
            if key is not None:
                out.close()
                path = posixpath.join(base, key[0], key[1], f"slab_{key[2]:06d}.raw")
                system.move(hidden, path)
                done.append((*key, path, length, dtype))

        for batch in batches:
            for row in batch.to_pylist():
                at = (row["round"], row["channel"], row["slab"])
                if at != key:
                    finish()
                    key, length = at, 0
                    system.create_dir(posixpath.join(base, at[0], at[1]), recursive=True)
                    hidden = posixpath.join(base, at[0], at[1], f".{uuid.uuid4().hex}.part")
                    out = system.open_output_stream(hidden)
                out.write(row["data"])
                length += len(row["data"])
        finish()
        names = ["round", "channel", "slab", "path", "length", "dtype"]
        if done:
            yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*done)))))

    return write
