"""Raw slabs by byte ranges: files beyond a row's size, blocks across files, chosen ranges, whole files on retry."""

from __future__ import annotations

import json
import os

import numpy as np
import pytest
from pyspark.sql import datasource as ds

from tests.helpers import array_of, shape_of, texture, voxels_of
from voxelweave.model import Shape
from voxelweave.operators import blocks as bl
from voxelweave.sources import slabs, volumes

BLOCK = Shape(4, 3, 4)


def reader(slab_list, shape, block, partition_bytes=1):
    options = {"volumes": json.dumps([["O", "A", slab_list], ["F", "A", slab_list]]), "shape": json.dumps([*shape]),
               "block": json.dumps([*block]), "dtype": "uint16", "partition_bytes": str(partition_bytes)}
    return slabs.RawSlabReader(options)


def test_slab_larger_than_two_gigabytes(spark, tmp_path):
    """A sparse file; only the ranges of its last layer of blocks are read."""
    shape, path = Shape(1100, 1024, 1024), tmp_path / "slab_0.raw"
    with open(path, "wb") as file:
        file.truncate(shape.size * 2)
        file.seek(((1097 * 1024 + 700) * 1024 + 5) * 2)
        file.write((321).to_bytes(2, "little"))
    assert os.path.getsize(path) > 2**31
    found = volumes.ingest_round(spark, {"A": str(path)}, "r", shape, Shape(64, 64, 64)).filter("z0 >= 1088 and y0 = 640")
    assert bl.to_voxels(found).collect() == [("r", "A", 1097, 700, 5, 321)]


def test_filters_choose_bands():
    slab_list = [["a", 0, 5], ["b", 5, 6]]
    source = reader(slab_list, Shape(11, 7, 9), BLOCK)
    other = ds.StringStartsWith(("dtype",), "uint")
    taken = [ds.EqualTo(("round",), "F"), ds.GreaterThanOrEqual(("z0",), 4), ds.LessThan(("by",), 2), ds.In(("channel",), ("A", "B"))]
    assert list(source.pushFilters([*taken, other, ds.EqualTo(("bx",), 0)])) == [other, ds.EqualTo(("bx",), 0)]
    parts = source.partitions()
    assert [(p.round, p.bands) for p in parts] == [("F", [(z, y)]) for z in (1, 2) for y in (0, 1)]
    assert [[s[0] for s in p.slabs] for p in parts] == [["a", "b"], ["a", "b"], ["b"], ["b"]]


def test_partition_size_does_not_change_blocks(spark, tmp_path):
    array = texture((11, 7, 9))
    for number, (lo, hi) in enumerate(((0, 5), (5, 6), (6, 11))):
        (tmp_path / f"s{number}.raw").write_bytes(array[lo:hi].astype("<u2").tobytes())
    listed = slabs.list_slabs(spark, str(tmp_path), 7 * 9 * 2)
    assert [s[1:] for s in listed] == [(0, 5), (5, 1), (6, 5)]
    for size in (1, 300, 1 << 20):
        blocks = slabs.read_slabs(spark, [("O", "A", listed)], shape_of(array), BLOCK, partition_bytes=size)
        assert blocks.count() == 3 * 3 * 3
        assert np.array_equal(array_of(bl.to_voxels(blocks), array.shape), array)


def test_slices_beyond_the_shape_or_the_files(spark, tmp_path):
    """Slices beyond the shape are not read; blocks without any slice are absent, missing slices of a block are 0."""
    array = texture((5, 3, 4))
    (tmp_path / "s0.raw").write_bytes(array.astype("<u2").tobytes())
    low = volumes.ingest_round(spark, {"A": str(tmp_path)}, "O", Shape(2, 3, 4), BLOCK)
    assert np.array_equal(array_of(bl.to_voxels(low), (2, 3, 4)), array[:2])
    high = volumes.ingest_round(spark, {"A": str(tmp_path)}, "O", Shape(12, 3, 4), BLOCK)
    assert sorted(r["bz"] for r in high.collect()) == [0, 1]
    assert np.array_equal(array_of(bl.to_voxels(high), (12, 3, 4))[:5], array)


def test_file_that_shrinks_after_listing_is_an_error(spark, tmp_path):
    path = tmp_path / "s0.raw"
    path.write_bytes(bytes(5 * 24))
    blocks = volumes.ingest_round(spark, {"A": str(tmp_path)}, "O", Shape(5, 3, 4), BLOCK)
    path.write_bytes(bytes(4 * 24))
    with pytest.raises(Exception, match="shorter than when it was listed"):
        blocks.collect()


@pytest.mark.parametrize("strip_rows", [1, 2, 64])
def test_written_slabs_hold_the_volume(spark, tmp_path, strip_rows):
    """Slabs of a sparse volume are whole; nothing but finished files is left."""
    array = np.zeros((7, 5, 6), dtype=int)
    array[0, 0, 0], array[6, 4, 5] = 7, 9
    blocks = bl.to_blocks(voxels_of(spark, array), shape_of(array), BLOCK)
    listed = volumes.write_raw_slabs(blocks, shape_of(array), str(tmp_path), 3, strip_rows).orderBy("slab").collect()
    assert [(r["slab"], r["length"]) for r in listed] == [(0, 180), (1, 180), (2, 60)]
    folder = tmp_path / "O" / "A"
    assert sorted(n for n in os.listdir(folder) if not n.endswith(".crc")) == [f"slab_{i:06d}.raw" for i in range(3)]
    raw = b"".join((folder / f"slab_{i:06d}.raw").read_bytes() for i in range(3))
    assert np.array_equal(np.frombuffer(raw, "<u2").reshape(array.shape), array)
    again = volumes.ingest_round(spark, {"A": str(folder)}, "O", shape_of(array), BLOCK)
    assert np.array_equal(array_of(bl.to_voxels(again), array.shape), array)
