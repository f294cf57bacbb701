"""Small-array helpers: volumes as NumPy arrays and as tables."""

from __future__ import annotations

import numpy as np

from voxelweave.model import VOXEL_SCHEMA, Shape


def voxels_of(spark, array: np.ndarray, round_name: str = "O", channel: str = "A"):
    rows = [(round_name, channel, *map(int, at), int(array[at])) for at in zip(*np.nonzero(array))]
    return spark.createDataFrame(rows, VOXEL_SCHEMA)


def array_of(voxels, shape, value: str = "value") -> np.ndarray:
    out = np.zeros(tuple(shape))
    for r in voxels.collect():
        out[r["z"], r["y"], r["x"]] = r[value]
    return out


def shape_of(array: np.ndarray) -> Shape:
    return Shape(*array.shape)


def texture(shape, seed: int = 0) -> np.ndarray:
    """Smooth random intensities with plenty of local structure."""
    rng = np.random.default_rng(seed)
    out = rng.random(shape)
    for axis in range(3):
        out = (np.roll(out, 1, axis) + 2 * out + np.roll(out, -1, axis)) / 4
    out = (out - out.min()) / (out.max() - out.min())
    return (out * 60000 + 1).astype(np.int64)
