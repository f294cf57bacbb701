"""NumPy helpers that run inside Spark tasks on one bounded block at a time."""

from __future__ import annotations

import numpy as np


def decode(row) -> np.ndarray:
    """Block row -> array (read only)."""
    return np.frombuffer(row.data, dtype=np.dtype(row.dtype).newbyteorder("<")).reshape(row.nz, row.ny, row.nx)


def encode(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).astype(array.dtype.newbyteorder("<"), copy=False).tobytes()


def block_range(start: int, stop: int, size: int, limit: int, halo: int) -> range:
    """Indices of target blocks whose extent, widened by ``halo``, meets ``[start, stop)``."""
    last = (limit - 1) // size
    return range(max(0, (start - halo) // size), min(last, (stop - 1 + halo) // size) + 1)


def gaussian_weights(sigma: float) -> np.ndarray:
    """Normalised taps, truncated at four sigma."""
    if sigma <= 0:
        return np.ones(1)
    radius = int(4.0 * sigma + 0.5)
    taps = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    return taps / taps.sum()


def smooth(array: np.ndarray, sigma: float) -> np.ndarray:
    """Separable Gaussian of an array that already carries ``radius`` extra voxels per side."""
    taps = gaussian_weights(sigma)
    out = array.astype(np.float64)
    for axis in range(3):
        n = out.shape[axis] - len(taps) + 1
        out = sum(w * np.take(out, np.arange(k, k + n), axis=axis) for k, w in enumerate(taps))
    return out


# Half of the 26-neighbourhood; the other half is covered by symmetry.
FORWARD = [
    (dz, dy, dx)
    for dz in (-1, 0, 1)
    for dy in (-1, 0, 1)
    for dx in (-1, 0, 1)
    if (dz, dy, dx) > (0, 0, 0)
]


def local_components(mask: np.ndarray) -> np.ndarray:
    """26-connected labels 1..n inside one block (0 = background), by minimum-label hooking."""
    mask = np.asarray(mask, dtype=bool)
    ids = np.full(mask.shape, -1, dtype=np.int64)
    ids[mask] = np.arange(int(mask.sum()))
    links = []
    for shift in FORWARD:
        here = tuple(slice(max(0, -d), n - max(0, d)) for d, n in zip(shift, mask.shape))
        there = tuple(slice(max(0, d), n - max(0, -d)) for d, n in zip(shift, mask.shape))
        a, b = ids[here], ids[there]
        both = (a >= 0) & (b >= 0)
        links.append(np.stack([a[both], b[both]]))
    pairs = np.concatenate(links, axis=1) if links else np.empty((2, 0), dtype=np.int64)
    parent = np.arange(int(mask.sum()))
    while pairs.size:
        low = np.minimum(parent[pairs[0]], parent[pairs[1]])
        before = parent.copy()
        for side in pairs:
            np.minimum.at(parent, before[side], low)
            np.minimum.at(parent, side, low)
        parent = parent[parent]
        if np.array_equal(parent, before):
            break
    labels = np.zeros(mask.shape, dtype=np.int64)
    if len(parent):
        labels[mask] = np.unique(parent, return_inverse=True)[1] + 1
    return labels

