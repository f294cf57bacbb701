"""voxelweave: multi-round, multi-channel 3-D image volumes as Spark tables."""

from voxelweave.model import Shape

__all__ = ["Shape"]
