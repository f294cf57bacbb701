"""Block-form paths checked against the same SQL as the voxel form."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxelweave.model import Shape
from voxelweave.operators import block_objects as bo
from voxelweave.operators import blocks as bl
from voxelweave.operators import projections as pr
from voxelweave.operators import registration as rg
from voxelweave.operators import tile_blocks as tb
from voxelweave.operators import transform as tf
from voxelweave.plans.workflow import segment_volume
from voxelweave.queries import geometry, objects, pixels, tiles
from voxelweave.queries.registration import _fixed_moving
from voxelweave.queries.registry import Registry
from voxelweave.queries.volumes import BLOCK, OTHER, as_blocks, one_volume, shape
from voxelweave.sources import fixtures as fx

query = Registry()


def label_blocks(spark, sf):
    rows = fx.labels(spark, sf).withColumnRenamed("label", "value")
    tagged = rows.withColumns({"round": F.lit(fx.REFERENCE_ROUND), "channel": F.lit("labels")})
    return bl.to_blocks(tagged, shape(spark, sf), BLOCK, "int64")


def channel_blocks(spark, sf):
    return as_blocks(spark, sf).filter(F.col("round") == fx.REFERENCE_ROUND)


@query("obj_region_props_blocks", objects.query.oracles["obj_region_props"])
def obj_region_props_blocks(spark, sf):
    props = bo.region_props(label_blocks(spark, sf))
    return props.withColumns({c: F.round(c, 6) for c in ("cz", "cy", "cx")})


@query("mip_dense_blocks", objects.query.oracles["mip_dense"])
def mip_dense_blocks(spark, sf):
    boxes = objects.padded(spark, sf)
    mips = bo.nucleus_mip(label_blocks(spark, sf), channel_blocks(spark, sf), pr.crop_pixels(boxes, objects.CHANNELS))
    return mips.join(boxes.select("label"), "label", "left_semi")


@query("mip_channel_stats_blocks", objects.query.oracles["mip_channel_stats"])
def mip_channel_stats_blocks(spark, sf):
    stats = bo.channel_stats(label_blocks(spark, sf), channel_blocks(spark, sf), objects.nuclei(spark, sf), objects.CHANNELS)
    return stats.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})


def _without_zeros(sql: str) -> str:
    return f"SELECT * FROM ({sql}) WHERE value > 0"


@query("pix_scale_uint16_blocks", _without_zeros(pixels.query.oracles["pix_scale_uint16"]))
def pix_scale_uint16_blocks(spark, sf):
    return bl.to_voxels(bo.scale_to_uint16(as_blocks(spark, sf), shape(spark, sf)))


@query("pix_merge_mean_blocks", _without_zeros(pixels.query.oracles["pix_merge_mean"]))
def pix_merge_mean_blocks(spark, sf):
    return bl.to_voxels(bo.merge_channels(as_blocks(spark, sf), "A", "N", shape(spark, sf)))


@query("pix_merge_max_blocks", _without_zeros(pixels.query.oracles["pix_merge_max"]))
def pix_merge_max_blocks(spark, sf):
    return bl.to_voxels(bo.merge_channels(as_blocks(spark, sf), "A", "N", shape(spark, sf), "max"))


@query("rs_downsample_blocks", geometry.query.oracles["rs_downsample"])
def rs_downsample_blocks(spark, sf):
    return bo.downsample(as_blocks(spark, sf, OTHER), shape(spark, sf), geometry.FACTORS)


@query("obj_segment_volume")
def obj_segment_volume(spark, sf):
    """Downsample, segment, enlarge to the original shape."""
    ext = shape(spark, sf)
    return segment_volume(bl.to_blocks(one_volume(spark, sf), ext, BLOCK), ext, BLOCK, (1, 2, 2), sigma=1.0)


@query("reg_pair")
def reg_pair(spark, sf):
    """Both registration stages of a displaced round; quality before and after."""
    fixed, moved, ext = _fixed_moving(spark, sf)
    steps = [("ransac", {"blob_sizes": (2.0, 4.0), "patch": 2, "n_iter": 200, "tolerance": 1.0})]
    result = rg.run_registration(fixed, moved, ["A"], ext, BLOCK, factors=(1, 1, 1), steps=steps)
    quality = tf.registration_quality(fixed, moved, bl.to_voxels(result["aligned"]), ext)
    return quality.select("stage", F.round("ncc", 6).alias("ncc"), F.round("mi", 6).alias("mi"))


def _tile_blend_blocks(spark, sf, method, normalize):
    vox = fx.tile_voxels(spark, sf).withColumns({"round": F.col("tile").cast("string"), "channel": F.lit("A")}).drop("tile")
    tile_blocks = bl.to_blocks(vox, fx.TILE_SHAPE, Shape(7, 8, 8))
    out = tb.blend(tile_blocks, fx.tiles(spark, sf), Shape(4, 9, 11), Shape(7, 8, 8), method, normalize)
    return bl.to_voxels(out).select("z", "y", "x", "value")


@query("tile_blend_weighted_blocks", _without_zeros(tiles.query.oracles["tile_blend_weighted"]))
def tile_blend_weighted_blocks(spark, sf):
    return _tile_blend_blocks(spark, sf, "weighted_average", True)


@query("tile_blend_max_blocks", _without_zeros(tiles.query.oracles["tile_blend_max"]))
def tile_blend_max_blocks(spark, sf):
    return _tile_blend_blocks(spark, sf, "max", False)


@query("tile_blend_overwrite_blocks", _without_zeros(tiles.query.oracles["tile_blend_overwrite"]))
def tile_blend_overwrite_blocks(spark, sf):
    return _tile_blend_blocks(spark, sf, "overwrite", False)
