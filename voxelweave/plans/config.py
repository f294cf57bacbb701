"""Run configuration: required keys, defaults and cross checks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from voxelweave.model import Shape

# Required configuration keys and defaults.
REQUIRED = ("working_directory", "voxel_spacing", "downsample_factors", "block_size")
REQUIRED_SECTIONS = {
    "registration": ("merge_strategy", "channels"),
    "segmentation": ("channel", "downsample_for_processing", "upsample_results"),
    "data": ("reference_round", "rounds"),
    "cluster_config": ("cluster_type", "n_workers", "threads_per_worker", "memory_limit"),
}
SEGMENTATION_CLUSTER_KEYS = ("n_workers", "threads_per_worker", "memory_limit")
CHUNK_DEFAULTS = {
    "downsample_factors": (1, 3, 3),
    "interpolation_method": "linear",
    "block_size": (512, 512, 512),
    "overlap": 0.3,
}


@dataclass(frozen=True)
class RunConfig:
    working_directory: str
    voxel_spacing: tuple[float, float, float]
    registration_factors: tuple[float, float, float]
    segmentation_factors: tuple[float, float, float]
    block: Shape
    merge_strategy: str
    registration_channels: tuple[str, ...]
    segmentation_channel: str
    downsample_for_segmentation: bool
    upsample_results: bool
    reference_round: str
    rounds: dict[str, dict[str, str]]
    cluster: dict = field(default_factory=dict)
    segmentation_cluster: dict = field(default_factory=dict)
    chunk_alignment: dict = field(default_factory=dict)

    @property
    def moving_rounds(self) -> list[str]:
        return [r for r in self.rounds if r != self.reference_round]


def _require(section: dict, keys, where: str = "") -> None:
    for key in keys:
        if key not in section:
            raise ValueError(f"configuration lacks {where}{key}")


def validate_config(config: dict) -> RunConfig:
    """Checked configuration; raises ``ValueError`` naming the first missing key."""
    _require(config, REQUIRED)
    _require(config, REQUIRED_SECTIONS)
    for name, keys in REQUIRED_SECTIONS.items():
        _require(config[name], keys, f"{name}.")
    factors = config["downsample_factors"]
    if isinstance(factors, dict):
        _require(factors, ("registration", "segmentation"), "downsample_factors.")
        registration, segmentation = tuple(factors["registration"]), tuple(factors["segmentation"])
    else:
        registration = segmentation = tuple(factors)
    data = config["data"]
    if data["reference_round"] not in data["rounds"]:
        raise ValueError(f"data.rounds has no {data['reference_round']!r}, the reference round")
    seg_cluster = config.get("segmentation_cluster_config")
    if seg_cluster is None:
        seg_cluster = dict(config["cluster_config"])
    else:
        _require(seg_cluster, SEGMENTATION_CLUSTER_KEYS, "segmentation_cluster_config.")
    reg, seg = config["registration"], config["segmentation"]
    return RunConfig(
        working_directory=str(config["working_directory"]),
        voxel_spacing=tuple(float(v) for v in config["voxel_spacing"]),
        registration_factors=registration,
        segmentation_factors=segmentation,
        block=Shape(*(int(v) for v in config["block_size"])),
        merge_strategy=reg["merge_strategy"],
        registration_channels=tuple(reg["channels"]),
        segmentation_channel=seg["channel"],
        downsample_for_segmentation=bool(seg["downsample_for_processing"]),
        upsample_results=bool(seg["upsample_results"]),
        reference_round=data["reference_round"],
        rounds={r: dict(c) for r, c in data["rounds"].items()},
        cluster=dict(config["cluster_config"]),
        segmentation_cluster=seg_cluster,
        chunk_alignment={**CHUNK_DEFAULTS, **reg.get("chunk_alignment", {})},
    )


def rounds_table(spark: SparkSession, config: RunConfig) -> DataFrame:
    """``round, channel, round_ord, channel_ord, path`` for the run plan."""
    rows = [
        (r, c, i, j, path)
        for i, (r, channels) in enumerate(config.rounds.items())
        for j, (c, path) in enumerate(channels.items())
    ]
    return spark.createDataFrame(rows, "round string, channel string, round_ord bigint, channel_ord bigint, path string")
