"""Names under which configs find the built-in transforms and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.cleaning import add_fields, round_nested
from ..operators.arm import ARM_JOINTS, Chain, Solver
from ..operators.quality import quality_filter
from ..operators.sampling import shard, visualize_flag
from ..sinks.writers import pick_fields, to_trajectory_schema
from ..sources import readers
from .registry import sources, transforms
from .trajectory import Retarget, retarget, solve_trajectories, to_wide


@transforms.register("add_fields")
def _add_fields(fields: dict):
    return lambda df: add_fields(df, fields)


@transforms.register("round_floats")
def _round_floats(float_decimals: int | None = None):
    return lambda df: round_nested(df, float_decimals)


@transforms.register("pick_fields")
def _pick_fields(include_keys: list[str] | None = None):
    return lambda df: pick_fields(df, include_keys)


@transforms.register("retarget")
def _retarget(fps: str | None = None, **params):
    return lambda df: retarget(df, Retarget(**params), fps)


@transforms.register("inverse_kinematics")
def _inverse_kinematics(chain: list[dict] | None = None, **params):
    return lambda df: solve_trajectories(df, Chain.of(chain or ARM_JOINTS), Solver(**params))


@transforms.register("write_data")
def _trajectory_rows():
    """The trajectory table of solved sides; the caller writes it."""
    return lambda df: to_trajectory_schema(to_wide(df))


@transforms.register("render_filter")
def _render_filter(
    reachable_ratio_threshold: float = 0.9,
    collision_ratio_threshold: float = 0.05,
    missing_reachable_ratio_default: float = 1.0,
):
    return lambda df: quality_filter(
        df, reachable_ratio_threshold, collision_ratio_threshold, missing_reachable_ratio_default
    )


def _share(df: DataFrame, ratio: float, num_parts: int, part: int) -> DataFrame:
    return shard(visualize_flag(df, "sample_id", ratio), "sample_id", num_parts, part)


@sources.register("glob")
def _glob(spark: SparkSession, input_dir: str, visualize_ratio: float = 0.0, num_parts: int = 1, part: int = 0):
    return _share(readers.list_clips(spark, input_dir), visualize_ratio, num_parts, part)


@sources.register("egodex")
def _pairs(
    spark: SparkSession, input_dir: str, annotation_glob: str = "*.hdf5", video_extension: str = ".mp4",
    strict_pairing: bool = True, recursive: bool = True, sample_id_tail_parts: int | None = 3,
    visualize_ratio: float = 0.0, num_parts: int = 1, part: int = 0,
):
    from ..functions.keys import sample_id_rel
    from pyspark.sql import functions as F

    pairs = readers.list_pairs(spark, input_dir, annotation_glob, video_extension, strict_pairing, recursive)
    keyed = pairs.withColumn("sample_id", sample_id_rel(F.col("data_path"), input_dir, sample_id_tail_parts))
    return _share(keyed, visualize_ratio, num_parts, part)


@sources.register("database_loader")
def _catalog(spark: SparkSession, table: str, num_parts: int = 1, part: int = 0, **params):
    """Catalog in any table Spark can read by name."""
    return shard(readers.scan_catalog(spark.table(table), **params), "sample_id", num_parts, part)


@sources.register("processed", "processd")
def _processed(spark: SparkSession, index: str, trajectories: str, meta: str, meta_schema: str, num_parts: int = 1, part: int = 0, document: bool = False):
    clips = readers.processed_clips(
        readers.read_index(spark, index, document),
        spark.read.parquet(trajectories).select("sample_id").distinct(),
        readers.read_clip_meta(spark, meta, meta_schema),
    )
    return shard(clips, "sample_id", num_parts, part)
