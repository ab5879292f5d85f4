"""Writers and publish jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.readers import TRAJECTORY_SCHEMA


def to_trajectory_schema(df: DataFrame) -> DataFrame:
    """The fixed 21 columns in order and type; absent columns are NULL, non-finite values too."""
    out: list[Column] = []
    for part in TRAJECTORY_SCHEMA.split(", "):
        name, kind = part.strip().split(" ", 1)
        c = F.col(name) if name in df.columns else F.lit(None)
        if kind == "float":
            c = F.when(F.abs(c.cast("double")) < float("inf"), c)
        elif kind == "array<float>":
            c = F.transform(c.cast("array<double>"), lambda v: F.when(F.abs(v) < float("inf"), v))
        out.append(c.cast(kind).alias(name))
    return df.select(*out)


def write_trajectories(
    df: DataFrame, path: str, compression: str = "snappy", buckets: int = 0, mode: str = "overwrite"
) -> None:
    """Write the trajectory table.

    A clip per file would mean millions of small files: rows are grouped by a hash
    bucket of the id and a block of frames, so a very long clip spreads over tasks.
    """
    fixed = to_trajectory_schema(df)
    if buckets:
        fixed = fixed.withColumn("bucket", F.pmod(F.xxhash64("sample_id"), F.lit(int(buckets))).cast("int"))
        fixed = fixed.repartition("bucket", F.expr("frame_index div 65536"))
        fixed = fixed.sortWithinPartitions("bucket", "sample_id", "frame_index")
        fixed.write.mode(mode).partitionBy("bucket").option("compression", compression).parquet(path)
    else:
        fixed.write.mode(mode).option("compression", compression).parquet(path)


def sorted_keys(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in sorted(df.columns)])


def write_clip_meta(df: DataFrame, path: str, now: Column | None = None, mode: str = "overwrite") -> None:
    """Clip metadata as JSON lines with sorted keys and a UTC ``updated_at``."""
    stamp = now if now is not None else F.current_timestamp()
    text = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    sorted_keys(df.withColumn("updated_at", text)).write.mode(mode).option("ignoreNullFields", "false").json(path)


def pick_fields(df: DataFrame, include: Sequence[str] | None = None) -> DataFrame:
    """The chosen columns; a chosen column that is missing is NULL."""
    if include is None:
        return df
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in include])


def as_json(df: DataFrame, include: Sequence[str] | None = None) -> DataFrame:
    """One JSON text per row in ``value``, NULL fields included."""
    some = pick_fields(df, include)
    return some.select(F.to_json(F.struct(*some.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_json(df: DataFrame, path: str, include: Sequence[str] | None = None, mode: str = "overwrite") -> None:
    """Chosen columns as JSON lines."""
    as_json(df, include).write.mode(mode).text(path)


def publishable(tasks: DataFrame, trajectories: DataFrame, meta: DataFrame, root: str) -> DataFrame:
    """Ids of all completed tasks that have data and metadata, with the output root."""
    done = tasks.filter(F.col("status") == "completed").select("sample_id")
    some = done.join(trajectories.select("sample_id"), "sample_id", "left_semi")
    return some.join(meta.select("sample_id"), "sample_id", "left_semi").withColumn("output_dir", F.lit(root))


def index_entries(published: DataFrame, per_entry: int = 10000) -> DataFrame:
    """Index entries ``{sample_ids, output_dir}`` of bounded size, ids in order within and across entries.

    Written as JSON there is one entry a line, which ``read_index`` reads back line by line.
    """
    ranged = published.repartitionByRange("sample_id").sortWithinPartitions("sample_id")
    at = F.floor(F.monotonically_increasing_id() / F.lit(int(per_entry)))
    return (
        ranged.withColumn("_e", at)
        .groupBy("_e", "output_dir")
        .agg(F.sort_array(F.collect_list("sample_id")).alias("sample_ids"))
        .select("sample_ids", "output_dir")
    )


def publish_index(
    tasks: DataFrame, trajectories: DataFrame, meta: DataFrame, root: str, path: str | None = None
) -> DataFrame:
    """Publish all completed clips; returns the long form and, with ``path``, writes the entries."""
    long = publishable(tasks, trajectories, meta, root)
    if path:
        index_entries(long).write.mode("overwrite").json(path)
    return long


def publish_render_index(tasks: DataFrame, renders: DataFrame, path: str | None = None) -> DataFrame:
    """Completed ids that have a render."""
    done = tasks.filter(F.col("status") == "completed").select("sample_id")
    out = done.join(renders.select("sample_id"), "sample_id", "left_semi")
    if path:
        out.write.mode("overwrite").json(path)
    return out


def update_catalog(catalog: DataFrame, index: DataFrame, meta: DataFrame, render_index: DataFrame) -> DataFrame:
    """Catalog with the outcome of the indexed clips, matched on the video path; other rows untouched.

    ``meta`` maps ``sample_id`` to ``video_path``. Several parts are their union.
    """
    flags = (
        index.select("sample_id")
        .distinct()
        .join(meta.select("sample_id", "video_path"), "sample_id")
        .join(render_index.select("sample_id").distinct().withColumn("_r", F.lit(True)), "sample_id", "left")
        .groupBy(F.col("video_path").alias("path"))
        .agg(F.max(F.coalesce("_r", F.lit(False))).alias("_rendered"))
    )
    return (
        catalog.join(flags, "path", "left")
        .withColumns(
            {
                "has_ik_result": F.when(F.col("_rendered").isNotNull(), True).otherwise(F.col("has_ik_result")),
                "rendered": F.coalesce("_rendered", "rendered"),
            }
        )
        .drop("_rendered")
    )


def write_sweep(ranked: DataFrame, path: str, config: dict, mode: str = "overwrite") -> None:
    """Sweep report: the settings beside every valid result, best first."""
    tagged = ranked.select(F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in sorted(config.items())])).alias("config"), "*")
    tagged.coalesce(1).write.mode(mode).option("ignoreNullFields", "false").json(path)
