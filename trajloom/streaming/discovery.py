"""Resume as a stream: new media files become pending tasks, each exactly once.

The file source remembers in its checkpoint what it has seen, which is what the
batch ledger does with its sync: a restart continues with the unseen files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ledger import sync


def stream_clips(spark: SparkSession, root: str, glob: str = "*.mp4", per_trigger: int = 10000) -> DataFrame:
    """Stream of new media files below ``root``; contents are not read."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", str(per_trigger))
        .load(root)
    )
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(F.regexp_replace(name, r"\.mp4$", "").alias("sample_id"), "path")


def sync_stream(
    clips: DataFrame, read: Callable[[], DataFrame], write: Callable[[DataFrame], None], checkpoint: str
):
    """Upsert every micro-batch into the ledger that ``read`` and ``write`` version."""

    def step(batch: DataFrame, _: int) -> None:
        found = batch.select("sample_id", F.to_json(F.struct("sample_id", "path")).alias("payload"))
        write(sync(read(), found, F.current_timestamp()).drop("_sync"))

    return (
        clips.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
