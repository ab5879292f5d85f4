"""Discovery and readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import sample_id, sibling, stem
from ..functions.vectorized import sample_share
from .json_pieces import index_pieces, task_pieces

TRAJECTORY_SCHEMA = (
    "sample_id string, frame_index int, fps float, image_height int, image_width int, "
    "intrinsics array<float>, camera_extrinsics array<float>, "
    "left_pose array<float>, right_pose array<float>, "
    "left_joint_position array<float>, right_joint_position array<float>, "
    "left_reachable boolean, right_reachable boolean, left_collision boolean, right_collision boolean, "
    "left_position_error float, right_position_error float, "
    "left_orientation_error float, right_orientation_error float, "
    "left_gripper_signal float, right_gripper_signal float"
)

TASK_ENTRY = (
    "struct<status:string,payload:string,artifacts:array<string>,temp_artifacts:array<string>,attempts:int,"
    "created_at:string,updated_at:string,last_error:string,worker:string,started_at:string,"
    "completed_at:string,summary:string>"
)


def _listing(spark: SparkSession, root: str, glob: str, recursive: bool = True) -> DataFrame:
    """Paths, sizes and times below a root; file contents are pruned and never read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "length", "modificationTime")
    )
    return files.withColumn("path", F.regexp_replace("path", "^file:/*", "/"))


def list_clips(spark: SparkSession, root: str, data_ext: str = ".pose3d_hand", glob: str = "*.mp4") -> DataFrame:
    """All videos below ``root`` with their id (base name) and sibling data path."""
    name = F.element_at(F.split("path", "/"), -1)
    return _listing(spark, root, glob).select(
        F.regexp_replace(name, r"\.mp4$", "").alias("sample_id"),
        F.col("path").alias("video_path"),
        sibling(F.col("path"), ".mp4", data_ext).alias("data_path"),
        "length",
        "modificationTime",
    )


def list_pairs(
    spark: SparkSession,
    root: str,
    annotation_glob: str = "*.hdf5",
    video_ext: str = ".mp4",
    strict: bool = True,
    recursive: bool = True,
) -> DataFrame:
    """Annotations with the video of the same stem beside them, by path.

    ``strict`` raises on an annotation without a video, otherwise it is dropped.
    """
    ann = _listing(spark, root, annotation_glob, recursive).select(
        stem(F.col("path")).alias("_stem"), F.col("path").alias("data_path")
    )
    vid = _listing(spark, root, "*" + video_ext, recursive).select(
        stem(F.col("path")).alias("_stem"), F.col("path").alias("video_path")
    )
    if strict:
        lonely = ann.join(vid, "_stem", "left_anti").limit(1).collect()
        if lonely:
            raise FileNotFoundError(f"no video beside {lonely[0]['data_path']}")
    return ann.join(vid, "_stem").drop("_stem").orderBy("data_path")


def scan_catalog(
    catalog: DataFrame,
    dataset: str | None = None,
    required: str | None = None,
    flag: str | None = "multi_hand_flag",
    flag_value: bool | None = False,
    path: str = "path",
    data: str | None = None,
    data_ext: str = ".pose3d_hand",
    tail: int | None = None,
    visualize: float = 0.0,
    algo: str = "md5",
) -> DataFrame:
    """Clips of a catalog table: filters, id, data path and visualize flag.

    Rows with an empty path are dropped; the data path is the column when it is
    filled, else the sibling of the video. Filters and columns reach the source.
    """
    df = catalog
    if dataset is not None:
        df = df.filter(F.col("dataset_name") == dataset)
    if required:
        df = df.filter(F.col(required).isNotNull())
    if flag:
        want = F.lit(None).cast("boolean") if flag_value is None else F.lit(flag_value)
        df = df.filter(F.col(flag).eqNullSafe(want))
    df = df.filter(F.length(path) > 0)
    own = F.nullif(F.col(data), F.lit("")) if data else F.lit(None).cast("string")
    sid = sample_id(F.col(path), tail)
    if visualize <= 0.0 or visualize >= 1.0:
        show: Column = F.lit(visualize >= 1.0)
    else:
        show = sample_share(F.col("sample_id"), algo) < visualize
    return df.select(
        sid.alias("sample_id"),
        F.col(path).alias("video_path"),
        F.coalesce(own, sibling(F.col(path), ".mp4", data_ext)).alias("data_path"),
    ).withColumn("visualize", show)


_ENTRY = "struct<sample_id:string,sample_ids:array<string>>"


def read_index(spark: SparkSession, path: str, document: bool = False) -> DataFrame:
    """Index files: ``pos, sample_id`` in order, single ids before the list of their entry.

    Lines are read apart, so a published index of any size splits over tasks. A line holds
    one entry or a list of them; brackets and commas around the lines of a list may stand
    alone. A file with any other line, such as an indented one, is read as one document,
    which splits over tasks at its commas; it is an error if that is no JSON text to its
    end. ``document`` reads every file so without trying its lines. ``pos`` is
    ``(file, entry, listed, n)``: entries in their order, single ids before lists.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    odd = lines.where(_unread("value")).select("file").distinct()
    pieces = index_pieces(spark, path, None if document else odd)
    place = F.struct("file", F.col("entry").cast("long").alias("entry"), "listed", F.col("n").cast("long").alias("n"))
    in_pieces = pieces.select(place.alias("pos"), "sample_id")
    if document:
        return in_pieces
    plain = parse_index(lines.join(odd, "file", "left_anti"), keep=("file",))
    in_lines = plain.select(F.struct("file", F.col("pos._entry").alias("entry"), F.lit(False).alias("listed"), F.col("pos._pos").cast("long").alias("n")).alias("pos"), "sample_id")
    return in_lines.unionByName(in_pieces)


def parse_index(lines: DataFrame, column: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Entries of index texts, one or a list of them in each; other texts than lone brackets are an error.

    Columns of ``keep`` come along.
    """
    bad = F.raise_error(F.concat(F.lit("no index entry: "), F.substring(column, 1, 200)))
    entries = F.when(_unread(column), bad.cast(f"array<{_ENTRY}>")).otherwise(_entries(column))
    return index_ids(lines.select(*keep, F.explode(entries).alias("e")).select(*keep, "e.sample_id", "e.sample_ids"), keep)


def _entries(column: str) -> Column:
    """The entries of a text, null where it is not one JSON object or list to its end."""
    doc = _bare(column)
    closed = F.concat(F.lit("["), doc, F.lit("]"))  # what stands behind the first value is not passed over
    lists = F.flatten(F.from_json(closed, f"array<array<{_ENTRY}>>"))
    return F.when(doc.startswith("["), lists).when(doc.startswith("{"), F.from_json(closed, f"array<{_ENTRY}>"))


def _unread(column: str) -> Column:
    """Whether a text is neither an entry nor a list nor a bracket, comma or blank between them."""
    doc = _bare(column)
    return doc.isNotNull() & ~doc.isin("", "[", "]") & _entries(column).isNull()


def _bare(column: str) -> Column:
    """A line without white space and the comma behind it."""
    return F.regexp_replace(F.col(column), r"^\s+|\s*,?\s*$", "")


def read_render_index(spark: SparkSession, path: str, document: bool = False) -> DataFrame:
    """Ids of rendered clips, from a list of ids or from lines with an id each."""
    return parse_render_index(spark.read.text(path, wholetext=document))


def parse_render_index(lines: DataFrame, column: str = "value") -> DataFrame:
    """``sample_id`` of render index texts: ``[id, ...]``, ``"id"`` or ``{"sample_id": id}``."""
    doc = _bare(column)
    one = F.from_json(doc, "struct<sample_id:string>")["sample_id"]
    quoted = F.from_json(F.concat(F.lit("["), doc, F.lit("]")), "array<string>")
    ids = F.when(doc.startswith("["), F.from_json(doc, "array<string>")).when(doc.startswith("{"), F.array(one)).otherwise(quoted)
    return lines.select(F.explode(ids).alias("sample_id")).where(F.length("sample_id") > 0)


def index_ids(entries: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Index entries (``sample_id``, ``sample_ids``) to one row per listed id with its position."""
    single = F.when(F.length("sample_id") > 0, F.array("sample_id")).otherwise(F.array().cast("array<string>"))
    many = F.filter(F.coalesce("sample_ids", F.array().cast("array<string>")), lambda s: F.length(s) > 0)
    seq = entries.withColumn("_entry", F.monotonically_increasing_id())
    return seq.select(*keep, "_entry", F.posexplode(F.concat(single, many)).alias("_pos", "sample_id")).select(
        *keep, F.struct("_entry", "_pos").alias("pos"), "sample_id"
    )


def processed_clips(index: DataFrame, trajectories: DataFrame, meta: DataFrame) -> DataFrame:
    """Indexed ids, first mention kept, that have both data and metadata, joined to the metadata."""
    first = index.groupBy("sample_id").agg(F.min("pos").alias("pos"))
    return first.join(trajectories.select("sample_id"), "sample_id", "left_semi").join(meta, "sample_id")


def read_task_json(spark: SparkSession, path: str) -> DataFrame:
    """Legacy task file ``{"tasks": {id: {...}}}`` to ledger rows; entries that are no objects are skipped.

    The document splits over tasks at the commas between its entries.
    """
    return _task_rows(task_pieces(spark, path).select("sample_id", F.col("entry").alias("_entry")))


def parse_task_json(df: DataFrame, col: str) -> DataFrame:
    """Explode the task map of a JSON text column."""
    raw = F.from_json(F.get_json_object(col, "$.tasks"), "map<string,string>")
    return _task_rows(df.select(F.explode(raw).alias("sample_id", "_entry")))


def _task_rows(entries: DataFrame) -> DataFrame:
    """Ledger rows of (``sample_id``, ``_entry``: its JSON text)."""
    rows = entries.filter(F.col("_entry").startswith("{"))
    e = F.from_json("_entry", TASK_ENTRY)
    rows = rows.withColumn("_e", e)
    stamp = lambda c: F.col("_e")[c].try_cast("timestamp").alias(c)
    return rows.select(
        "sample_id",
        F.coalesce(F.col("_e.status"), F.lit("pending")).alias("status"),
        F.coalesce(F.col("_e.payload"), F.lit("{}")).alias("payload"),
        F.coalesce(F.col("_e.artifacts"), F.array().cast("array<string>")).alias("artifacts"),
        F.coalesce(F.col("_e.temp_artifacts"), F.array().cast("array<string>")).alias("temp_artifacts"),
        F.coalesce(F.col("_e.attempts"), F.lit(0)).alias("attempts"),
        stamp("created_at"),
        stamp("updated_at"),
        F.col("_e.last_error").alias("last_error"),
        F.col("_e.worker").alias("worker"),
        stamp("started_at"),
        stamp("completed_at"),
        F.col("_e.summary").alias("summary"),
    )


def read_trajectories(spark: SparkSession, path: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Trajectory columns; absent optional ones come back NULL, without any joint column it is an error.

    The fixed columns are asked for by their fixed types, so a file without one gives NULL
    and one footer tells what else there is. All footers are read only where that one has no
    joint column.
    """
    fixed = T.StructType.fromDDL(TRAJECTORY_SCHEMA)
    found = spark.read.parquet(path).schema
    have, joints = set(found.names), {"left_joint_position", "right_joint_position"}
    if not joints & have and not joints & set(spark.read.option("mergeSchema", "true").parquet(path).columns):
        raise ValueError("the table has neither left nor right joint positions")
    more = [f for f in found.fields if f.name not in fixed.names]
    df = spark.read.schema(T.StructType([*fixed.fields, *more])).parquet(path)
    return df.select(*(list(cols) if cols is not None else fixed.names))


def read_clip_meta(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """Clip metadata JSON, one object per clip; what is no object is skipped, or an error when strict."""
    df = spark.read.schema(schema + ", _corrupt_record string").json(path)
    good = F.col("_corrupt_record").isNull()
    if strict:
        bad = F.raise_error(F.concat(F.lit("metadata must be a JSON object: "), F.col("_corrupt_record")))
        good = F.when(good, True).otherwise(bad.cast("boolean"))
    return df.filter(good).drop("_corrupt_record")
