"""One JSON document read by many tasks.

A document need not have lines, so it is read as the fragments between its commas, which
Spark deals over tasks by byte ranges like lines. A fragment tells how many quotes it has
and how much deeper it leads, for a start outside of a string and for one inside. Prefix
sums over the ranges of a file, and within each range, say which it is: the number of
quotes before a fragment gives its state, the state its part of the depth. A comma outside
of strings, at a depth that asks for it, ends a piece; fragments of a piece are joined.

No task holds more of a file than a range, and no piece is larger than what lies between
two such commas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A string, or another value up to the end of the structure around it.
VALUE = r'("(?:[^"\\]|\\.)*"|[^\s"\[\]{}:,]+)'
KEY = r'^"((?:[^"\\]|\\.)*)"\s*:'
#: Pieces that one task looks back over.
BLOCK = 8192


def _outside(parts: Column, odd: int) -> Column:
    """The parts between quotes that lie outside of strings, a quote for each string."""
    return F.array_join(F.filter(parts, lambda _, i: i % 2 == odd), '"')


def _depth(outside: Column) -> Column:
    """Structures opened less those closed."""
    count = lambda signs: F.length(outside) - F.length(F.translate(outside, signs, ""))
    return count("[{") - count("]}")


def _before(totals: DataFrame, col: str, by: str, order: str) -> DataFrame:
    """Sum of a column over the earlier rows of a file."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn(col, F.coalesce(F.sum(col).over(w), F.lit(0)))


def json_pieces(spark: SparkSession, path: str, depth: int, files: DataFrame | None = None) -> DataFrame:
    """Pieces of JSON documents: ``file, n, entry, value, begin, depth``.

    A document is cut at the commas outside of strings at ``depth`` or less. ``n`` counts the
    pieces of a file, ``entry`` the commas at depth 1 before them; ``begin`` and ``depth`` are
    the depths around a piece. A string that does not close is an error.
    """
    raw = spark.read.option("lineSep", ",").text(path)
    raw = raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    raw = raw.withColumn("i", F.monotonically_increasing_id())
    raw = raw.join(files, "file", "left_semi") if files is not None else raw
    parts = F.split(F.regexp_replace("value", r"\\.", ""), '"', -1)
    raw = raw.withColumn("_p", parts).select(
        "file", "at", "i", "value", (F.size("_p") - 1).alias("q"), _outside(F.col("_p"), 0).alias("o0"), _outside(F.col("_p"), 1).alias("o1")
    )
    # behind what closes, only a comma or another such sign may stand
    tell = [F.struct(_depth(F.col(o)).alias("d"), F.col(o).rlike(r"[}\]]\s*[^\s,}\]]").alias("bad")).alias(n) for o, n in (("o0", "t0"), ("o1", "t1"))]
    raw = raw.select("file", "at", "i", "value", "q", *tell)
    own = Window.partitionBy("file", "at").orderBy("i")
    upto, before = own.rowsBetween(Window.unboundedPreceding, 0), own.rowsBetween(Window.unboundedPreceding, -1)

    def carried(df: DataFrame, col: str, name: str) -> DataFrame:
        totals = df.groupBy("file", "at").agg(F.sum(col).alias(name))
        return df.join(_before(totals, name, "file", "at"), ["file", "at"])

    quoted = carried(raw, "q", "_q").withColumn("_in", (F.col("_q") + F.coalesce(F.sum("q").over(before), F.lit(0))) % 2)
    deep = quoted.withColumn("_t", F.when(F.col("_in") == 0, F.col("t0")).otherwise(F.col("t1"))).drop("t0", "t1", "_q")
    deep = deep.withColumns({"d": F.col("_t.d"), "bad": F.col("_t.bad")}).drop("_t")
    deep = carried(deep, "d", "_d").withColumn("depth", F.col("_d") + F.sum("d").over(upto))
    outside = (F.col("_in") + F.col("q")) % 2 == 0
    ends = deep.withColumn("cut", (outside & (F.col("depth") <= depth)).cast("int"))
    ends = ends.withColumn("top", (outside & (F.col("depth") <= 1)).cast("int"))
    ends = carried(carried(ends, "cut", "_c"), "top", "_t")
    numbered = ends.select(
        "file", "at", "i", "value", "depth", (F.col("depth") - F.col("d")).alias("begin"), "bad", outside.alias("outside"),
        (F.col("_c") + F.coalesce(F.sum("cut").over(before), F.lit(0))).alias("n"),
        (F.col("_t") + F.coalesce(F.sum("top").over(before), F.lit(0))).alias("entry"),
    )
    run = F.sort_array(F.collect_list(F.struct("at", "i", "value", "begin", "depth", "bad", "outside")))
    pieces = numbered.groupBy("file", "n").agg(run.alias("_r"), F.min("entry").alias("entry"))
    first, last = F.col("_r")[0], F.element_at("_r", -1)
    text = F.array_join(F.col("_r")["value"], ",")
    wrong = ~last["outside"] | F.exists(F.col("_r")["bad"], lambda x: x)
    value = F.when(wrong, F.raise_error(F.concat(F.lit("no JSON document to its end: "), F.col("file"))).cast("string")).otherwise(text)
    return pieces.select("file", "n", "entry", value.alias("value"), first["begin"].alias("begin"), last["depth"].alias("depth"))


def _in_place(p: DataFrame, key: Column) -> DataFrame:
    """Pieces with ``at``, the last ``key`` up to each, and ``top``, whether their file is a list.

    A key and what a file begins and ends with are handed on by blocks of pieces. A file
    that is not one object or list to its end is an error.
    """
    p = p.withColumns({"_key": key, "_blk": F.floor(F.col("n") / BLOCK)})
    known = F.when(F.col("_key").isNotNull(), F.struct("n", "_key"))
    start = F.when(F.col("n") == 0, F.substring(F.ltrim(F.translate("value", "\t\r\n", "   ")), 1, 1))
    facts = p.groupBy("file", "_blk").agg(F.max(known).alias("_k"), F.max(start).alias("_l"), F.max_by("depth", "n").alias("_e"))
    w = Window.partitionBy("file").orderBy("_blk")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    facts = facts.select(
        "file", "_blk", F.last("_k", True).over(w.rowsBetween(Window.unboundedPreceding, -1))["_key"].alias("_kept"),
        F.first("_l", True).over(whole).alias("_top"), F.last("_e").over(whole).alias("_end"),
    )
    own = Window.partitionBy("file", "_blk").orderBy("n")
    bad = F.raise_error(F.concat(F.lit("no JSON document to its end: "), F.col("file"))).cast("string")
    fine = (F.col("_end") == 0) & F.col("_top").isin("[", "{")
    at = F.when(fine, F.coalesce(F.last("_key", True).over(own), "_kept")).otherwise(bad)
    return p.join(facts, ["file", "_blk"]).withColumns({"at": at, "top": F.col("_top") == "["}).drop("_key", "_blk", "_kept", "_top", "_end")


def _string(value: Column) -> Column:
    """The text of a JSON string or other value; null for a null."""
    return F.from_json(F.concat(F.lit("["), value, F.lit("]")), "array<string>")[0]


def index_pieces(spark: SparkSession, path: str, files: DataFrame | None = None) -> DataFrame:
    """Ids of index documents: ``file, entry, listed, n, sample_id``.

    A document is an entry or a list of entries; an entry has ``sample_id``, or a list of
    ``sample_ids`` of any length, whose elements are read by as many tasks as its file.
    """
    p = json_pieces(spark, path, 3, files).withColumn("_b", F.regexp_replace("value", r"^[\s\[{]+", ""))
    held = _in_place(p, F.when(F.col("_b").rlike(KEY), F.regexp_extract("_b", KEY, 1)))
    first = F.regexp_extract(F.regexp_replace(F.regexp_replace("_b", KEY, ""), r"^[\s\[]+", ""), "^" + VALUE, 1)
    out = held.where(F.col("at").isin("sample_id", "sample_ids")).select(
        "file",
        F.when(F.col("top"), F.col("entry")).otherwise(0).alias("entry"),
        (F.col("at") == "sample_ids").alias("listed"),
        "n",
        F.when(first != "", _string(first)).alias("sample_id"),
    )
    return out.where(F.length("sample_id") > 0)


def task_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Entries of task documents ``{"tasks": {id: entry, ...}}``: ``file, n, sample_id, entry`` (their JSON text)."""
    p = json_pieces(spark, path, 2).withColumn("_b", F.regexp_replace("value", r"^[\s{]+", ""))
    held = _in_place(p, F.when((F.col("begin") <= 1) & F.col("_b").rlike(KEY), F.regexp_extract("_b", KEY, 1)))
    # the first entry stands behind the key of all, the last before what closes them
    body = F.when(F.col("begin") <= 1, F.regexp_replace("_b", KEY + r"\s*\{\s*", "")).otherwise(F.col("_b"))
    closed = F.when(F.col("depth") == 1, F.regexp_replace(body, r"\s*\}\s*$", "")).when(F.col("depth") <= 0, F.regexp_replace(body, r"\s*\}\s*\}\s*$", ""))
    named = held.where("at = 'tasks'").select("file", "n", F.coalesce(closed, body).alias("_b")).where(F.col("_b").rlike(KEY))
    key = F.concat(F.lit('"'), F.regexp_extract("_b", KEY, 1), F.lit('"'))
    return named.select("file", "n", _string(key).alias("sample_id"), F.regexp_replace("_b", KEY + r"\s*", "").alias("entry"))
