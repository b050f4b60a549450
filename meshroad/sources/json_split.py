"""The objects in the top-level arrays of large JSON documents, each document read by many tasks.

The text is read in pieces that end with a closing brace, so that Spark can cut a document anywhere. Whether a piece
begins inside a string, and how deep, is a running sum over the pieces before it: within each block of the file, and
from block to block by a table of one row per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meshroad.operators.slices import attach_carry, spread_groups, within
from meshroad.session import materialize

# From the start of a piece to its first opening brace outside of strings; possessive, so that long text takes no stack.
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_TO_BRACE = rf'(?:[^"{{]++|{_STRING})*+\{{'
_STRING_END = r'(?:[^"\\]++|\\.)*+"'
_KEYS = ("file", "_slice")


def _count(text: Column, what: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """`text` up to each closing brace, which it lacks, its place, its `quotes`, and the braces it opens if it begins outside (`opens0`)
    or inside of a string (`opens1`). Written once, as the places come from the reading."""
    raw = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_slice"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("text"))
    plain = F.regexp_replace("text", r"(?s)\\.", "")
    outside = lambda t: F.regexp_replace(t, r'"[^"]*+("|$)', "")
    return materialize(raw.withColumns({
        "quotes": _count(plain, '"'), "opens0": _count(outside(plain), "{"),
        "opens1": _count(outside(F.regexp_replace(plain, r'^[^"]*+("|$)', "")), "{")}), "json-pieces")


def _before(value: Column) -> Column:
    """Sum over the pieces of the block before this one."""
    return F.sum(value).over(within(["file"], "id")) - value


def _change(inside: Column) -> Column:
    """By how much a piece changes the depth: what it opens, less its brace at the end if that is outside of strings."""
    return F.when(inside == 0, F.col("opens0")).otherwise(F.col("opens1")) - F.when((inside + F.col("quotes")) % 2 == 0, 1).otherwise(0)


def _with_depth(pieces: DataFrame, carry: DataFrame | None) -> DataFrame:
    """Adds `inside` (1 if a piece begins in a string), `depth` at its begin and `starts` (an object in the document begins in it)."""
    if carry is None:
        pieces = pieces.withColumns({"_quotes_before": F.lit(0), "_depth_before": F.lit(0)})
    else:
        zero = {c: F.coalesce(c, F.lit(0)) for c in ("_quotes_before", "_depth_before")}
        pieces = attach_carry(pieces, carry, ["file"]).withColumns(zero)
    told = pieces.withColumn("inside", (F.col("_quotes_before") + _before(F.col("quotes"))) % 2)
    told = told.withColumn("_change", _change(F.col("inside"))).withColumn("depth", F.col("_depth_before") + _before(F.col("_change")))
    opens = F.when(F.col("inside") == 0, F.col("opens0")).otherwise(F.col("opens1"))
    return told.withColumn("starts", ((F.col("depth") <= 1) & (F.col("depth") + opens >= 2)).cast("int"))


def _carried(pieces: DataFrame) -> DataFrame:
    """For each block of the documents read in several: quotes, depth and objects before it."""
    narrow = pieces.select(*_KEYS, "id", "quotes", "opens0", "opens1")
    inside = _before(F.col("quotes")) % 2
    blocks = spread_groups(
        narrow.withColumns({"_c0": _change(inside), "_c1": _change(1 - inside)}), ["file"],
        F.sum("quotes").alias("quotes"), F.sum("_c0").alias("_c0"), F.sum("_c1").alias("_c1"))
    earlier = Window.partitionBy("file").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    summed = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    depths = blocks.withColumn("_quotes_before", summed("quotes")).withColumn(
        "_c", F.when(F.col("_quotes_before") % 2 == 0, F.col("_c0")).otherwise(F.col("_c1"))).select(
        *_KEYS, "_quotes_before", summed("_c").alias("_depth_before"))
    depths = materialize(depths, "json-depths")
    starts = spread_groups(_with_depth(narrow, depths), ["file"], F.sum("starts").alias("starts"))
    counted = starts.select(*_KEYS, summed("starts").alias("_starts_before"))
    return materialize(depths.join(F.broadcast(counted), list(_KEYS)), "json-carry")


def array_objects(spark: SparkSession, path: str) -> DataFrame:
    """`file`, `place` (from 1, in the order of the document) and `text` of each object that lies in an array of a document's object.

    Objects that are the value of a member itself are left out, but count in `place`. An object's text lies in one row.
    """
    pieces = _pieces(spark, path)
    carry = None if pieces.filter("_slice > 0").isEmpty() else _carried(pieces)
    told = _with_depth(pieces, carry)
    place = F.sum("starts").over(within(["file"], "id")) + (F.lit(0) if carry is None else F.coalesce("_starts_before", F.lit(0)))
    begin = lambda string, braces: F.length(F.regexp_extract("text", rf"(?s)^{string}(?:{_TO_BRACE}){{{braces}}}", 0))
    at = F.when(F.col("inside") == 0, F.when(F.col("depth") == 1, begin("", 1)).otherwise(begin("", 2))).otherwise(begin(_STRING_END, 1))
    told = told.withColumn("place", place).filter("starts = 1 or depth >= 2").withColumn("_at", F.when(F.col("starts") == 1, at))
    told = told.withColumns({
        "part": F.concat(F.when(F.col("starts") == 1, F.expr("substring(text, _at)")).otherwise(F.col("text")), F.lit("}")),
        "in_array": F.when(F.col("starts") == 1, ~F.expr("substring(text, 1, _at - 1)").rlike(r":\s*\z"))})
    whole = told.groupBy("file", "place").agg(
        F.array_sort(F.collect_list(F.struct("_slice", "id", "part"))).alias("parts"), F.max("in_array").alias("in_array"))
    return whole.filter("in_array").select("file", "place", F.array_join(F.transform("parts", lambda p: p.part), "").alias("text"))
