"""Large JSON documents, read in splits: one document of any size is as many tasks as it has blocks.

The text reader cuts a file at every ``}``, which Spark can do from any block. Whether a piece begins inside a string,
and how deep it lies, follows from sums over the pieces before it: within a run of pieces by a window, over runs by one
row for each. Pieces between two ends of elements are joined again, so only elements that cross a run's end move twice.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemill.operators.rows import SEQ
from tidemill.sources.files import _load

#: Pieces of a run, as a power of two: a block is many runs, so that no task holds a whole block.
RUN_BITS = 14
_RUN = ("_path", "_block", "_run")


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _outside(text: Column) -> Column:
    """The brackets of a text that begins outside a string and has no escapes."""
    return F.regexp_replace(F.regexp_replace(text, r'"[^"]*("|\z)', ""), r"[^\[\]{}]", "")


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text up to each ``}`` (left out), with its change of depth if it begins outside (0) or inside (1) a string."""
    meta = F.col("_metadata")
    texts = _load(spark.read.option("lineSep", "}"), "text", path)
    pieces = texts.select(
        "value",
        meta["file_path"].alias("_path"),
        meta["file_block_start"].alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        meta["file_size"].alias("_size"),
    )
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    pieces = pieces.withColumns(
        {"_odd": _count(plain, '"') % 2 == 1, "_m0": _outside(plain), "_m1": _outside(F.concat(F.lit('"'), plain))}
    )
    changes = {}
    for state, closes in ((0, ~F.col("_odd")), (1, F.col("_odd"))):
        marks = F.col(f"_m{state}")
        changes[f"_braces{state}"] = _count(marks, "{") - closes.cast("int")
        changes[f"_brackets{state}"] = _count(marks, "[") - _count(marks, "]")
    # The position within the scan's task, without the task's number: runs are cut there, and at the start of each block.
    pieces = pieces.withColumn("_run", F.shiftright(F.col("_row").bitwiseAND((1 << 33) - 1), RUN_BITS))
    # Parts grow with the scan; left to itself Spark makes them as large as its advisory size, which is many times that in memory.
    parts = max(spark.sparkContext.defaultParallelism, 4 * texts.rdd.getNumPartitions())
    before = Window.partitionBy(*_RUN).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumns(changes).drop("_m0", "_m1").repartition(parts, *_RUN)
    return pieces.withColumn("_flip", F.coalesce(F.sum(F.col("_odd").cast("int")).over(before), F.lit(0)) % 2 == 1)


def _runs(pieces: DataFrame) -> DataFrame:
    """One row per run: state and depth at its start, whether it begins its document, and whether that is an array."""
    sums = {"_odds": F.sum(F.col("_odd").cast("int")), "_array": F.min_by(F.col("value").rlike(r"^\s*\["), "_row")}
    sums |= {"_bytes": F.sum(F.octet_length("value") + 1), "_size": F.max("_size")}
    for kind in ("braces", "brackets"):
        zero, one = F.col(f"_{kind}0"), F.col(f"_{kind}1")
        sums[f"_{kind}0"] = F.sum(F.when(F.col("_flip"), one).otherwise(zero))
        sums[f"_{kind}1"] = F.sum(F.when(F.col("_flip"), zero).otherwise(one))
    runs = pieces.groupBy(*_RUN).agg(*[c.alias(name) for name, c in sums.items()])
    document = Window.partitionBy("_path").orderBy("_block", "_run")
    before, whole = document.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("_path")
    runs = runs.withColumn("_inside", F.coalesce(F.sum("_odds").over(before), F.lit(0)) % 2 == 1)
    for kind in ("braces", "brackets"):
        runs = runs.withColumn(f"_{kind}", F.when(F.col("_inside"), F.col(f"_{kind}1")).otherwise(F.col(f"_{kind}0")))
    # A text after the last "}" counts one brace and one byte too many; of compressed files the size does not tell.
    spare, depth = F.sum("_bytes").over(whole) - F.col("_size"), F.sum("_braces").over(whole)
    sound = (F.sum("_odds").over(whole) % 2 == 0) & (F.sum("_brackets").over(whole) == 0)
    sound &= F.when(spare.isin(0, 1), depth == -spare).otherwise(depth.isin(0, -1))
    broken = F.raise_error(F.concat(F.lit("a JSON document is cut or malformed: "), F.col("_path"))).cast("boolean")
    return runs.select(
        *_RUN,
        F.when(sound, F.col("_inside")).otherwise(broken).alias("_inside"),
        F.first("_array").over(document).alias("_array"),
        (F.row_number().over(document) == 1).alias("_opens"),
        *[F.coalesce(F.sum(f"_{k}").over(before), F.lit(0)).alias(f"_{k}_before") for k in ("braces", "brackets")],
    )


def _joined(frame: DataFrame, keys: list[str], place: list[str]) -> DataFrame:
    """Texts of one element, in order of place."""
    parts = F.array_sort(F.collect_list(F.struct(*place, "value")))
    return frame.groupBy(*keys).agg(
        F.array_join(F.transform(parts, lambda part: part["value"]), "").alias("value"),
        F.max("_end").alias("_end"),
        F.first("_array").alias("_array"),
        F.max("_opens").alias("_opens"),
        F.min(F.struct(*place)).alias("_first"),
    )


def _elements(spark: SparkSession, path: str | list[str], braces: Column, brackets: Column) -> DataFrame:
    """Texts up to each end of an element, and what follows the last; an end is a ``}`` at the given depth."""
    pieces = _pieces(spark, path)
    placed = pieces.join(_runs(pieces), list(_RUN))
    inside = F.col("_flip") != F.col("_inside")
    rows = Window.partitionBy(*_RUN).orderBy("_row")
    for kind in ("braces", "brackets"):
        change = F.when(inside, F.col(f"_{kind}1")).otherwise(F.col(f"_{kind}0"))
        placed = placed.withColumn(f"_{kind}", F.col(f"_{kind}_before") + F.sum(change).over(rows))
    end = (inside == F.col("_odd")) & (F.col("_braces") == braces) & (F.col("_brackets") == brackets)
    placed = placed.withColumns({"_end": end, "value": F.concat("value", F.lit("}"))})
    ends = F.sum(F.col("_end").cast("int")).over(rows.rowsBetween(Window.unboundedPreceding, -1))
    placed = placed.withColumn("_nth", F.coalesce(ends, F.lit(0))).withColumn("_opens", F.col("_opens") & (F.col("_nth") == 0))
    texts = _joined(placed, [*_RUN, "_nth"], ["_row"])
    # The first text of a run and one without an end may belong to an element of other runs: two rows a run.
    crossing = (F.col("_nth") == 0) | ~F.col("_end")
    order = Window.partitionBy("_path").orderBy("_block", "_run", "_nth").rowsBetween(Window.unboundedPreceding, -1)
    parts = texts.filter(crossing).withColumn("_element", F.coalesce(F.sum(F.col("_end").cast("int")).over(order), F.lit(0)))
    parts = _joined(parts, ["_path", "_element"], ["_block", "_run", "_nth"])
    columns = ["_path", "value", "_end", "_array", "_opens"]
    return texts.filter(~crossing).select(*columns, "_block", "_run", "_nth").union(parts.select(*columns, "_first.*"))


def _opening(key: str) -> Column:
    """The text up to the array under a member of the outermost object; null without that member."""
    name = rf'"{re.escape(key)}"\s*:\s*\['  # never part of a string, whose quotes are escaped
    parts = F.split("value", name)
    steps = F.arrays_zip(F.slice(parts, 1, F.size(parts) - 1).alias("part"), F.regexp_extract_all("value", F.lit(name), F.lit(0)).alias("name"))

    def step(seen: Column, item: Column) -> Column:
        marks = _outside(F.regexp_replace(item["part"], r"(?s)\\.", ""))
        braces = seen["braces"] + _count(marks, "{") - _count(marks, "}")
        brackets = seen["brackets"] + 1 + _count(marks, "[") - _count(marks, "]")
        at = seen["at"] + F.length(item["part"]) + F.length(item["name"])
        found = F.coalesce(seen["found"], F.when((braces == 1) & (brackets == 1), at))
        return F.struct(braces.alias("braces"), brackets.alias("brackets"), at.alias("at"), found.alias("found"))

    zero = F.lit(0)
    start = F.struct(zero.alias("braces"), zero.alias("brackets"), zero.alias("at"), F.lit(None).cast("int").alias("found"))
    return F.substring("value", F.lit(1), F.aggregate(steps, start, step)["found"])


def read_json_elements(spark: SparkSession, path: str | list[str], key: str | None = None) -> DataFrame:
    """The objects in large JSON documents as texts in ``value``, with their position in ``_seq``.

    Without ``key`` a document is an array of objects, or an object that is one row itself. With ``key`` it is an object
    with an array of objects under that name; other members may stand around it, but no second array of objects on that
    level. Files are read in splits, so a single document is read by many tasks. A cut document, an element that is no
    object, a missing array and a second one fail the job. Empty files and empty arrays have no rows. Compressed files
    are one task, as Spark cannot split them.
    """
    if key is None:
        texts = _elements(spark, path, F.lit(0), F.col("_array").cast("int"))
        head = F.regexp_extract("value", r"^[^{]*", 0)
        fits = F.when(F.col("_array"), head.rlike(r"^\s*[\[,]\s*$")).otherwise(head.rlike(r"^\s*$"))
        rest = F.when(F.col("_array"), F.col("value").rlike(r"^\s*\[?\s*\]\s*\}\z")).otherwise(F.col("value").rlike(r"^\s*\}\z"))
    else:
        texts = _elements(spark, path, F.lit(1), F.lit(1))
        first = F.col("_opens")
        head = F.when(first, _opening(key)).otherwise(F.regexp_extract("value", r"^[^{]*", 0))
        after = F.substring("value", F.length(head) + 1, F.length("value"))
        fits = F.when(first, after.rlike(r"^\s*\{")).otherwise(head.rlike(r"^\s*,\s*$"))
        rest = F.when(first, after.rlike(r"^\s*\]")).otherwise(F.col("value").rlike(r"^\s*\]"))
    wrong = F.raise_error(F.concat(F.lit(f"not an array of objects{f' under {key}' if key else ''}: "), F.col("_path"))).cast("boolean")
    texts = texts.filter(F.when(F.when(F.col("_end"), fits).otherwise(rest), F.col("_end")).otherwise(wrong))
    return texts.select(
        F.substring("value", F.length(head) + 1, F.length("value")).alias("value"),
        F.struct("_path", "_block", "_run", "_nth").alias(SEQ),
    )


def read_json_pages(spark: SparkSession, path: str | list[str], schema: str, key: str | None = None) -> DataFrame:
    """Typed rows of large JSON documents (see ``read_json_elements``), with ``_seq``; malformed elements fail the job."""
    texts = read_json_elements(spark, path, key)
    return texts.select(F.inline(F.array(F.from_json("value", schema, {"mode": "FAILFAST"}))), SEQ)
