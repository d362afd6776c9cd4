"""Dumps of INSERT statements whose texts, tuples, heads or clauses go over several lines.

Whether a line begins inside a text, a tuple or a clause depends on all lines before it. Each line is
first taken as a change of that state, whatever the state is; changes are summed within the blocks
in which Spark splits a file, then over the blocks of a file (one row each), so a large file is read
by many tasks and none sees more than one block. Lines that belong together are then joined, and
every joined line is parsed on its own.

States, one after the other:
  texts    an apostrophe opens or closes a text, a doubled one does both; ``--`` outside a text is a
           comment to the end of the line, whatever apostrophes it holds;
  tuples   parentheses outside texts;
  phases   the last keyword or ``;`` outside texts and parentheses: head, rows, clause.

Defined results: blank lines and comments are skipped; line breaks in texts stay as they are; empty
files have no rows; equal rows come as often as they are written. What is no row, head or clause ends
the job, as do a tuple outside of a statement's rows, a tuple of another length, a text or tuple that
is never closed, and a value that its column does not take. An apostrophe escaped by a backslash is
not understood. Compressed files are one block each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.sources.files import rows_of_tuples
from tallyhouse.storage import stage

# The pieces of a statement. The head may end with its line.
_TEXT = r"[Ee]?'(?:[^']++|'')*+'"
_TUPLE = rf"\((?:{_TEXT}|[^'()])*+\)"
_HEAD = r"INSERT(?:\s+INTO)?(?:\s+[^\s(',;]+)?\s*(?:\([^()']*\))?\s*(?:VALUES\b|$)"
_CLAUSE = rf"(?:ON\s+(?:CONFLICT|DUPLICATE)|RETURNING)\b(?:{_TEXT}|[^';])*+"
_PIECES = rf"(?i){_HEAD}|{_CLAUSE}|{_TUPLE}|[,;\s]+"
_KEYWORDS = r"(?i)(\bINSERT\b|(?<!=\s{0,9})\bVALUES\b|\bCONFLICT\b|\bDUPLICATE\b|\bRETURNING\b|;)"

_HEAD_PHASE, _ROWS_PHASE, _CLAUSE_PHASE, _NO_PHASE = 1, 2, 3, 0


def _scanned(rows: DataFrame, by: WindowSpec) -> DataFrame:
    """Adds ``after``, the sum of ``change`` since the last ``reset`` up to each row, and ``fixed``,
    whether there was one. A reset row begins anew with its own change."""
    so_far = by.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("run", F.sum("change").over(so_far))
    base = F.last(F.when(F.col("reset"), F.col("run") - F.col("change")), ignorenulls=True)
    rows = rows.withColumn("base", base.over(so_far))
    return rows.select(
        "*",
        (F.col("run") - F.coalesce("base", F.lit(0))).alias("after"),
        F.col("base").isNotNull().alias("fixed"),
    ).drop("run", "base", "change", "reset")


def _before(by: WindowSpec) -> list[Column]:
    return [
        F.lag("after", 1, 0).over(by).alias("before"),
        F.lag("fixed", 1, False).over(by).alias("was_fixed"),
    ]


def _running(lines: DataFrame, change: Column, reset: Column) -> DataFrame:
    """(file, block, at, value, before): the state before each line."""
    in_block = Window.partitionBy("file", "block").orderBy("at")
    rows = _scanned(lines.withColumns({"change": change.cast("bigint"), "reset": reset}), in_block)
    rows = stage(rows.select("*", *_before(in_block)), "dump-lines")
    blocks = rows.groupBy("file", "block").agg(F.max_by(F.struct("after", "fixed"), "at").alias("b"))
    blocks = blocks.select("file", "block", F.col("b.after").alias("change"), F.col("b.fixed").alias("reset"))
    in_file = Window.partitionBy("file").orderBy("block")
    carried = _scanned(blocks, in_file).select("file", "block", F.lag("after", 1, 0).over(in_file).alias("carried"))
    before = F.col("before") + F.when(F.col("was_fixed"), 0).otherwise(F.col("carried"))
    return rows.join(carried, ["file", "block"]).select("file", "block", "at", "value", before.alias("before"))


def _joined(lines: DataFrame) -> DataFrame:
    """Lines that begin in an open state, put together with the line that opened it."""
    begins = (F.col("before") == 0).cast("int")
    numbered = _running(lines.withColumn("value", F.struct("value", begins.alias("begins"))).drop("before"),
                        F.col("value.begins"), F.lit(False))
    numbered = numbered.select(
        "file", "block", "at", F.col("value.value").alias("value"), (F.col("before") + F.col("value.begins")).alias("n")
    )
    parts = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    together = numbered.groupBy("file", "n").agg(parts.alias("parts"))
    return together.select(
        "file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["at"].alias("at"),
        F.array_join("parts.value", "\n").alias("value"),
    )


def _ends_in_text(line: Column) -> tuple[Column, Column]:
    """Whether a line that begins outside a text ends inside one, and whether it ends in a comment."""
    rest = F.regexp_replace(line, "'[^']*'", "")
    comment = rest.rlike("^[^']*--")
    return ~comment & rest.contains("'"), comment


def _bare(line: Column) -> Column:
    return F.regexp_replace(line, "'[^']*'", "")


def _count(line: Column, mark: str) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(mark), F.lit("")))


def whole_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, value) of a dump's lines in which no text or tuple is open at the end; without
    comments."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    from_outside, _ = _ends_in_text(F.col("value"))
    from_inside, _ = _ends_in_text(F.concat(F.lit("'"), F.col("value")))
    # A line keeps the state, turns it, or ends outside in both cases; nothing else is possible.
    turns = from_outside & ~from_inside
    ends = ~from_outside & ~from_inside
    lines = _running(lines, turns.cast("int"), ends)
    lines = _joined(lines.withColumn("before", F.col("before") % 2))
    lines = lines.withColumn("value", F.regexp_replace("value", r"('[^']*')|--[^\n]*", "$1"))
    bare = _bare(F.col("value"))
    return _joined(_running(lines, _count(bare, "(") - _count(bare, ")"), F.lit(False)))


def read_dump(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of the INSERT ... VALUES statements for one table."""
    outside = F.regexp_replace(_bare(F.col("value")), r"\([^()]*\)", "()")
    last = F.upper(F.try_element_at(F.regexp_extract_all(outside, F.lit(_KEYWORDS), F.lit(1)), F.lit(-1)))
    phase = (
        F.when(last == "INSERT", _HEAD_PHASE)
        .when(last == "VALUES", _ROWS_PHASE)
        .when(last == ";", _NO_PHASE)
        .when(last.isNotNull(), _CLAUSE_PHASE)
    )
    lines = _running(whole_lines(spark, path), F.coalesce(phase, F.lit(0)), phase.isNotNull())
    # A head or clause that goes on is parsed like one that begins.
    goes_on = F.when(F.col("before") == _HEAD_PHASE, "INSERT INTO ").when(
        F.col("before") == _CLAUSE_PHASE, "ON CONFLICT "
    )
    line = F.concat(F.coalesce(goes_on, F.lit("")), F.col("value"))
    pieces = F.regexp_extract_all(line, F.lit(f"({_PIECES})"), F.lit(1))
    tuples = F.filter(pieces, lambda x: x.startswith("("))
    sound = (F.regexp_replace(line, _PIECES, "") == "") & (
        (F.size(tuples) == 0) | (F.col("before") == _ROWS_PHASE) | outside.rlike(r"(?i)\bVALUES\b")
    )
    refused = F.raise_error(F.concat(F.lit("not a statement of rows: "), F.col("value")))
    found = lines.select(F.explode(F.when(sound, tuples).otherwise(refused)).alias("tuple"))
    return rows_of_tuples(found, schema)
