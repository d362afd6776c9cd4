"""Tables derived from the stored sale lines, kept per partition of the lines and rebuilt only where
lines have changed.

A derived table lies beside the lines and has their partitions. Next to it a small table keeps, per
partition, a mark made of the names, sizes and times of the line files it was built from. A refresh
lists the files, compares the marks and rebuilds the partitions whose files are others than before;
their old rows go first, and the marks are stored last, so a refresh that dies is repeated by the next
one. What passes the driver is one mark per partition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.plans.star import BLOCK, NO_DAY, recover, stored_lines
from tallyhouse.storage import delete, is_complete

Build = Callable[[DataFrame], DataFrame]


def _marks(spark: SparkSession, root: str) -> dict[int | None, str]:
    """Partition to the mark of its files. Only the listing is read, never a file's content."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(f"{root}/sales_lines")
    )
    if BLOCK not in files.columns:
        return {}
    file = F.concat_ws(":", F.substring_index("path", "/", -1), "length", F.unix_micros("modificationTime"))
    marks = files.groupBy(F.col(BLOCK).cast("int").alias(BLOCK)).agg(
        F.sha2(F.array_join(F.sort_array(F.collect_list(file)), ","), 256).alias("mark")
    )
    return {row[BLOCK]: row["mark"] for row in marks.collect()}


def _stored_marks(spark: SparkSession, path: str) -> dict[int | None, str]:
    if not is_complete(spark, path):
        return {}
    stored = spark.read.schema(f"{BLOCK} INT, mark STRING").parquet(path)
    return {row[BLOCK]: row["mark"] for row in stored.collect()}


def in_blocks(lines: DataFrame, blocks: list[int | None]) -> DataFrame:
    """The lines of some partitions; only those are read."""
    wanted = F.col(BLOCK).isin([b for b in blocks if b is not None])
    return lines.where(wanted | F.col(BLOCK).isNull() if None in blocks else wanted)


def refresh(spark: SparkSession, root: str, name: str, build: Build) -> tuple[DataFrame, list[int | None]]:
    """The derived table ``name`` up to date, and the partitions that had to be rebuilt. ``build`` makes
    its rows from lines of whole partitions and keeps their ``day_block``."""
    recover(spark, root)
    path, marks_path = f"{root}/{name}", f"{root}/{name}-marks"
    lines = stored_lines(spark, f"{root}/sales_lines")
    now, before = _marks(spark, root), _stored_marks(spark, marks_path)
    stale = [block for block, mark in now.items() if before.get(block) != mark]
    schema = build(lines).schema
    if not before:
        delete(spark, path)
    for block in {*stale, *(before.keys() - now.keys())}:
        delete(spark, f"{path}/{BLOCK}={NO_DAY if block is None else block}")
    if stale:
        rows = build(lines if len(stale) == len(now) else in_blocks(lines, stale))
        rows.hint("rebalance", BLOCK).write.mode("append").partitionBy(BLOCK).parquet(path)
    elif not before:
        spark.createDataFrame([], schema).write.mode("append").partitionBy(BLOCK).parquet(path)
    if now != before:
        marks = spark.createDataFrame(list(now.items()), f"{BLOCK} INT, mark STRING")
        marks.coalesce(1).write.mode("overwrite").parquet(marks_path)
    return spark.read.schema(schema).parquet(path), stale
