"""Repair of duplicated dimension members.

Loads elsewhere append every member every day, so a dimension may hold many copies of one member and
the lines of a day link to that day's copies. A repair keeps one copy of each member, links the lines
to it and drops the others:

* the copy that is kept is the one a load would link to: the largest id, and of a payment method the
  smallest, which is its fixed one;
* an index of the keys in each partition of the lines, itself derived and refreshed by partition,
  tells which partitions hold a replaced id; only these are read and rewritten, as all others stay
  byte for byte;
* the rewritten rows are stored under the star before the partitions are swapped, as for a reloaded
  day, and the repaired dimensions are stored before they replace the old ones. A repair that dies is
  finished by ``star.recover``, which every load and refresh calls, and by repairing again.

Versions of a member, the same natural key with other attributes, are not copies and stay. Nothing
but partition numbers and counts per dimension reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators import members
from tallyhouse.plans import derived, star
from tallyhouse.plans.star import BLOCK, MEMBER_COLUMNS
from tallyhouse.schemas import STAR
from tallyhouse.storage import Scratch

KEY_INDEX = "line-keys"
KEYED_DIMENSIONS = (*MEMBER_COLUMNS, "dim_payment_method")


@dataclass(frozen=True)
class Repair:
    """What a repair did: rows dropped per dimension, and the partitions rewritten."""

    dropped: dict[str, int]
    blocks: list[int | None]


def keys_of_lines(lines: DataFrame) -> DataFrame:
    """(day_block, name, key): the surrogate keys that occur in each partition of the lines."""
    names = [f"{d}_id" for d in KEYED_DIMENSIONS]
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("bigint").alias("key")) for n in names])
    return lines.select(BLOCK, F.inline(pairs)).where("key IS NOT NULL").distinct()


def kept_members(dimension: DataFrame, name: str) -> DataFrame:
    """One row per member: the copy that stays."""
    if name == "dim_payment_method":
        return dimension.groupBy("method").agg(F.min("id").alias("id")).select("id", "method")
    if name == "dim_time":
        return dimension.distinct()
    return members.latest_copy(dimension, MEMBER_COLUMNS[name]).select(*STAR[name].names)


def replaced_ids(dimension: DataFrame, name: str) -> DataFrame:
    """(name, key, keep): every id that goes, and the one that takes its place."""
    columns = [c for c in STAR[name].names if c != "id"]
    kept = kept_members(dimension, name).withColumnRenamed("id", "keep")
    return (
        dimension.join(kept, members.same_member(dimension, kept, columns))
        .where(dimension["id"] != kept["keep"])
        .select(F.lit(f"{name}_id").alias("name"), dimension["id"].alias("key"), "keep")
        .distinct()
    )


def _relinked(lines: DataFrame, replaced: DataFrame) -> DataFrame:
    """The lines with the kept ids. No broadcast is forced: the planner goes by size, and a hot
    key's lines are split at run time."""
    for name in (f"{d}_id" for d in KEYED_DIMENSIONS):
        mine = replaced.where(F.col("name") == name).select(F.col("key").alias("_key"), F.col("keep").alias("_keep"))
        kind = lines.schema[name].dataType
        lines = (
            lines.join(mine, F.col(name) == F.col("_key"), "left")
            .withColumn(name, F.coalesce("_keep", name).cast(kind))
            .drop("_key", "_keep")
        )
    return lines


def repair_members(spark: SparkSession, root: str) -> Repair:
    """Leave one copy of every member in the star under ``root``, with all lines linked to it."""
    star.recover(spark, root)
    keys, _ = derived.refresh(spark, root, KEY_INDEX, keys_of_lines)
    tables = {name: spark.read.schema(STAR[name]).parquet(f"{root}/{name}") for name in (*KEYED_DIMENSIONS, "dim_time")}
    with Scratch(spark) as scratch:
        replaced = reduce(DataFrame.unionByName, [replaced_ids(tables[n], n) for n in KEYED_DIMENSIONS])
        replaced = scratch.stage(replaced, "replaced")
        touched = keys.join(replaced, ["name", "key"], "left_semi").select(BLOCK).distinct()
        blocks = sorted((row[BLOCK] for row in touched.collect()), key=lambda b: (b is not None, b))
        if blocks:
            lines = star.stored_lines(spark, f"{root}/sales_lines")
            star.swap_lines(_relinked(derived.in_blocks(lines, blocks), replaced), root)
        dropped = {}
        for name, stored in tables.items():
            kept = scratch.stage(kept_members(stored, name), name)
            dropped[name] = stored.count() - kept.count()
            if dropped[name]:
                kept.write.mode("overwrite").parquet(f"{root}/{star.REPAIRED}/{name}")
        star.recover(spark, root)
    return Repair(dropped, blocks)


def member_links(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, source_id, members, lines, revenue_cents) per natural key of a dimension: how many
    member rows it has, and what the lines linked to them come to."""

    def links(name: str) -> DataFrame:
        key = "id" if name == "dim_payment_method" else "source_id"
        per_id = (
            star.sale_facts(tables)
            .groupBy(F.col(f"{name}_id").alias("_id"))
            .agg(F.count(F.lit(1)).alias("lines"), F.sum("revenue_cents").alias("revenue_cents"))
        )
        found = tables[name].select("id", F.col(key).cast("bigint").alias("source_id"))
        return (
            found.join(per_id, F.col("id") == F.col("_id"), "left")
            .groupBy("source_id")
            .agg(
                F.count(F.lit(1)).alias("members"),
                F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"),
                F.coalesce(F.sum("revenue_cents"), F.lit(0)).alias("revenue_cents"),
            )
            .select(F.lit(name).alias("table_name"), "*")
        )

    return reduce(DataFrame.unionByName, map(links, KEYED_DIMENSIONS))
