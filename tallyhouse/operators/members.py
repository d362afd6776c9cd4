"""Dimension members: insert-if-absent and surrogate keys, without a single-task numbering."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bound of the one table that passes through an ordered global window and a forced broadcast.
ID_BUCKETS = 1024


def same_member(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Null-safe equality on all columns; still an equi-join for the planner."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def absent_members(members: DataFrame, existing: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct members not yet stored with exactly these attributes."""
    fresh = members.select(*columns).distinct()
    return fresh.join(existing, same_member(fresh, existing, columns), "left_anti")


def number_members(members: DataFrame, columns: list[str], after: Column) -> DataFrame:
    """Add a dense ``id`` counting up from ``after`` + 1.

    Members are hashed into a fixed number of buckets and numbered inside each; a bucket starts
    where the ones before it end. The bucket sizes are at most ``ID_BUCKETS`` rows however many
    members there are.
    """
    bucketed = members.withColumn(
        "_bucket", F.pmod(F.xxhash64(*columns), F.lit(ID_BUCKETS)).cast("int")
    )
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        bucketed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(
            F.col("_bucket").alias("_start_bucket"),
            F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
        )
    )
    inside = Window.partitionBy("_bucket").orderBy(*columns)
    return (
        bucketed.withColumn("_position", F.row_number().over(inside))
        .join(F.broadcast(starts), F.col("_bucket") == F.col("_start_bucket"))
        .select((after + F.col("_start") + F.col("_position")).cast("bigint").alias("id"), *columns)
    )


def latest_copy(dimension: DataFrame, columns: list[str]) -> DataFrame:
    """One row per distinct member; where exact copies exist, the one with the largest id."""
    return dimension.groupBy(*columns).agg(F.max("id").alias("id"))


def duplicate_members(dimension: DataFrame, *natural_key: str) -> DataFrame:
    """Natural keys held by more than one member row."""
    return (
        dimension.groupBy(*natural_key)
        .agg(F.count(F.lit(1)).alias("members"))
        .where(F.col("members") > 1)
    )
