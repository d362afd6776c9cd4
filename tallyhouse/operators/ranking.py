"""Dense rank inside groups that may be far too large for one sorting task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEADING_DIGITS = 4


def value_block(cents: Column) -> Column:
    """A whole number that never decreases with ``cents`` and splits any spread of amounts.

    Amounts are grouped by sign, number of digits and first four digits, so neighbouring amounts
    share a block and a group has at most a few thousand blocks per power of ten. Integer
    arithmetic only: every evaluation gives the same block.
    """
    size = F.abs(cents).cast("decimal(20,0)").cast("string")
    digits = F.length(size)
    lead = F.substring(F.rpad(size, LEADING_DIGITS, "0"), 1, LEADING_DIGITS).cast("bigint")
    block = digits * 10**LEADING_DIGITS + lead
    return F.when(cents < 0, -block).when(cents == 0, F.lit(0)).otherwise(block).cast("bigint")


def dense_rank_desc(df: DataFrame, group: str, amount: str, alias: str) -> DataFrame:
    """``dense_rank() over (partition by group order by amount desc)`` with the sort of each group
    split over value blocks. Rows of equal amount share a rank, so only distinct amounts are
    ranked; a block's ranks start after the distinct amounts of all higher blocks of its group.
    """
    cents = (F.col(amount) * 100).cast("decimal(20,0)")
    amounts = df.select(group, amount).distinct().withColumn("_block", value_block(cents))
    higher = (
        Window.partitionBy(group)
        .orderBy(F.desc("_block"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        amounts.groupBy(group, "_block")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(higher), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(group, "_block").orderBy(F.desc(amount))
    ranked = (
        amounts.withColumn("_local", F.row_number().over(inside))
        .join(starts, [group, "_block"])
        .select(group, amount, (F.col("_start") + F.col("_local")).alias(alias))
    )
    return df.join(ranked, [group, amount])
