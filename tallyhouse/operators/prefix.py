"""Running totals and moving means over all rows of a large table, without one task seeing them all.

Rows are dealt into ranges of the order, and stored with the number of their range. A total per range
tells where each range starts. Inside a range an ordinary window runs; a moving frame that reaches
back over the start of its range gets the rows it needs, fewer than a frame, as a halo of copies from
the ranges before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.storage import stage

# Rows of a range: what one task sorts.
ROWS_PER_RANGE = 1 << 20
LEAST_RANGES = 4


def running(
    df: DataFrame,
    order: list[str],
    totals: dict[str, str],
    moving: dict[str, str],
    frame: int = 30,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``df`` with the running total of each whole-number column of ``totals`` and the sum over the last
    ``frame`` rows of each one of ``moving``, under the names given there. A moving sum is NULL until
    ``frame`` values are there, as is one with a NULL value in its frame. ``order`` has to tell all
    rows apart, or rows that it does not are in any order.

    The driver holds one row per range.
    """
    spark = df.sparkSession
    ranges = max(LEAST_RANGES, -(-df.count() // rows_per_range))
    rows = stage(df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "ranges")

    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in totals]
    starts, before, so_far = [], 0, [0] * len(totals)
    for row in rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"), *sums).orderBy("_range").collect():
        starts.append((row["_range"], before, row["_rows"], *so_far))
        before += row["_rows"]
        so_far = [a + row[c] for a, c in zip(so_far, totals)]
    long = T.LongType()
    names = ["_of", "_before", "_rows", *[f"_before_{c}" for c in totals]]
    schema = T.StructType([T.StructField("_of", T.IntegerType()), *[T.StructField(n, long) for n in names[1:]]])
    start = spark.createDataFrame(starts, schema)

    from_end = Window.partitionBy("_range").orderBy(*[F.desc_nulls_last(c) for c in order])
    ends = (
        rows.withColumn("_back", F.row_number().over(from_end))
        .where(F.col("_back") < frame)
        .join(F.broadcast(start.select("_of", "_before", "_rows")), F.col("_range") == F.col("_of"))
        .withColumn("_place", F.col("_before") + F.col("_rows") - F.col("_back") + 1)
        .drop("_range", "_of", "_before", "_rows", "_back")
    )
    # A row is in the halo of the range that begins behind it by less than a frame.
    reach = ends.withColumn("_begins", F.explode(F.sequence(F.col("_place"), F.col("_place") + frame - 2)))
    halo = reach.join(
        F.broadcast(start.select(F.col("_of").alias("_range"), F.col("_before").alias("_begins"))), "_begins"
    ).select(*df.columns, "_range", F.lit(True).alias("_halo"))

    inside = Window.partitionBy("_range").orderBy(*[F.asc_nulls_first(c) for c in order])
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    last = inside.rowsBetween(1 - frame, 0)

    def own(column: str) -> Column:
        return F.coalesce(F.sum(F.when(~F.col("_halo"), F.col(column))).over(upto), F.lit(0))

    def full(column: str) -> Column:
        return F.when(F.count(column).over(last) == frame, F.sum(column).over(last))

    found = rows.withColumn("_halo", F.lit(False)).unionByName(halo)
    found = found.withColumns({out: own(c) for c, out in totals.items()} | {out: full(c) for c, out in moving.items()})
    found = found.where(~F.col("_halo")).join(F.broadcast(start), F.col("_range") == F.col("_of"))
    found = found.withColumns({out: F.col(out) + F.col(f"_before_{c}") for c, out in totals.items()})
    return found.select(*df.columns, *totals.values(), *moving.values())
