"""Members' attributes as of a day.

A load reads the operational tables as they are when it runs. For a new day that is the day's close;
for an old day that is loaded again it is too late: its lines must keep the attributes of that day. So
loads with history record since which day a member has had which version, and link lines by day.

The days of a batch are new from the latest day loaded so far onwards; that day itself may be loaded
again at its close. The batch's attributes hold from the first of its new days. A batch of old days
only tells nothing about later days and records nothing but members never seen before. Records are
only ever added: of several for one member and day the latest counts.

A line before the first record of its member takes that first version, the nearest that is known.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.asof import as_of
from tallyhouse.storage import is_complete, stage

HISTORY_SCHEMA = "source_id BIGINT, dim_id BIGINT, from_day INT, recorded BIGINT"


class Span(NamedTuple):
    """First day of a batch, and its first day that is not older than all days loaded before."""

    first: int | None
    new_from: int | None


def batch_span(loaded_hours: DataFrame, per_day: DataFrame) -> Span:
    """One row each from the time dimension and from the days of the batch."""
    latest = loaded_hours.agg(F.max("simulated_day").alias("day")).first()["day"]
    day = F.col("simulated_day")
    new = F.min("simulated_day") if latest is None else F.min(F.when(day >= latest, day))
    return Span(*per_day.agg(F.min("simulated_day"), new).first())


def stored_history(spark, path: str) -> DataFrame:
    if not is_complete(spark, path):
        spark.createDataFrame([], HISTORY_SCHEMA).write.mode("overwrite").parquet(path)
    return spark.read.schema(HISTORY_SCHEMA).parquet(path)


def record(keys: DataFrame, path: str, span: Span) -> DataFrame:
    """Add to the history at ``path`` what a batch tells about the versions ``keys`` (source_id, dim_id)
    and return the whole history."""
    spark = keys.sparkSession
    history = stored_history(spark, path)
    if span.first is None:
        return history
    last = history.groupBy("source_id").agg(F.max_by("dim_id", F.struct("from_day", "recorded")).alias("_last"))
    number = history.agg(F.coalesce(F.max("recorded"), F.lit(0)) + 1).first()[0]
    known = F.col("_last").isNotNull()
    changed = ~known if span.new_from is None else ~known | (F.col("_last") != F.col("dim_id"))
    from_day = span.first if span.new_from is None else span.new_from
    # A member first seen in a batch that has old days as well is valid on those, too.
    since = F.when(known, F.lit(from_day)).otherwise(F.lit(span.first))
    fresh = (
        keys.select("source_id", "dim_id")
        .join(last, "source_id", "left")
        .where(changed)
        .select("source_id", "dim_id", since.cast("int").alias("from_day"), F.lit(number).cast("bigint").alias("recorded"))
    )
    # Stored first, as it is read from the table that it is added to.
    stage(fresh, "versions").write.mode("append").parquet(path)
    return spark.read.schema(HISTORY_SCHEMA).parquet(path)


def looks_back(history: DataFrame, span: Span) -> bool:
    """Whether a record begins after the first day of a batch. If none does, all of its rows take the last
    version of their member, whatever their day."""
    latest = history.agg(F.max("from_day").alias("day")).first()["day"]
    return None not in (latest, span.first) and latest > span.first


def last_records(history: DataFrame) -> DataFrame:
    """The record of every member that counts for the latest days."""
    record = F.max(F.struct("from_day", "recorded", "dim_id")).alias("_last")
    return history.groupBy("source_id").agg(record).select("source_id", "_last.*")


def version_map(history: DataFrame, dimension: DataFrame, columns: list[str]) -> DataFrame:
    """(source_id, from_day, recorded, dim_id, attributes) of every record. A record whose member is not
    there has NULLs."""
    stored = dimension.select(F.col("id").alias("_dim"), *[c for c in columns if c != "source_id"])
    return history.withColumnRenamed("dim_id", "_recorded_dim").join(
        stored, F.col("_recorded_dim") == F.col("_dim"), "left"
    ).select("source_id", "from_day", "recorded", F.col("_dim").alias("dim_id"), *[c for c in columns if c != "source_id"])


def keys_as_of(rows: DataFrame, key: str, known: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (``key``, simulated_day, ...) with ``columns`` of the member as of their day, looked up in the
    version map ``known``; NULLs where the member was never recorded."""
    dated = known.withColumnRenamed("source_id", key).withColumnRenamed("from_day", "simulated_day")
    return as_of(rows, dated, key, "simulated_day", "recorded", columns, from_first=True)
