"""As-of join: for every asked (key, place) the last version at or before that place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of(
    asked: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    order: str,
    columns: list[str],
    width: int = 1024,
    from_first: bool = False,
) -> DataFrame:
    """``asked`` (key, at, ...) with ``columns`` of the version of the same key that has the largest
    (at, order) not beyond the row's ``at``; NULLs where there is none, or with ``from_first`` the
    version with the smallest ``at``. A NULL place takes the last version of all.

    A version holds up to the next one of its key. Places are cut into ranges of ``width``, a version
    has a row for each range in which it holds, and rows meet versions by a join on key and range. So
    asked rows are moved once, with all they carry, and a row is compared with the versions of its
    key in one range only. A key asked for very often is split at run time like that of any other join.
    Places before all versions belong to the first range, those after all, and NULL, to the last one.
    """
    given = versions.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    # One version for each key and place: of several the one with the largest order.
    given = given.groupBy(F.col(key).alias("_key"), F.col(at).alias("_from")).agg(
        F.max(F.struct(order, *columns)).alias("_version")
    )
    bounds = versions.agg(
        F.coalesce(F.floor(F.min(at) / width), F.lit(0)).alias("low"),
        F.coalesce(F.floor(F.max(at) / width), F.lit(0)).alias("high"),
    )
    low, high = bounds.first()
    top = F.lit(high + 1).cast("bigint")
    by_place = Window.partitionBy("_key").orderBy("_from")
    until = F.lead("_from").over(by_place)
    first = F.lag("_from").over(by_place).isNull() if from_first else F.lit(False)
    last_range = F.coalesce(F.floor((F.col("_until") - 1) / width), top)
    first_range = F.when(F.col("_first"), F.lit(low).cast("bigint")).otherwise(F.floor(F.col("_from") / width))
    held = (
        given.select("*", until.alias("_until"), first.alias("_first"))
        .withColumn("_of_range", F.explode(F.sequence(first_range, last_range)))
        .select("_key", "_from", "_until", "_first", "_of_range", *[F.col("_version")[c].alias(f"_found_{c}") for c in columns])
    )
    place = F.col(at)
    own_range = F.coalesce(F.greatest(F.least(F.floor(place / width), top), F.lit(low).cast("bigint")), top)
    holds = (
        F.when(place.isNull(), F.col("_until").isNull())
        .otherwise((F.col("_first") | (F.col("_from") <= place)) & (F.col("_until").isNull() | (place < F.col("_until"))))
    )
    others = [c for c in asked.columns if c not in (key, at)]
    same = (F.col(key) == F.col("_key")) & (F.col("_range") == F.col("_of_range")) & holds
    return asked.withColumn("_range", own_range).join(held, same, "left").select(
        key, at, *others, *[F.col(f"_found_{c}").alias(c) for c in columns]
    )
