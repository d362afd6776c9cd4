"""Ordered windows and distribution statistics over the day rollup.

Everything here takes one row per trading day. That table is bounded by the calendar (a century is
36,525 rows) and does not grow with the number of sale lines, which is what makes a window without
partition key and exact percentiles acceptable. Never apply these to line-grain rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallyhouse.functions import money


def by_day() -> WindowSpec:
    return Window.orderBy("simulated_day")


def moving_average(amount: str, rows: int) -> Column:
    """Mean of the last ``rows`` days on record, NULL until that many exist. Counts rows, so a gap
    in the day numbers does not matter."""
    frame = by_day().rowsBetween(1 - rows, 0)
    seen = F.count(amount).over(frame)
    return F.when(seen == rows, money.per_unit(F.sum(amount).over(frame), F.lit(rows), 4))


def previous(amount: str) -> Column:
    return F.lag(amount, 1).over(by_day())


def change(amount: str) -> Column:
    return F.col(amount) - previous(amount)


def percent_change(amount: str) -> Column:
    """NULL on the first day and after a day of zero."""
    return money.percent_of(change(amount), previous(amount), 2)


def running_total(amount: str) -> Column:
    frame = by_day().rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(amount).over(frame).cast("decimal(20,2)")


def quartiles(daily: DataFrame, amount: str) -> DataFrame:
    """One row: q1, median, q3 by linear interpolation."""
    exact = F.percentile(F.col(amount).cast("double"), [0.25, 0.5, 0.75])
    return daily.agg(exact.alias("q")).select(
        F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
    )


def iqr_bounds(daily: DataFrame, amount: str) -> DataFrame:
    """One row: quartiles and the 1.5 IQR fences."""
    spread = F.col("q3") - F.col("q1")
    return quartiles(daily, amount).select(
        "q1",
        "median",
        "q3",
        (F.col("q1") - 1.5 * spread).alias("lower_bound"),
        (F.col("q3") + 1.5 * spread).alias("upper_bound"),
    )


def correlations(daily: DataFrame, measures: tuple[str, ...]) -> DataFrame:
    """Pearson correlation of every pair of measures in long form, from one aggregate over each
    unordered pair. NULL (not an error) when either side is constant."""
    value = {m: F.col(m).cast("double") for m in measures}
    spread = {m: f"_spread_{m}" for m in measures}
    pairs = {(a, b): f"_{a}_{b}" for i, a in enumerate(measures) for b in measures[i:]}
    moments = daily.agg(
        *[F.stddev_pop(value[m]).alias(spread[m]) for m in measures],
        *[F.covar_pop(value[a], value[b]).alias(name) for (a, b), name in pairs.items()],
    )

    def cell(a: str, b: str) -> Column:
        shared = F.col(pairs.get((a, b)) or pairs[b, a])
        ratio = F.try_divide(shared, F.col(spread[a]) * F.col(spread[b]))
        return F.struct(
            F.lit(a).alias("measure_a"),
            F.lit(b).alias("measure_b"),
            F.round(ratio, 4).alias("correlation"),
        )

    return moments.select(F.inline(F.array(*[cell(a, b) for a in measures for b in measures])))


def histogram(daily: DataFrame, amount: str, bins: int) -> DataFrame:
    """Equal-width bins over the range of ``amount``, the last one closed, empty ones included.

    A range of zero width is widened by half a unit to each side. Amounts are compared as whole
    cents, so a value on an edge always falls into the bin above it.
    """
    cents = daily.select((F.col(amount) * 100).cast("bigint").alias("_cents"))
    widen = F.when(F.min("_cents") == F.max("_cents"), F.lit(50)).otherwise(F.lit(0))
    edges = cents.agg(
        (F.min("_cents") - widen).alias("_lo"), (F.max("_cents") + widen).alias("_hi")
    )
    lo, hi = edges.select("_lo").scalar(), edges.select("_hi").scalar()
    counted = (
        cents.select("_cents", lo.alias("_lo"), hi.alias("_hi"))
        .selectExpr(f"least((_cents - _lo) * {bins} div (_hi - _lo), {bins - 1}) AS _bin")
        .groupBy("_bin")
        .agg(F.count(F.lit(1)).alias("_days"))
    )

    def edge(position: Column) -> Column:
        width = (F.col("_hi") - F.col("_lo")).cast("decimal(20,0)") * position
        in_cents = F.col("_lo").cast("decimal(24,4)") + (width / bins).cast("decimal(24,4)")
        return (in_cents / 100).cast("decimal(24,4)").cast("double")

    return (
        edges.where(F.col("_lo").isNotNull())
        .select("_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("_edge"))
        .join(counted, F.col("_edge") == F.col("_bin"), "left")
        .select(
            (F.col("_edge") + 1).alias("bin"),
            edge(F.col("_edge")).alias("lower_edge"),
            edge(F.col("_edge") + 1).alias("upper_edge"),
            F.coalesce("_days", F.lit(0)).cast("bigint").alias("days"),
        )
    )


def box_summary(daily: DataFrame, amount: str) -> DataFrame:
    """One row: quartiles, whiskers (furthest values inside the fences, but never inside the
    box) and the number of fliers."""
    bounds = iqr_bounds(daily, amount)
    low, high = bounds.select("lower_bound").scalar(), bounds.select("upper_bound").scalar()
    value = F.col(amount).cast("double")
    marked = daily.select(value.alias("_v"), low.alias("_low"), high.alias("_high"))
    inside = F.col("_v").between(F.col("_low"), F.col("_high"))
    return marked.agg(
        F.round(F.percentile("_v", 0.25), 4).alias("q1"),
        F.round(F.percentile("_v", 0.5), 4).alias("median"),
        F.round(F.percentile("_v", 0.75), 4).alias("q3"),
        F.round(
            F.least(F.min(F.when(inside, F.col("_v"))), F.percentile("_v", 0.25)), 4
        ).alias("lower_whisker"),
        F.round(
            F.greatest(F.max(F.when(inside, F.col("_v"))), F.percentile("_v", 0.75)), 4
        ).alias("upper_whisker"),
        F.count_if(~inside).alias("fliers"),
    )
