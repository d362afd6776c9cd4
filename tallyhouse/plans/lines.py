"""Analytics over single sale lines, where a task must not see all of them."""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import schemas as S
from tallyhouse.functions import money
from tallyhouse.operators.prefix import ROWS_PER_RANGE, running
from tallyhouse.operators.quantiles import exact_quantiles
from tallyhouse.plans.star import sale_facts
from tallyhouse.schemas import Tables

LINE = ["simulated_day", "source_transaction_id", "id"]
# Line numbers may repeat within a sale; lines alike in all of this can stand for each other.
ORDER = [*LINE, "revenue_cents", "profit_cents"]
WHISKER = Fraction(3, 2)
QUARTER_CENTS = "decimal(20,4)"


def running_revenue(tables: Tables, frame: int = 30, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Every line in the order of days, sales and lines, with revenue and profit so far and the mean
    revenue of the last ``frame`` lines (NULL until there are so many)."""
    lines = sale_facts(tables).select(*ORDER)
    totals = {"revenue_cents": "_revenue", "profit_cents": "_profit"}
    found = running(lines, ORDER, totals, {"revenue_cents": "_moving"}, frame, rows_per_range)
    return found.select(
        *LINE,
        money.from_cents(F.col("_revenue")).alias("running_revenue"),
        money.from_cents(F.col("_profit")).alias("running_profit"),
        money.per_unit(money.from_cents(F.col("_moving")), F.lit(frame), 4).alias("mean_revenue"),
    )


def _amount(cents: Fraction | None) -> Column:
    """A quartile has at most two more decimals than its values."""
    text = None if cents is None else str(int(cents * 4) * 25)
    return F.lit(text).cast("decimal(20,0)") * F.lit("0.0001").cast("decimal(5,4)")


def line_revenue_box(tables: Tables) -> DataFrame:
    """Quartiles, whiskers (the furthest values within 1.5 interquartile ranges) and how many lines
    lie outside, of the revenue of single lines."""
    facts = sale_facts(tables).select("revenue_cents")
    q1, q2, q3 = exact_quantiles(facts, "revenue_cents", [0.25, 0.5, 0.75])
    value = F.col("revenue_cents")
    if q1 is None:
        inside = F.lit(False)
    else:
        low, high = q1 - WHISKER * (q3 - q1), q3 + WHISKER * (q3 - q1)
        inside = value.between(math.ceil(low), math.floor(high))
    quartiles = {name: _amount(q).cast(QUARTER_CENTS) for name, q in (("q1", q1), ("median", q2), ("q3", q3))}
    return (
        facts.agg(
            F.count("revenue_cents").alias("lines"),
            money.from_cents(F.min(F.when(inside, value)), S.MONEY_SUM).alias("low_whisker"),
            money.from_cents(F.max(F.when(inside, value)), S.MONEY_SUM).alias("high_whisker"),
            F.count_if(~inside).alias("outliers"),
        )
        .withColumns(quartiles)
        .select("lines", "q1", "median", "q3", "low_whisker", "high_whisker", "outliers")
    )
