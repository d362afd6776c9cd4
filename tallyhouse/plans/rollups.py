"""Reports from sums kept per day, and approximate counts from sketches kept per day.

Three derived tables follow the partitions of the sale lines (``plans/derived.py``): after a day was
loaded again only the partition with that day is read and built anew.

* Sales: one row per sale and set of keys, with its sums. Its sale numbers are the key set from which
  distinct sales are counted exactly, over any days and labels.
* Products: one row per day and product. Sums add up over days.
* Sketches: one row per day, from which the number of sales in any range of days is estimated
  without reading a sale.

The first two stand in for the lines in the tables given to a report: reports add up sums and count
distinct sales, and take the number of lines from the rows' counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.plans import derived, star
from tallyhouse.plans.star import BLOCK, CENTS
from tallyhouse.schemas import Tables

SALES, PRODUCTS, SKETCHES = "sales-by-day", "products-by-day", "sketches-by-day"
SALE_KEYS = [
    "simulated_day", "source_transaction_id", "dim_time_id", "dim_customer_id", "dim_employee_id",
    "dim_payment_method_id",
]
PRODUCT_KEYS = ["simulated_day", "dim_product_id"]
# 2^14 registers: a standard error below one per cent in 16 KB at most.
SKETCH_SIZE = 14


def _sums() -> list[Column]:
    amounts = [F.sum(c).alias(c) for c in CENTS]
    return [F.sum("quantity_sold").cast("bigint").alias("quantity_sold"), *amounts, F.count(CENTS[0]).alias("lines")]


def _by(keys: list[str]) -> derived.Build:
    def build(lines: DataFrame) -> DataFrame:
        return lines.where("accepted").groupBy(BLOCK, *keys).agg(*_sums())

    return build


def _sketched(lines: DataFrame) -> DataFrame:
    sketch = F.hll_sketch_agg("source_transaction_id", SKETCH_SIZE).alias("sketch")
    return lines.where("accepted").groupBy(BLOCK, "simulated_day").agg(sketch)


def _standing_in(spark: SparkSession, root: str, name: str, keys: list[str]) -> Tables:
    rows, _ = derived.refresh(spark, root, name, _by(keys))
    missing = [c for c in SALE_KEYS + PRODUCT_KEYS if c not in keys]
    rows = rows.drop(BLOCK).withColumns({c: F.lit(None).cast("bigint") for c in missing})
    return star.read_star(spark, root) | {"sums": rows}


def by_sale(spark: SparkSession, root: str) -> Tables:
    """The star with a row per sale instead of per line: for reports by day, hour, customer, employee
    and payment method."""
    return _standing_in(spark, root, SALES, SALE_KEYS)


def by_product(spark: SparkSession, root: str) -> Tables:
    """The star with a row per day and product instead of per line: for reports by day, product and
    category that count no sales."""
    return _standing_in(spark, root, PRODUCTS, PRODUCT_KEYS)


def approximate_sales(spark: SparkSession, root: str, ranges: DataFrame) -> DataFrame:
    """``ranges`` (first_day, last_day) with about how many distinct sales they have. Sketches are
    merged, so a sale seen on two days counts once; the lines are not read."""
    sketches, _ = derived.refresh(spark, root, SKETCHES, _sketched)
    of_range = ranges.select("first_day", "last_day", F.explode(F.sequence("first_day", "last_day")).alias("simulated_day"))
    return (
        of_range.join(sketches.drop(BLOCK), "simulated_day")
        .groupBy("first_day", "last_day")
        .agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("sales"))
    )


def exact_sales(tables: Tables, ranges: DataFrame) -> DataFrame:
    """The same ranges, counted."""
    of_range = ranges.select("first_day", "last_day", F.explode(F.sequence("first_day", "last_day")).alias("simulated_day"))
    sales = tables["fact_sales"].select("simulated_day", "source_transaction_id").distinct()
    return (
        of_range.join(sales, "simulated_day")
        .select("first_day", "last_day", "source_transaction_id")
        .distinct()
        .groupBy("first_day", "last_day")
        .agg(F.count(F.lit(1)).alias("sales"))
    )
