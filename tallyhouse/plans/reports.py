"""The standing reports over the star.

Sums are taken per surrogate key before joining a dimension that may be large (products,
customers): one row per key and task is shuffled instead of the lines, and a key on a third of all
lines is an ordinary row by the time it meets the join. Counting distinct sales groups by
(label, sale) first, which spreads any hot label over its sales.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallyhouse.functions import labels, money
from tallyhouse.plans.star import sale_facts
from tallyhouse.schemas import Tables

# A sale number identifies a sale only within one life of the operational database; add the day
# where numbering restarts.
SALE_KEY = ("source_transaction_id",)


def all_groups() -> WindowSpec:
    """Every row at once: only over a handful of already grouped rows."""
    return Window.partitionBy()


def distinct_sales(sale_key: tuple[str, ...] = SALE_KEY) -> Column:
    return F.count_distinct(*sale_key)


def line_count(facts: DataFrame) -> Column:
    """Lines with an amount; rows that are sums over lines bring their number."""
    return F.sum("lines") if "lines" in facts.columns else F.count("revenue_cents")


def join_dimension(df: DataFrame, tables: Tables, name: str, columns: list[str],
                   how: str = "inner") -> DataFrame:
    """Join a dimension on its surrogate key, reading only ``columns`` of it."""
    dimension = tables[name].select(F.col("id").alias(f"{name}_id"), *columns)
    return df.join(dimension, f"{name}_id", how)


def daily_revenue(tables: Tables, sale_key: tuple[str, ...] = SALE_KEY) -> DataFrame:
    facts = sale_facts(tables)
    return (
        facts.groupBy("simulated_day")
        .agg(
            distinct_sales(sale_key).alias("total_transactions"),
            money.units(F.col("quantity_sold")).alias("total_items_sold"),
            money.total("revenue_cents").alias("total_revenue"),
            money.total("cost_cents").alias("total_cost"),
            money.total("profit_cents").alias("total_profit"),
            money.per_unit(money.total("revenue_cents"), line_count(facts)).alias("avg_revenue_per_item"),
        )
        .orderBy("simulated_day")
    )


def revenue_by_hour(tables: Tables, sale_key: tuple[str, ...] = SALE_KEY) -> DataFrame:
    hour = ["hour_of_day", "time_label", "part_of_day", "is_rush_hour"]
    facts = sale_facts(tables)
    return (
        join_dimension(facts, tables, "dim_time", hour)
        .groupBy(*hour)
        .agg(
            distinct_sales(sale_key).alias("total_transactions"),
            money.total("revenue_cents").alias("total_revenue"),
            money.per_unit(money.total("revenue_cents"), line_count(facts)).alias("avg_revenue_per_item"),
        )
        .orderBy(F.asc_nulls_last("hour_of_day"))
    )


def sums_by_product(tables: Tables, *more_keys: str) -> DataFrame:
    facts = sale_facts(tables)
    return (
        facts.groupBy("dim_product_id", *more_keys)
        .agg(
            F.sum("quantity_sold").alias("units"),
            F.sum("revenue_cents").alias("revenue_cents"),
            F.sum("profit_cents").alias("profit_cents"),
            (F.sum("lines") if "lines" in facts.columns else F.count(F.lit(1))).alias("lines"),
        )
    )


def _product_totals(tables: Tables, keys: list[Column]) -> DataFrame:
    return (
        join_dimension(sums_by_product(tables), tables, "dim_product", ["name", "category"])
        .groupBy(*keys)
        .agg(
            money.units(F.col("units")).alias("total_units_sold"),
            money.total("revenue_cents").alias("total_revenue"),
            money.total("profit_cents").alias("total_profit"),
        )
    )


def _with_margin(df: DataFrame) -> DataFrame:
    margin = money.percent_of(F.col("total_profit"), F.col("total_revenue"))
    return df.withColumn("profit_margin_pct", margin)


def top_products(tables: Tables, rows: int = 10) -> DataFrame:
    totals = _product_totals(tables, [F.col("name").alias("product"), F.col("category")])
    order = [F.desc_nulls_first("total_revenue"), "product", "category"]
    return _with_margin(totals.orderBy(*order).limit(rows))


def revenue_by_category(tables: Tables) -> DataFrame:
    totals = _product_totals(tables, [F.col("category")])
    return _with_margin(totals).orderBy(F.desc_nulls_first("total_revenue"), "category")


def bottom_products(tables: Tables, rows: int = 10) -> DataFrame:
    totals = _product_totals(tables, [F.col("name").alias("product"), F.col("category")])
    order = [F.asc_nulls_last("total_units_sold"), "product", "category"]
    return totals.drop("total_profit").orderBy(*order).limit(rows)


def sums_by_customer_sale(tables: Tables, sale_key: tuple[str, ...] = SALE_KEY) -> DataFrame:
    """One row per customer and sale: the anonymous customer's share is spread by sale."""
    facts = sale_facts(tables)
    return (
        facts.groupBy("dim_customer_id", *sale_key)
        .agg(
            F.sum("revenue_cents").alias("revenue_cents"),
            F.sum("profit_cents").alias("profit_cents"),
            line_count(facts).alias("lines"),
        )
    )


def loyalty_split(tables: Tables, sale_key: tuple[str, ...] = SALE_KEY) -> DataFrame:
    """Grouped on the raw flag: members without a flag form a second walk-in row."""
    grouped = (
        join_dimension(
            sums_by_customer_sale(tables, sale_key), tables, "dim_customer", ["is_loyalty"]
        )
        .groupBy("is_loyalty")
        .agg(
            distinct_sales(sale_key).alias("total_transactions"),
            money.total("revenue_cents").alias("total_revenue"),
        )
    )
    return grouped.orderBy(F.desc_nulls_first("is_loyalty")).select(
        labels.flag_label(F.col("is_loyalty"), "Loyalty Member", "Walk-In").alias("customer_type"),
        "total_transactions",
        "total_revenue",
        money.per_unit(F.col("total_revenue"), F.col("total_transactions")).alias(
            "avg_spend_per_transaction"
        ),
    )


def _share_of_sales() -> Column:
    return money.percent_of(
        F.col("total_transactions"), F.sum("total_transactions").over(all_groups())
    ).alias("pct_of_transactions")


def payment_breakdown(tables: Tables, sale_key: tuple[str, ...] = SALE_KEY) -> DataFrame:
    grouped = (
        join_dimension(sale_facts(tables), tables, "dim_payment_method", ["method"])
        .groupBy(F.col("method").alias("payment_method"))
        .agg(
            distinct_sales(sale_key).alias("total_transactions"),
            money.total("revenue_cents").alias("total_revenue"),
        )
    )
    return grouped.select("*", _share_of_sales()).orderBy(
        F.desc("total_transactions"), "payment_method"
    )


def sums_by_employee_sale(tables: Tables, sale_key: tuple[str, ...] = SALE_KEY) -> DataFrame:
    """Amounts per employee and sale, of sales with an employee: what is joined with the employees is
    one row per sale and not one per line."""
    return (
        sale_facts(tables)
        .where(F.col("dim_employee_id").isNotNull())
        .groupBy("dim_employee_id", *sale_key)
        .agg(
            F.sum("revenue_cents").alias("revenue_cents"),
            F.sum("profit_cents").alias("profit_cents"),
            F.sum("quantity_sold").alias("quantity_sold"),
        )
    )


def cashier_performance(tables: Tables, sale_key: tuple[str, ...] = SALE_KEY) -> DataFrame:
    """Sales without an employee are left out by the inner join."""
    grouped = (
        join_dimension(sums_by_employee_sale(tables, sale_key), tables, "dim_employee", ["name", "role"])
        .groupBy(F.col("name").alias("employee"), "role")
        .agg(
            distinct_sales(sale_key).alias("total_transactions"),
            money.total("revenue_cents").alias("total_revenue_processed"),
        )
    )
    average = money.per_unit(F.col("total_revenue_processed"), F.col("total_transactions"))
    return grouped.withColumn("avg_transaction_value", average).orderBy(
        F.desc_nulls_first("total_revenue_processed"), "employee", "role"
    )


def rush_hour_split(tables: Tables, sale_key: tuple[str, ...] = SALE_KEY) -> DataFrame:
    facts = sale_facts(tables)
    grouped = (
        join_dimension(facts, tables, "dim_time", ["is_rush_hour"])
        .groupBy("is_rush_hour")
        .agg(
            distinct_sales(sale_key).alias("total_transactions"),
            money.total("revenue_cents").alias("total_revenue"),
            money.per_unit(money.total("revenue_cents"), line_count(facts)).alias("avg_revenue_per_item"),
        )
    )
    return grouped.orderBy(F.desc_nulls_first("is_rush_hour")).select(
        labels.flag_label(F.col("is_rush_hour"), "Rush Hour", "Off-Peak").alias("period"),
        "total_transactions",
        "total_revenue",
        "avg_revenue_per_item",
        _share_of_sales(),
    )


def category_by_day(tables: Tables) -> DataFrame:
    return (
        join_dimension(
            sums_by_product(tables, "simulated_day"), tables, "dim_product", ["category"]
        )
        .groupBy("simulated_day", "category")
        .agg(money.total("revenue_cents").alias("revenue"))
        .orderBy("simulated_day", F.desc_nulls_first("revenue"), "category")
    )


def row_counts(tables: Tables) -> DataFrame:
    names = ["fact_sales", "dim_time", "dim_product", "dim_customer", "dim_employee",
             "dim_payment_method"]
    counts = None
    for name in names:
        one = tables[name].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts
