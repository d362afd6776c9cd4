"""Exploratory analytics over the star: time series, rankings, outliers, distributions.

Averages called ``avg_revenue``, ``avg_per_item`` or ``avg_per_visit`` are means over sale lines;
those called ``avg_per_transaction`` divide by distinct sales. Groups without a key are left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import labels, money
from tallyhouse.operators import days, ranking
from tallyhouse.plans.reports import (
    SALE_KEY,
    all_groups,
    distinct_sales,
    join_dimension,
    sums_by_customer_sale,
    sums_by_employee_sale,
    sums_by_product,
)
from tallyhouse.plans.star import sale_facts
from tallyhouse.schemas import MILESTONES, Tables
from tallyhouse.sources.files import seeded_sample

STAR_TABLES = (
    "dim_customer",
    "dim_employee",
    "dim_payment_method",
    "dim_product",
    "dim_time",
    "fact_sales",
)
DAILY_MEASURES = (
    "daily_revenue",
    "daily_profit",
    "daily_cost",
    "num_items",
    "num_transactions",
)


def _mean_line(lines: Column | None = None) -> Column:
    counted = F.count("revenue_cents") if lines is None else lines
    return money.per_unit(money.total("revenue_cents"), counted, 4)


def _share_of_revenue() -> Column:
    whole = F.sum("total_revenue").over(all_groups())
    return money.percent_of(F.col("total_revenue"), whole).alias("pct_of_revenue")


def table_shapes(tables: Tables) -> DataFrame:
    """One row per column of every table: name, type and the table's row count."""

    def shape(name: str) -> DataFrame:
        fields = tables[name].schema.fields
        columns = F.array(
            *[
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("data_type"),
                )
                for i, f in enumerate(fields, start=1)
            ]
        )
        counted = tables[name].agg(F.count(F.lit(1)).alias("row_count"))
        return counted.select(
            F.lit(name).alias("table_name"), "row_count", F.inline(columns)
        )

    return reduce(DataFrame.unionByName, [shape(name) for name in STAR_TABLES])


def table_samples(tables: Tables, rows: int = 5, seed: int = 42) -> Tables:
    """A repeatable random sample of every table."""
    return {name: seeded_sample(tables[name], "id", rows, seed) for name in STAR_TABLES}


def overall_totals(tables: Tables, sale_key: tuple[str, ...] = SALE_KEY) -> DataFrame:
    """One row of headline numbers. The per-day means come from the day rollup, and the distinct
    sales from their own pass, so that no aggregate mixes distincts over different keys."""
    fact = sale_facts(tables)
    daily = fact.groupBy("simulated_day").agg(
        F.sum("revenue_cents").alias("revenue_cents"),
        F.sum("cost_cents").alias("cost_cents"),
        F.sum("profit_cents").alias("profit_cents"),
        F.count(F.lit(1)).alias("lines"),
    )
    sales = fact.agg(distinct_sales(sale_key).alias("n")).scalar()
    return daily.agg(
        money.total("revenue_cents").alias("total_revenue"),
        money.total("cost_cents").alias("total_cost"),
        money.total("profit_cents").alias("total_profit"),
        money.percent_of(F.sum("profit_cents"), F.sum("revenue_cents")).alias("profit_margin_pct"),
        money.units(F.col("lines")).alias("line_items"),
        F.count("simulated_day").alias("simulated_days"),
        money.per_unit(
            money.total("revenue_cents"), F.count("simulated_day")
        ).alias("avg_revenue_per_day"),
        money.per_unit(
            money.total("profit_cents"), F.count("simulated_day")
        ).alias("avg_profit_per_day"),
    ).withColumn("unique_transactions", sales)


def overall_text(tables: Tables) -> DataFrame:
    """The headline numbers as display text, one (label, value) row each."""
    totals = overall_totals(tables)
    lines = [
        ("Total Revenue", money.currency_text(F.col("total_revenue"))),
        ("Total Cost", money.currency_text(F.col("total_cost"))),
        ("Total Profit", money.currency_text(F.col("total_profit"))),
        ("Profit Margin", money.percent_text(F.col("profit_margin_pct"))),
        ("Total Line Items", money.thousands_text(F.col("line_items"))),
        ("Unique Transactions", money.thousands_text(F.col("unique_transactions"))),
        ("Simulated Days", money.thousands_text(F.col("simulated_days"))),
        ("Avg Revenue/Day", money.currency_text(F.col("avg_revenue_per_day"))),
        ("Avg Profit/Day", money.currency_text(F.col("avg_profit_per_day"))),
    ]
    rows = F.array(*[F.struct(F.lit(k).alias("label"), v.alias("value")) for k, v in lines])
    return totals.select(F.inline(rows))


def _sums_by(tables: Tables, keys: list[str]) -> DataFrame:
    """Product sums regrouped by product attributes, lines without a product left out."""
    return (
        join_dimension(sums_by_product(tables), tables, "dim_product", keys, "left")
        .dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            money.total("revenue_cents").alias("total_revenue"),
            money.total("profit_cents").alias("total_profit"),
            money.units(F.col("units")).alias("units_sold"),
            money.units(F.col("lines")).alias("num_sales"),
        )
    )


def _margin() -> Column:
    return money.percent_of(F.col("total_profit"), F.col("total_revenue")).alias("profit_margin")


def top_products_by_name(tables: Tables, rows: int = 10) -> DataFrame:
    """Products sharing a name count as one, whatever their category."""
    best = (
        _sums_by(tables, ["name"])
        .orderBy(F.desc_nulls_last("total_revenue"), "name")
        .limit(rows)
    )
    return best.select(
        F.col("name").alias("product_name"),
        money.currency_text(F.col("total_revenue")).alias("total_revenue"),
        money.currency_text(F.col("total_profit")).alias("total_profit"),
        "units_sold",
        "num_sales",
        _margin(),
    )


def category_summary(tables: Tables) -> DataFrame:
    return (
        _sums_by(tables, ["category"])
        .select("category", "total_revenue", "total_profit", "units_sold", _margin())
        .orderBy(F.desc_nulls_last("total_revenue"), "category")
    )


def daily_rollup(tables: Tables, sale_key: tuple[str, ...] = SALE_KEY) -> DataFrame:
    """One row per trading day; ``num_items`` counts lines, not units."""
    return (
        sale_facts(tables)
        .where(F.col("simulated_day").isNotNull())
        .groupBy("simulated_day")
        .agg(
            money.total("revenue_cents").alias("daily_revenue"),
            money.total("profit_cents").alias("daily_profit"),
            money.total("cost_cents").alias("daily_cost"),
            F.count("id").alias("num_items"),
            distinct_sales(sale_key).alias("num_transactions"),
        )
    )


def daily_revenue_only(tables: Tables) -> DataFrame:
    """The part of the rollup that needs no distinct count."""
    return (
        sale_facts(tables)
        .where(F.col("simulated_day").isNotNull())
        .groupBy("simulated_day")
        .agg(
            money.total("revenue_cents").alias("daily_revenue"),
            money.total("profit_cents").alias("daily_profit"),
        )
    )


def moving_averages(tables: Tables, short: int = 30, long: int = 90) -> DataFrame:
    return (
        daily_rollup(tables)
        .withColumn(f"revenue_{short}d_avg", days.moving_average("daily_revenue", short))
        .withColumn(f"revenue_{long}d_avg", days.moving_average("daily_revenue", long))
        .orderBy("simulated_day")
    )


def first_days(tables: Tables, rows: int = 5) -> DataFrame:
    """The head of the day rollup."""
    return daily_rollup(tables).orderBy("simulated_day").limit(rows)


def daily_revenue_range(tables: Tables) -> DataFrame:
    daily = daily_revenue_only(tables)
    return daily.agg(
        F.min("daily_revenue").alias("lowest"),
        F.max("daily_revenue").alias("highest"),
        money.per_unit(F.sum("daily_revenue"), F.count("daily_revenue")).alias("mean"),
    ).select(
        "lowest",
        "highest",
        "mean",
        F.concat(
            money.currency_text(F.col("lowest")),
            F.lit(" to "),
            money.currency_text(F.col("highest")),
        ).alias("range_text"),
    )


def hourly_revenue(tables: Tables) -> DataFrame:
    return (
        join_dimension(sale_facts(tables), tables, "dim_time", ["hour_of_day"], "left")
        .dropna(subset=["hour_of_day"])
        .groupBy("hour_of_day")
        .agg(
            _mean_line().alias("avg_revenue"),
            money.total("revenue_cents").alias("total_revenue"),
        )
        .orderBy("hour_of_day")
    )


def rush_comparison(tables: Tables) -> DataFrame:
    flags = {True: "Rush Hour", False: "Non-Rush Hour"}
    return (
        join_dimension(sale_facts(tables), tables, "dim_time", ["is_rush_hour"], "left")
        .dropna(subset=["is_rush_hour"])
        .groupBy("is_rush_hour")
        .agg(
            money.total("revenue_cents").alias("total_revenue"),
            _mean_line().alias("avg_revenue"),
            money.units(F.col("quantity_sold")).alias("total_items"),
        )
        .withColumn("is_rush_hour", labels.recode(F.col("is_rush_hour"), flags))
    )


def part_of_day_breakdown(tables: Tables) -> DataFrame:
    return (
        join_dimension(sale_facts(tables), tables, "dim_time", ["part_of_day"], "left")
        .dropna(subset=["part_of_day"])
        .groupBy("part_of_day")
        .agg(
            money.total("revenue_cents").alias("total_revenue"),
            money.total("profit_cents").alias("total_profit"),
            F.count("id").alias("num_items"),
        )
        .orderBy(F.desc_nulls_last("total_revenue"), "part_of_day")
    )


def loyalty_summary(tables: Tables, sale_key: tuple[str, ...] = SALE_KEY) -> DataFrame:
    flags = {True: "Loyalty Member", False: "Walk-in"}
    grouped = (
        join_dimension(
            sums_by_customer_sale(tables, sale_key), tables, "dim_customer", ["is_loyalty"], "left"
        )
        .dropna(subset=["is_loyalty"])
        .groupBy("is_loyalty")
        .agg(
            money.total("revenue_cents").alias("total_revenue"),
            _mean_line(lines=F.sum("lines")).alias("avg_transaction"),
            money.total("profit_cents").alias("total_profit"),
            distinct_sales(sale_key).alias("num_transactions"),
        )
    )
    return grouped.select(
        labels.recode(F.col("is_loyalty"), flags).alias("is_loyalty"),
        "total_revenue",
        "avg_transaction",
        "total_profit",
        "num_transactions",
        _share_of_revenue(),
    )


def top_customers(
    tables: Tables, rows: int = 10, sale_key: tuple[str, ...] = SALE_KEY
) -> DataFrame:
    who = ["name", "is_loyalty"]
    return (
        join_dimension(
            sums_by_customer_sale(tables, sale_key), tables, "dim_customer", who, "left"
        )
        .dropna(subset=who)
        .groupBy(*who)
        .agg(
            money.total("revenue_cents").alias("total_spend"),
            distinct_sales(sale_key).alias("total_visits"),
            _mean_line(lines=F.sum("lines")).alias("avg_per_visit"),
        )
        .orderBy(F.desc_nulls_last("total_spend"), "name", "is_loyalty")
        .limit(rows)
    )


def employee_performance(tables: Tables, sale_key: tuple[str, ...] = SALE_KEY) -> DataFrame:
    grouped = (
        join_dimension(
            sums_by_employee_sale(tables, sale_key),
            tables,
            "dim_employee",
            ["name", "role"],
            "left",
        )
        .dropna(subset=["name", "role"])
        .groupBy(F.col("name").alias("employee_name"), "role")
        .agg(
            money.total("revenue_cents").alias("total_revenue"),
            money.total("profit_cents").alias("total_profit"),
            distinct_sales(sale_key).alias("num_transactions"),
            money.units(F.col("quantity_sold")).alias("items_sold"),
        )
    )
    average = money.per_unit(F.col("total_revenue"), F.col("num_transactions"))
    return grouped.withColumn("avg_per_transaction", average).orderBy(
        F.desc_nulls_last("total_revenue"), "employee_name", "role"
    )


def payment_summary(tables: Tables, sale_key: tuple[str, ...] = SALE_KEY) -> DataFrame:
    grouped = (
        join_dimension(sale_facts(tables), tables, "dim_payment_method", ["method"], "left")
        .dropna(subset=["method"])
        .groupBy("method")
        .agg(
            money.total("revenue_cents").alias("total_revenue"),
            _mean_line().alias("avg_per_item"),
            distinct_sales(sale_key).alias("num_transactions"),
        )
    )
    return grouped.select("*", _share_of_revenue()).orderBy(
        F.desc_nulls_last("total_revenue"), "method"
    )


def day_over_day(tables: Tables) -> DataFrame:
    return (
        daily_revenue_only(tables)
        .select(
            "simulated_day",
            "daily_revenue",
            days.previous("daily_revenue").alias("prev_day_revenue"),
            days.change("daily_revenue").cast("decimal(20,2)").alias("day_over_day_change"),
            days.percent_change("daily_revenue").alias("day_over_day_pct"),
        )
        .orderBy("simulated_day")
    )


def _extreme_days(tables: Tables, order: Column, rows: int) -> DataFrame:
    return (
        day_over_day(tables)
        .select("simulated_day", "daily_revenue", "day_over_day_pct")
        .orderBy(order, "simulated_day")
        .limit(rows)
    )


def best_days(tables: Tables, rows: int = 5) -> DataFrame:
    return _extreme_days(tables, F.desc_nulls_last("daily_revenue"), rows)


def worst_days(tables: Tables, rows: int = 5) -> DataFrame:
    return _extreme_days(tables, F.asc_nulls_last("daily_revenue"), rows)


def cumulative(tables: Tables) -> DataFrame:
    return (
        daily_revenue_only(tables)
        .select(
            "simulated_day",
            "daily_revenue",
            days.running_total("daily_revenue").alias("cumulative_revenue"),
            days.running_total("daily_profit").alias("cumulative_profit"),
        )
        .orderBy("simulated_day")
    )


def milestone_days(tables: Tables, milestones: tuple[int, ...] = MILESTONES) -> DataFrame:
    """First day on which the running revenue reaches each milestone, NULL if it never does; one
    pass for all milestones."""
    reached = [
        F.struct(
            F.lit(m).cast("bigint").alias("milestone"),
            F.min(F.when(F.col("cumulative_revenue") >= m, F.col("simulated_day"))).alias(
                "day_reached"
            ),
        )
        for m in milestones
    ]
    return cumulative(tables).agg(F.array(*reached).alias("m")).select(F.inline("m"))


def _product_revenue(tables: Tables) -> DataFrame:
    return _sums_by(tables, ["category", "name"]).select(
        "category", F.col("name").alias("product_name"), F.col("total_revenue").alias("revenue")
    )


def rank_in_category(tables: Tables) -> DataFrame:
    """Dense rank of every product within its category by revenue."""
    ranked = ranking.dense_rank_desc(
        _product_revenue(tables), "category", "revenue", "rank_in_category"
    )
    return ranked.select("category", "product_name", "revenue", "rank_in_category")


def top_per_category(tables: Tables) -> DataFrame:
    """Every product of dense rank 1. Equal to holding the category's highest revenue, which needs
    a maximum instead of a sort."""
    revenue = _product_revenue(tables)
    highest = revenue.groupBy("category").agg(F.max("revenue").alias("revenue"))
    return (
        revenue.join(highest, ["category", "revenue"])
        .select("category", "product_name", "revenue", F.lit(1).cast("bigint").alias("rank_in_category"))
        .orderBy(F.desc("revenue"), "category", "product_name")
    )


def outlier_bounds(tables: Tables) -> DataFrame:
    """Quartiles, fences and the number of days outside them."""
    daily = daily_revenue_only(tables)
    fences = days.iqr_bounds(daily, "daily_revenue")
    outside = _outside(daily, fences).agg(F.count(F.lit(1)).alias("n")).scalar()
    return fences.select(
        *[F.round(c, 4).alias(c) for c in ("q1", "q3", "lower_bound", "upper_bound")],
    ).withColumn("outlier_days", outside)


def _outside(daily: DataFrame, fences: DataFrame) -> DataFrame:
    revenue = F.col("daily_revenue").cast("double")
    low = fences.select("lower_bound").scalar()
    high = fences.select("upper_bound").scalar()
    return daily.where((revenue < low) | (revenue > high))


def outlier_days(tables: Tables) -> DataFrame:
    daily = daily_revenue_only(tables)
    outside = _outside(daily, days.iqr_bounds(daily, "daily_revenue"))
    return outside.select("simulated_day", "daily_revenue").orderBy("simulated_day")


def daily_correlation(tables: Tables) -> DataFrame:
    """Correlation matrix of the daily measures."""
    return days.correlations(daily_rollup(tables), DAILY_MEASURES)


def revenue_histogram(tables: Tables, bins: int = 50) -> DataFrame:
    return days.histogram(daily_revenue_only(tables), "daily_revenue", bins)


def revenue_box(tables: Tables) -> DataFrame:
    return days.box_summary(daily_revenue_only(tables), "daily_revenue")
