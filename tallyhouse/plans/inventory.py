"""Stock after every sale, the purchase orders that keep it up, and who is at the till.

Stock starts at S0. A sale lowers it; if it is then at or below T, one order of Q arrives at once.
With C_n the units sold up to the n-th sale of a product, stock would call for
D_n = floor((C_n - (S0 - T)) / Q) + 1 orders (0 while C_n < S0 - T) if a sale could trigger several.
A sale triggers at most one, so R_n = min(R_{n-1} + 1, D_n), which unrolls to

    R_n = n + min(R_0, min_{k <= n} (D_k - k))

and stock is S0 - C_n + Q * R_n. Running sums and running minima are all it takes, for sales of any
size, so there is no sequential pass.

A product on a third of all sales must not end in one task. Sales are cut into ranges of sale numbers
that hold about ``BLOCK_ROWS`` lines each, however the numbers are spread; each (product, block) is a
window of its own and starts from totals of the blocks before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse import schemas as S
from tallyhouse.functions import labels
from tallyhouse.schemas import Tables
from tallyhouse.storage import stage

BLOCK_ROWS = 1 << 20
# Lines that a task of the ledger sorts, on average.
TASK_ROWS = 1 << 17


def _present(column: str) -> Column:
    """A column that a sale line must have; a line without it ends the job rather than vanish."""
    return F.coalesce(F.col(column), F.raise_error(F.lit(f"a sale line without {column}"))).alias(column)


def blocked_lines(sales: DataFrame, keys: list[str], block_rows: int, rows: int | None = None) -> DataFrame:
    """The lines with the number of their block. Ranges are cut by the rows they hold; the block of a
    line is stored, so that it is the same wherever it is used."""
    columns = [*keys, "transaction_id", "quantity"]
    lines = sales.select(*map(_present, columns))
    blocks = -(-(sales.count() if rows is None else rows) // block_rows)
    if blocks <= 1:
        return lines.withColumn("_block", F.lit(0))
    ranged = lines.repartitionByRange(blocks, "transaction_id")
    return stage(ranged.withColumn("_block", F.spark_partition_id()), "sale-blocks")


def ledger(
    sales: DataFrame,
    reset_daily: bool = False,
    opening_stock: int = S.OPENING_STOCK,
    threshold: int = S.REORDER_THRESHOLD,
    order_quantity: int = S.REORDER_QUANTITY,
    state: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
    levels: DataFrame | None = None,
) -> DataFrame:
    """One row per product and sale, in order of sale number.

    ``sales``: product_id, transaction_id, quantity and, with ``reset_daily``, simulated_day: stock
    then starts afresh every day. A line without one of them ends the job with an error, and so
    does a product's sale of less than nothing: returns would need orders to be taken back.
    ``levels``: product_id, quantity_on_hand, reorder_threshold as the shop has them stored; products
    without them start from ``opening_stock`` and ``threshold``. ``state``: product_id, units_sold,
    reorders reached by earlier sales, for continuing a ledger.
    """
    keys = ["product_id", "simulated_day"] if reset_daily else ["product_id"]
    group = [*keys, "_block"]
    gap = F.col("_stock_0") - F.col("_threshold")

    def wanted(sold: Column) -> Column:
        """Orders called for once ``sold`` units are gone."""
        steps = F.call_function("div", sold - gap, F.lit(order_quantity))
        return F.when(sold < gap, F.lit(0)).otherwise(steps + 1).cast("bigint")

    # The lines are clustered once; the sums per sale and all windows below reuse that shuffle. Their
    # sorts share a task's memory, so the tasks number as many as the lines call for.
    units = F.sum("quantity").cast("bigint")
    rows = sales.count()
    blocked = (
        blocked_lines(sales, keys, block_rows, rows)
        .repartition(max(1, -(-rows // TASK_ROWS)), *group)
        .groupBy(*group, "transaction_id")
        .agg(F.when(units < 0, F.raise_error(F.lit("a sale of less than nothing"))).otherwise(units).alias("quantity"))
    )
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    totals = blocked.groupBy(*group).agg(
        F.sum("quantity").alias("_units"),
        F.count(F.lit(1)).alias("_sales"),
        F.max("quantity").alias("_largest"),
    )
    starts = totals.select(
        *group,
        F.coalesce(F.sum("_units").over(before), F.lit(0)).alias("_units_before"),
        F.coalesce(F.sum("_sales").over(before), F.lit(0)).alias("_sales_before"),
        F.max("_largest").over(whole).alias("_largest"),
    )
    if state is None:
        units_0, orders_0 = F.lit(0), F.lit(0)
    else:
        carried = state.select(
            "product_id", F.col("units_sold").alias("_u0"), F.col("reorders").alias("_r0")
        )
        starts = starts.join(carried, "product_id", "left")
        units_0, orders_0 = F.coalesce("_u0", F.lit(0)), F.coalesce("_r0", F.lit(0))
    if levels is None:
        starts = starts.withColumns({"_stock_0": F.lit(opening_stock), "_threshold": F.lit(threshold)})
    else:
        stored = levels.select(
            "product_id",
            F.col("quantity_on_hand").alias("_stock_0"),
            F.col("reorder_threshold").alias("_threshold"),
        )
        starts = starts.join(stored, "product_id", "left").withColumns(
            {
                "_stock_0": F.coalesce("_stock_0", F.lit(opening_stock)),
                "_threshold": F.coalesce("_threshold", F.lit(threshold)),
            }
        )
    starts = starts.select(
        *group,
        "_stock_0",
        "_threshold",
        (units_0 + F.col("_units_before")).alias("_units_before"),
        "_sales_before",
        orders_0.cast("bigint").alias("_orders_0"),
        # While no sale exceeds one order, and none did before, R_n = D_n: no minimum is needed.
        ((F.col("_largest") <= order_quantity) & (orders_0 == wanted(units_0))).alias("_in_step"),
    )

    inside = Window.partitionBy(*group).orderBy("transaction_id")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)

    def positioned(block_starts: DataFrame) -> DataFrame:
        return (
            blocked.withColumn("_units", F.sum("quantity").over(upto))
            .withColumn("_n", F.row_number().over(inside))
            .join(block_starts, group)
            .withColumn("units_sold", F.col("_units_before") + F.col("_units"))
            .withColumn("_n", F.col("_sales_before") + F.col("_n"))
            .withColumn("_gap", wanted(F.col("units_sold")) - F.col("_n"))
        )

    def finished(rows: DataFrame, orders: Column, orders_before: Column) -> DataFrame:
        return rows.withColumn("reorders", orders).select(
            *keys,
            "transaction_id",
            "quantity",
            "units_sold",
            "reorders",
            (F.col("reorders") > orders_before).alias("reordered"),
            (F.col("_stock_0") - F.col("units_sold") + order_quantity * F.col("reorders"))
            .cast("bigint")
            .alias("stock_on_hand"),
        )

    in_step = finished(
        positioned(starts.where(F.col("_in_step"))),
        wanted(F.col("units_sold")),
        wanted(F.col("units_sold") - F.col("quantity")),
    )
    # Products with an oversized sale. Usually there are none and this half is dropped at run time.
    behind = positioned(starts.where(~F.col("_in_step")))
    gaps_before = (
        behind.groupBy(*group)
        .agg(F.min("_gap").alias("_lowest"))
        .select(*group, F.min("_lowest").over(before).alias("_gap_before"))
    )
    behind = finished(
        behind.join(gaps_before, group),
        F.col("_n") + F.least("_orders_0", "_gap_before", F.min("_gap").over(upto)),
        F.col("_n") - 1 + F.least("_orders_0", "_gap_before", F.min("_gap").over(earlier)),
    )
    return in_step.unionByName(behind)


def purchase_orders(
    stock: DataFrame, oltp: Tables, order_quantity: int = S.REORDER_QUANTITY
) -> DataFrame:
    """One order per ledger row that triggered one, placed at the time of the sale. Goods arrive
    at once and no receipt date is recorded."""
    placed = stock.where(F.col("reordered")).select("product_id", "transaction_id")
    supplier = oltp["products"].select(
        F.col("id").alias("product_id"), "supplier_id", F.col("unit_cost").alias("cost_per_unit")
    )
    time = oltp["transactions"].select(
        F.col("id").alias("transaction_id"), F.col("transaction_time").alias("order_date")
    )
    return (
        placed.join(supplier, "product_id")
        .join(time, "transaction_id")
        .select(
            "supplier_id",
            "product_id",
            F.lit(order_quantity).alias("quantity_ordered"),
            "cost_per_unit",
            "order_date",
            F.lit(None).cast("timestamp_ntz").alias("received_date"),
            "transaction_id",
        )
    )


def closing_stock(stock: DataFrame, oltp: Tables, reset_daily: bool = False) -> DataFrame:
    """Stock after the last sale and the time of the last order. Without daily reset, products
    never sold appear with the stock they started with: ``oltp["inventory"]``, which the ledger has
    to be made with as well."""
    keys = ["product_id", "simulated_day"] if reset_daily else ["product_id"]
    last = stock.groupBy(*keys).agg(
        F.max_by("stock_on_hand", "transaction_id").alias("quantity_on_hand"),
        F.max("reorders").alias("reorders"),
        F.max(F.when(F.col("reordered"), F.col("transaction_id"))).alias("_restocked_by"),
    )
    time = oltp["transactions"].select(
        F.col("id").alias("_restocked_by"), F.col("transaction_time").alias("last_restocked")
    )
    sold = last.join(time, "_restocked_by", "left").drop("_restocked_by")
    if reset_daily:
        return sold.select(*keys, "quantity_on_hand", "reorders", "last_restocked")
    opening = oltp["inventory"].select("product_id", F.col("quantity_on_hand").alias("_opening"))
    return opening.join(sold, "product_id", "left").select(
        "product_id",
        F.coalesce("quantity_on_hand", F.col("_opening").cast("bigint")).alias("quantity_on_hand"),
        labels.or_default(F.col("reorders"), 0).cast("bigint").alias("reorders"),
        "last_restocked",
    )


def roster(employees: DataFrame) -> DataFrame:
    """Cashiers on shift in each open hour; an hour without any falls to the first cashier.

    Every cashier is expanded to the hours of the shift (at most the open hours of a day), so
    coverage is an equality on the hour rather than a range join.
    """
    cashiers = employees.where(F.col("role") == "Cashier")
    first = F.greatest("shift_start_hour", F.lit(S.OPEN_HOUR))
    last = F.least(F.col("shift_end_hour") - 1, F.lit(S.LAST_HOUR))
    on_shift = cashiers.where(first <= last).select(
        F.explode(F.sequence(first, last)).alias("hour_of_day"), F.col("id").alias("employee_id")
    )
    hours = employees.sparkSession.range(S.OPEN_HOUR, S.LAST_HOUR + 1).select(
        F.col("id").cast("int").alias("hour_of_day")
    )
    fallback = cashiers.agg(F.min("id").alias("id")).scalar()
    return hours.join(on_shift, "hour_of_day", "left").select(
        "hour_of_day",
        F.coalesce("employee_id", fallback).alias("employee_id"),
        F.col("employee_id").isNull().alias("is_fallback"),
    )
