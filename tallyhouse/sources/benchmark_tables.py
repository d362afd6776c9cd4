"""The given benchmark tables seen as the operational store of a shop.

The mapping is chosen so that every loading rule has something to act on: hours outside opening
time, an unknown payment method, sales without an employee, prices at sale below list price and
product names shared by several products.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.functions import labels, money
from tallyhouse.schemas import (
    MONEY,
    OPENING_STOCK,
    PAYMENT_METHODS,
    PRICE,
    REORDER_THRESHOLD,
    Tables,
)

FIRST_DAY = "1995-01-01"
FEED_FIRST_DAY = "2024-01-01"


_SCHEMAS: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is taken from the files once, not once per query."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def _supplier_count(spark: SparkSession, sf_dir: str) -> Column:
    """One number as a scalar subquery: part of the plan, nothing is collected here."""
    supplier = table(spark, sf_dir, "supplier")
    return supplier.agg((F.max("s_suppkey") + 1).alias("n")).scalar()


def _price_at_sale() -> Column:
    one = F.lit(1).cast("decimal(3,2)")
    discount = F.col("l_discount").cast("decimal(3,2)")
    return F.round(F.col("p_retailprice").cast(PRICE) * (one - discount), 2).cast(PRICE)


def transaction_items(
    spark: SparkSession, sf_dir: str, lines: DataFrame | None = None
) -> DataFrame:
    """The line items; ``lines`` may be a stream over the same rows."""
    lines = (table(spark, sf_dir, "lineitem") if lines is None else lines).select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount"
    )
    prices = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    quantity = F.col("l_quantity").cast("int")
    return (
        lines.join(prices, F.col("l_partkey") == F.col("p_partkey"), "left")
        .withColumn("unit_price_at_sale", _price_at_sale())
        .select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
            F.col("l_orderkey").alias("transaction_id"),
            F.col("l_partkey").alias("product_id"),
            quantity.alias("quantity"),
            "unit_price_at_sale",
            money.subtotal(F.col("unit_price_at_sale"), quantity).alias("subtotal"),
        )
    )


def sold_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items without prices, for what needs no join with the products."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )


def transactions(spark: SparkSession, sf_dir: str, items: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    hour = (7 + key % 16).cast("int")
    payment = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "cash")
        .when(F.col("o_orderpriority") == "2-HIGH", "credit")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "debit")
        .when(F.col("o_orderpriority") == "5-LOW", "mobile")
        .otherwise("voucher")
    )
    # A reader that does not ask for the total pays nothing: the right side is unique on its key,
    # so the optimizer removes the join.
    totals = items.groupBy("transaction_id").agg(F.sum("subtotal").alias("items_total"))
    seeded_defect = F.when(key % 100 == 0, F.lit("0.05")).otherwise("0.00").cast("decimal(3,2)")
    total = F.coalesce("items_total", F.lit(0).cast(MONEY)) + seeded_defect
    return (
        table(spark, sf_dir, "orders")
        .join(totals, key == F.col("transaction_id"), "left")
        .select(
            key.alias("id"),
            F.col("o_custkey").alias("customer_id"),
            F.when(key % 20 != 0, key % _supplier_count(spark, sf_dir)).alias("employee_id"),
            labels.at_clock(
                F.to_date("o_orderdate"), hour, F.lit(0), F.lit(0)
            ).alias("transaction_time"),
            payment.alias("payment_method"),
            total.cast(MONEY).alias("total_amount"),
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice").cast(PRICE)
    share = (F.lit("0.1").cast("decimal(2,1)") * (4 + F.col("p_size") % 5)).cast("decimal(2,1)")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        price.alias("unit_price"),
        F.round(price * share, 2).cast(PRICE).alias("unit_cost"),
        (F.col("p_partkey") % _supplier_count(spark, sf_dir)).alias("supplier_id"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    member = F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.when(member, F.concat("c_name", F.lit("@email.com"))).alias("email"),
        F.lit(FIRST_DAY).cast("date").alias("join_date"),
    )


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = (8 + 2 * (F.col("s_suppkey") % 4)).cast("int")
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_suppkey") % 4 == 3, "Supervisor").otherwise("Cashier").alias("role"),
        start.alias("shift_start_hour"),
        (start + 8).alias("shift_end_hour"),
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.lit(None).cast("string").alias("contact_info"),
        F.lit(1).alias("lead_time_days"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.lit(OPENING_STOCK).alias("quantity_on_hand"),
        F.lit(REORDER_THRESHOLD).alias("reorder_threshold"),
        F.lit(None).cast("timestamp_ntz").alias("last_restocked"),
    )


class _Operational(dict):
    """The operational tables by name, each put together when first asked for: a query pays for
    building the plans of only the tables it uses."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        super().__init__()
        self._source = (spark, sf_dir)

    def __missing__(self, name: str) -> DataFrame:
        if name == "transactions":
            self[name] = transactions(*self._source, self["transaction_items"])
        else:
            self[name] = _BUILDERS[name](*self._source)
        return self[name]


    def __or__(self, other: Tables) -> Tables:
        changed = _Operational(*self._source)
        changed.update(other)
        return changed


_BUILDERS = {
    "customers": customers,
    "suppliers": suppliers,
    "products": products,
    "inventory": inventory,
    "employees": employees,
    "transaction_items": transaction_items,
    "sold_quantities": sold_quantities,
}


def operational(spark: SparkSession, sf_dir: str) -> Tables:
    return _Operational(spark, sf_dir)


def feed_events(events: DataFrame) -> DataFrame:
    """The event table as feed events; works on a batch or a streaming frame."""
    kind = (
        F.when(F.col("event_type") == "purchase", "transaction")
        .when(F.col("event_type") == "error", "reorder")
        .otherwise("system")
    )
    article = F.concat(F.lit("article "), F.get_json_object("props", "$.k"))
    is_sale, is_reorder = F.col("type") == "transaction", F.col("type") == "reorder"
    methods = F.array(*[F.lit(m) for m in PAYMENT_METHODS])
    cart = F.array(F.struct((1 + F.col("event_id") % 4).cast("int").alias("quantity"),
                            article.alias("product")))
    return events.withColumn("type", kind).select(
        F.col("event_id").alias("seq"),
        "ts",
        "type",
        labels.day_number(F.col("ts"), FEED_FIRST_DAY).alias("day"),
        F.hour("ts").alias("hour"),
        labels.clock(F.col("ts")).alias("sim_time"),
        F.when(is_sale, F.concat(F.lit("user "), F.col("user_id"))).alias("customer"),
        F.when(is_sale, cart).alias("items"),
        F.when(is_sale, F.col("value").cast("decimal(12,2)")).alias("total"),
        F.when(is_sale, F.element_at(methods, (1 + F.col("user_id") % 4).cast("int"))).alias(
            "payment"
        ),
        F.when(is_reorder, article).alias("product"),
        F.when(F.col("type") == "system", F.col("event_type")).alias("message"),
        F.when(F.col("type") == "system", labels.clock(F.col("ts"))).alias("time"),
    )
