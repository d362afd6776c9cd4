"""From operational tables to the star: extract, dimensions, sale lines, and day replacement.

Sale lines, accepted or not, are stored in one table. ``fact_sales`` and ``rejected_lines`` are its
two halves, so both are produced by one pass and a reloaded day replaces both at once.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse import schemas as S
from tallyhouse.functions import labels, money
from tallyhouse.operators import members
from tallyhouse.plans import versions
from tallyhouse.schemas import Tables
from tallyhouse.storage import Scratch, delete, is_complete, path_exists, stage

PRODUCT = ["source_id", "name", "category", "subcategory", "unit_cost"]
CUSTOMER = ["source_id", "name", "is_loyalty", "join_date"]
EMPLOYEE = ["source_id", "name", "role"]
MEMBER_COLUMNS = {"dim_product": PRODUCT, "dim_customer": CUSTOMER, "dim_employee": EMPLOYEE}
LINE_KEYS = {"dim_product": "product_id", "dim_customer": "customer_id", "dim_employee": "employee_id"}

# The stored sale lines: the fact with its amounts in whole cents, then what is needed to tell why
# a line was rejected.
AMOUNTS = ("revenue", "cost", "profit")
CENTS = [f"{amount}_cents" for amount in AMOUNTS]
SALES_LINES = T.StructType(
    [
        *[f for f in S.STAR["fact_sales"] if f.name not in AMOUNTS],
        *[T.StructField(cents, T.LongType()) for cents in CENTS],
        T.StructField("hour_of_day", T.IntegerType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("reasons", T.StringType()),
        T.StructField("accepted", T.BooleanType()),
    ]
)
BLOCK = "day_block"
LINES_WITH_BLOCK = T.StructType([*SALES_LINES, T.StructField(BLOCK, T.IntegerType())])
# Where lines without a day are, and what is kept under the root while partitions are swapped.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
KEPT, KEPT_HOURS = "kept", "kept-hours"
# Where the versions of members are recorded by day.
HISTORY = "history"
# Repaired dimensions that are to replace the stored ones.
REPAIRED = "repaired"

REJECTED_COLUMNS = [
    "id",
    "source_transaction_id",
    "simulated_day",
    "hour_of_day",
    "product_id",
    "customer_id",
    "payment_method",
    "quantity_sold",
    "unit_price",
    "reasons",
]


def extract(oltp: Tables) -> DataFrame:
    """The end-of-day extract: every line with its sale, product, customer and, if any, employee."""
    items, sales = oltp["transaction_items"], oltp["transactions"]
    products, customers, employees = oltp["products"], oltp["customers"], oltp["employees"]
    return (
        items.join(sales, items["transaction_id"] == sales["id"])
        .join(products, items["product_id"] == products["id"])
        .join(customers, sales["customer_id"] == customers["id"])
        .join(employees, sales["employee_id"] == employees["id"], "left")
        .select(
            sales["id"].alias("transaction_id"),
            sales["customer_id"],
            sales["employee_id"],
            sales["transaction_time"],
            sales["payment_method"],
            items["product_id"],
            items["quantity"],
            items["unit_price_at_sale"],
            items["subtotal"],
            products["unit_cost"],
            products["name"].alias("product_name"),
            products["category"],
            products["subcategory"],
            products["supplier_id"],
            customers["name"].alias("customer_name"),
            customers["email"],
            employees["name"].alias("employee_name"),
            employees["role"],
        )
    )


def line_items(oltp: Tables) -> DataFrame:
    return oltp["transaction_items"].select(
        "id", "transaction_id", "product_id", "quantity", "unit_price_at_sale"
    )


def sale_headers(oltp: Tables, first_day: str) -> DataFrame:
    """The header fields the load needs, keys only."""
    return oltp["transactions"].select(
        F.col("id").alias("transaction_id"),
        "customer_id",
        "employee_id",
        "payment_method",
        labels.day_number(F.col("transaction_time"), first_day).alias("simulated_day"),
        F.hour("transaction_time").alias("hour_of_day"),
    )


def sale_lines(oltp: Tables, first_day: str) -> DataFrame:
    """Line items with the header fields. A line whose sale is missing stays, with NULL header fields,
    and is rejected later."""
    return line_items(oltp).join(sale_headers(oltp, first_day), "transaction_id", "left")


def time_dimension(lines: DataFrame) -> DataFrame:
    """One row per open hour of every day that has sale lines."""
    days = lines.where(F.col("simulated_day").isNotNull()).select("simulated_day").distinct()
    hours = F.sequence(F.lit(S.OPEN_HOUR), F.lit(S.LAST_HOUR))
    hour = F.col("hour_of_day")
    return days.select("simulated_day", F.explode(hours).alias("hour_of_day")).select(
        labels.time_key(F.col("simulated_day"), hour).alias("id"),
        "simulated_day",
        "hour_of_day",
        labels.time_label(hour).alias("time_label"),
        labels.part_of_day(hour).alias("part_of_day"),
        labels.is_rush_hour(hour).alias("is_rush_hour"),
    )


def _seen(lines: DataFrame, key: str) -> DataFrame:
    """Distinct keys on the lines: combined per task before the shuffle, so a key on a third of
    all lines sends one row per task."""
    return lines.select(F.col(key).alias("source_id")).where(F.col(key).isNotNull()).distinct()


def sold_products(lines: DataFrame, products: DataFrame) -> DataFrame:
    return (
        products.withColumnRenamed("id", "source_id")
        .join(_seen(lines, "product_id"), "source_id", "left_semi")
        .select(*PRODUCT)
    )


def seen_customers(lines: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers on the lines. Holding an e-mail address makes a loyalty member; the join date is
    not carried into the star."""
    return (
        customers.withColumnRenamed("id", "source_id")
        .join(_seen(lines, "customer_id"), "source_id", "left_semi")
        .select(
            "source_id",
            "name",
            F.col("email").isNotNull().alias("is_loyalty"),
            F.lit(None).cast("date").alias("join_date"),
        )
    )


def seen_employees(lines: DataFrame, employees: DataFrame) -> DataFrame:
    return (
        _seen(lines, "employee_id")
        .join(employees.withColumnRenamed("id", "source_id"), "source_id", "left")
        .select(*EMPLOYEE)
    )


def batch_members(items: DataFrame, headers: DataFrame, oltp: Tables) -> Tables:
    """Members on line items and on the headers of sales that have lines."""
    return {
        "dim_product": sold_products(items, oltp["products"]),
        "dim_customer": seen_customers(headers, oltp["customers"]),
        "dim_employee": seen_employees(headers, oltp["employees"]),
    }


def new_members(batch: DataFrame, existing: DataFrame, columns: list[str]) -> DataFrame:
    """Members to add, numbered after the largest id in use."""
    highest = existing.agg(F.coalesce(F.max("id"), F.lit(0)).alias("id")).scalar()
    return members.number_members(
        members.absent_members(batch, existing, columns), columns, after=highest
    )


def key_map(batch: DataFrame, dimension: DataFrame, columns: list[str]) -> DataFrame:
    """Natural key to surrogate id of the version holding this batch's attributes."""
    stored = members.latest_copy(dimension, columns)
    return batch.join(stored, members.same_member(batch, stored, columns)).select(
        stored["id"].alias("dim_id"), *[batch[c] for c in columns]
    )


def _link(rows: DataFrame, keys: Tables, name: str, *more: str) -> DataFrame:
    """Rows with the surrogate key of a dimension, from a map of natural keys or of versions by day.

    Product, customer and employee maps may be large, so no broadcast is forced on them: the planner
    decides by size and splits skewed keys at run time.
    """
    key = LINE_KEYS[name]
    if "from_day" in keys[name].columns:
        found = keys[name].withColumnRenamed("dim_id", f"{name}_id")
        return versions.keys_as_of(rows, key, found, [f"{name}_id", *more])
    found = keys[name].select(
        F.col("source_id").alias("_key"), F.col("dim_id").alias(f"{name}_id"), *more
    )
    return rows.join(found, F.col(key) == F.col("_key"), "left").drop("_key")


def _link_header(rows: DataFrame, keys: Tables, payment: DataFrame) -> DataFrame:
    """Rows with the keys that come from a sale's header. The payment table is small by definition."""
    method = payment.select(
        F.col("method").alias("payment_method"), F.col("id").alias("dim_payment_method_id")
    )
    linked = _link(_link(rows, keys, "dim_customer"), keys, "dim_employee").drop("employee_id")
    return linked.join(F.broadcast(method), "payment_method", "left")


def linked_lines(lines: DataFrame, keys: Tables, payment: DataFrame) -> DataFrame:
    """Lines that have their header fields, with all keys that are looked up."""
    return _link_header(_link(lines, keys, "dim_product", "unit_cost"), keys, payment)


def linked_items(items: DataFrame, headers: DataFrame, keys: Tables, payment: DataFrame) -> DataFrame:
    """The same from line items and headers: lines are moved once for products and once for their sales,
    whose header has been linked by then. Products by day need the day first; others go first, while the
    lines are narrow."""
    linked = _link_header(headers, keys, payment)
    if "from_day" in keys["dim_product"].columns:
        return _link(items.join(linked, "transaction_id", "left"), keys, "dim_product", "unit_cost")
    return _link(items, keys, "dim_product", "unit_cost").join(linked, "transaction_id", "left")


def keyed_lines(linked: DataFrame, *more: str) -> DataFrame:
    """Surrogate keys, measures and the reasons, if any, for not accepting a line. The time key needs no
    lookup at all."""
    day, hour = F.col("simulated_day"), F.col("hour_of_day")
    looked_up = linked.withColumn("dim_time_id", labels.time_key(day, hour))
    missing = {
        "time": F.col("dim_time_id").isNull(),
        "product": F.col("dim_product_id").isNull(),
        "customer": F.col("dim_customer_id").isNull(),
        "payment method": F.col("dim_payment_method_id").isNull(),
    }
    reasons = F.concat_ws(", ", *[F.when(gone, reason) for reason, gone in missing.items()])
    accepted = ~reduce(or_, missing.values())
    revenue = money.in_cents(F.col("unit_price_at_sale")) * F.col("quantity")
    cost = money.in_cents(F.col("unit_cost")) * F.col("quantity")
    return looked_up.select(
        "id",
        "dim_time_id",
        "dim_product_id",
        "dim_customer_id",
        "dim_employee_id",
        "dim_payment_method_id",
        F.col("transaction_id").alias("source_transaction_id"),
        "simulated_day",
        F.col("quantity").alias("quantity_sold"),
        F.col("unit_price_at_sale").alias("unit_price"),
        "unit_cost",
        revenue.alias("revenue_cents"),
        cost.alias("cost_cents"),
        (revenue - cost).alias("profit_cents"),
        "hour_of_day",
        "product_id",
        "customer_id",
        "payment_method",
        reasons.alias("reasons"),
        accepted.alias("accepted"),
        *more,
    )


def accepted_lines(sales_lines: DataFrame) -> DataFrame:
    """The fact table, amounts as money."""
    amounts = {
        amount: money.from_cents(F.col(cents), S.MONEY) for amount, cents in zip(AMOUNTS, CENTS)
    }
    return (
        sales_lines.where(F.col("accepted")).withColumns(amounts).select(*S.STAR["fact_sales"].names)
    )


def sale_facts(tables: Tables) -> DataFrame:
    """The accepted lines with their amounts in cents, for summing; or what stands in for them, rows
    that are sums over ``lines`` lines (``plans/rollups.py``)."""
    if "sums" in tables:
        return tables["sums"]
    if "sales_lines" in tables:
        fact_columns = [c for c in S.STAR["fact_sales"].names if c not in AMOUNTS]
        return tables["sales_lines"].where(F.col("accepted")).select(*fact_columns, *CENTS)
    in_cents = {c: money.in_cents(F.col(amount)) for amount, c in zip(AMOUNTS, CENTS)}
    return tables["fact_sales"].withColumns(in_cents)


def rejected_lines(sales_lines: DataFrame) -> DataFrame:
    return sales_lines.where(~F.col("accepted")).select(*REJECTED_COLUMNS)


def star(oltp: Tables, first_day: str) -> Tables:
    """The whole pipeline as frames, all days at once, for a first load into nothing. Sale lines and
    members are staged, so that the big join runs once and not once per table derived from it."""
    spark = oltp["transactions"].sparkSession
    lines = stage(sale_lines(oltp, first_day), "lines")
    tables: Tables = {"dim_time": time_dimension(lines)}
    keys: Tables = {}
    for name, batch in batch_members(lines, lines, oltp).items():
        columns = MEMBER_COLUMNS[name]
        none_yet = spark.createDataFrame([], S.STAR[name])
        tables[name] = stage(new_members(stage(batch, name), none_yet, columns), name)
        keys[name] = tables[name].withColumnRenamed("id", "dim_id")
    tables["dim_payment_method"] = S.payment_methods(spark)
    keyed = keyed_lines(linked_lines(lines, keys, tables["dim_payment_method"]))
    tables["sales_lines"] = keyed
    tables["fact_sales"] = accepted_lines(keyed)
    tables["rejected_lines"] = rejected_lines(keyed)
    return tables


def load_days(
    spark: SparkSession,
    oltp: Tables,
    root: str,
    first_day: str,
    days_per_partition: int | None = None,
    history: bool = False,
    stored_items: bool = False,
) -> None:
    """Load every day found in ``oltp`` into the star stored under ``root``, replacing exactly those
    days; repeating it changes nothing, and a batch without lines does nothing.

    The sale lines are partitioned by day, or by runs of ``days_per_partition`` days where single
    days are too small for a file each. The first load decides on the width and stores it with the
    tables; a later load may leave it out and may not ask for another.

    Dimensions are written before the lines, and members are only ever added, so a load that dies
    half way is repaired by running it again. Rows of other days and loads that share a partition
    with the batch are first stored under ``root`` and put back by the next load or removal, should
    the driver die while partitions are being swapped. Lines without a sale have no day; they stay
    rejected until a load brings the same line again.

    With ``history`` lines link to the version of a member that was valid on their day, as recorded
    by earlier loads (``plans/versions.py``); without it to the version with the batch's attributes.
    Line items that are a stored table already (``stored_items``) are not staged again.
    """
    with Scratch(spark) as scratch:
        items = line_items(oltp) if stored_items else scratch.stage(line_items(oltp), "items")
        if items.isEmpty():
            return
        sold = items.select("transaction_id").distinct()
        headers = scratch.stage(sale_headers(oltp, first_day).join(sold, "transaction_id", "left_semi"), "headers")
        per_day = scratch.stage(headers.select("simulated_day").distinct(), "days")
        width = _width(spark, root, days_per_partition)
        recover(spark, root)

        span = versions.batch_span(_stored(spark, root, "dim_time"), per_day) if history else None

        def merge(name: str, members_seen: DataFrame) -> DataFrame:
            columns = MEMBER_COLUMNS[name]
            batch = scratch.stage(members_seen, name)
            stored = _stored(spark, root, name)
            new_members(batch, stored, columns).write.mode("append").parquet(f"{root}/{name}")
            stored = _stored(spark, root, name)
            keys = key_map(batch, stored, columns)
            if span is None:
                return keys
            recorded = versions.record(keys, f"{root}/{HISTORY}/{name}", span)
            if versions.looks_back(recorded, span):
                return scratch.stage(versions.version_map(recorded, stored, columns), "keys")
            last = versions.version_map(versions.last_records(recorded), stored, columns)
            return scratch.stage(last.drop("from_day", "recorded"), "keys")

        # The dimensions do not depend on each other: let their jobs share the cluster.
        seen = batch_members(items, headers, oltp)
        with ThreadPoolExecutor(len(seen)) as pool:
            keys = dict(zip(seen, pool.map(merge, seen.keys(), seen.values())))
        payment_path = f"{root}/dim_payment_method"
        S.payment_methods(spark).write.mode("ignore").parquet(payment_path)
        # One row per method, also in a star to which copies were appended.
        payment = _stored(spark, root, "dim_payment_method").groupBy("method").agg(F.min("id").alias("id"))
        hours = time_dimension(per_day).join(_stored(spark, root, "dim_time"), "id", "left_anti")
        hours.write.mode("append").parquet(f"{root}/dim_time")
        days = per_day.select("simulated_day").where("simulated_day IS NOT NULL")
        linked = linked_items(items, headers, keys, payment)
        dated = headers.where("simulated_day IS NOT NULL").select("transaction_id")
        undated = items.join(dated, "transaction_id", "left_anti").unionByName(
            items.join(headers.where("simulated_day IS NULL").select("transaction_id"), "transaction_id", "left_semi")
        )
        _replace_days(linked, items, undated, days, root, width)


def _width(spark: SparkSession, root: str, asked: int | None) -> int:
    """Days per partition of the star under ``root``, stored by its first load."""
    path, schema = f"{root}/layout", "days_per_partition INT"
    if not path_exists(spark, path):
        spark.createDataFrame([(asked or 1,)], schema).write.parquet(path)
        return asked or 1
    width = spark.read.schema(schema).parquet(path).first()["days_per_partition"]
    if asked not in (None, width):
        raise ValueError(f"{root} has {width} days per partition, not {asked}")
    return width


def _day_block(days_per_partition: int) -> Column:
    return F.floor((F.col("simulated_day") - 1) / days_per_partition).cast("int")


def _stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A star table as stored so far, empty at first."""
    path = f"{root}/{name}"
    if not path_exists(spark, path):
        spark.createDataFrame([], S.STAR[name]).write.mode("ignore").parquet(path)
    return spark.read.schema(S.STAR[name]).parquet(path)


def _replace_days(
    linked: DataFrame, items: DataFrame, undated: DataFrame, days: DataFrame, root: str, days_per_partition: int
) -> None:
    """Overwrite the partitions of the batch. What else they hold is kept: other days that share a
    partition, and lines without a day that the batch does not bring again. Lines are dealt to the
    tasks that write them before amounts and reasons are added; ``undated`` are its items without a day."""
    spark = linked.sparkSession
    path = f"{root}/sales_lines"
    block = _day_block(days_per_partition)
    rows = keyed_lines(_dealt(linked.withColumn(BLOCK, block)), BLOCK)
    if not path_exists(spark, path):
        _write_blocks(rows, path)
        return
    stored = stored_lines(spark, path)
    homeless = stored.where(F.col(BLOCK).isNull())
    had_homeless = not homeless.isEmpty()
    kept = homeless.join(items.select("id"), "id", "left_anti")
    if days_per_partition > 1:
        blocks = days.select(block.alias(BLOCK)).distinct()
        sharing = stored.join(F.broadcast(blocks), BLOCK, "left_semi")
        kept = kept.unionByName(sharing.join(F.broadcast(days), "simulated_day", "left_anti"))
    kept = _journal(kept, root)
    _write_blocks(rows.unionByName(_dealt(kept)), path)
    if had_homeless and undated.isEmpty() and kept.where(F.col(BLOCK).isNull()).isEmpty():
        delete(spark, f"{path}/{BLOCK}={NO_DAY}")
    delete(spark, f"{root}/{KEPT}")


def _dealt(rows: DataFrame) -> DataFrame:
    """Rebalancing gives a partition as many tasks as its size calls for, so a day holding a third of
    all lines is split and small ones share a task."""
    return rows.hint("rebalance", BLOCK)


def _write_blocks(rows: DataFrame, path: str) -> None:
    """Write whole partitions of rows that were dealt to tasks. Lines of a sale lie together, so that
    what they share is stored once."""
    (
        rows.sortWithinPartitions(BLOCK, "simulated_day", "source_transaction_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BLOCK)
        .parquet(path)
    )


def _journal(kept: DataFrame, root: str) -> DataFrame:
    """Rows that must outlive the swap of their partitions, stored until it is done."""
    kept = kept.select(*SALES_LINES.names, BLOCK)
    kept.write.mode("overwrite").parquet(f"{root}/{KEPT}")
    return kept.sparkSession.read.schema(LINES_WITH_BLOCK).parquet(f"{root}/{KEPT}")


def swap_lines(rows: DataFrame, root: str) -> None:
    """Replace the partitions of ``rows``, which are all rows these are to hold."""
    kept = _journal(rows, root)
    _write_blocks(_dealt(kept), f"{root}/sales_lines")
    delete(rows.sparkSession, f"{root}/{KEPT}")


def recover(spark: SparkSession, root: str) -> None:
    """Finish what a load, removal or repair that died left behind: put back the rows it had kept and
    put repaired dimensions in place. Its own days are put right by running it again. Without a dead
    run nothing happens."""
    path = f"{root}/sales_lines"
    for name in S.STAR:
        repaired = f"{root}/{REPAIRED}/{name}"
        if is_complete(spark, repaired):
            spark.read.schema(S.STAR[name]).parquet(repaired).write.mode("overwrite").parquet(f"{root}/{name}")
    delete(spark, f"{root}/{REPAIRED}")
    if is_complete(spark, f"{root}/{KEPT_HOURS}"):
        hours = spark.read.schema(S.STAR["dim_time"]).parquet(f"{root}/{KEPT_HOURS}")
        hours.write.mode("overwrite").parquet(f"{root}/dim_time")
    delete(spark, f"{root}/{KEPT_HOURS}")
    if is_complete(spark, f"{root}/{KEPT}"):
        kept = spark.read.schema(LINES_WITH_BLOCK).parquet(f"{root}/{KEPT}")
        blocks = kept.select(BLOCK).distinct().withColumnRenamed(BLOCK, "_kept")
        stored = stored_lines(spark, path)
        there = stored.join(F.broadcast(blocks), F.col(BLOCK).eqNullSafe(F.col("_kept")), "left_semi")
        kept_days = kept.select(F.col("simulated_day").alias("_day")).distinct()
        there = there.join(kept_days, F.col("simulated_day") == F.col("_day"), "left_anti")
        ids = kept.where(F.col(BLOCK).isNull()).select(F.col("id").alias("_id"))
        there = there.join(ids, F.col(BLOCK).isNull() & (F.col("id") == F.col("_id")), "left_anti")
        with Scratch(spark) as scratch:
            _write_blocks(_dealt(scratch.stage(there, "there").unionByName(kept)), path)
    delete(spark, f"{root}/{KEPT}")


def remove_days(spark: SparkSession, root: str, days: list[int]) -> None:
    """Take out days for which no new rows will arrive. Repeating an interrupted removal completes
    it; only the partitions of the days are read."""
    width = _width(spark, root, None)
    recover(spark, root)
    path = f"{root}/sales_lines"
    blocks = sorted({(day - 1) // width for day in days})
    stored = stored_lines(spark, path).where(F.col(BLOCK).isin(blocks))
    kept = _journal(stored.where(~F.col("simulated_day").isin(days)), root)
    left = {r[BLOCK] for r in kept.select(BLOCK).distinct().collect()}
    _write_blocks(_dealt(kept), path)
    for block in set(blocks) - left:
        delete(spark, f"{path}/{BLOCK}={block}")
    delete(spark, f"{root}/{KEPT}")
    hours = _stored(spark, root, "dim_time").where(~F.col("simulated_day").isin(days))
    hours.write.mode("overwrite").parquet(f"{root}/{KEPT_HOURS}")
    recover(spark, root)


def stored_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LINES_WITH_BLOCK).parquet(path)


def read_star(
    spark: SparkSession, root: str, first_day: int | None = None, last_day: int | None = None
) -> Tables:
    """The stored star; with bounds, only the sale lines of those days, and only their partitions
    are read."""
    tables = {
        name: spark.read.schema(S.STAR[name]).parquet(f"{root}/{name}")
        for name in ("dim_time", "dim_product", "dim_customer", "dim_employee", "dim_payment_method")
    }
    lines = stored_lines(spark, f"{root}/sales_lines")
    if first_day is not None or last_day is not None:
        width = _width(spark, root, None)
        if first_day is not None:
            lines = lines.where((F.col(BLOCK) >= (first_day - 1) // width) & (F.col("simulated_day") >= first_day))
        if last_day is not None:
            lines = lines.where((F.col(BLOCK) <= (last_day - 1) // width) & (F.col("simulated_day") <= last_day))
    lines = lines.drop(BLOCK)
    tables["sales_lines"] = lines
    tables["fact_sales"] = accepted_lines(lines)
    tables["rejected_lines"] = rejected_lines(lines)
    return tables


def member_attributes(tables: Tables) -> DataFrame:
    """The fact with every surrogate key resolved back to what it stands for."""
    fact = tables["fact_sales"]

    def side(name: str, columns: dict[str, str]) -> DataFrame:
        named = [F.col(c).alias(alias) for c, alias in columns.items()]
        return tables[name].select(F.col("id").alias(f"{name}_id"), *named)

    return (
        fact.join(
            side("dim_time", {"hour_of_day": "hour_of_day", "time_label": "time_label"}),
            "dim_time_id",
        )
        .join(side("dim_product", {"source_id": "product_id", "name": "product"}), "dim_product_id")
        .join(
            side("dim_customer", {"source_id": "customer_id", "is_loyalty": "is_loyalty"}),
            "dim_customer_id",
        )
        .join(side("dim_employee", {"source_id": "employee_id"}), "dim_employee_id", "left")
        .join(side("dim_payment_method", {"method": "payment_method"}), "dim_payment_method_id")
        .select(
            "id",
            "source_transaction_id",
            "simulated_day",
            "hour_of_day",
            "time_label",
            "product_id",
            "product",
            "customer_id",
            "is_loyalty",
            "employee_id",
            "payment_method",
            "quantity_sold",
            "unit_price",
            "unit_cost",
            "revenue",
            "cost",
            "profit",
        )
    )
