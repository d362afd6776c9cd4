"""Data-quality checks. Each is a pass over columns of one table or a join of grouped keys; none
brings rows to the driver."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import labels, money
from tallyhouse.operators import members
from tallyhouse.plans.analytics import STAR_TABLES
from tallyhouse.plans.star import AMOUNTS, CENTS, sale_facts
from tallyhouse.schemas import OPERATIONAL, PAYMENT_METHODS, STAR, Tables
from tallyhouse.storage import stage

FOREIGN_KEYS = {
    "dim_product_id": "dim_product",
    "dim_customer_id": "dim_customer",
    "dim_employee_id": "dim_employee",
    "dim_payment_method_id": "dim_payment_method",
    "dim_time_id": "dim_time",
}
CENTS_TOLERATED = 1
NON_NEGATIVE = ("quantity_sold", "unit_price", "revenue", "cost")
MANDATORY = (
    "dim_time_id",
    "dim_product_id",
    "dim_customer_id",
    "dim_payment_method_id",
    "source_transaction_id",
    "simulated_day",
    "quantity_sold",
    "unit_price",
    "unit_cost",
    "revenue",
    "cost",
    "profit",
)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _long(counts: list[tuple[str, Column]], key: str) -> Column:
    return F.inline(
        F.array(*[F.struct(F.lit(k).alias(key), v.alias("failing_rows")) for k, v in counts])
    )


def _stored_as(column: str) -> str:
    """Amounts are looked at in the form they are stored in, whole cents."""
    return f"{column}_cents" if column in AMOUNTS else column


def _null_counts(df: DataFrame, columns: list[str]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(_stored_as(c) if _stored_as(c) in df.columns else c).isNull()).alias(c) for c in columns],
    ]


def fact_counts(tables: Tables) -> DataFrame:
    """Everything that is counted over single lines of the fact, in one row from one pass."""
    facts = sale_facts(tables)
    tests = [broken.alias(f"_test{i}") for i, (_, broken) in enumerate(_measure_counts())]
    return facts.agg(*_null_counts(facts, STAR["fact_sales"].names), *tests)


def null_profile(
    tables: Tables, only_with_nulls: bool = False, counted: DataFrame | None = None
) -> DataFrame:
    """Share of NULLs per column, one aggregate per table. ``counted``: stored ``fact_counts``."""

    def profile(name: str) -> DataFrame:
        columns = STAR[name].names
        if name == "fact_sales":
            counts = fact_counts(tables) if counted is None else counted
        else:
            counts = tables[name].agg(*_null_counts(tables[name], columns))
        cells = F.array(
            *[
                F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows"))
                for c in columns
            ]
        )
        return counts.select("_rows", F.inline(cells)).select(
            F.lit(name).alias("table_name"),
            "column_name",
            "null_rows",
            money.percent_of(F.col("null_rows"), F.col("_rows"), 2).alias("null_pct"),
        )

    profiles = _union([profile(name) for name in STAR_TABLES])
    return profiles.where(F.col("null_pct") > 0) if only_with_nulls else profiles


def duplicate_ids(tables: Tables) -> DataFrame:
    """Rows beyond the first per id; NULL counts as one id."""

    def surplus(name: str) -> DataFrame:
        per_id = tables[name].groupBy("id").agg(F.count(F.lit(1)).alias("n"))
        return per_id.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates")).select(
            F.lit(name).alias("table_name"), "duplicates"
        )

    return _union([surplus(name) for name in STAR_TABLES])


DAY = "simulated_day"


def lines_per_key(tables: Tables) -> DataFrame:
    """(name, key, lines): lines of the fact per value of every foreign key and per day, in one pass.
    A hot key is one row of each task before anything is shuffled."""
    pairs = F.array(
        *[F.struct(F.lit(k).alias("name"), F.col(k).cast("bigint").alias("key")) for k in (*FOREIGN_KEYS, DAY)]
    )
    return (
        tables["fact_sales"]
        .select(F.inline(pairs))
        .groupBy("name", "key")
        .agg(F.count(F.lit(1)).alias("lines"))
    )


def _key_checks(tables: Tables, per_key: DataFrame | None) -> DataFrame:
    """(foreign_key, dimension, rows_before, rows_after, orphaned_rows): one join of counts per key
    with the copies of each dimension row answers both questions."""
    # Stored, as five joins read it: the lines are scanned once.
    per_key = stage(lines_per_key(tables), "lines-per-key") if per_key is None else per_key

    def checked(key: str, dimension: str) -> DataFrame:
        copies = (
            tables[dimension]
            .groupBy(F.col("id").cast("bigint").alias("id"))
            .agg(F.count(F.lit(1)).alias("copies"))
        )
        lines = per_key.where(F.col("name") == key)
        joined = lines.join(copies, F.col("key") == F.col("id"), "left")
        after = F.col("lines") * F.coalesce("copies", F.lit(1))
        return joined.agg(
            F.coalesce(F.sum("lines"), F.lit(0)).cast("bigint").alias("rows_before"),
            F.coalesce(F.sum(after), F.lit(0)).cast("bigint").alias("rows_after"),
            F.coalesce(F.sum(F.when(F.col("copies").isNull(), F.col("lines"))), F.lit(0))
            .cast("bigint")
            .alias("orphaned_rows"),
        ).select(F.lit(key).alias("foreign_key"), F.lit(dimension).alias("dimension"), "*")

    return _union([checked(k, d) for k, d in FOREIGN_KEYS.items()])


def orphan_keys(tables: Tables, per_key: DataFrame | None = None) -> DataFrame:
    """Lines whose key is in no dimension row. A NULL key counts as orphaned. ``per_key``: stored
    ``lines_per_key``."""
    return _key_checks(tables, per_key).select("foreign_key", "orphaned_rows")


def join_row_counts(tables: Tables, per_key: DataFrame | None = None) -> DataFrame:
    """Rows of the fact before and after a left join with each dimension, worked out from counts
    per key on both sides instead of the joined rows."""
    return _key_checks(tables, per_key).select(
        "dimension",
        "rows_before",
        "rows_after",
        (F.col("rows_before") == F.col("rows_after")).alias("preserved"),
    )


def _measure_counts() -> list[tuple[str, Column]]:
    price = money.in_cents(F.col("unit_price"))
    revenue, cost, profit = (F.col(c) for c in CENTS)

    def off(left: Column, right: Column) -> Column:
        return F.abs(left - right) > CENTS_TOLERATED

    checks = [
        ("revenue = quantity x price", off(F.col("quantity_sold") * price, revenue)),
        ("profit = revenue - cost", off(revenue - cost, profit)),
    ]
    checks += [(f"{c} not negative", F.col(_stored_as(c)) < 0) for c in NON_NEGATIVE]
    checks += [(f"{c} present", F.col(_stored_as(c)).isNull()) for c in MANDATORY]
    return [(name, F.count_if(broken)) for name, broken in checks]


def measure_checks(tables: Tables, counted: DataFrame | None = None) -> DataFrame:
    """Arithmetic, sign and presence checks on the fact, all in one pass. ``counted``: stored
    ``fact_counts``."""
    counts = fact_counts(tables) if counted is None else counted
    named = [(name, F.col(f"_test{i}")) for i, (name, _) in enumerate(_measure_counts())]
    return counts.select(_long(named, "check_name"))


def payment_method_violations(oltp: Tables) -> DataFrame:
    """Sales whose payment method is outside the allowed set, per method."""
    return (
        oltp["transactions"]
        .where(~F.col("payment_method").isin(*PAYMENT_METHODS))
        .groupBy("payment_method")
        .agg(F.count(F.lit(1)).alias("failing_rows"))
    )


def day_range(
    tables: Tables,
    expected_first: int | None = None,
    expected_last: int | None = None,
    per_key: DataFrame | None = None,
) -> DataFrame:
    """First and last day, how many days between them have no lines, and whether the range is the
    expected one (NULL when nothing is expected). ``per_key``: stored ``lines_per_key``."""
    if per_key is None:
        seen = tables["fact_sales"].select(DAY).distinct()
    else:
        seen = per_key.where(F.col("name") == DAY).select(F.col("key").cast("int").alias(DAY))
    span = F.max("simulated_day") - F.min("simulated_day") + 1

    def expected(actual: Column, day: int | None) -> Column:
        return F.lit(True) if day is None else actual == day

    as_expected = expected(F.col("first_day"), expected_first) & expected(
        F.col("last_day"), expected_last
    )
    if expected_first is None and expected_last is None:
        as_expected = F.lit(None).cast("boolean")
    return seen.agg(
        F.min("simulated_day").alias("first_day"),
        F.max("simulated_day").alias("last_day"),
        (span - F.count("simulated_day")).cast("bigint").alias("missing_days"),
    ).withColumn("as_expected", as_expected)


def missing_days(tables: Tables) -> DataFrame:
    """Days without lines between the first and the last one."""
    seen = tables["fact_sales"].select("simulated_day").distinct()
    every = seen.agg(
        F.sequence(F.min("simulated_day"), F.max("simulated_day")).alias("days")
    ).select(F.explode("days").alias("simulated_day"))
    return every.join(seen, "simulated_day", "left_anti").orderBy("simulated_day")


def unbalanced_sales(oltp: Tables) -> DataFrame:
    """Sales whose header total is not the sum of their line subtotals."""
    lines = (
        oltp["transaction_items"].groupBy("transaction_id").agg(F.sum("subtotal").alias("lines"))
    )
    items_total = F.coalesce("lines", F.lit(0).cast("decimal(20,2)"))
    return (
        oltp["transactions"]
        .select(F.col("id").alias("transaction_id"), "total_amount")
        .join(lines, "transaction_id", "left")
        .where(money.differs(F.col("total_amount"), items_total))
        .select("transaction_id", "total_amount", items_total.cast("decimal(20,2)").alias("items_total"))
    )


SOURCES = (
    "customers",
    "employees",
    "inventory",
    "products",
    "purchase_orders",
    "suppliers",
    "transaction_items",
    "transactions",
)


def source_not_empty(oltp: Tables) -> DataFrame:
    """Whether each operational table has rows: the precondition of a load."""

    def filled(name: str) -> DataFrame:
        return oltp[name].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", (F.col("row_count") > 0).alias("ready")
        )

    return _union([filled(name) for name in SOURCES])


NATURAL_KEYS = {
    "dim_time": ("simulated_day", "hour_of_day"),
    "dim_product": ("source_id",),
    "dim_customer": ("source_id",),
    "dim_employee": ("source_id",),
    "dim_payment_method": ("method",),
}


def duplicate_dimension_members(tables: Tables) -> DataFrame:
    """Natural keys with more than one row, per dimension. An hour is named by its time key, a payment
    method by its place in the fixed list (0 if it is not there)."""
    methods = F.array(*[F.lit(m) for m in PAYMENT_METHODS])
    named = {
        "dim_time": labels.time_key(F.col("simulated_day"), F.col("hour_of_day")),
        "dim_payment_method": F.array_position(methods, F.col("method")),
    }

    def duplicates(name: str) -> DataFrame:
        key = named.get(name, F.col("source_id")).cast("bigint")
        return members.duplicate_members(tables[name], *NATURAL_KEYS[name]).select(
            F.lit(name).alias("table_name"), key.alias("source_id"), "members"
        )

    return _union([duplicates(name) for name in NATURAL_KEYS])


def check_summary(tables: Tables, oltp: Tables) -> DataFrame:
    """Every check as (check, table, failing rows, status). The fact is read three times: for the
    counts over its lines, for the lines per key and day, and for repeated ids."""
    per_key = stage(lines_per_key(tables), "lines-per-key")
    counted = stage(fact_counts(tables), "fact-counts")

    def as_check(df: DataFrame, check: Column, table: Column, failing: Column) -> DataFrame:
        return df.select(
            check.alias("check_name"),
            table.alias("table_name"),
            failing.cast("bigint").alias("failing_rows"),
        )

    def total(df: DataFrame, check: str, table: str, failing: str | None = None) -> DataFrame:
        count = F.count(F.lit(1)) if failing is None else F.coalesce(F.sum(failing), F.lit(0))
        return as_check(df.agg(count.alias("n")), F.lit(check), F.lit(table), F.col("n"))

    name = F.col("table_name")
    nulls = F.concat(F.lit("no nulls in "), F.col("column_name"))
    preserved = F.concat(F.lit("join keeps rows: "), F.col("dimension"))
    fact = F.lit("fact_sales")
    checks = _union(
        [
            as_check(null_profile(tables, counted=counted), nulls, name, F.col("null_rows")),
            as_check(duplicate_ids(tables), F.lit("unique id"), name, F.col("duplicates")),
            as_check(
                orphan_keys(tables, per_key),
                F.concat(F.lit("known "), F.col("foreign_key")),
                fact,
                F.col("orphaned_rows"),
            ),
            as_check(measure_checks(tables, counted), F.col("check_name"), fact, F.col("failing_rows")),
            as_check(
                join_row_counts(tables, per_key),
                preserved,
                fact,
                F.abs(F.col("rows_after") - F.col("rows_before")),
            ),
            as_check(day_range(tables, per_key=per_key), F.lit("no missing days"), fact, F.col("missing_days")),
            total(
                payment_method_violations(oltp), "allowed payment method", "transactions",
                "failing_rows",
            ),
            total(unbalanced_sales(oltp), "total = sum of lines", "transactions"),
            as_check(
                source_not_empty(oltp), F.lit("has rows"), name, F.when(F.col("ready"), 0).otherwise(1)
            ),
            total(duplicate_dimension_members(tables), "one member per key", "dimensions"),
        ]
    )
    status = F.when(F.col("failing_rows") == 0, "Good").otherwise(
        F.concat(F.format_number("failing_rows", 0), F.lit(" failing rows"))
    )
    return checks.withColumn("status", status)


# What the operational tables refer to and which columns must be unique.
REFERENCES = {
    "products": {"supplier_id": "suppliers"},
    "inventory": {"product_id": "products"},
    "transactions": {"customer_id": "customers", "employee_id": "employees"},
    "transaction_items": {"transaction_id": "transactions", "product_id": "products"},
    "purchase_orders": {"supplier_id": "suppliers", "product_id": "products"},
}
UNIQUE = {"customers": ("id", "email"), "inventory": ("product_id",)}


def operational_checks(oltp: Tables) -> DataFrame:
    """(table_name, constraint_name, failing_rows) of the constraints that the operational tables are
    declared with: required columns, one pass per table; unique columns, rows beyond the first of a
    value; references, rows whose value is not an id of the other table. NULL is never a repeated
    value nor a broken reference."""

    def required(name: str) -> DataFrame:
        columns = [f.name for f in OPERATIONAL[name] if not f.nullable]
        counts = oltp[name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        named = [(f"{c} required", F.col(c)) for c in columns]
        return counts.select(F.lit(name).alias("table_name"), _long(named, "constraint_name"))

    def unique(name: str, column: str) -> DataFrame:
        per_value = oltp[name].where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
        return per_value.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("failing_rows")).select(
            F.lit(name).alias("table_name"), F.lit(f"{column} unique").alias("constraint_name"), "failing_rows"
        )

    def refers(name: str, column: str, other: str) -> DataFrame:
        per_value = oltp[name].where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
        known = oltp[other].select(F.col("id").alias("_id"))
        lost = per_value.join(known, F.col(column) == F.col("_id"), "left_anti")
        return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failing_rows")).select(
            F.lit(name).alias("table_name"), F.lit(f"{column} in {other}").alias("constraint_name"), "failing_rows"
        )

    checks = [required(name) for name in SOURCES]
    checks += [unique(name, c) for name in SOURCES for c in UNIQUE.get(name, ("id",))]
    checks += [refers(n, c, other) for n, refs in REFERENCES.items() for c, other in refs.items()]
    return _union(checks)
