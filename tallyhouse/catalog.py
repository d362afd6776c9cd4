"""Every registered query, its oracle and the blueprint lines it covers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import oracle, workspace
from tallyhouse import schemas as S
from tallyhouse.functions import labels, money
from tallyhouse.plans import analytics, inventory, lines, quality, repair, reports, rollups, star
from tallyhouse.schemas import Tables
from tallyhouse.sources import benchmark_tables as bench
from tallyhouse.sources import dumps, files
from tallyhouse.storage import Scratch, fresh_path, stage
from tallyhouse.streaming import feed, runs

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None
    covers: tuple[str, ...]


CATALOG: dict[str, Entry] = {}


def _register(name: str, covers: str, sql: str | None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        CATALOG[name] = Entry(run, sql, tuple(covers.split()))
        return run

    return add


def _over_star(name: str, covers: str, plan: Callable[[Tables], DataFrame]) -> None:
    """Register a query that reads the loaded star."""
    _register(name, covers, oracle.SQL.get(name))(
        lambda spark, sf_dir: plan(workspace.star_tables(spark, sf_dir))
    )


def _over_source(name: str, covers: str, plan: Callable[[Tables], DataFrame]) -> None:
    """Register a query that reads the operational tables."""
    _register(name, covers, oracle.SQL.get(name))(
        lambda spark, sf_dir: plan(bench.operational(spark, sf_dir))
    )


def _over_all_sources(name: str, covers: str, plan: Callable[[Tables], DataFrame]) -> None:
    """Register a query that reads the operational tables and the orders placed with suppliers."""
    _register(name, covers, oracle.SQL.get(name))(
        lambda spark, sf_dir: plan(workspace.all_sources(spark, sf_dir))
    )


# Reports -----------------------------------------------------------------------------------------

_over_star("r01_daily_revenue", "R1 A1 A2 P16 P18 O1", reports.daily_revenue)
_over_star("r02_revenue_by_hour", "R2 J2 A1 A2", reports.revenue_by_hour)
_over_star("r03_top_products", "R3 J2 P13 P14 O2 A6", reports.top_products)
_over_star("r04_revenue_by_category", "R4 J2 P14", reports.revenue_by_category)
_over_star("r05_loyalty_split", "R5 J2 P9 P15", reports.loyalty_split)
_over_star("r06_payment_breakdown", "R6 J2 W1", reports.payment_breakdown)
_over_star("r07_cashier_performance", "R7 J2 P15", reports.cashier_performance)
_over_star("r08_rush_hour_split", "R8 J2 P9 W1", reports.rush_hour_split)
_over_star("r09_category_by_day", "R9 J2", reports.category_by_day)
_over_star("r10_bottom_products", "R10 J2 O2", reports.bottom_products)
_over_star("r11_row_counts", "R11 U1 A3 P23", reports.row_counts)



def _over_rollups(name: str, covers: str, tables: Callable[[SparkSession, str], Tables], plan: Callable[[Tables], DataFrame]) -> None:
    """Register a report that reads sums kept per day."""
    _register(name, covers, oracle.SQL.get(name))(
        lambda spark, sf_dir: plan(tables(spark, workspace.star_root(spark, sf_dir)))
    )


_over_rollups("r01_from_rollups", "R1 A1 A2", rollups.by_sale, reports.daily_revenue)
_over_rollups("r08_from_rollups", "R8 A2", rollups.by_sale, reports.rush_hour_split)
_over_rollups("r09_from_rollups", "R9 A1", rollups.by_product, reports.category_by_day)


@_register("r12_approximate_sales", "A2", oracle.SQL.get("r12_approximate_sales"))
def _approximate_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of every ninety days and of all days, counted, and whether the estimate from the days'
    sketches is within three per cent."""
    root = workspace.star_root(spark, sf_dir)
    tables = star.read_star(spark, root)
    days = tables["fact_sales"].agg(F.min("simulated_day").alias("a"), F.max("simulated_day").alias("b"))
    firsts = days.select(F.explode(F.sequence("a", "b", F.lit(90))).alias("first_day"))
    ranges = firsts.select("first_day", (F.col("first_day") + 89).alias("last_day")).unionByName(
        days.select(F.col("a").alias("first_day"), F.col("b").alias("last_day"))
    )
    ranges = stage(ranges, "ranges")
    estimate = rollups.approximate_sales(spark, root, ranges).withColumnRenamed("sales", "estimate")
    return rollups.exact_sales(tables, ranges).join(estimate, ["first_day", "last_day"]).select(
        "first_day", "last_day", "sales", (F.abs(F.col("estimate") - F.col("sales")) <= 0.03 * F.col("sales")).alias("close")
    )


# Analytics ---------------------------------------------------------------------------------------

_over_star("n01_table_shapes", "N1", analytics.table_shapes)
_over_star("n02_overall_totals", "N2 A4 A5 S11", analytics.overall_totals)
_over_star("n02_overall_text", "N2 P19 P20", analytics.overall_text)
_over_star("n03_top_products_by_name", "N3 J3 J10 P19 P21", analytics.top_products_by_name)
_over_star("n04_category_summary", "N4 J3", analytics.category_summary)
_over_star("n05_daily_rollup", "N5", analytics.daily_rollup)
_over_star("n06_moving_averages", "N6 W3", analytics.moving_averages)
_over_star("n06_first_days", "N6 O4", analytics.first_days)
_over_star("n06_daily_revenue_range", "N6 A7 P19", analytics.daily_revenue_range)
_over_star("n07_hourly_revenue", "N7 J3", analytics.hourly_revenue)
_over_star("n08_rush_comparison", "N8 J3 P10", analytics.rush_comparison)
_over_star("n09_part_of_day", "N9 J3", analytics.part_of_day_breakdown)
_over_star("n10_loyalty_summary", "N10 P10 P17 W2", analytics.loyalty_summary)
_over_star("n11_top_customers", "N11 O2", analytics.top_customers)
_over_star("n12_employee_performance", "N12 P15", analytics.employee_performance)
_over_star("n13_payment_summary", "N13 W2", analytics.payment_summary)
_over_star("n14_day_over_day", "N14 W4 W5 W6", analytics.day_over_day)
_over_star("n14_best_days", "N14 O3", analytics.best_days)
_over_star("n14_worst_days", "N14 O3", analytics.worst_days)
_over_star("n15_cumulative", "N15 W7", analytics.cumulative)
_over_star("n15_milestones", "N15 A8 F6", analytics.milestone_days)
_over_star("n16_rank_in_category", "N16 W8", analytics.rank_in_category)
_over_star("n16_top_per_category", "N16 F7", analytics.top_per_category)
_over_star("n17_outlier_bounds", "N17 A9", analytics.outlier_bounds)
_over_star("n17_outlier_days", "N17 F5", analytics.outlier_days)
_over_star("n18_daily_correlation", "N18 A10", analytics.daily_correlation)
_over_star("n19_revenue_histogram", "N19 A11", analytics.revenue_histogram)
_over_star("n20_revenue_box", "N20 A12", analytics.revenue_box)

_over_star("n21_running_revenue", "W3 W7", lines.running_revenue)
_over_star("n22_line_revenue_box", "A9 A12 N17", lines.line_revenue_box)

# Quality -----------------------------------------------------------------------------------------

_over_star("q01_null_profile", "Q1 A13", quality.null_profile)
_over_star(
    "q01_columns_with_nulls", "Q1 F10", lambda t: quality.null_profile(t, only_with_nulls=True)
)
_over_star("q02_duplicate_ids", "Q2 A14", quality.duplicate_ids)
_over_star("q03_orphan_keys", "Q3 J6", quality.orphan_keys)
_over_star("q04_measure_checks", "Q4 Q5 Q6 Q7 A15 P22", quality.measure_checks)
_over_source("q07_payment_violations", "Q7 F4", quality.payment_method_violations)
_over_star("q08_day_range", "Q8 A7", quality.day_range)
_over_star("q08_missing_days", "Q8", quality.missing_days)
_over_star("q09_join_row_counts", "Q9 J4", quality.join_row_counts)
_over_source("q10_unbalanced_sales", "Q10 P12 P22", quality.unbalanced_sales)
_over_all_sources("q11_source_not_empty", "Q11", quality.source_not_empty)
_over_star("q12_duplicate_members", "Q12", quality.duplicate_dimension_members)


_over_all_sources("q14_operational_constraints", "Q7 S3", quality.operational_checks)


@_register("q13_check_summary", "Q13", oracle.SQL.get("q13_check_summary"))
def _check_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_summary(
        workspace.star_tables(spark, sf_dir), workspace.all_sources(spark, sf_dir)
    )


# Load --------------------------------------------------------------------------------------------

_over_source("j01_extract", "J1 P7", star.extract)
_over_source(
    "j01_extract_size",
    "A17 U2",
    lambda oltp: star.extract(oltp).agg(
        F.count(F.lit(1)).alias("line_items"),
        F.count_distinct("transaction_id").alias("transactions"),
    ),
)
_over_star("k01_dim_time", "K1 P1 P2 P3 P26 J9", lambda t: t["dim_time"])
_over_star("k02_dim_product", "K2 W9 S8", lambda t: t["dim_product"].drop("id"))
_over_star("k03_dim_customer", "K3 P8", lambda t: t["dim_customer"].drop("id"))
_over_star("k04_dim_employee", "K4 F2", lambda t: t["dim_employee"].drop("id"))


@_register("k04_dim_payment_method", "K4 S5", oracle.SQL.get("k04_dim_payment_method"))
def _payment_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accepted payment methods and how many sales used each."""
    methods = workspace.star_tables(spark, sf_dir)["dim_payment_method"]
    used = bench.operational(spark, sf_dir)["transactions"].groupBy("payment_method").agg(
        F.count(F.lit(1)).alias("n")
    )
    sales = labels.or_default(F.col("n"), 0).cast("bigint").alias("sales")
    return methods.join(used, F.col("method") == F.col("payment_method"), "left").select("id", "method", sales)


_over_star("k05_fact_sales", "K5 J5 F1 P5 P11 S4 S6 W10", star.member_attributes)
_over_star("k11_rejected_lines", "K11 F1", lambda t: t["rejected_lines"])


@_register("k06_star_totals", "K6", oracle.SQL.get("k06_star_totals"))
def _star_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts and amounts of a star made without a place to store it."""
    tables = star.star(bench.operational(spark, sf_dir), bench.FIRST_DAY)
    return tables["fact_sales"].agg(
        F.count(F.lit(1)).alias("accepted_lines"),
        F.count("dim_employee_id").alias("lines_with_employee"),
        F.sum("quantity_sold").cast("bigint").alias("units"),
        F.sum("revenue").cast("decimal(20,2)").alias("revenue"),
        F.sum("profit").cast("decimal(20,2)").alias("profit"),
    )


@_register("s09_surrogate_keys", "S9", oracle.SQL.get("s09_surrogate_keys"))
def _surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of each dimension run from 1 without gap or repetition; those of hours follow from day and
    hour."""
    tables = workspace.star_tables(spark, sf_dir)

    def ids(name: str) -> DataFrame:
        return tables[name].agg(
            F.count(F.lit(1)).alias("members"),
            F.count_distinct("id").alias("distinct_ids"),
            F.min("id").alias("lowest_id"),
            F.max("id").alias("highest_id"),
        ).select(F.lit(name).alias("table_name"), "*")

    return reduce(DataFrame.unionByName, map(ids, quality.NATURAL_KEYS))


@_register("s08_insert_if_absent", "S8", oracle.SQL.get("s08_insert_if_absent"))
def _insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load of unchanged products adds nothing; raising the cost of one category adds a
    version of exactly its members, numbered on."""
    tables = workspace.star_tables(spark, sf_dir)
    products = tables["dim_product"]
    dearer = F.when(F.col("category") == "ECONOMY", F.col("unit_cost") + 1).otherwise(
        F.col("unit_cost")
    )
    changed = products.withColumn("unit_cost", dearer.cast(S.PRICE)).drop("id")
    again = star.new_members(products.drop("id"), products, star.PRODUCT)
    added = star.new_members(changed, products, star.PRODUCT)

    def summary(df: DataFrame, batch: str) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias("added"),
            F.min("id").alias("lowest_id"),
            F.max("id").alias("highest_id"),
            F.coalesce(F.sum("unit_cost"), F.lit(0)).cast(S.MONEY_SUM).alias("cost_sum"),
        ).select(F.lit(batch).alias("batch"), "*")

    return summary(again, "unchanged").unionByName(summary(added, "one category dearer"))


@_register("k10_replace_days", "K10 F9", oracle.SQL.get("k10_replace_days"))
def _replace_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all days, load everything a second time and remove the first three days: each remaining
    day must still count once."""
    root = fresh_path(spark, "replaced")
    oltp = bench.operational(spark, sf_dir)
    days_per_partition = workspace.DAYS_PER_PARTITION
    for _ in range(2):
        star.load_days(spark, oltp, root, bench.FIRST_DAY, days_per_partition)
    star.remove_days(spark, root, [1, 2, 3])
    return _per_day(star.read_star(spark, root))


def _per_day(tables: Tables) -> DataFrame:
    hours = tables["dim_time"].groupBy("simulated_day").agg(
        F.count(F.lit(1)).alias("open_hours")
    )
    sold = tables["sales_lines"].groupBy("simulated_day").agg(
        F.count_if("accepted").alias("accepted_lines"),
        F.count_if(~F.col("accepted")).alias("rejected_lines"),
        money.from_cents(F.sum(F.when(F.col("accepted"), F.col("revenue_cents")))).alias("revenue"),
    )
    return hours.join(sold, "simulated_day")


@_register("k10_mixed_widths", "K10 K5", oracle.SQL.get("k10_mixed_widths"))
def _mixed_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all days many to a partition, then a hundred days again without naming a width: every day
    counts once, also those that share a partition with a reloaded one."""
    root = fresh_path(spark, "widths")
    oltp = bench.operational(spark, sf_dir)
    star.load_days(spark, oltp, root, bench.FIRST_DAY, workspace.DAYS_PER_PARTITION)
    day = labels.day_number(F.col("transaction_time"), bench.FIRST_DAY)
    some = oltp["transactions"].where(day.between(200, 300))
    items = oltp["transaction_items"].join(
        some.select(F.col("id").alias("transaction_id")), "transaction_id", "left_semi"
    )
    star.load_days(spark, oltp | {"transactions": some, "transaction_items": items}, root, bench.FIRST_DAY)
    return _per_day(star.read_star(spark, root))


@_register("k11_lines_without_sale", "K11 F1", oracle.SQL.get("k11_lines_without_sale"))
def _lines_without_sale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, each with lines whose sales are missing: both stay rejected, next to each other."""
    root = fresh_path(spark, "orphans")
    oltp = bench.operational(spark, sf_dir)
    for half, lost in ((0, 8), (1, 7)):
        part = {
            "transactions": oltp["transactions"].where((F.col("id") % 2 == half) & (F.col("id") % 100 != lost)),
            "transaction_items": oltp["transaction_items"].where(F.col("transaction_id") % 2 == half),
        }
        star.load_days(spark, oltp | part, root, bench.FIRST_DAY, workspace.DAYS_PER_PARTITION)
    rejected = star.read_star(spark, root)["rejected_lines"]
    return rejected.where("simulated_day IS NULL").select("id", "source_transaction_id", "reasons")


@_register("k13_repaired_members", "K2 K3 K4 Q12 S8", oracle.SQL.get("k13_repaired_members"))
def _repaired_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star with a copy of every second member, to which half of the lines of every second partition
    are linked, after its repair: member rows per natural key, and what is linked to them."""
    clean, root = workspace.star_root(spark, sf_dir), fresh_path(spark, "copies")
    spark.read.parquet(f"{clean}/layout").write.parquet(f"{root}/layout")
    # Copies with smaller ids go, but of a payment method the one with the smallest id stays.
    shift = dict.fromkeys(star.MEMBER_COLUMNS, -(10**9)) | {"dim_payment_method": 10**9, "dim_time": 0}
    for name, by in shift.items():
        stored = star.read_star(spark, clean)[name]
        copies = stored.where(F.col("id") % 2 == 0).withColumn("id", F.col("id") + by)
        stored.unionByName(copies).write.parquet(f"{root}/{name}")
    stored = star.stored_lines(spark, f"{clean}/sales_lines")
    linked = (F.col(star.BLOCK) % 2 == 1) & (F.col("id") % 2 == 0)
    for name in repair.KEYED_DIMENSIONS:
        key = F.col(f"{name}_id")
        stored = stored.withColumn(
            f"{name}_id", F.when(linked & (key % 2 == 0), key + shift[name]).otherwise(key)
        )
    stored.write.partitionBy(star.BLOCK).parquet(f"{root}/sales_lines")
    repair.repair_members(spark, root)
    return repair.member_links(star.read_star(spark, root))


@_register("k14_costs_as_of_day", "W9 W10 K5", oracle.SQL.get("k14_costs_as_of_day"))
def _costs_as_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the days before 1,200, then the later ones after the cost of a category was raised, then a
    hundred early days again: these keep the cost of their day."""
    root = fresh_path(spark, "versions")
    oltp = bench.operational(spark, sf_dir)
    dearer = F.when(F.col("category") == "ECONOMY", F.col("unit_cost") + 1).otherwise(F.col("unit_cost"))
    raised = {"products": oltp["products"].withColumn("unit_cost", dearer.cast(S.PRICE))}
    day = labels.day_number(F.col("transaction_time"), bench.FIRST_DAY)
    batches = {"_early": (day < 1200, {}), "_late": (day >= 1200, raised), "_again": (day.between(100, 199), raised)}
    # The lines are prepared once, with a mark for each batch that their sale is in.
    marks = oltp["transactions"].groupBy(F.col("id").alias("transaction_id")).agg(
        *[F.max(days).alias(mark) for mark, (days, _) in batches.items()]
    )
    with Scratch(spark) as scratch:
        marked = scratch.stage(star.line_items(oltp).join(marks, "transaction_id"), "marked")
        for mark, (days, products) in batches.items():
            some = marked.where(mark).drop(*batches)
            batch = oltp | (products | {"transactions": oltp["transactions"].where(days), "transaction_items": some})
            star.load_days(
                spark, batch, root, bench.FIRST_DAY, workspace.DAYS_PER_PARTITION, history=True, stored_items=True
            )
    return star.sale_facts(star.read_star(spark, root)).groupBy("simulated_day").agg(
        F.count(F.lit(1)).alias("lines"),
        money.total("cost_cents").alias("cost"),
        money.total("profit_cents").alias("profit"),
    )


# Inventory ---------------------------------------------------------------------------------------


def _ledger(oltp: Tables) -> DataFrame:
    return inventory.ledger(oltp["sold_quantities"], levels=oltp["inventory"])


def _daily_lines(oltp: Tables) -> DataFrame:
    day = labels.day_number(F.col("transaction_time"), bench.FIRST_DAY)
    header = oltp["transactions"].select(F.col("id").alias("transaction_id"),
                                         day.alias("simulated_day"))
    return oltp["sold_quantities"].join(header, "transaction_id")


def _daily_ledger(oltp: Tables) -> DataFrame:
    return inventory.ledger(_daily_lines(oltp), reset_daily=True, levels=oltp["inventory"])


_over_source("k07_stock_ledger", "K7 W11 F8", _ledger)
_over_source("k07_daily_stock_ledger", "K7 W11", _daily_ledger)
# Small orders make most sales larger than one order: the ledger's general case.
_over_source(
    "k07_small_orders_ledger",
    "K7",
    lambda oltp: inventory.ledger(oltp["sold_quantities"], order_quantity=20),
)


def _levels_by_product(oltp: Tables) -> DataFrame:
    """Opening stock and reorder threshold that differ from product to product."""
    number = F.col("product_id")
    return oltp["inventory"].select(
        number,
        (60 + number % 7 * 30).cast("int").alias("quantity_on_hand"),
        (10 + number % 4 * 15).cast("int").alias("reorder_threshold"),
    )


_over_source(
    "k07_ledger_by_levels",
    "K7 F8",
    lambda oltp: inventory.ledger(
        oltp["sold_quantities"], levels=_levels_by_product(oltp), order_quantity=30
    ),
)
_over_source(
    "k07_daily_ledger_by_levels",
    "K7 F8",
    lambda oltp: inventory.ledger(
        _daily_lines(oltp), reset_daily=True, levels=_levels_by_product(oltp), order_quantity=30
    ),
)


def _with_stored_ledger(plan: Callable[[DataFrame, Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Purchase orders and closing stock join the ledger to other tables: end its lineage first."""
    return lambda oltp: plan(stage(_ledger(oltp), "ledger"), oltp)


_over_source("k08_purchase_orders", "K8 J8", _with_stored_ledger(inventory.purchase_orders))
_over_source("k09_closing_stock", "K9 P27", _with_stored_ledger(inventory.closing_stock))
_over_source(
    "k09_daily_closing_stock",
    "K9",
    lambda oltp: inventory.closing_stock(
        stage(_daily_ledger(oltp), "ledger"), oltp, reset_daily=True
    ),
)
_over_source("k12_roster", "K12 J7 F3", lambda oltp: inventory.roster(oltp["employees"]))

# Files -------------------------------------------------------------------------------------------


@_register("s01_headerless_csv", "S1", oracle.SQL.get("s01_headerless_csv"))
def _headerless_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every star table written as headerless CSV and read back with its schema: its rows, and how
    many differ from those written."""
    tables = workspace.star_tables(spark, sf_dir)
    folder = fresh_path(spark, "csv")
    for name in S.STAR:
        files.write_headerless_csv(tables[name], f"{folder}/{name}")
    back = files.read_star_csv(spark, folder)

    def compared(name: str) -> DataFrame:
        both = tables[name].select(*S.STAR[name].names, F.lit(1).alias("n")).unionByName(
            back[name].withColumn("n", F.lit(-1))
        )
        differing = both.groupBy(*S.STAR[name].names).agg(F.sum("n").alias("n")).where("n <> 0")
        rows = back[name].agg(F.count(F.lit(1)).alias("row_count"))
        lost = differing.agg(F.count(F.lit(1)).alias("differing_rows"))
        return rows.select(
            F.lit(name).alias("table_name"), "row_count", lost.scalar().alias("differing_rows")
        )

    return reduce(DataFrame.unionByName, map(compared, S.STAR))


@_register("s03_operational_files", "S2 S3 S6 J1", oracle.SQL.get("j01_extract"))
def _operational_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operational tables appended to files in two halves, read back by their definitions, and
    extracted."""
    oltp = bench.operational(spark, sf_dir)
    folder = fresh_path(spark, "operational")
    names = [n for n in S.OPERATIONAL if n != "purchase_orders"]
    for half in (0, 1):
        key = {"inventory": "product_id"}
        part = {n: oltp[n].where(F.col(key.get(n, "id")) % 2 == half) for n in names}
        files.write_tables(part, folder)
    files.write_tables({"purchase_orders": S.empty_tables(spark, S.OPERATIONAL)["purchase_orders"]}, folder)
    return star.extract(files.read_operational_parquet(spark, folder))


@_register("s10_views", "S10", oracle.SQL.get("s10_views"))
def _views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star registered by name and asked in SQL text."""
    files.register_views(workspace.star_tables(spark, sf_dir), prefix="shop_")
    return spark.sql("""
        SELECT p.category, c.is_loyalty, count(*) AS lines, cast(sum(f.quantity_sold) AS BIGINT) AS units
        FROM shop_fact_sales f JOIN shop_dim_product p ON f.dim_product_id = p.id
          JOIN shop_dim_customer c ON f.dim_customer_id = c.id
        GROUP BY p.category, c.is_loyalty
    """)


@_register("s07_insert_dump", "S7", oracle.SQL.get("s07_insert_dump"))
def _insert_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product dimension dumped as INSERT statements and loaded from the dump."""
    products = workspace.star_tables(spark, sf_dir)["dim_product"].drop("id")
    path = fresh_path(spark, "dump")
    files.write_insert_dump(products, path, "dim_product")
    return files.read_insert_dump(spark, path, products.schema)


@_register("s07_dump_over_lines", "S7", oracle.SQL.get("s07_dump_over_lines"))
def _dump_over_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product dimension dumped with raw line breaks in texts, comments with apostrophes, and tuples
    and clauses over several lines, and loaded from the dump."""
    products = workspace.star_tables(spark, sf_dir)["dim_product"].drop("id")
    broken = products.withColumn("name", F.replace("name", F.lit(" "), F.lit("\n' -- ")))

    def text(name: str) -> Column:
        return F.concat(F.lit("'"), F.replace(name, F.lit("'"), F.lit("''")), F.lit("'"))

    values = [F.col("source_id").cast("string"), *map(text, ("name", "category", "subcategory")), F.col("unit_cost").cast("string")]
    row = F.concat_ws(",\n  ", *[F.coalesce(v, F.lit("NULL")) for v in values])
    statement = F.concat(
        F.lit("-- the shop's product\nINSERT INTO dim_product\nVALUES ("), row,
        F.lit(") -- don't add twice\nON CONFLICT (source_id)\n  DO NOTHING;"),
    )
    path = fresh_path(spark, "dump")
    broken.select(statement.alias("value")).write.text(path)
    return dumps.read_dump(spark, path, products.schema)


def _sampled_ids(tables: Tables) -> DataFrame:
    samples = [
        sample.select(F.lit(name).alias("table_name"), "id")
        for name, sample in analytics.table_samples(tables).items()
    ]
    return reduce(DataFrame.unionByName, samples)


_over_star("o05_table_samples", "O5", _sampled_ids)

# Streams -----------------------------------------------------------------------------------------


def _over_feed(
    name: str,
    covers: str,
    plan: Callable[[DataFrame], DataFrame],
    files_per_batch: int | None = None,
) -> None:
    _register(name, covers, oracle.SQL.get(name))(
        lambda spark, sf_dir: plan(workspace.feed_stream(spark, sf_dir, files_per_batch))
    )


_over_feed(
    "l01_sale_events",
    "L1 S12 S13 P6",
    lambda events: runs.append_to_table(
        feed.of_type(events, "transaction").select(
            "seq", "ts", "day", "hour", "sim_time", "customer", "payment", "total",
            labels.cart_text(F.col("items")).alias("items_text"),
        ),
        "sales",
    ),
)
_over_feed(
    "l01_reorder_events",
    "L1",
    lambda events: runs.append_to_table(
        feed.of_type(events, "reorder").select("seq", "day", "sim_time", "product"), "reorders"
    ),
)
_over_feed(
    "l02_sales_so_far",
    "L2",
    lambda events: runs.totals_to_table(feed.sales_so_far(events), "sales-so-far"),
    files_per_batch=1,
)
_over_feed(
    "l03_hour_summary",
    "L3 P4",
    lambda events: runs.totals_to_table(feed.hour_summary(events), "hours"),
    files_per_batch=1,
)


def _day_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams with day totals, one over sale lines and one over sale headers. Both sources are
    only ever added to; a reloaded star would count days again."""
    oltp = bench.operational(spark, sf_dir)
    day = labels.day_number(F.col("transaction_time"), bench.FIRST_DAY)
    header = oltp["transactions"].select(F.col("id").alias("transaction_id"), day.alias("simulated_day"))
    costs = oltp["products"].select(F.col("id").alias("product_id"), "unit_cost")
    lines = (
        bench.transaction_items(spark, sf_dir, workspace.line_stream(spark, sf_dir))
        .join(header, "transaction_id", "left")
        .join(costs, "product_id", "left")
    )
    revenue = money.in_cents(F.col("unit_price_at_sale")) * F.col("quantity")
    cost = money.in_cents(F.col("unit_cost")) * F.col("quantity")
    lines = lines.select(
        "simulated_day",
        F.col("quantity").alias("quantity_sold"),
        revenue.alias("revenue_cents"),
        cost.alias("cost_cents"),
        (revenue - cost).alias("profit_cents"),
    )
    orders = bench.table(spark, sf_dir, "orders")
    order_stream = runs.stream_table(spark, sf_dir, orders, "orders.parquet")
    headers = order_stream.select(F.col("o_orderdate").alias("transaction_time"))
    amounts = runs.totals_to_table(feed.day_amounts(lines), "day-amounts")
    sales = runs.totals_to_table(feed.day_sales(headers, bench.FIRST_DAY), "day-sales")
    return sales.join(amounts, "simulated_day", "left")


_register("l04_day_summary", "L4 A16", oracle.SQL.get("l04_day_summary"))(_day_summary)


@_register("l05_stock_alerts", "L5 F8", oracle.SQL.get("l05_stock_alerts"))
def _stock_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over several micro-batches, with sales that begin in one and end in the next."""
    stream = workspace.line_stream(spark, sf_dir).select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )
    return runs.low_stock_alerts(runs.stock_ledger(stream))


_over_feed(
    "l06_feed_lines",
    "L6 P24 P25",
    lambda events: runs.append_to_table(feed.feed_lines(events), "lines"),
)


@_register("l06_summary_lines", "L6 P25 P4", oracle.SQL.get("l06_summary_lines"))
def _summary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour, day-start and day-end events made from the summaries, as display lines."""
    hours = runs.totals_to_table(feed.hour_summary(workspace.feed_stream(spark, sf_dir)), "hours")
    days = _day_summary(spark, sf_dir)
    events = [feed.hour_events(hours), feed.day_start_events(days), feed.day_end_events(days)]
    conformed = [feed.conform(e) for e in events]
    lines = conformed[0].unionByName(conformed[1]).unionByName(conformed[2])
    return lines.select("type", feed.feed_line().alias("line"))


_over_feed(
    "l07_latest_lines",
    "L7 O6",
    lambda events: feed.latest_lines(runs.append_to_table(feed.feed_lines(events), "lines")),
)


_over_feed(
    "l07_running_latest",
    "L7 O6",
    lambda events: runs.latest_to_table(feed.feed_lines(events), "seq"),
    files_per_batch=1,
)


def _hours_and_late(events: DataFrame) -> DataFrame:
    """Hours that close a quarter of an hour after their end, with the events that came later added."""
    hours, late = runs.hours_with_late(events.select("ts", "type"), "15 MINUTES")
    late = late.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_start")).agg(
        F.count_if(F.col("type") == "transaction").alias("customers"),
        F.count_if(F.col("type") == "reorder").alias("reorders"),
        F.count(F.lit(1)).alias("events"),
    )
    both = hours.drop("closed").unionByName(late)
    return both.groupBy("hour_start").agg(*[F.sum(c).alias(c) for c in ("customers", "reorders", "events")])


_over_feed("l03_hours_and_late", "L3", _hours_and_late, files_per_batch=1)


@_register("l08_pushed_events", "L8", oracle.SQL.get("l08_pushed_events"))
def _pushed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events handed to a caller's function, here one that stores counts by type and day."""
    path = fresh_path(spark, "pushed")

    def store(batch: DataFrame, number: int) -> None:
        counts = batch.groupBy("type", "day").agg(F.count(F.lit(1)).alias("events"))
        counts.write.mode("overwrite").parquet(f"{path}/batch={number}")

    runs.push(workspace.feed_stream(spark, sf_dir), store)
    stored = spark.read.schema("type STRING, day INT, events BIGINT").parquet(path)
    return stored.groupBy("type", "day").agg(F.sum("events").alias("events"))


@_register("l09_lines_from_sales", "L1 S12 S13 P12 P24 P25", oracle.SQL.get("l09_lines_from_sales"))
def _lines_from_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales and reorders of the shop as events, written as JSON, read back and rendered."""
    oltp = bench.operational(spark, sf_dir)
    sales = feed.sale_events(oltp, bench.FIRST_DAY)
    reorders = feed.reorder_events(stage(_ledger(oltp), "ledger"), oltp, bench.FIRST_DAY)
    events = feed.conform(sales).unionByName(feed.conform(reorders))
    return feed.feed_lines(feed.decode(stage(feed.encode(events), "event-texts")))


_over_star(
    "l09_load_lines",
    "L6 P25",
    lambda t: feed.conform(feed.load_events(t)).select("type", "day", feed.feed_line().alias("line")),
)


@_register("l09_malformed_events", "L1 S13", oracle.SQL.get("l09_malformed_events"))
def _malformed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with every fiftieth text cut off: how many texts are events, and the others."""
    texts = feed.encode(bench.feed_events(bench.table(spark, sf_dir, "events"))).select(
        F.when(F.get_json_object("value", "$.seq").cast("bigint") % 50 == 0, F.substring("value", 1, 10))
        .otherwise(F.col("value"))
        .alias("value")
    )
    texts = stage(texts, "some-broken")
    sound = feed.well_formed(texts).agg(F.count("seq").alias("n")).select(
        F.lit("events").alias("value"), "n"
    )
    broken = feed.malformed(texts).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    return sound.unionByName(broken)


def queries() -> dict[str, Query]:
    return {name: entry.run for name, entry in CATALOG.items()}


def oracle_sql() -> dict[str, str]:
    return {name: entry.sql for name, entry in CATALOG.items() if entry.sql is not None}


def covered() -> dict[str, list[str]]:
    """Blueprint id to the queries that exercise it."""
    by_id: dict[str, list[str]] = {}
    for name, entry in CATALOG.items():
        for item in entry.covers:
            by_id.setdefault(item, []).append(name)
    return by_id
