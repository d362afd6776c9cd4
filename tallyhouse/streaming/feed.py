"""The live event feed: JSON encoding, typed events, running totals and display lines.

All functions take batch or streaming frames alike; ``streaming.runs`` drives them as streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse import schemas as S
from tallyhouse.functions import labels, money

# An event as it travels: its position and time, then the fields of its type.
ENVELOPE = T.StructType(
    [T.StructField("seq", T.LongType()), T.StructField("ts", T.TimestampNTZType()), *S.EVENT]
)

JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def encode(events: DataFrame) -> DataFrame:
    """One JSON text per event; fields an event does not have are left out."""
    return events.select(F.to_json(F.struct("*"), JSON_OPTIONS).alias("value"))


_BROKEN = "_broken"


def _checked(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Texts with their event; ``_broken`` holds a text that is not an event of the schema."""
    marked = T.StructType([*schema, T.StructField(_BROKEN, T.StringType())])
    options = {**JSON_OPTIONS, "columnNameOfCorruptRecord": _BROKEN}
    read = lines.select("value", F.from_json("value", marked, options).alias("event"))
    unread = F.when(F.col("event").isNull(), F.col("value")).otherwise(F.col(f"event.{_BROKEN}"))
    return read.withColumn(_BROKEN, unread)


def decode(lines: DataFrame, schema: T.StructType = ENVELOPE) -> DataFrame:
    """JSON texts as typed events. A text that is not one ends the job; to set such texts aside
    first, see ``well_formed`` and ``malformed``."""
    refuse = F.raise_error(F.concat(F.lit("not an event: "), F.col(_BROKEN))).cast("boolean")
    checked = _checked(lines, schema).where(
        F.when(F.col(_BROKEN).isNotNull(), refuse).otherwise(F.lit(True))
    )
    return checked.select(*[F.col(f"event.{name}") for name in schema.names])


def well_formed(lines: DataFrame, schema: T.StructType = ENVELOPE) -> DataFrame:
    """The texts that are events, typed; ``malformed`` has the others."""
    checked = _checked(lines, schema).where(F.col(_BROKEN).isNull())
    return checked.select(*[F.col(f"event.{name}") for name in schema.names])


def malformed(lines: DataFrame, schema: T.StructType = ENVELOPE) -> DataFrame:
    """The texts that are not events."""
    checked = _checked(lines, schema)
    return checked.where(F.col(_BROKEN).isNotNull()).select("value")


def read_json_feed(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream over a folder of JSON-lines files."""
    reader = spark.readStream.schema("value STRING")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return decode(reader.text(path))


def of_type(events: DataFrame, kind: str) -> DataFrame:
    if kind not in S.EVENT_TYPES:
        raise ValueError(f"unknown event type {kind!r}")
    return events.where(F.col("type") == kind)


def sales_so_far(events: DataFrame) -> DataFrame:
    """Number and revenue of the day's sales; a new day starts at zero."""
    return (
        of_type(events, "transaction")
        .groupBy("day")
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            F.sum("total").cast(S.MONEY_SUM).alias("revenue"),
        )
    )


def hour_summary(events: DataFrame, late_by: str | None = None) -> DataFrame:
    """Customers and reorders per hour. With ``late_by`` the hour is closed that long after its
    end and its state dropped; this needs a time-zone timestamp, so set the session zone to UTC."""
    if late_by is not None:
        events = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late_by)
    return (
        events.groupBy(F.window("ts", "1 hour"))
        .agg(
            F.count_if(F.col("type") == "transaction").alias("customers"),
            F.count_if(F.col("type") == "reorder").alias("reorders"),
        )
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("hour_start"),
            F.hour("window.start").alias("hour"),
            labels.hour_range_label(F.hour("window.start")).alias("label"),
            "customers",
            "reorders",
        )
    )


def day_amounts(lines: DataFrame) -> DataFrame:
    """Units, revenue, cost and profit of each day's sale lines so far."""
    return lines.groupBy("simulated_day").agg(
        money.units(F.col("quantity_sold")).alias("items_sold"),
        money.total("revenue_cents").alias("revenue"),
        money.total("cost_cents").alias("cost"),
        money.total("profit_cents").alias("profit"),
    )


def day_sales(headers: DataFrame, first_day: str) -> DataFrame:
    """Number of sales of each day so far, from the sale headers."""
    day = labels.day_number(F.col("transaction_time"), first_day)
    return headers.groupBy(day.alias("simulated_day")).agg(
        F.count(F.lit(1)).alias("transactions")
    )


def sale_events(oltp: S.Tables, first_day: str) -> DataFrame:
    """One ``transaction`` event per sale, with its lines in order of their number as items. A sale
    has a handful of lines, so collecting them is bounded."""
    line = F.struct(
        "line", F.coalesce("quantity", F.lit(0)).alias("quantity"), "product", F.col("price").alias("unit_price")
    )
    names = oltp["products"].select(F.col("id").alias("product_id"), F.col("name").alias("product"))
    carts = (
        oltp["transaction_items"]
        .select("transaction_id", "product_id", "quantity", F.col("id").alias("line"), F.col("unit_price_at_sale").alias("price"))
        .join(names, "product_id")
        .groupBy("transaction_id")
        .agg(F.array_sort(F.collect_list(line)).alias("cart"))
    )
    customers = oltp["customers"].select(F.col("id").alias("customer_id"), F.col("name").alias("customer"))
    ts = F.col("transaction_time")
    return (
        oltp["transactions"]
        .join(carts, F.col("id") == F.col("transaction_id"))
        .join(customers, "customer_id")
        .select(
            F.col("id").alias("seq"),
            ts.alias("ts"),
            F.lit("transaction").alias("type"),
            labels.day_number(ts, first_day).alias("day"),
            F.hour(ts).alias("hour"),
            labels.clock(ts).alias("sim_time"),
            "customer",
            F.transform("cart", lambda i: F.struct(i["quantity"].alias("quantity"), i["product"].alias("product"))).alias("items"),
            money.cart_total(F.col("cart")).cast("decimal(12,2)").alias("total"),
            F.col("payment_method").alias("payment"),
        )
    )


def reorder_events(stock: DataFrame, oltp: S.Tables, first_day: str) -> DataFrame:
    """One ``reorder`` event per ledger row that placed an order, at the time of its sale."""
    names = oltp["products"].select(F.col("id").alias("product_id"), F.col("name").alias("product"))
    times = oltp["transactions"].select(F.col("id").alias("transaction_id"), "transaction_time")
    ts = F.col("transaction_time")
    return (
        stock.where("reordered")
        .select("product_id", "transaction_id")
        .join(names, "product_id")
        .join(times, "transaction_id")
        .select(
            F.col("transaction_id").alias("seq"),
            ts.alias("ts"),
            F.lit("reorder").alias("type"),
            labels.day_number(ts, first_day).alias("day"),
            F.hour(ts).alias("hour"),
            labels.clock(ts).alias("sim_time"),
            "product",
        )
    )


def load_events(tables: S.Tables) -> DataFrame:
    """One ``etl`` event per loaded day with the numbers of accepted and rejected lines."""
    counts = tables["sales_lines"].where("simulated_day IS NOT NULL").groupBy("simulated_day").agg(
        F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("rejected")
    )
    message = F.concat(
        F.lit("day "), F.col("simulated_day").cast("string"), F.lit(": "),
        F.col("accepted").cast("string"), F.lit(" lines loaded, "),
        F.col("rejected").cast("string"), F.lit(" rejected"),
    )
    return counts.select(
        F.lit("etl").alias("type"), F.col("simulated_day").alias("day"), message.alias("message")
    )


def hour_events(hours: DataFrame) -> DataFrame:
    return hours.select(
        F.lit("hour").alias("type"), "hour", "label", "customers", "reorders"
    )


def day_start_events(days: DataFrame) -> DataFrame:
    return days.select(
        F.lit("day_start").alias("type"), F.col("simulated_day").alias("day")
    )


def day_end_events(days: DataFrame) -> DataFrame:
    return days.select(
        F.lit("day_end").alias("type"),
        F.col("simulated_day").alias("day"),
        "transactions",
        "revenue",
        "profit",
    )


def conform(events: DataFrame) -> DataFrame:
    """Widen events of some type to the common schema, absent fields NULL."""
    present = set(events.columns)
    return events.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in ENVELOPE
        ]
    )


def _dollars(amount: Column) -> Column:
    return F.concat(F.lit("$"), amount.cast(S.MONEY_SUM).cast("string"))


def feed_line(order_quantity: int = S.REORDER_QUANTITY) -> Column:
    """The text shown for an event. The wording and separators are fixed values."""

    def text(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    dash = " — "
    lines = {
        "transaction": text(
            shown("sim_time"), " SALE ", shown("customer"), dash, labels.cart_text(F.col("items")),
            dash, _dollars(F.col("total")), " [", shown("payment"), "]",
        ),
        "reorder": text(
            shown("sim_time"), " REORDER ", shown("product"), " stock low", dash,
            f"purchase order placed (+{order_quantity} units)",
        ),
        "hour": text(
            "HOUR ", shown("label"), dash, shown("customers"), " customers", dash,
            shown("reorders"), " reorder(s)",
        ),
        "day_start": text("DAY ", shown("day"), dash, f"Store opening at {S.OPEN_HOUR:02d}:00"),
        "day_end": text(
            "DAY ", shown("day"), " CLOSED Transactions: ", shown("transactions"), dash,
            "Revenue: ", _dollars(F.col("revenue")), dash, "Profit: ", _dollars(F.col("profit")),
        ),
        "etl": text("ETL ", shown("message")),
        "system": text(shown("time"), " ", shown("message")),
    }
    line = None
    for kind, shown_as in lines.items():
        is_kind = F.col("type") == kind
        line = F.when(is_kind, shown_as) if line is None else line.when(is_kind, shown_as)
    return line


def feed_lines(events: DataFrame) -> DataFrame:
    return events.select("seq", "ts", "type", feed_line().alias("line"))


def latest_lines(lines: DataFrame, rows: int = 300) -> DataFrame:
    """The newest lines by position; each task passes on only its own newest."""
    return lines.orderBy(F.desc("seq")).limit(rows)
