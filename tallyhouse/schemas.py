"""Table definitions of the operational store and of the star, and the fixed business constants.

Identifiers are 64-bit: a 32-bit serial would run out long before 100 TB of sale lines.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

Tables = dict[str, DataFrame]

PRICE = T.DecimalType(8, 2)
MONEY = T.DecimalType(10, 2)
MONEY_SUM = T.DecimalType(20, 2)


LONG, INT, TEXT, FLAG = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType()
DAY, TIME = T.DateType(), T.TimestampNTZType()


def _table(columns: dict[str, T.DataType], required: str = "") -> T.StructType:
    mandatory = set(required.split())
    return T.StructType(
        [T.StructField(name, kind, name not in mandatory) for name, kind in columns.items()]
    )


OPERATIONAL: dict[str, T.StructType] = {
    "customers": _table(
        {"id": LONG, "name": TEXT, "email": TEXT, "join_date": DAY}, required="id join_date"
    ),
    "suppliers": _table(
        {"id": LONG, "name": TEXT, "contact_info": TEXT, "lead_time_days": INT},
        required="id name lead_time_days",
    ),
    "products": _table(
        {
            "id": LONG,
            "name": TEXT,
            "category": TEXT,
            "subcategory": TEXT,
            "unit_price": PRICE,
            "unit_cost": PRICE,
            "supplier_id": LONG,
        },
        required="id name category unit_price unit_cost",
    ),
    "inventory": _table(
        {
            "product_id": LONG,
            "quantity_on_hand": INT,
            "reorder_threshold": INT,
            "last_restocked": TIME,
        },
        required="product_id quantity_on_hand reorder_threshold",
    ),
    # Only the hour of a shift boundary is ever used, so shifts are kept as whole hours.
    "employees": _table(
        {"id": LONG, "name": TEXT, "role": TEXT, "shift_start_hour": INT, "shift_end_hour": INT},
        required="id name role",
    ),
    "transactions": _table(
        {
            "id": LONG,
            "customer_id": LONG,
            "employee_id": LONG,
            "transaction_time": TIME,
            "payment_method": TEXT,
            "total_amount": MONEY,
        },
        required="id customer_id transaction_time payment_method total_amount",
    ),
    "transaction_items": _table(
        {
            "id": LONG,
            "transaction_id": LONG,
            "product_id": LONG,
            "quantity": INT,
            "unit_price_at_sale": PRICE,
            "subtotal": MONEY,
        },
        required="id transaction_id product_id quantity unit_price_at_sale subtotal",
    ),
    "purchase_orders": _table(
        {
            "id": LONG,
            "supplier_id": LONG,
            "product_id": LONG,
            "quantity_ordered": INT,
            "cost_per_unit": PRICE,
            "order_date": TIME,
            "received_date": TIME,
        },
        required="id supplier_id product_id quantity_ordered cost_per_unit order_date",
    ),
}

STAR: dict[str, T.StructType] = {
    "dim_time": _table(
        {
            "id": LONG,
            "simulated_day": INT,
            "hour_of_day": INT,
            "time_label": TEXT,
            "part_of_day": TEXT,
            "is_rush_hour": FLAG,
        }
    ),
    "dim_product": _table(
        {
            "id": LONG,
            "source_id": LONG,
            "name": TEXT,
            "category": TEXT,
            "subcategory": TEXT,
            "unit_cost": PRICE,
        }
    ),
    "dim_customer": _table(
        {"id": LONG, "source_id": LONG, "name": TEXT, "is_loyalty": FLAG, "join_date": DAY}
    ),
    "dim_employee": _table({"id": LONG, "source_id": LONG, "name": TEXT, "role": TEXT}),
    "dim_payment_method": _table({"id": LONG, "method": TEXT}),
    "fact_sales": _table(
        {
            "id": LONG,
            "dim_time_id": LONG,
            "dim_product_id": LONG,
            "dim_customer_id": LONG,
            "dim_employee_id": LONG,
            "dim_payment_method_id": LONG,
            "source_transaction_id": LONG,
            "simulated_day": INT,
            "quantity_sold": INT,
            "unit_price": PRICE,
            "unit_cost": PRICE,
            "revenue": MONEY,
            "cost": MONEY,
            "profit": MONEY,
        }
    ),
}

# One schema wide enough for every kind of feed event; a kind leaves the rest NULL.
EVENT = _table(
    {
        "type": TEXT,
        "day": INT,
        "hour": INT,
        "sim_time": TEXT,
        "customer": TEXT,
        "items": T.ArrayType(_table({"quantity": INT, "product": TEXT})),
        "total": T.DecimalType(12, 2),
        "payment": TEXT,
        "product": TEXT,
        "label": TEXT,
        "customers": LONG,
        "reorders": LONG,
        "transactions": LONG,
        "revenue": MONEY_SUM,
        "profit": MONEY_SUM,
        "message": TEXT,
        "time": TEXT,
    }
)

# They decide which lines are accepted and how hours are labelled.
OPEN_HOUR = 8
LAST_HOUR = 21
RUSH_HOURS = (8, 9, 12, 17, 18)
AFTERNOON_FROM = 12
EVENING_FROM = 17
PAYMENT_METHODS = ("cash", "credit", "debit", "mobile")
WALK_IN_ID = 1
WALK_IN_NAME = "Walk-In Customer"
OPENING_STOCK = 150
REORDER_THRESHOLD = 20
REORDER_QUANTITY = 100
EVENT_TYPES = ("transaction", "reorder", "hour", "day_start", "day_end", "etl", "system")
CENT_TOLERANCE = "0.01"
MILESTONES = (10_000_000, 25_000_000, 50_000_000, 100_000_000)


def empty_tables(spark: SparkSession, schemas: dict[str, T.StructType]) -> Tables:
    """Typed tables without rows, the counterpart of running the table definitions."""
    return {name: spark.createDataFrame([], schema) for name, schema in schemas.items()}


def payment_methods(spark: SparkSession) -> DataFrame:
    """The four accepted payment methods, numbered in their fixed order."""
    rows = [(i, method) for i, method in enumerate(PAYMENT_METHODS, start=1)]
    return spark.createDataFrame(rows, STAR["dim_payment_method"])


def walk_in_customer(spark: SparkSession, join_date: date) -> DataFrame:
    """The anonymous customer every sale without a loyalty card belongs to."""
    rows = [(WALK_IN_ID, WALK_IN_NAME, None, join_date)]
    return spark.createDataFrame(rows, OPERATIONAL["customers"])
