"""Small hand-made operational tables and star frames."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from tallyhouse import schemas as S
from tallyhouse.schemas import Tables

FIRST_DAY = "2025-01-01"
PRODUCTS = [
    (1, "Pears", "Fruit", "Fresh", "2.00", "1.00", 1),
    (2, "Oats", "Cereal", None, "3.50", "2.25", 2),
    (3, "Plums", "Fruit", "Fresh", "4.00", "3.00", 1),
]
CUSTOMERS = [(1, "Walk-In Customer", None), (2, "Ann", "ann@example.org"), (3, "Bo", None)]
EMPLOYEES = [(1, "Cy", "Cashier", 8, 16), (2, "Di", "Cashier", 14, 22), (3, "Ed", "Supervisor", 8, 16)]


def money(text: str | None) -> Decimal | None:
    return None if text is None else Decimal(text)


def at(day: int, hour: int, minute: int = 0) -> datetime:
    return datetime(2025, 1, day, hour, minute)


def shop(
    spark: SparkSession,
    sales: list[tuple],
    items: list[tuple],
    products: list[tuple] = PRODUCTS,
    customers: list[tuple] = CUSTOMERS,
) -> Tables:
    """``sales``: id, customer, employee, time, payment. ``items``: sale, product, quantity, price."""
    lines = [
        (n, sale, product, quantity, money(price), quantity * money(price))
        for n, (sale, product, quantity, price) in enumerate(items, start=1)
    ]
    totals: dict[int, Decimal] = {}
    for _, sale, _, _, _, amount in lines:
        totals[sale] = totals.get(sale, Decimal(0)) + amount
    rows = {
        "customers": [(i, n, e, date(2024, 1, 1)) for i, n, e in customers],
        "suppliers": [(1, "Orchard", None, 1), (2, "Mill", None, 2)],
        "products": [(i, n, c, sub, money(p), money(k), sup) for i, n, c, sub, p, k, sup in products],
        "inventory": [(p[0], 150, 20, None) for p in products],
        "employees": EMPLOYEES,
        "transactions": [(*s, totals.get(s[0], Decimal(0))) for s in sales],
        "transaction_items": lines,
        "purchase_orders": [(1, 1, 1, 100, money("1.00"), at(1, 9), None)],
    }
    return {
        name: spark.createDataFrame(data, S.OPERATIONAL[name]) for name, data in rows.items()
    }


def fact(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Fact rows from partial dicts; whatever is not given gets a harmless value."""
    full = []
    for n, row in enumerate(rows, start=1):
        quantity = row.get("quantity_sold", 1)
        price = Decimal(row.get("unit_price", row.get("revenue", "1.00")))
        revenue = Decimal(row.get("revenue", price * quantity))
        cost = Decimal(row.get("cost", "0.00"))
        given = {
            "id": n,
            "dim_time_id": 1,
            "dim_product_id": 1,
            "dim_customer_id": 1,
            "dim_employee_id": 1,
            "dim_payment_method_id": 1,
            "source_transaction_id": n,
            "simulated_day": 1,
            "quantity_sold": quantity,
            "unit_price": price,
            "unit_cost": Decimal("0.00"),
            "revenue": revenue,
            "cost": cost,
            "profit": revenue - cost,
        }
        given.update({k: v for k, v in row.items() if k not in ("unit_price", "revenue", "cost")})
        if "profit" in row:
            given["profit"] = Decimal(row["profit"])
        full.append(tuple(given[c] for c in S.STAR["fact_sales"].names))
    return spark.createDataFrame(full, S.STAR["fact_sales"])


def star(spark: SparkSession, rows: list[dict], **dimensions: list[tuple]) -> Tables:
    defaults = {
        "dim_time": [(1, 1, 8, "08:00", "Morning", True)],
        "dim_product": [(1, 1, "Pears", "Fruit", "Fresh", Decimal("1.00"))],
        "dim_customer": [(1, 1, "Walk-In Customer", False, None)],
        "dim_employee": [(1, 1, "Cy", "Cashier")],
        "dim_payment_method": [(1, "cash"), (2, "credit"), (3, "debit"), (4, "mobile")],
    }
    defaults.update(dimensions)
    tables = {n: spark.createDataFrame(r, S.STAR[n]) for n, r in defaults.items()}
    tables["fact_sales"] = fact(spark, rows)
    return tables


def days(spark: SparkSession, revenue_by_day: dict[int, str]) -> Tables:
    return star(
        spark, [{"simulated_day": d, "revenue": r} for d, r in sorted(revenue_by_day.items())]
    )
