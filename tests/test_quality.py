"""Each check must pass on sound data and fail on a planted defect."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from tallyhouse.plans import quality

from tests.shop import at, shop, star


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_revenue_off_by_one_cent_is_tolerated_but_not_two(spark):
    tables = star(
        spark,
        [{"unit_price": "2.00", "quantity_sold": 2, "revenue": r} for r in ("4.00", "4.01", "4.02")],
    )
    failing = as_dict(quality.measure_checks(tables), "check_name", "failing_rows")
    assert failing["revenue = quantity x price"] == 1
    assert sum(failing.values()) == 1


def test_profit_sign_and_presence_checks(spark):
    tables = star(
        spark,
        [{"profit": "5.00", "revenue": "1.00"}, {"unit_price": "-1.00", "revenue": "-1.00"},
         {"dim_product_id": None}],
    )
    failing = as_dict(quality.measure_checks(tables), "check_name", "failing_rows")
    assert {k: v for k, v in failing.items() if v} == {
        "profit = revenue - cost": 1,
        "unit_price not negative": 1,
        "revenue not negative": 1,
        "dim_product_id present": 1,
    }


def test_orphans_include_missing_employees(spark):
    tables = star(
        spark, [{"dim_employee_id": None}, {"dim_product_id": 5}, {"dim_product_id": 5}, {}]
    )
    assert as_dict(quality.orphan_keys(tables), "foreign_key", "orphaned_rows") == {
        "dim_product_id": 2,
        "dim_customer_id": 0,
        "dim_employee_id": 1,
        "dim_payment_method_id": 0,
        "dim_time_id": 0,
    }


def test_duplicate_ids_count_null_as_one_value(spark):
    tables = star(spark, [{"id": 1}, {"id": 1}, {"id": None}, {"id": None}, {"id": 2}])
    assert as_dict(quality.duplicate_ids(tables), "table_name", "duplicates")["fact_sales"] == 2


def test_duplicate_dimension_rows_break_row_preservation(spark):
    twice = [(1, 1, "Cy", "Cashier"), (1, 1, "Cy", "Cashier")]
    tables = star(spark, [{}, {}], dim_employee=twice)
    out = {r["dimension"]: tuple(r)[1:] for r in quality.join_row_counts(tables).collect()}
    assert out["dim_employee"] == (2, 4, False)
    assert out["dim_product"] == (2, 2, True)
    assert [tuple(r) for r in quality.duplicate_dimension_members(tables).collect()] == [
        ("dim_employee", 1, 2)
    ]


def test_null_profile_in_percent(spark):
    tables = star(spark, [{"dim_employee_id": None}, {}, {}])
    out = {
        (r["table_name"], r["column_name"]): r["null_pct"]
        for r in quality.null_profile(tables, only_with_nulls=True).collect()
    }
    assert out == {
        ("fact_sales", "dim_employee_id"): Decimal("33.33"),
        ("dim_customer", "join_date"): Decimal("100.00"),
    }


def test_day_range_and_missing_days(spark):
    tables = star(spark, [{"simulated_day": d} for d in (1, 2, 5)])
    assert [tuple(r) for r in quality.day_range(tables, 1, 6).collect()] == [(1, 5, 2, False)]
    assert [r[0] for r in quality.missing_days(tables).collect()] == [3, 4]


def test_header_total_must_match_the_lines(spark):
    oltp = shop(
        spark,
        [(1, 1, 1, at(1, 9), "cash"), (2, 1, 1, at(1, 9), "gold"), (3, 1, 1, at(1, 9), "cash")],
        [(1, 1, 1, "2.00"), (2, 1, 2, "2.00")],
    )
    wrong = F.when(F.col("id") != 1, F.col("total_amount") + 1).otherwise(F.col("total_amount"))
    oltp["transactions"] = oltp["transactions"].withColumn("total_amount", wrong)
    assert sorted(tuple(r) for r in quality.unbalanced_sales(oltp).collect()) == [
        (2, Decimal("5.00"), Decimal("4.00")),
        (3, Decimal("1.00"), Decimal("0.00")),
    ]
    assert [tuple(r) for r in quality.payment_method_violations(oltp).collect()] == [("gold", 1)]


def test_source_without_rows_is_not_ready(spark):
    out = as_dict(quality.source_not_empty(shop(spark, [], [])), "table_name", "ready")
    assert not out["transactions"] and not out["transaction_items"] and out["products"]


def test_summary_names_every_failure(spark):
    tables = star(spark, [{"dim_employee_id": None}, {}])
    oltp = shop(spark, [(1, 1, 1, at(1, 9), "gold")], [(1, 1, 1, "2.00")])
    bad = {
        r["check_name"]: r["status"]
        for r in quality.check_summary(tables, oltp).collect()
        if r["status"] != "Good"
    }
    assert bad == {
        "no nulls in dim_employee_id": "1 failing rows",
        "no nulls in join_date": "1 failing rows",
        "known dim_employee_id": "1 failing rows",
        "allowed payment method": "1 failing rows",
    }


def test_operational_constraints_find_each_planted_defect(spark):
    oltp = shop(spark, [(1, 2, 1, at(1, 9), "cash")], [(1, 1, 2, "2.00")])
    sound = quality.operational_checks(oltp).collect()
    assert sum(r["failing_rows"] for r in sound) == 0 and len(sound) > 35

    def failing(name, change):
        found = quality.operational_checks(oltp | {name: change(oltp[name])}).where("failing_rows > 0")
        return {(r["table_name"], r["constraint_name"]): r["failing_rows"] for r in found.collect()}

    twice = failing("customers", lambda d: d.unionByName(d.where("email IS NOT NULL")))
    assert twice == {("customers", "id unique"): 1, ("customers", "email unique"): 1}
    lost = failing("transactions", lambda d: d.withColumn("payment_method", F.lit(None).cast("string")))
    assert lost == {("transactions", "payment_method required"): 1}
    unknown = failing("purchase_orders", lambda d: d.withColumn("supplier_id", F.lit(7).cast("bigint")))
    assert unknown == {("purchase_orders", "supplier_id in suppliers"): 1}
    astray = failing("transaction_items", lambda d: d.withColumn("product_id", F.lit(99).cast("bigint")))
    assert astray == {("transaction_items", "product_id in products"): 1}


def test_key_checks_scan_the_lines_once(spark):
    tables = star(spark, [{"dim_product_id": 7}, {}])
    for check in (quality.orphan_keys, quality.join_row_counts):
        read = check(tables).inputFiles()
        assert read and all("/lines-per-key-" in f for f in read)


def test_duplicate_members_of_all_dimensions(spark):
    hours = [(1, 1, 8, "08:00", "Morning", True), (9, 1, 8, "08:00", "Morning", True)]
    tables = star(spark, [{}], dim_time=hours, dim_payment_method=[(1, "cash"), (5, "cash"), (2, "credit")])
    assert sorted(tuple(r) for r in quality.duplicate_dimension_members(tables).collect()) == [
        ("dim_payment_method", 1, 2),
        ("dim_time", 1, 2),
    ]
