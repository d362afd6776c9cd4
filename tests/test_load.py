from __future__ import annotations

import contextlib
import io
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans import star
from tallyhouse.operators import members
from tallyhouse.plans import reports
from tallyhouse.storage import delete, fresh_path, path_exists, shared_root

from tests.shop import FIRST_DAY, PRODUCTS, at, shop

SALES = [
    (10, 2, 1, at(1, 9, 30), "cash"),
    (11, 1, None, at(1, 21), "mobile"),
    (12, 1, 2, at(2, 22), "cash"),  # after the last open hour
    (13, 3, 1, at(2, 12), "voucher"),  # unknown payment method
    (14, 9, 1, at(2, 13), "debit"),  # unknown customer
    (15, 1, 1, at(3, 17), "credit"),
]
ITEMS = [
    (10, 1, 2, "2.00"),
    (10, 2, 1, "3.10"),
    (11, 1, 3, "2.00"),
    (12, 1, 1, "2.00"),
    (13, 2, 1, "3.50"),
    (14, 1, 1, "2.00"),
    (15, 7, 1, "9.99"),  # unknown product
    (99, 1, 1, "2.00"),  # unknown sale
    (15, 3, 1, "4.00"),
]


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def load(spark, *batches, days_per_partition=1):
    root = fresh_path(spark, "star")
    for batch in batches:
        star.load_days(spark, batch, root, FIRST_DAY, days_per_partition)
    return root


def summary(spark, root):
    fact = star.read_star(spark, root)["fact_sales"]
    return rows(
        fact.groupBy("simulated_day").agg(F.count(F.lit(1)), F.sum("revenue"), F.sum("profit")),
        "simulated_day",
    )


def test_items_and_headers_link_like_joined_lines(spark):
    oltp = shop(spark, [*SALES, SALES[0]], [*ITEMS, ITEMS[1]])
    items, headers = star.line_items(oltp), star.sale_headers(oltp, FIRST_DAY)
    keys = {
        "dim_product": spark.createDataFrame([(1, 31, "1.00"), (2, 32, "2.00")], "source_id BIGINT, dim_id BIGINT, unit_cost STRING").withColumn("unit_cost", F.col("unit_cost").cast("decimal(10,2)")),
        "dim_customer": spark.createDataFrame([(1, 41), (2, 42), (3, 43)], "source_id BIGINT, dim_id BIGINT"),
        "dim_employee": spark.createDataFrame([(1, 51)], "source_id BIGINT, dim_id BIGINT"),
    }
    payment = spark.createDataFrame([("cash", 1), ("mobile", 2)], "method STRING, id BIGINT")
    once = star.keyed_lines(star.linked_items(items, headers, keys, payment))
    joined = star.keyed_lines(star.linked_lines(star.sale_lines(oltp, FIRST_DAY), keys, payment))
    assert once.columns == joined.columns and once.count() == 13
    assert once.exceptAll(joined).isEmpty() and joined.exceptAll(once).isEmpty()


def test_accepts_and_rejects_lines_with_reasons(spark):
    tables = star.read_star(spark, load(spark, shop(spark, SALES, ITEMS)))
    fact = tables["fact_sales"]
    assert rows(fact.select("id", "simulated_day", "quantity_sold", "unit_price", "unit_cost",
                            "revenue", "cost", "profit"), "id") == [
        (1, 1, 2, Decimal("2.00"), Decimal("1.00"), Decimal("4.00"), Decimal("2.00"), Decimal("2.00")),
        (2, 1, 1, Decimal("3.10"), Decimal("2.25"), Decimal("3.10"), Decimal("2.25"), Decimal("0.85")),
        (3, 1, 3, Decimal("2.00"), Decimal("1.00"), Decimal("6.00"), Decimal("3.00"), Decimal("3.00")),
        (9, 3, 1, Decimal("4.00"), Decimal("3.00"), Decimal("4.00"), Decimal("3.00"), Decimal("1.00")),
    ]
    assert rows(tables["rejected_lines"].select("id", "reasons"), "id") == [
        (4, "time"),
        (5, "payment method"),
        (6, "customer"),
        (7, "product"),
        (8, "time, customer, payment method"),
    ]


def test_sale_without_employee_is_kept_but_not_reported_per_employee(spark):
    tables = star.read_star(spark, load(spark, shop(spark, SALES, ITEMS)))
    assert rows(tables["fact_sales"].where("dim_employee_id IS NULL").select("id"), "id") == [(3,)]
    assert rows(reports.cashier_performance(tables).select("employee", "total_transactions"),
                "employee") == [("Cy", 2)]


def test_lazy_star_equals_the_stored_one(spark):
    oltp = shop(spark, SALES, ITEMS)
    stored = star.read_star(spark, load(spark, oltp))
    lazy = star.star(oltp, FIRST_DAY)
    assert rows(star.member_attributes(lazy), "id") == rows(star.member_attributes(stored), "id")
    assert rows(lazy["rejected_lines"], "id") == rows(stored["rejected_lines"], "id")
    assert rows(lazy["dim_time"], "id") == rows(stored["dim_time"], "id")


def test_time_dimension_has_every_open_hour(spark):
    tables = star.read_star(spark, load(spark, shop(spark, SALES, ITEMS)))
    day = [r for r in rows(tables["dim_time"], "id") if r[1] == 1]
    assert [r[2] for r in day] == list(range(8, 22))
    assert {r[2] for r in day if r[5]} == {8, 9, 12, 17, 18}
    assert [r[4] for r in day] == ["Morning"] * 4 + ["Afternoon"] * 5 + ["Evening"] * 5
    assert day[0][3] == "08:00"


def test_loading_a_day_twice_changes_nothing(spark):
    for days_per_partition in (1, 10):
        oltp = shop(spark, SALES, ITEMS)
        once = load(spark, oltp, days_per_partition=days_per_partition)
        twice = load(spark, oltp, oltp, days_per_partition=days_per_partition)
        assert summary(spark, once) == summary(spark, twice)
        for name in ("dim_time", "dim_product", "dim_customer", "dim_employee"):
            a, b = (star.read_star(spark, r)[name].drop("id") for r in (once, twice))
            assert rows(a, *a.columns) == rows(b, *b.columns)


def test_reloading_one_day_keeps_the_others(spark):
    whole = shop(spark, SALES, ITEMS)
    day_one = shop(spark, SALES[:1], [(10, 1, 5, "2.00")])
    for days_per_partition in (1, 10):
        root = load(spark, whole, day_one, days_per_partition=days_per_partition)
        assert summary(spark, root) == [
            (1, 1, Decimal("10.00"), Decimal("5.00")),
            (3, 1, Decimal("4.00"), Decimal("1.00")),
        ]


def test_rejects_of_a_reloaded_day_are_replaced(spark):
    bad = shop(spark, [(12, 1, 2, at(2, 22), "cash")], [(12, 1, 1, "2.00")])
    good = shop(spark, [(12, 1, 2, at(2, 20), "cash")], [(12, 1, 1, "2.00")])
    tables = star.read_star(spark, load(spark, bad, good))
    assert tables["rejected_lines"].count() == 0
    assert tables["fact_sales"].count() == 1


def test_removing_days(spark):
    for days_per_partition in (1, 10):
        root = load(spark, shop(spark, SALES, ITEMS), days_per_partition=days_per_partition)
        star.remove_days(spark, root, [1, 77])
        tables = star.read_star(spark, root)
        assert summary(spark, root) == [(3, 1, Decimal("4.00"), Decimal("1.00"))]
        assert rows(tables["dim_time"].select("simulated_day").distinct(), "simulated_day") == [
            (2,), (3,)
        ]


def test_width_is_stored_and_another_one_refused(spark):
    many = [(n, 1, 1, at(n, 9), "cash") for n in range(1, 5)]
    lines = [(n, 1, 1, "2.00") for n in range(1, 5)]
    root = load(spark, shop(spark, many, lines), days_per_partition=2)
    again = shop(spark, many[1:2], [(2, 1, 7, "2.00")])
    star.load_days(spark, again, root, FIRST_DAY)
    assert [(r[0], r[1]) for r in summary(spark, root)] == [(1, 1), (2, 1), (3, 1), (4, 1)]
    assert summary(spark, root)[1][2] == Decimal("14.00")
    with pytest.raises(ValueError, match="2 days per partition"):
        star.load_days(spark, again, root, FIRST_DAY, 1)


def test_lines_without_sale_outlive_other_loads(spark):
    for width in (1, 10):
        first = shop(spark, [(10, 1, 1, at(1, 9), "cash")], [(10, 1, 1, "2.00"), (77, 1, 1, "2.00")])
        second = shop(spark, [(11, 1, 1, at(2, 9), "cash")], [(11, 1, 1, "2.00"), (78, 1, 1, "2.00")])
        second["transaction_items"] = second["transaction_items"].withColumn("id", F.col("id") + 10)
        root = load(spark, first, second, days_per_partition=width)
        rejected = star.read_star(spark, root)["rejected_lines"].where("simulated_day IS NULL")
        assert rows(rejected.select("source_transaction_id"), "source_transaction_id") == [(77,), (78,)]
        found = shop(spark, [(77, 1, 1, at(3, 9), "cash")], [(77, 1, 1, "2.00")])
        found["transaction_items"] = found["transaction_items"].withColumn("id", F.col("id") + 1)
        star.load_days(spark, found, root, FIRST_DAY)
        rejected = star.read_star(spark, root)["rejected_lines"]
        assert rows(rejected.select("source_transaction_id"), "source_transaction_id") == [(78,)]
        lost = second | {"transactions": second["transactions"].where("id = 0")}
        star.load_days(spark, lost, root, FIRST_DAY)  # both lines of the second load, sales gone


def test_last_line_without_sale_goes_when_its_sale_comes(spark):
    root = load(spark, shop(spark, [(10, 1, 1, at(1, 9), "cash")], [(77, 1, 1, "2.00"), (10, 1, 1, "2.00")]))
    star.load_days(spark, shop(spark, [(77, 1, 1, at(3, 9), "cash")], [(77, 1, 1, "2.00")]), root, FIRST_DAY)
    assert star.read_star(spark, root)["rejected_lines"].count() == 0


def test_a_dead_run_loses_no_other_day(spark, monkeypatch):
    many = [(n, 1, 1, at(n, 9), "cash") for n in range(1, 7)]
    lines = [*[(n, 1, 1, "2.00") for n in range(1, 7)], (99, 1, 1, "2.00")]
    for act in ("load", "remove"):
        root = load(spark, shop(spark, many, lines), days_per_partition=3)
        before = summary(spark, root)
        write = star._write_blocks

        def dies(kept, path):
            for block in (0, 1):
                delete(spark, f"{path}/{star.BLOCK}={block}")
            delete(spark, f"{path}/{star.BLOCK}={star.NO_DAY}")
            raise RuntimeError("driver lost")

        again = shop(spark, many[:1], lines[:1])

        def run():
            if act == "load":
                star.load_days(spark, again, root, FIRST_DAY)
            else:
                star.remove_days(spark, root, [1, 5])

        monkeypatch.setattr(star, "_write_blocks", dies)
        with pytest.raises(RuntimeError):
            run()
        monkeypatch.setattr(star, "_write_blocks", write)
        run()
        left = [r for r in before if act == "load" or r[0] not in (1, 5)]
        touched = (1, 2, 3) if act == "load" else (1, 2, 3, 4, 5, 6)
        assert [r for r in summary(spark, root) if r[0] in touched] == [r for r in left if r[0] in touched]


def test_nothing_is_left_in_the_shared_folder(spark):
    root = load(spark, shop(spark, SALES, ITEMS), days_per_partition=10)
    folder = Path(shared_root(spark)) / f"tallyhouse-{spark.sparkContext.applicationId}"
    before = {p.name for p in folder.iterdir()}
    star.load_days(spark, shop(spark, SALES[:1], ITEMS[:2]), root, FIRST_DAY)
    star.remove_days(spark, root, [1])
    assert {p.name for p in folder.iterdir()} == before
    assert not {p.name for p in Path(root).iterdir()} & {star.KEPT, star.KEPT_HOURS}


def test_a_day_filter_reads_only_its_partitions(spark):
    root = load(spark, shop(spark, SALES, ITEMS))
    some = star.read_star(spark, root, first_day=3, last_day=3)["fact_sales"]
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        some.explain("formatted")
    assert "PartitionFilters: [isnotnull(day_block" in plan.getvalue()
    assert rows(some.select("simulated_day").distinct(), "simulated_day") == [(3,)]


def test_empty_batch_is_a_no_op(spark):
    root = load(spark, shop(spark, [], []))
    assert not path_exists(spark, f"{root}/sales_lines")


def test_changed_attribute_adds_a_version_and_lines_link_to_it(spark):
    dearer = [(1, "Pears", "Fruit", "Fresh", "2.00", "1.30", 1), *PRODUCTS[1:]]
    first = shop(spark, [(10, 2, 1, at(1, 9), "cash")], [(10, 1, 1, "2.00"), (10, 2, 1, "3.50")])
    second = shop(
        spark, [(20, 2, 1, at(2, 9), "cash")], [(20, 1, 1, "2.00"), (20, 2, 1, "3.50")],
        products=dearer,
    )
    third = shop(spark, [(30, 2, 1, at(3, 9), "cash")], [(30, 1, 1, "2.00")])
    tables = star.read_star(spark, load(spark, first, second, third))
    products = tables["dim_product"]
    assert rows(products.select("source_id", "unit_cost"), "source_id", "unit_cost") == [
        (1, Decimal("1.00")), (1, Decimal("1.30")), (2, Decimal("2.25"))
    ]
    assert sorted(r["id"] for r in products.collect()) == [1, 2, 3]
    linked = tables["fact_sales"].join(products.withColumnRenamed("id", "dim_product_id"),
                                       "dim_product_id").where("source_id = 1")
    assert rows(linked.select("simulated_day", products["unit_cost"]), "simulated_day") == [
        (1, Decimal("1.00")), (2, Decimal("1.30")), (3, Decimal("1.00"))
    ]
    assert rows(members.duplicate_members(products, "source_id"), "source_id") == [(1, 2)]


def test_exact_copies_resolve_to_the_largest_id(spark):
    copies = spark.createDataFrame([(4, 1, "Cy", "Cashier"), (9, 1, "Cy", "Cashier")],
                                   "id BIGINT, source_id BIGINT, name STRING, role STRING")
    batch = copies.drop("id").distinct()
    assert rows(star.key_map(batch, copies, star.EMPLOYEE).select("dim_id"), "dim_id") == [(9,)]


def test_member_numbers_are_dense_and_continue(spark):
    many = spark.range(5000).selectExpr("id AS source_id", "cast(id AS STRING) AS name",
                                        "if(id % 2 = 0, NULL, 'Cashier') AS role")
    numbered = members.number_members(many, star.EMPLOYEE, after=F.lit(100))
    assert sorted(r["id"] for r in numbered.collect()) == list(range(101, 5101))


def test_null_attributes_are_equal_for_insert_if_absent(spark):
    stored = spark.createDataFrame([(1, 1, "A", None)],
                                   "id BIGINT, source_id BIGINT, name STRING, role STRING")
    assert star.new_members(stored.drop("id"), stored, star.EMPLOYEE).count() == 0


def test_extract_keeps_sales_without_employee(spark):
    out = star.extract(shop(spark, SALES[:2], ITEMS[:3]))
    assert rows(out.select("transaction_id", "product_name", "employee_name", "email"),
                "transaction_id", "product_name") == [
        (10, "Oats", "Cy", "ann@example.org"),
        (10, "Pears", "Cy", "ann@example.org"),
        (11, "Pears", None, None),
    ]
