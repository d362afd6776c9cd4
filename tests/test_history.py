"""Repair of duplicated members, versions by day, and tables derived by partition."""

from __future__ import annotations

import hashlib
from decimal import Decimal
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse import schemas as S
from tallyhouse.operators.asof import as_of
from tallyhouse.plans import derived, quality, repair, reports, star, versions
from tallyhouse.plans.star import BLOCK
from tallyhouse.storage import fresh_path, stage

from tests.shop import FIRST_DAY, PRODUCTS, at, shop

DAYS = 9


def three_sales_a_day(spark, days=range(1, DAYS + 1), products=PRODUCTS):
    sales = [(10 * d + n, 1 + n, 1 + n if n < 2 else None, at(d, 9 + n), "cash") for d in days for n in range(3)]
    items = [(sale[0], 1 + (sale[0] + k) % 3, 1 + k, "4.00") for sale in sales for k in range(2)]
    return shop(spark, sales, items, products)


def files_of(root):
    return {
        str(p.relative_to(root)): hashlib.sha256(p.read_bytes()).hexdigest()
        for p in Path(root).rglob("*.parquet")
        if "sales_lines" in str(p)
    }


def block_of(name):
    return int(name.split(f"{BLOCK}=")[1].split("/")[0])


def answers(spark, root):
    tables = star.read_star(spark, root)
    asked = (reports.daily_revenue, reports.payment_breakdown, reports.cashier_performance, reports.category_by_day)
    return {ask.__name__: sorted(map(str, ask(tables).collect())) for ask in asked}


def planted(spark, **loading):
    """A star to which copies of members were appended, days 4 to 6 linked to them."""
    root = fresh_path(spark, "copies")
    star.load_days(spark, three_sales_a_day(spark), root, FIRST_DAY, 2, **loading)
    before = answers(spark, root)
    for name, after in (("dim_product", 100), ("dim_customer", 100), ("dim_employee", 100), ("dim_payment_method", 4)):
        stored = spark.read.schema(S.STAR[name]).parquet(f"{root}/{name}")
        stage(stored.withColumn("id", F.col("id") + after), "copy").write.mode("append").parquet(f"{root}/{name}")
        if name == "dim_product":
            stage(stored.withColumn("id", F.col("id") + 50), "copy").write.mode("append").parquet(f"{root}/{name}")
    hours = spark.read.schema(S.STAR["dim_time"]).parquet(f"{root}/dim_time")
    stage(hours, "copy").write.mode("append").parquet(f"{root}/dim_time")
    lines = star.stored_lines(spark, f"{root}/sales_lines").where(F.col(BLOCK).isin(1, 2))
    on_copies = F.col("simulated_day").between(4, 6)

    def link(key, after):
        column = F.col(key)
        return F.when(on_copies, column + after).otherwise(column).cast(lines.schema[key].dataType)

    lines = lines.withColumns({f"{d}_id": link(f"{d}_id", 100) for d in ("dim_product", "dim_customer", "dim_employee")})
    star.swap_lines(lines.withColumn("dim_payment_method_id", link("dim_payment_method_id", 4)), root)
    return root, before


def test_repair_leaves_one_copy_and_equal_reports(spark):
    root, before = planted(spark)
    assert not quality.duplicate_dimension_members(star.read_star(spark, root)).isEmpty()
    files = files_of(root)
    done = repair.repair_members(spark, root)
    assert done.dropped == {
        "dim_product": 6, "dim_customer": 3, "dim_employee": 2, "dim_payment_method": 4, "dim_time": DAYS * 14,
    }
    assert answers(spark, root) == before
    tables = star.read_star(spark, root)
    assert quality.duplicate_dimension_members(tables).isEmpty()
    assert quality.orphan_keys(tables).where("orphaned_rows > 0 AND foreign_key <> 'dim_employee_id'").isEmpty()
    assert sorted(r["id"] for r in tables["dim_payment_method"].collect()) == [1, 2, 3, 4]
    # The kept copies are the largest ids, so the partitions without them are the ones rewritten.
    untouched = {f: h for f, h in files.items() if block_of(f) not in done.blocks}
    assert {f: h for f, h in files_of(root).items() if block_of(f) not in done.blocks} == untouched
    # A second repair and a reload of all days change nothing any more.
    files = files_of(root)
    again = repair.repair_members(spark, root)
    assert again.blocks == [] and set(again.dropped.values()) == {0} and files_of(root) == files
    star.load_days(spark, three_sales_a_day(spark), root, FIRST_DAY)
    assert answers(spark, root) == before
    assert quality.duplicate_dimension_members(star.read_star(spark, root)).isEmpty()


def test_partitions_without_replaced_ids_stay(spark):
    root, before = planted(spark)
    # With the first copies as the larger ids nothing but days 1 to 4 and 7 on holds a replaced id.
    for name in ("dim_product", "dim_customer", "dim_employee"):
        stored = spark.read.schema(S.STAR[name]).parquet(f"{root}/{name}")
        swapped = stored.withColumn("id", F.when(F.col("id") > 100, F.col("id") - 100).when(F.col("id") < 50, F.col("id") + 200).otherwise(F.col("id")))
        stage(swapped, "swapped").write.mode("overwrite").parquet(f"{root}/{name}")
    lines = star.stored_lines(spark, f"{root}/sales_lines")
    changed = {
        f"{d}_id": F.when(F.col(f"{d}_id") > 100, F.col(f"{d}_id") - 100).otherwise(F.col(f"{d}_id") + 200)
        for d in ("dim_product", "dim_customer", "dim_employee")
    }
    star.swap_lines(lines.withColumns({k: c.cast(lines.schema[k].dataType) for k, c in changed.items()}), root)
    files = files_of(root)
    done = repair.repair_members(spark, root)
    assert done.blocks == [1, 2]
    assert answers(spark, root) == before
    after = files_of(root)
    assert {f for f in files if f in after} == {f for f in files if block_of(f) not in (1, 2)}
    assert all(after[f] == h for f, h in files.items() if f in after)


@pytest.mark.parametrize("dies_at", ["swap", "dimensions"])
def test_a_repair_that_dies_is_finished_by_the_next(spark, monkeypatch, dies_at):
    root, before = planted(spark)
    with monkeypatch.context() as patched:
        if dies_at == "swap":
            real = star._write_blocks

            def half(rows, path):
                real(rows.where(F.col("id") % 2 == 0), path)  # the partitions lose rows
                raise RuntimeError("dead")

            patched.setattr(star, "_write_blocks", half)
        else:
            recover, calls = star.recover, []

            def last(spark, root):
                calls.append(1)
                if len(calls) == 2:
                    raise RuntimeError("dead")
                recover(spark, root)

            patched.setattr(star, "recover", last)
        with pytest.raises(RuntimeError):
            repair.repair_members(spark, root)
    star.load_days(spark, three_sales_a_day(spark, days=[2]), root, FIRST_DAY)
    repair.repair_members(spark, root)
    assert answers(spark, root) == before
    assert quality.duplicate_dimension_members(star.read_star(spark, root)).isEmpty()


# Versions ----------------------------------------------------------------------------------------

DEARER = [(i, n, c, s, p, str(Decimal(k) + 1), sup) for i, n, c, s, p, k, sup in PRODUCTS]


def costs(spark, root):
    fact = star.read_star(spark, root)["fact_sales"]
    found = {}
    for row in fact.join(star.read_star(spark, root)["dim_product"].select(F.col("id").alias("dim_product_id"), "source_id", F.col("unit_cost").alias("linked")), "dim_product_id").collect():
        assert row["unit_cost"] == row["linked"]
        found.setdefault(row["simulated_day"], set()).add((row["source_id"], row["unit_cost"]))
    return found


def expected(dearer_from, products=PRODUCTS):
    old = {(p[0], Decimal(p[5])) for p in products}
    new = {(p[0], Decimal(p[5]) + 1) for p in products}
    return {d: new if d >= dearer_from else old for d in range(1, DAYS + 1)}


@pytest.mark.parametrize("width", [4])
def test_a_reloaded_day_keeps_its_attributes(spark, width):
    root = fresh_path(spark, "versions")
    load = lambda days, products: star.load_days(
        spark, three_sales_a_day(spark, days, products), root, FIRST_DAY, width, history=True
    )
    load(range(1, 6), PRODUCTS)
    load(range(6, DAYS + 1), DEARER)
    assert costs(spark, root) == expected(6)
    load([2, 3], DEARER)  # after the change, as the shop is now
    assert costs(spark, root) == expected(6)
    load([DAYS], DEARER)
    assert costs(spark, root) == expected(6)
    # Without history the reloaded day would take the present cost.
    star.load_days(spark, three_sales_a_day(spark, [2], DEARER), root, FIRST_DAY)
    assert costs(spark, root)[2] == expected(1)[2]
    load([2], DEARER)
    assert costs(spark, root) == expected(6)


def test_the_latest_day_may_be_read_again_and_attributes_may_return(spark):
    root = fresh_path(spark, "versions")
    load = lambda days, products: star.load_days(
        spark, three_sales_a_day(spark, days, products), root, FIRST_DAY, history=True
    )
    load([1, 2], PRODUCTS)
    load([3], DEARER)
    load([3], PRODUCTS)  # its close: the cost was taken back
    load([4], DEARER)
    load([5, 6, 7, 8, 9], PRODUCTS)
    load([3, 4, 5], DEARER)
    want = expected(10) | {4: expected(1)[4]}
    assert costs(spark, root) == want


def test_members_first_seen_in_an_old_day(spark):
    root = fresh_path(spark, "versions")
    only_oats = shop(spark, [(50, 1, 1, at(5, 9), "cash")], [(50, 2, 1, "4.00")])
    star.load_days(spark, only_oats, root, FIRST_DAY, history=True)
    star.load_days(spark, three_sales_a_day(spark, [2]), root, FIRST_DAY, history=True)
    star.load_days(spark, three_sales_a_day(spark, [1, 7], DEARER), root, FIRST_DAY, history=True)
    want = expected(7)
    got = costs(spark, root)
    assert got == {1: want[1], 2: want[2], 5: {(2, Decimal("2.25"))}, 7: want[7]}


def test_rejected_lines_with_history_have_the_same_reasons(spark):
    sales = [(1, 9, 1, at(1, 9), "cash"), (2, 1, None, at(1, 22), "voucher")]
    oltp = shop(spark, sales, [(1, 1, 1, "2.00"), (2, 8, 1, "2.00"), (77, 1, 1, "2.00")])
    found = []
    for history in (False, True):
        root = fresh_path(spark, "versions")
        star.load_days(spark, oltp, root, FIRST_DAY, history=history)
        found.append(sorted(map(tuple, star.read_star(spark, root)["rejected_lines"].select("id", "reasons").collect())))
    assert found[0] == found[1]


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_as_of_equals_a_search(spark, width):
    rng = np.random.default_rng(3)
    given = [(int(k), int(a), n, int(rng.integers(100))) for n, (k, a) in enumerate(rng.integers(0, [5, 60], (60, 2)))]
    rows = [(int(k), int(a), n) for n, (k, a) in enumerate(rng.integers(0, [6, 60], (200, 2)))] + [(0, None, 900), (5, None, 901)]
    rows += rows[:3]
    got = as_of(
        spark.createDataFrame(rows, "k BIGINT, day INT, n INT"),
        spark.createDataFrame(given, "k BIGINT, day INT, o INT, v INT"),
        "k", "day", "o", ["v"], width,
    )
    want = []
    for k, day, n in rows:
        before = [(d, o, v) for key, d, o, v in given if key == k and (day is None or d <= day)]
        want.append((k, day, n, max(before)[2] if before else None))
    order = lambda r: tuple((v is None, v) for v in r)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(want, key=order)


@pytest.mark.parametrize("width", [4, 1024])
def test_as_of_takes_the_first_version_before_all(spark, width):
    got = as_of(
        spark.createDataFrame([(1, -9), (1, 6), (1, 7), (1, 99), (1, None), (2, 3), (3, 3), (None, 3)], "k BIGINT, day INT"),
        spark.createDataFrame([(1, 7, 1, 10), (1, 30, 2, 12), (1, 30, 3, 11), (2, 50, 1, 20), (None, 1, 1, 9)], "k BIGINT, day INT, o INT, v INT"),
        "k", "day", "o", ["v"], width, from_first=True,
    )
    want = {(1, -9, 10), (1, 6, 10), (1, 7, 10), (1, 99, 11), (1, None, 11), (2, 3, 20), (3, 3, None), (None, 3, None)}
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_history_moves_no_line_for_the_days_of_members(spark, monkeypatch):
    """Lines are staged once, and neither with their headers nor as pairs of member and day."""
    root, labels, rows = fresh_path(spark, "narrow"), [], star.Scratch.stage
    monkeypatch.setattr(star.Scratch, "stage", lambda self, df, label: labels.append(label) or rows(self, df, label))
    dearer = [(n, name, c, u, p, cost if n > 1 else "3.00", x) for n, name, c, u, p, cost, x in PRODUCTS]
    star.load_days(spark, three_sales_a_day(spark, range(1, 6)), root, FIRST_DAY, 2, history=True)
    star.load_days(spark, three_sales_a_day(spark, range(6, 10), dearer), root, FIRST_DAY, 2, history=True)
    again = three_sales_a_day(spark, range(4, 7), dearer)
    again["transaction_items"] = stage(again["transaction_items"], "given")
    star.load_days(spark, again, root, FIRST_DAY, 2, history=True, stored_items=True)
    assert labels.count("items") == 2 and not {"lines", "pairs"} & set(labels)
    lines = star.read_star(spark, root)["sales_lines"]
    costs = {r[0]: r[1] for r in lines.where("product_id = 1").groupBy("simulated_day").agg(F.collect_set("unit_cost")).collect()}
    old = Decimal(next(p[5] for p in PRODUCTS if p[0] == 1))
    assert costs == {d: [old if d < 6 else Decimal("3.00")] for d in range(1, 10)}


# Derived tables ----------------------------------------------------------------------------------


def test_only_changed_partitions_are_built_again(spark):
    root = fresh_path(spark, "derived")
    star.load_days(spark, three_sales_a_day(spark), root, FIRST_DAY, 2)

    def build(lines):
        return lines.groupBy(BLOCK).agg(F.sum("quantity_sold").cast("bigint").alias("units"))

    def units():
        table, stale = derived.refresh(spark, root, "units", build)
        return {r[BLOCK]: r["units"] for r in table.collect()}, stale

    whole = {b: 18 if b < 4 else 9 for b in range(5)}
    got, stale = units()
    assert got == whole and sorted(stale) == [0, 1, 2, 3, 4]
    assert units() == (whole, [])
    star.load_days(spark, shop(spark, [(1, 1, 1, at(3, 9), "cash")], [(1, 1, 5, "4.00")]), root, FIRST_DAY)
    assert units() == (whole | {1: 14}, [1])
    star.remove_days(spark, root, [9])
    assert units() == ({b: n for b, n in (whole | {1: 14}).items() if b < 4}, [])
    star.load_days(spark, shop(spark, [], [(77, 1, 2, "4.00")]), root, FIRST_DAY)
    got, stale = units()
    assert stale == [None] and got[None] == 2
    star.remove_days(spark, root, list(range(1, DAYS)))
    assert units() == ({None: 2}, [])
