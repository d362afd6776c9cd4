from __future__ import annotations

import random

import pytest

from tallyhouse import schemas as S
from tallyhouse.plans import inventory
from tallyhouse.streaming import runs
from tallyhouse.storage import fresh_path, path_exists

from tests.shop import at, shop

SCHEMA = "product_id BIGINT, transaction_id BIGINT, quantity INT"


def one_by_one(sales, stock=150, threshold=20, order=100):
    """The shop's own procedure: a sale lowers the stock; if it is low, one order arrives."""
    on_hand, sold, placed = {}, {}, {}
    out = []
    for product, sale, quantity in sorted(sales, key=lambda s: (s[0], s[1])):
        left = on_hand.get(product, stock) - quantity
        sold[product] = sold.get(product, 0) + quantity
        low = left <= threshold
        if low:
            left += order
            placed[product] = placed.get(product, 0) + 1
        on_hand[product] = left
        out.append((product, sale, quantity, sold[product], placed.get(product, 0), low, left))
    return out


def collected(df):
    order = df.orderBy("product_id", "transaction_id")
    return [tuple(r) for r in order.collect()]


def random_sales(seed, largest, products=4, sales=400):
    pick = random.Random(seed)
    return [
        (p, s, pick.randint(0, largest))
        for p in range(products)
        for s in pick.sample(range(3 * sales), sales)
    ]


def test_ledger_equals_the_sequential_procedure(spark):
    for seed, largest in ((1, 40), (2, 100), (3, 170), (4, 700)):
        sales = random_sales(seed, largest)
        df = spark.createDataFrame(sales, SCHEMA)
        expected = one_by_one(sales)
        # Blocks of about 100 lines make every product cross many block borders.
        assert collected(inventory.ledger(df, block_rows=100)) == expected
        assert collected(inventory.ledger(df)) == expected


def test_tasks_of_the_ledger_number_as_many_as_the_lines_call_for(spark, monkeypatch):
    monkeypatch.setattr(inventory, "TASK_ROWS", 100)
    sales = random_sales(6, 170)
    found = inventory.ledger(spark.createDataFrame(sales, SCHEMA))
    assert ", 16\n" in found._jdf.queryExecution().analyzed().toString().split("RepartitionByExpression")[1]
    assert collected(found) == one_by_one(sales)


def test_one_oversized_sale_among_small_ones(spark):
    sales = random_sales(5, 30, products=2) + [(9, s, 450 if s == 7 else 10) for s in range(60)]
    df = spark.createDataFrame(sales, SCHEMA)
    assert collected(inventory.ledger(df, block_rows=9)) == one_by_one(sales)


def test_levels_by_product_and_sparse_sale_numbers(spark):
    pick = random.Random(8)
    levels = [(0, 40, 30), (1, 10, 60), (2, 500, 0), (3, 90, 45)]  # product 4 has none stored
    sales = [(p, pick.randint(0, 2**62), pick.randint(0, 70)) for p in range(5) for _ in range(150)]
    expected = []
    for product in range(5):
        stock, low = next(((s, t) for p, s, t in levels if p == product), (150, 20))
        expected += one_by_one([s for s in sales if s[0] == product], stock, low, 100)
    df = spark.createDataFrame(sales, SCHEMA)
    stored = spark.createDataFrame(levels, "product_id BIGINT, quantity_on_hand INT, reorder_threshold INT")
    assert collected(inventory.ledger(df, levels=stored, block_rows=50)) == expected
    one = spark.createDataFrame([(0, 1, 15)], SCHEMA)
    assert collected(inventory.ledger(one, levels=stored)) == [(0, 1, 15, 15, 1, True, 125)]


def test_a_hot_product_is_cut_by_rows_not_by_numbers(spark):
    sales = spark.range(4000).selectExpr("1L AS product_id", "id * 1000000007 AS transaction_id", "1 AS quantity")
    blocks = inventory.blocked_lines(sales, ["product_id"], 500).groupBy("_block").count().collect()
    assert len(blocks) == 8 and max(r["count"] for r in blocks) < 1000


@pytest.mark.parametrize("line", [(None, 1, 5), (1, None, 5), (1, 1, None), (1, 1, -5)])
def test_lines_without_keys_and_returns_are_refused(spark, line):
    df = spark.createDataFrame([(1, 2, 5), line], SCHEMA)
    with pytest.raises(Exception, match="a sale"):
        inventory.ledger(df).collect()


def test_stock_exactly_at_the_threshold_reorders(spark):
    df = spark.createDataFrame([(1, 1, 129), (1, 2, 1), (1, 3, 99), (1, 4, 1)], SCHEMA)
    out = collected(inventory.ledger(df))
    assert [(r[5], r[6]) for r in out] == [(False, 21), (True, 120), (False, 21), (True, 120)]


def test_lines_of_one_sale_are_one_movement(spark):
    df = spark.createDataFrame([(1, 1, 60), (1, 1, 70), (1, 2, 1)], SCHEMA)
    assert [r[2] for r in collected(inventory.ledger(df))] == [130, 1]


def test_daily_reset_starts_every_day_afresh(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, 120), (1, 1, 2, 20), (1, 2, 3, 20)],
        "product_id BIGINT, simulated_day INT, transaction_id BIGINT, quantity INT",
    )
    out = inventory.ledger(df, reset_daily=True).orderBy("transaction_id").collect()
    assert [(r["reordered"], r["stock_on_hand"]) for r in out] == [
        (False, 30), (True, 110), (False, 130)
    ]


def test_purchase_orders_and_closing_stock(spark):
    oltp = shop(
        spark,
        [(1, 1, 1, at(1, 9), "cash"), (2, 1, 1, at(1, 10), "cash")],
        [(1, 1, 140, "2.00"), (2, 1, 5, "2.00"), (2, 2, 5, "3.50")],
    )
    stock = inventory.ledger(oltp["transaction_items"])
    orders = inventory.purchase_orders(stock, oltp).collect()
    assert [(o["supplier_id"], o["product_id"], o["quantity_ordered"], str(o["cost_per_unit"]),
             o["order_date"], o["received_date"]) for o in orders] == [
        (1, 1, 100, "1.00", at(1, 9), None)
    ]
    closing = inventory.closing_stock(stock, oltp).orderBy("product_id").collect()
    assert [tuple(r) for r in closing] == [(1, 105, 1, at(1, 9)), (2, 145, 0, None), (3, 150, 0, None)]


def test_streamed_ledger_continues_over_micro_batches(spark):
    sales = random_sales(6, 160, products=3, sales=200)
    folder = fresh_path(spark, "arrivals")
    for low in range(0, 600, 100):  # arrival in order of sale number, one file set per hundred
        part = [s for s in sales if low <= s[1] < low + 100]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{folder}/{low:03d}")
    like = spark.createDataFrame([], SCHEMA)
    stream = runs.stream_table(spark, f"{folder}/*", like, files_per_batch=1)
    ledger = runs.stock_ledger(stream, block_rows=40)
    assert ledger.select("batch").distinct().count() == 6
    assert collected(ledger.drop("batch")) == one_by_one(sales)


def arrivals(spark, *parts):
    """A stream over the parts, one micro-batch each, in their order."""
    folder = fresh_path(spark, "arrivals")
    for number, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{folder}/{number:03d}")
    like = spark.createDataFrame([], SCHEMA)
    return runs.stream_table(spark, f"{folder}/*", like, files_per_batch=1)


def test_a_sale_that_spans_micro_batches_is_one_sale(spark):
    parts = [[(1, 1, 10), (1, 5, 135), (2, 5, 1)], [(1, 5, 20), (2, 6, 3)], [(1, 5, 90)], [(1, 7, 1)]]
    stock = runs.stock_ledger(arrivals(spark, *parts))
    whole = inventory.ledger(spark.createDataFrame(sum(parts, []), SCHEMA))
    assert collected(stock.drop("batch")) == collected(whole)
    assert (1, 5, 245, 255, 1, True, -5) in collected(whole)


def test_an_earlier_sale_in_a_later_batch_is_refused(spark):
    with pytest.raises(Exception, match="out of order"):
        runs.stock_ledger(arrivals(spark, [(1, 5, 10)], [(1, 4, 10)])).collect()


def test_only_the_last_states_are_kept(spark):
    root = fresh_path(spark, "states")
    runs.stock_ledger(arrivals(spark, *[[(1, n, 5)] for n in range(5)]), path=root)
    kept = [path_exists(spark, f"{root}/state/batch={n}") for n in range(5)]
    assert kept == [False, False, False, True, True]


def test_streams_over_nothing_give_empty_tables(spark):
    nothing = arrivals(spark, [])
    assert runs.stock_ledger(nothing).count() == 0
    assert runs.append_to_table(nothing, "none").count() == 0
    assert runs.totals_to_table(nothing.groupBy("product_id").count(), "none").count() == 0


def test_streamed_ledger_resumes_after_a_stop(spark):
    sales = random_sales(7, 160, products=2, sales=60)
    folder, root = fresh_path(spark, "arrivals"), fresh_path(spark, "resumed")
    for low in (0, 90):
        part = [s for s in sales if low <= s[1] < low + 90]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{folder}/{low:03d}")
        stream = runs.stream_table(spark, f"{folder}/*", spark.createDataFrame([], SCHEMA))
        ledger = runs.stock_ledger(stream, path=root)
    assert collected(ledger.drop("batch")) == one_by_one(sales)


def test_roster_covers_every_hour_with_fallback(spark):
    staff = spark.createDataFrame(
        [(5, "A", "Cashier", 10, 12), (4, "B", "Cashier", 11, 23), (1, "C", "Supervisor", 8, 22),
         (9, "D", "Cashier", 12, 12)],
        S.OPERATIONAL["employees"],
    )
    out = [tuple(r) for r in inventory.roster(staff).orderBy("hour_of_day", "employee_id").collect()]
    assert out[:2] == [(8, 4, True), (9, 4, True)]
    assert out[2:5] == [(10, 5, False), (11, 4, False), (11, 5, False)]
    assert {r[0] for r in out} == set(range(8, 22))
