"""Line-grain windows and quantiles, sums and sketches kept per day."""

from __future__ import annotations

import statistics
from pathlib import Path

import numpy as np
import pytest
from tallyhouse.operators.prefix import running
from tallyhouse.operators.quantiles import exact_quantiles, values_at
from tallyhouse.plans import lines, reports, rollups, star
from tallyhouse.storage import fresh_path

from tests.shop import FIRST_DAY, at, shop
from tests.shop import star as small_star
from tests.test_history import block_of, three_sales_a_day


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n, per_range, frame", [(500, 40, 30), (500, 3, 30), (25, 2, 30), (70, 1000, 5), (0, 10, 5), (90, 1, 2)])
def test_running_equals_a_loop(spark, n, per_range, frame):
    rng = np.random.default_rng(n)
    values = [None if v == 0 and n == 500 else int(v) for v in rng.integers(-20 if n != 500 else 0, 60, n)]
    rows = [(int(k), v) for k, v in zip(rng.permutation(n), values)]
    df = spark.createDataFrame(rows, "k BIGINT, v BIGINT")
    got = running(df, ["k"], {"v": "total"}, {"v": "moved"}, frame, per_range)
    want, total, last = [], 0, []
    for k, v in sorted(rows):
        total += v or 0
        last = [*last, v][-frame:]
        want.append((k, v, total, sum(last) if len(last) == frame and None not in last else None))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == want
    assert "SinglePartition" not in plan_of(got)


def test_running_revenue_has_no_single_task(spark):
    tables = small_star(spark, [{"simulated_day": 1 + n // 7, "revenue": f"{n}.25"} for n in range(100)])
    found = lines.running_revenue(tables, frame=3, rows_per_range=10)
    assert "SinglePartition" not in plan_of(found)
    got = [float(r["mean_revenue"]) if r["mean_revenue"] is not None else None for r in found.orderBy("simulated_day", "source_transaction_id").collect()]
    assert got[:4] == [None, None, 1.25, 2.25] and got[-1] == 98.25


@pytest.mark.parametrize("parts", [50, 1024])
def test_quantiles_equal_sorting(spark, parts):
    rng = np.random.default_rng(parts)
    for values in ([5], [1, 9], [3, 3, 3, 3], [-(10**12), 0, 7, 10**15], rng.integers(-1000, 100_000, 301).tolist()):
        df = spark.createDataFrame([(int(v),) for v in values] + [(None,)], "v BIGINT")
        got = exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.75, 1.0], parts)
        want = np.quantile(np.array(values, dtype=float), [0, 0.25, 0.5, 0.75, 1])
        assert [float(x) for x in got] == pytest.approx(want.tolist())
        assert got[2] == statistics.median(sorted(int(v) for v in values))
        every = values_at(df.where("v IS NOT NULL"), "v", list(range(len(values)))[:20], min(values), max(values), parts)
        assert [every[k] for k in sorted(every)] == sorted(values)[:20]
    assert exact_quantiles(df.limit(0), "v", [0.5]) == [None]


def test_box_without_lines(spark):
    row = lines.line_revenue_box(small_star(spark, [{}]) | {"fact_sales": small_star(spark, [{}])["fact_sales"].limit(0)}).first()
    assert tuple(row) == (0, None, None, None, None, None, 0)


# Sums and sketches by day ------------------------------------------------------------------------

BY_SALE = (
    reports.daily_revenue, reports.revenue_by_hour, reports.loyalty_split, reports.payment_breakdown,
    reports.cashier_performance, reports.rush_hour_split,
)
BY_PRODUCT = (reports.top_products, reports.bottom_products, reports.revenue_by_category, reports.category_by_day)


def same(spark, root):
    tables = star.read_star(spark, root)
    for asked, kept in ((BY_SALE, rollups.by_sale(spark, root)), (BY_PRODUCT, rollups.by_product(spark, root))):
        for ask in asked:
            assert [tuple(r) for r in ask(kept).collect()] == [tuple(r) for r in ask(tables).collect()], ask.__name__


def partition_files(path):
    return {str(p) for p in Path(path).rglob("*.parquet")}


def test_reports_from_rollups_follow_reloaded_days(spark):
    root = fresh_path(spark, "rollups")
    star.load_days(spark, three_sales_a_day(spark), root, FIRST_DAY, 2)
    same(spark, root)
    before = partition_files(f"{root}/{rollups.SALES}")
    star.load_days(spark, shop(spark, [(1, 1, 1, at(3, 9), "mobile")], [(1, 1, 5, "4.00")]), root, FIRST_DAY)
    same(spark, root)
    after = partition_files(f"{root}/{rollups.SALES}")
    assert {block_of(f) for f in before ^ after} == {1}
    # Reports read the sums, not the lines.
    read = reports.daily_revenue(rollups.by_sale(spark, root)).inputFiles()
    assert read and all(f"/{rollups.SALES}/" in f for f in read)


def test_sketches_merge_over_days(spark):
    root = fresh_path(spark, "sketches")
    sales = [(n, 1, 1, at(1 + n % 9, 9), "cash") for n in range(3000)]
    star.load_days(spark, shop(spark, sales, [(n, 1, 1, "1.00") for n in range(3000)]), root, FIRST_DAY, 4)
    ranges = spark.createDataFrame([(1, 9), (2, 4), (5, 5), (20, 30)], "first_day INT, last_day INT")
    got = {(r[0], r[1]): r[2] for r in rollups.approximate_sales(spark, root, ranges).collect()}
    want = {(r[0], r[1]): r[2] for r in rollups.exact_sales(star.read_star(spark, root), ranges).collect()}
    assert got.keys() == want.keys() == {(1, 9), (2, 4), (5, 5)}
    assert all(abs(got[k] - n) <= 0.03 * n for k, n in want.items())
    found = rollups.approximate_sales(spark, root, ranges)
    assert all(f"/{rollups.SKETCHES}/" in f for f in found.inputFiles() if root in f)
    # A sale number that comes back on another day counts once over both.
    again = shop(spark, [(0, 1, 1, at(2, 9), "cash")], [(0, 1, 1, "1.00")])
    star.load_days(spark, again, root, FIRST_DAY)
    whole = {(r[0], r[1]): r[2] for r in rollups.approximate_sales(spark, root, ranges.limit(1)).collect()}
    assert abs(whole[1, 9] - (3000 - 334 + 1)) <= 0.03 * 2667
