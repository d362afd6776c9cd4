from __future__ import annotations

from decimal import Decimal

from tallyhouse.operators import ranking
from tallyhouse.plans import analytics, reports

from tests.shop import days, star

D = Decimal


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_members_without_a_flag_form_a_second_walk_in_row(spark):
    tables = star(
        spark,
        [{"dim_customer_id": c, "revenue": r} for c, r in ((1, "1.00"), (2, "2.00"), (3, "4.00"))],
        dim_customer=[(1, 1, "A", False, None), (2, 2, "B", None, None), (3, 3, "C", True, None)],
    )
    assert rows(reports.loyalty_split(tables)) == [
        ("Walk-In", 1, D("2.00"), D("2.00")),
        ("Loyalty Member", 1, D("4.00"), D("4.00")),
        ("Walk-In", 1, D("1.00"), D("1.00")),
    ]
    # The exploratory variant leaves members without a flag out.
    assert sorted(r[0] for r in rows(analytics.loyalty_summary(tables))) == [
        "Loyalty Member", "Walk-in"
    ]


def test_sale_numbers_that_restart_need_the_day_in_the_key(spark):
    tables = star(spark, [{"source_transaction_id": 1, "simulated_day": d} for d in (1, 2)])
    by_number = reports.payment_breakdown(tables)
    by_day_and_number = reports.payment_breakdown(
        tables, sale_key=("simulated_day", "source_transaction_id")
    )
    assert rows(by_number)[0][1] == 1
    assert rows(by_day_and_number)[0][1] == 2


def test_margin_of_zero_revenue_is_null(spark):
    tables = star(spark, [{"revenue": "0.00", "unit_price": "0.00", "cost": "1.00"}])
    assert rows(reports.revenue_by_category(tables)) == [
        ("Fruit", 1, D("0.00"), D("-1.00"), None)
    ]


def test_rounding_is_half_away_from_zero(spark):
    # margin 2.25 % and -2.25 %
    for profit, expected in (("0.09", "2.3"), ("-0.09", "-2.3")):
        tables = star(spark, [{"revenue": "4.00", "cost": str(D("4.00") - D(profit))}])
        assert rows(reports.revenue_by_category(tables))[0][4] == D(expected)


def test_ties_at_the_limit_are_broken_by_name(spark):
    names = [chr(ord("a") + i) for i in range(12)]
    tables = star(
        spark,
        [{"dim_product_id": i, "revenue": "5.00"} for i in range(12)],
        dim_product=[(i, i, n, "X", None, D("1.00")) for i, n in enumerate(names)],
    )
    assert [r[0] for r in rows(reports.top_products(tables))] == names[:10]
    assert [r[0] for r in rows(reports.bottom_products(tables))] == names[:10]


def test_products_sharing_a_name_count_once_by_name(spark):
    tables = star(
        spark,
        [{"dim_product_id": 1, "revenue": "1234.50"}, {"dim_product_id": 2, "revenue": "1.00"}],
        dim_product=[(1, 1, "Pears", "Fruit", None, D("1.00")), (2, 2, "Pears", "Tins", None, D("1.00"))],
    )
    assert rows(analytics.top_products_by_name(tables)) == [
        ("Pears", "$1,235.50", "$1,235.50", 2, 2, D("100.0"))
    ]
    assert len(rows(reports.top_products(tables))) == 2


def test_mean_per_line_and_per_sale_differ(spark):
    tables = star(
        spark,
        [{"source_transaction_id": 7, "revenue": "1.00"}, {"source_transaction_id": 7, "revenue": "2.00"}],
    )
    assert rows(reports.loyalty_split(tables))[0][3] == D("3.00")
    assert rows(analytics.loyalty_summary(tables))[0][2] == D("1.5000")


def test_moving_average_counts_rows_and_is_null_until_full(spark):
    numbers = [d for d in range(1, 33) if d != 5]  # day 5 is missing: 31 days on record
    out = rows(
        analytics.moving_averages(days(spark, {d: f"{d}.00" for d in numbers}))
        .select("simulated_day", "revenue_30d_avg", "revenue_90d_avg")
    )
    assert [r[1] for r in out[:29]] == [None] * 29
    assert out[29][:2] == (31, (D(sum(numbers[:30])) / 30).quantize(D("0.0001")))
    assert out[30][1] == (D(sum(numbers[1:31])) / 30).quantize(D("0.0001"))
    assert {r[2] for r in out} == {None}


def test_percent_change_after_a_day_of_zero_is_null(spark):
    out = rows(analytics.day_over_day(days(spark, {1: "10.00", 2: "0.00", 3: "5.00"})))
    assert [r[4] for r in out] == [None, D("-100.00"), None]
    assert [r[3] for r in out] == [None, D("-10.00"), D("5.00")]


def test_best_and_worst_days_prefer_the_earlier_of_equals(spark):
    tables = days(spark, {d: r for d, r in enumerate(["3.00", "9.00", "9.00", "1.00", "1.00"], 1)})
    assert [r[0] for r in rows(analytics.best_days(tables, 2))] == [2, 3]
    assert [r[0] for r in rows(analytics.worst_days(tables, 1))] == [4]


def test_milestone_never_reached_is_null(spark):
    tables = days(spark, {1: "60.00", 2: "60.00"})
    assert rows(analytics.milestone_days(tables, (50, 100, 500))) == [(50, 1), (100, 2), (500, None)]


def test_dense_rank_repeats_for_equal_revenue(spark):
    revenue = {"a": "7.00", "b": "9.00", "c": "9.00", "d": "1.00"}
    tables = star(
        spark,
        [{"dim_product_id": i, "revenue": r} for i, r in enumerate(revenue.values())],
        dim_product=[(i, i, n, "X", None, D("1.00")) for i, n in enumerate(revenue)],
    )
    ranks = {r[1]: r[3] for r in rows(analytics.rank_in_category(tables))}
    assert ranks == {"b": 1, "c": 1, "a": 2, "d": 3}
    assert [r[1] for r in rows(analytics.top_per_category(tables))] == ["b", "c"]


def test_dense_rank_over_blocks_equals_the_window_function(spark):
    wide = spark.range(4000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('g', id % 7)) AS category",
        "cast(round(pow(1.01, id % 1500) * if(id % 11 = 0, -1, 1) * (id % 5), 2) "
        "AS decimal(20,2)) AS revenue",
        "id",
    )
    got = ranking.dense_rank_desc(wide, "category", "revenue", "r")
    want = wide.selectExpr(
        "*", "cast(dense_rank() OVER (PARTITION BY category ORDER BY revenue DESC) AS bigint) AS r"
    )
    columns = ["id", "category", "revenue", "r"]
    assert got.select(columns).exceptAll(want.select(columns)).count() == 0
    assert got.count() == 4000


def test_equal_days_give_a_flat_distribution(spark):
    tables = days(spark, {d: "8.00" for d in range(1, 5)})
    filled = [r for r in rows(analytics.revenue_histogram(tables)) if r[3]]
    assert filled == [(26, 8.0, 8.02, 4)]
    assert rows(analytics.revenue_box(tables)) == [(8.0, 8.0, 8.0, 8.0, 8.0, 0)]
    assert {r[2] for r in rows(analytics.daily_correlation(tables))} == {None}


def test_histogram_keeps_empty_bins_and_closes_the_last(spark):
    out = rows(analytics.revenue_histogram(days(spark, {1: "0.00", 2: "50.00", 3: "10.00"})))
    assert len(out) == 50
    assert [r[0] for r in out if r[3]] == [1, 11, 50]
    assert (out[10][1], out[10][2]) == (10.0, 11.0)


def test_outliers_and_box_whiskers(spark):
    values = ["10.00", "11.00", "12.00", "13.00", "100.00"]
    tables = days(spark, dict(enumerate(values, 1)))
    assert rows(analytics.outlier_bounds(tables)) == [(11.0, 13.0, 8.0, 16.0, 1)]
    assert rows(analytics.outlier_days(tables)) == [(5, D("100.00"))]
    assert rows(analytics.revenue_box(tables)) == [(11.0, 12.0, 13.0, 10.0, 13.0, 1)]


def test_whisker_never_ends_inside_the_box(spark):
    tables = days(spark, {1: "-100.00", 2: "1.00", 3: "1.00", 4: "1.00"})
    box = rows(analytics.revenue_box(tables))[0]
    assert box[3] == box[0] == -24.25


def test_overall_numbers_as_text(spark):
    tables = star(spark, [{"simulated_day": d, "revenue": "1500.00", "cost": "1000.00"} for d in (1, 2)])
    assert dict(rows(analytics.overall_text(tables))) == {
        "Total Revenue": "$3,000.00",
        "Total Cost": "$2,000.00",
        "Total Profit": "$1,000.00",
        "Profit Margin": "33.3%",
        "Total Line Items": "2",
        "Unique Transactions": "2",
        "Simulated Days": "2",
        "Avg Revenue/Day": "$1,500.00",
        "Avg Profit/Day": "$500.00",
    }
