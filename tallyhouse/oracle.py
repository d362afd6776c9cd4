"""The registered queries as SQL over the given tables, for an independent engine.

Money is whole cents and every rounding is integer arithmetic (half away from zero), so the oracle
shares neither decimal division nor floating point with the Spark plans.
"""

from __future__ import annotations

from tallyhouse.schemas import MILESTONES, STAR
from tallyhouse.plans.analytics import DAILY_MEASURES, STAR_TABLES
from tallyhouse.plans.quality import MANDATORY, NON_NEGATIVE


def half_up(numerator: str, denominator: str) -> str:
    n, d = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    return f"(CASE WHEN {n} < 0 THEN -1 ELSE 1 END * ((2 * abs({n}) + {d}) // (2 * {d})))"


def scaled(units: str, scale: int, precision: int = 20) -> str:
    step = "0." + "0" * (scale - 1) + "1"
    return (
        f"CAST(CAST({units} AS DECIMAL(30,0)) * CAST({step} AS DECIMAL({scale + 1},{scale})) "
        f"AS DECIMAL({precision},{scale}))"
    )


def money(cents: str) -> str:
    return scaled(cents, 2)


def per_unit(cents: str, count: str, scale: int = 2) -> str:
    return scaled(half_up(f"{cents} * {10 ** (scale - 2)}", f"nullif({count}, 0)"), scale)


def percent(part: str, whole: str, scale: int = 1) -> str:
    return scaled(half_up(f"({part}) * {100 * 10 ** scale}", f"nullif({whole}, 0)"), scale)


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


SOURCE = """
n_sup AS (SELECT max(s_suppkey) + 1 AS n FROM supplier),
tx AS (
  SELECT o_orderkey AS txn, o_custkey AS customer_id,
    CASE WHEN o_orderkey % 20 <> 0 THEN o_orderkey % (SELECT n FROM n_sup) END AS employee_id,
    CAST(date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) + 1 AS INTEGER) AS simulated_day,
    CAST(7 + o_orderkey % 16 AS INTEGER) AS hour_of_day,
    o_orderdate + to_hours(CAST(7 + o_orderkey % 16 AS INTEGER)) AS transaction_time,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'cash' WHEN '2-HIGH' THEN 'credit'
      WHEN '3-MEDIUM' THEN 'debit' WHEN '5-LOW' THEN 'mobile' ELSE 'voucher' END AS payment_method
  FROM orders),
prod AS (
  SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_brand AS subcategory,
    CAST(p_retailprice AS DECIMAL(8,2)) AS unit_price,
    CAST(round(CAST(p_retailprice AS DECIMAL(8,2)) * CAST(0.1 * (4 + p_size % 5) AS DECIMAL(2,1)), 2)
      AS DECIMAL(8,2)) AS unit_cost,
    p_partkey % (SELECT n FROM n_sup) AS supplier_id
  FROM part),
cust AS (
  SELECT c_custkey AS customer_id, c_name AS name,
    c_mktsegment IN ('BUILDING', 'HOUSEHOLD') AS is_loyalty FROM customer),
emp AS (
  SELECT s_suppkey AS employee_id, s_name AS name,
    CASE WHEN s_suppkey % 4 = 3 THEN 'Supervisor' ELSE 'Cashier' END AS role,
    CAST(8 + 2 * (s_suppkey % 4) AS INTEGER) AS shift_start FROM supplier),
item AS (
  SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey AS txn, l_partkey AS product_id,
    CAST(l_quantity AS INTEGER) AS quantity,
    CAST(round(unit_price * (CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(3,2))), 2)
      AS DECIMAL(8,2)) AS unit_price
  FROM lineitem LEFT JOIN prod ON l_partkey = product_id)"""

LINES = SOURCE + """,
line AS (
  SELECT item.id, item.txn, item.product_id, item.quantity, item.unit_price,
    tx.customer_id, tx.employee_id, tx.simulated_day, tx.hour_of_day, tx.payment_method,
    prod.unit_cost, CAST(item.unit_price * 100 AS BIGINT) * item.quantity AS rev,
    CAST(prod.unit_cost * 100 AS BIGINT) * item.quantity AS cst,
    tx.hour_of_day BETWEEN 8 AND 21 AS time_ok, prod.product_id IS NOT NULL AS product_ok,
    cust.customer_id IS NOT NULL AS customer_ok, tx.payment_method <> 'voucher' AS payment_ok
  FROM item LEFT JOIN tx ON item.txn = tx.txn LEFT JOIN prod ON item.product_id = prod.product_id
    LEFT JOIN cust ON tx.customer_id = cust.customer_id)"""

FACT = LINES + """,
fact AS (
  SELECT *, rev - cst AS prf FROM line WHERE time_ok AND product_ok AND customer_ok AND payment_ok),
hr AS (
  SELECT CAST(range AS INTEGER) AS hour_of_day, printf('%02d:00', range) AS time_label,
    CASE WHEN range < 12 THEN 'Morning' WHEN range < 17 THEN 'Afternoon' ELSE 'Evening' END
      AS part_of_day, range IN (8, 9, 12, 17, 18) AS is_rush_hour
  FROM range(8, 22)),
sold AS (
  SELECT fact.*, prod.name, prod.category FROM fact JOIN prod ON fact.product_id = prod.product_id)"""

DIMS = FACT + """,
d_time AS (
  SELECT (CAST(simulated_day AS BIGINT) - 1) * 14 + hour_of_day - 7 AS id, simulated_day, hr.*
  FROM (SELECT DISTINCT simulated_day FROM line WHERE simulated_day IS NOT NULL), hr),
d_product AS (SELECT * FROM prod WHERE product_id IN (SELECT product_id FROM line)),
d_customer AS (SELECT * FROM cust WHERE customer_id IN (SELECT customer_id FROM line)),
d_employee AS (SELECT * FROM emp WHERE employee_id IN (SELECT employee_id FROM line))"""

DAILY = FACT + """,
daily AS (
  SELECT simulated_day, sum(rev) AS rev, sum(prf) AS prf, sum(cst) AS cst, count(*) AS items,
    count(DISTINCT txn) AS txns FROM fact GROUP BY simulated_day)"""

QUARTILES = DAILY + """,
qs AS (
  SELECT quantile_cont(rev / 100.0, 0.25) AS q1, quantile_cont(rev / 100.0, 0.5) AS q2,
    quantile_cont(rev / 100.0, 0.75) AS q3 FROM daily),
fence AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM qs)"""

FEED = """
ev AS (
  SELECT event_id AS seq, ts, user_id,
    CASE event_type WHEN 'purchase' THEN 'transaction' WHEN 'error' THEN 'reorder'
      ELSE 'system' END AS type, event_type,
    CAST(date_diff('day', TIMESTAMP '2024-01-01', ts) + 1 AS INTEGER) AS day,
    CAST(extract(hour FROM ts) AS INTEGER) AS hour, strftime(ts, '%H:%M') AS sim_time,
    CAST(value AS DECIMAL(12,2)) AS total, 'user ' || user_id AS customer,
    CASE user_id % 4 WHEN 0 THEN 'cash' WHEN 1 THEN 'credit' WHEN 2 THEN 'debit' ELSE 'mobile' END
      AS payment,
    'article ' || json_extract_string(props, '$.k') AS product,
    (1 + event_id % 4) || 'x article ' || json_extract_string(props, '$.k') AS items_text
  FROM events)"""

FEED_LINES = FEED + """,
feed AS (
  SELECT seq, ts, type, CASE type
    WHEN 'transaction' THEN sim_time || ' SALE ' || customer || ' — ' || items_text || ' — $'
      || CAST(total AS VARCHAR) || ' [' || payment || ']'
    WHEN 'reorder' THEN sim_time || ' REORDER ' || product
      || ' stock low — purchase order placed (+100 units)'
    ELSE sim_time || ' ' || event_type END AS line
  FROM ev)"""

SALES = SOURCE + """,
sale AS (
  SELECT product_id, txn, sum(quantity) AS quantity,
    sum(sum(quantity)) OVER w AS sold, row_number() OVER w AS n
  FROM item GROUP BY product_id, txn WINDOW w AS (PARTITION BY product_id ORDER BY txn))"""

DAY_SALES = SOURCE + """,
sale AS (
  SELECT product_id, simulated_day, item.txn AS txn, sum(quantity) AS quantity,
    sum(sum(quantity)) OVER w AS sold, row_number() OVER w AS n
  FROM item JOIN tx ON item.txn = tx.txn GROUP BY product_id, simulated_day, item.txn
  WINDOW w AS (PARTITION BY product_id, simulated_day ORDER BY item.txn))"""

LEDGER = SALES + """,
led AS (
  SELECT *, CASE WHEN sold < 130 THEN 0 ELSE (sold - 130) // 100 + 1 END AS reorders,
    CASE WHEN sold - quantity < 130 THEN 0 ELSE (sold - quantity - 130) // 100 + 1 END AS earlier
  FROM sale)"""

DAY_LEDGER = SOURCE + """,
dsale AS (
  SELECT product_id, simulated_day, item.txn, sum(quantity) AS quantity,
    sum(sum(quantity)) OVER (PARTITION BY product_id, simulated_day ORDER BY item.txn) AS sold
  FROM item JOIN tx ON item.txn = tx.txn GROUP BY product_id, simulated_day, item.txn),
led AS (
  SELECT *, CASE WHEN sold < 130 THEN 0 ELSE (sold - 130) // 100 + 1 END AS reorders,
    CASE WHEN sold - quantity < 130 THEN 0 ELSE (sold - quantity - 130) // 100 + 1 END AS earlier
  FROM dsale)"""

LEDGER_COLUMNS = f"""txn AS transaction_id, {big('quantity')} AS quantity,
  {big('sold')} AS units_sold, {big('reorders')} AS reorders, reorders > earlier AS reordered,
  {big('150 - sold + 100 * reorders')} AS stock_on_hand"""


def q(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


AVG_REV = per_unit("sum(rev)", "count(*)")
AVG_REV4 = per_unit("sum(rev)", "count(*)", 4)
TXNS = "count(DISTINCT txn)"
REV, CST, PRF = money("sum(rev)"), money("sum(cst)"), money("sum(prf)")
UNITS = big("sum(quantity)")
MARGIN = percent("sum(prf)", "sum(rev)")
SHARE_TXN = percent(TXNS, f"sum({TXNS}) OVER ()")
SHARE_REV = percent("sum(rev)", "sum(sum(rev)) OVER ()")


def dollars(cents: str) -> str:
    return f"format('${{:,.2f}}', CAST({cents} AS DOUBLE) / 100)"


SQL: dict[str, str] = {}

# Reports -----------------------------------------------------------------------------------------

SQL["r01_daily_revenue"] = q(FACT, f"""
SELECT simulated_day, {TXNS} AS total_transactions, {UNITS} AS total_items_sold,
  {REV} AS total_revenue, {CST} AS total_cost, {PRF} AS total_profit,
  {AVG_REV} AS avg_revenue_per_item
FROM fact GROUP BY simulated_day ORDER BY simulated_day""")

SQL["r02_revenue_by_hour"] = q(FACT, f"""
SELECT hr.hour_of_day, time_label, part_of_day, is_rush_hour, {TXNS} AS total_transactions,
  {REV} AS total_revenue, {AVG_REV} AS avg_revenue_per_item
FROM fact JOIN hr ON fact.hour_of_day = hr.hour_of_day GROUP BY ALL ORDER BY 1""")

SQL["r03_top_products"] = q(FACT, f"""
SELECT name AS product, category, {UNITS} AS total_units_sold, {REV} AS total_revenue,
  {PRF} AS total_profit, {MARGIN} AS profit_margin_pct
FROM sold GROUP BY name, category ORDER BY sum(rev) DESC, name, category LIMIT 10""")

SQL["r04_revenue_by_category"] = q(FACT, f"""
SELECT category, {UNITS} AS total_units_sold, {REV} AS total_revenue,
  {PRF} AS total_profit, {MARGIN} AS profit_margin_pct
FROM sold GROUP BY category ORDER BY sum(rev) DESC, category""")

SQL["r05_loyalty_split"] = q(FACT, f"""
SELECT CASE WHEN is_loyalty THEN 'Loyalty Member' ELSE 'Walk-In' END AS customer_type,
  {TXNS} AS total_transactions, {REV} AS total_revenue,
  {per_unit('sum(rev)', TXNS)} AS avg_spend_per_transaction
FROM fact JOIN cust ON fact.customer_id = cust.customer_id
GROUP BY is_loyalty ORDER BY is_loyalty DESC""")

SQL["r06_payment_breakdown"] = q(FACT, f"""
SELECT payment_method, {TXNS} AS total_transactions, {REV} AS total_revenue,
  {SHARE_TXN} AS pct_of_transactions
FROM fact GROUP BY payment_method ORDER BY 2 DESC, 1""")

SQL["r07_cashier_performance"] = q(FACT, f"""
SELECT name AS employee, role, {TXNS} AS total_transactions, {REV} AS total_revenue_processed,
  {per_unit('sum(rev)', TXNS)} AS avg_transaction_value
FROM fact JOIN emp ON fact.employee_id = emp.employee_id
GROUP BY name, role ORDER BY sum(rev) DESC, 1, 2""")

SQL["r08_rush_hour_split"] = q(FACT, f"""
SELECT CASE WHEN is_rush_hour THEN 'Rush Hour' ELSE 'Off-Peak' END AS period,
  {TXNS} AS total_transactions, {REV} AS total_revenue, {AVG_REV} AS avg_revenue_per_item,
  {SHARE_TXN} AS pct_of_transactions
FROM fact JOIN hr ON fact.hour_of_day = hr.hour_of_day
GROUP BY is_rush_hour ORDER BY is_rush_hour DESC""")

SQL["r09_category_by_day"] = q(FACT, f"""
SELECT simulated_day, category, {REV} AS revenue
FROM sold GROUP BY simulated_day, category ORDER BY 1, sum(rev) DESC, 2""")

SQL["r10_bottom_products"] = q(FACT, f"""
SELECT name AS product, category, {UNITS} AS total_units_sold, {REV} AS total_revenue
FROM sold GROUP BY name, category ORDER BY sum(quantity), name, category LIMIT 10""")

COUNTS = """
SELECT 'fact_sales' AS table_name, count(*) AS row_count FROM fact
UNION ALL SELECT 'dim_time', count(*) FROM d_time
UNION ALL SELECT 'dim_product', count(*) FROM d_product
UNION ALL SELECT 'dim_customer', count(*) FROM d_customer
UNION ALL SELECT 'dim_employee', count(*) FROM d_employee
UNION ALL SELECT 'dim_payment_method', 4"""
SQL["r11_row_counts"] = q(DIMS, COUNTS)

# Analytics ---------------------------------------------------------------------------------------

_COLUMNS = ", ".join(
    f"('{name}', {i}, '{f.name}', '{f.dataType.simpleString()}')"
    for name in STAR_TABLES
    for i, f in enumerate(STAR[name], start=1)
)
SQL["n01_table_shapes"] = q(DIMS, f"""
SELECT c.table_name, n.row_count, c.position, c.column_name, c.data_type
FROM (VALUES {_COLUMNS}) AS c(table_name, position, column_name, data_type)
JOIN ({COUNTS}) n ON c.table_name = n.table_name""")

_TOTALS = f"""
SELECT {REV} AS total_revenue, {CST} AS total_cost, {PRF} AS total_profit,
  {MARGIN} AS profit_margin_pct, count(*) AS line_items,
  count(DISTINCT simulated_day) AS simulated_days,
  {per_unit('sum(rev)', 'count(DISTINCT simulated_day)')} AS avg_revenue_per_day,
  {per_unit('sum(prf)', 'count(DISTINCT simulated_day)')} AS avg_profit_per_day,
  {TXNS} AS unique_transactions
FROM fact"""
SQL["n02_overall_totals"] = q(FACT, _TOTALS)


def _cash(column: str) -> str:
    return f"format('${{:,.2f}}', CAST({column} AS DOUBLE))"


SQL["n02_overall_text"] = q(FACT, f"""
SELECT unnest(['Total Revenue', 'Total Cost', 'Total Profit', 'Profit Margin', 'Total Line Items',
    'Unique Transactions', 'Simulated Days', 'Avg Revenue/Day', 'Avg Profit/Day']) AS label,
  unnest([{_cash('total_revenue')}, {_cash('total_cost')}, {_cash('total_profit')},
    CAST(profit_margin_pct AS VARCHAR) || '%', format('{{:,}}', line_items),
    format('{{:,}}', unique_transactions), format('{{:,}}', simulated_days),
    {_cash('avg_revenue_per_day')}, {_cash('avg_profit_per_day')}]) AS value
FROM ({_TOTALS})""")

SQL["n03_top_products_by_name"] = q(FACT, f"""
SELECT name AS product_name, {dollars('sum(rev)')} AS total_revenue,
  {dollars('sum(prf)')} AS total_profit, {UNITS} AS units_sold, count(*) AS num_sales,
  {MARGIN} AS profit_margin
FROM sold GROUP BY name ORDER BY sum(rev) DESC, name LIMIT 10""")

SQL["n04_category_summary"] = q(FACT, f"""
SELECT category, {REV} AS total_revenue, {PRF} AS total_profit, {UNITS} AS units_sold,
  {MARGIN} AS profit_margin
FROM sold GROUP BY category ORDER BY sum(rev) DESC""")

_DAILY = f"""simulated_day, {money('rev')} AS daily_revenue, {money('prf')} AS daily_profit,
  {money('cst')} AS daily_cost, items AS num_items, txns AS num_transactions"""
SQL["n05_daily_rollup"] = q(DAILY, f"SELECT {_DAILY} FROM daily")


def _rolling(rows: int) -> str:
    frame = f"OVER (ORDER BY simulated_day ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    mean = per_unit(f"sum(rev) {frame}", str(rows), 4)
    return f"CASE WHEN count(*) {frame} = {rows} THEN {mean} END AS revenue_{rows}d_avg"


SQL["n06_moving_averages"] = q(DAILY, f"SELECT {_DAILY}, {_rolling(30)}, {_rolling(90)} FROM daily")
SQL["n06_first_days"] = q(DAILY, f"SELECT {_DAILY} FROM daily ORDER BY simulated_day LIMIT 5")
SQL["n06_daily_revenue_range"] = q(DAILY, f"""
SELECT {money('min(rev)')} AS lowest, {money('max(rev)')} AS highest,
  {per_unit('sum(rev)', 'count(*)')} AS mean,
  {dollars('min(rev)')} || ' to ' || {dollars('max(rev)')} AS range_text
FROM daily""")

SQL["n07_hourly_revenue"] = q(FACT, f"""
SELECT hour_of_day, {AVG_REV4} AS avg_revenue, {REV} AS total_revenue
FROM fact GROUP BY hour_of_day""")

SQL["n08_rush_comparison"] = q(FACT, f"""
SELECT CASE WHEN is_rush_hour THEN 'Rush Hour' ELSE 'Non-Rush Hour' END AS is_rush_hour,
  {REV} AS total_revenue, {AVG_REV4} AS avg_revenue, {UNITS} AS total_items
FROM fact JOIN hr ON fact.hour_of_day = hr.hour_of_day GROUP BY hr.is_rush_hour""")

SQL["n09_part_of_day"] = q(FACT, f"""
SELECT part_of_day, {REV} AS total_revenue, {PRF} AS total_profit, count(*) AS num_items
FROM fact JOIN hr ON fact.hour_of_day = hr.hour_of_day GROUP BY part_of_day""")

SQL["n10_loyalty_summary"] = q(FACT, f"""
SELECT CASE WHEN cust.is_loyalty THEN 'Loyalty Member' ELSE 'Walk-in' END AS is_loyalty,
  {REV} AS total_revenue, {AVG_REV4} AS avg_transaction, {PRF} AS total_profit,
  {TXNS} AS num_transactions, {SHARE_REV} AS pct_of_revenue
FROM fact JOIN cust ON fact.customer_id = cust.customer_id GROUP BY cust.is_loyalty""")

SQL["n11_top_customers"] = q(FACT, f"""
SELECT name, is_loyalty, {REV} AS total_spend, {TXNS} AS total_visits, {AVG_REV4} AS avg_per_visit
FROM fact JOIN cust ON fact.customer_id = cust.customer_id
GROUP BY name, is_loyalty ORDER BY sum(rev) DESC, name, is_loyalty LIMIT 10""")

SQL["n12_employee_performance"] = q(FACT, f"""
SELECT name AS employee_name, role, {REV} AS total_revenue, {PRF} AS total_profit,
  {TXNS} AS num_transactions, {UNITS} AS items_sold,
  {per_unit('sum(rev)', TXNS)} AS avg_per_transaction
FROM fact JOIN emp ON fact.employee_id = emp.employee_id GROUP BY name, role""")

SQL["n13_payment_summary"] = q(FACT, f"""
SELECT payment_method AS method, {REV} AS total_revenue, {AVG_REV4} AS avg_per_item,
  {TXNS} AS num_transactions, {SHARE_REV} AS pct_of_revenue
FROM fact GROUP BY payment_method""")

_CHANGES = f"""
SELECT simulated_day, {money('rev')} AS daily_revenue,
  {money('lag(rev) OVER w')} AS prev_day_revenue,
  {money('rev - lag(rev) OVER w')} AS day_over_day_change,
  {percent('rev - lag(rev) OVER w', 'lag(rev) OVER w', 2)} AS day_over_day_pct
FROM daily WINDOW w AS (ORDER BY simulated_day)"""
SQL["n14_day_over_day"] = q(DAILY, _CHANGES)
for _name, _order in (("best", "DESC"), ("worst", "ASC")):
    SQL[f"n14_{_name}_days"] = q(DAILY, f"""
SELECT simulated_day, daily_revenue, day_over_day_pct FROM ({_CHANGES})
ORDER BY daily_revenue {_order}, simulated_day LIMIT 5""")

SQL["n15_cumulative"] = q(DAILY, f"""
SELECT simulated_day, {money('rev')} AS daily_revenue,
  {money('sum(rev) OVER w')} AS cumulative_revenue, {money('sum(prf) OVER w')} AS cumulative_profit
FROM daily WINDOW w AS (ORDER BY simulated_day ROWS UNBOUNDED PRECEDING)""")

_MARKS = ", ".join(f"(CAST({m} AS BIGINT))" for m in MILESTONES)
SQL["n15_milestones"] = q(DAILY, f"""
SELECT m.milestone, (SELECT min(simulated_day) FROM (
    SELECT simulated_day, sum(rev) OVER (ORDER BY simulated_day ROWS UNBOUNDED PRECEDING) AS total
    FROM daily) c WHERE c.total >= m.milestone * 100) AS day_reached
FROM (VALUES {_MARKS}) AS m(milestone)""")

_RANKED = f"""
SELECT category, name AS product_name, {REV} AS revenue,
  dense_rank() OVER (PARTITION BY category ORDER BY sum(rev) DESC) AS rank_in_category
FROM sold GROUP BY category, name"""
SQL["n16_rank_in_category"] = q(FACT, _RANKED)
SQL["n16_top_per_category"] = q(FACT, f"SELECT * FROM ({_RANKED}) WHERE rank_in_category = 1")

SQL["n17_outlier_bounds"] = q(QUARTILES, """
SELECT round(q1, 4) AS q1, round(q3, 4) AS q3, round(lo, 4) AS lower_bound,
  round(hi, 4) AS upper_bound,
  (SELECT count(*) FROM daily, fence f WHERE rev / 100.0 < f.lo OR rev / 100.0 > f.hi) AS outlier_days
FROM fence""")
SQL["n17_outlier_days"] = q(QUARTILES, f"""
SELECT simulated_day, {money('rev')} AS daily_revenue FROM daily, fence
WHERE rev / 100.0 < lo OR rev / 100.0 > hi""")

_MEASURE = {
    "daily_revenue": "rev / 100.0",
    "daily_profit": "prf / 100.0",
    "daily_cost": "cst / 100.0",
    "num_items": "items",
    "num_transactions": "txns",
}
SQL["n18_daily_correlation"] = q(DAILY, "\nUNION ALL ".join(
    f"SELECT '{a}' AS measure_a, '{b}' AS measure_b, "
    f"round(corr({_MEASURE[a]}, {_MEASURE[b]}), 4) AS correlation FROM daily"
    for a in DAILY_MEASURES
    for b in DAILY_MEASURES
))

SQL["n19_revenue_histogram"] = q(DAILY + """,
edge AS (
  SELECT CASE WHEN min(rev) = max(rev) THEN min(rev) - 50 ELSE min(rev) END AS lo,
    CASE WHEN min(rev) = max(rev) THEN max(rev) + 50 ELSE max(rev) END AS hi FROM daily)""", """
SELECT CAST(range + 1 AS INTEGER) AS bin,
  CAST(CAST(lo * 50 + (hi - lo) * range AS DECIMAL(30,0)) * CAST(0.0002 AS DECIMAL(5,4)) AS DOUBLE)
    AS lower_edge,
  CAST(CAST(lo * 50 + (hi - lo) * (range + 1) AS DECIMAL(30,0)) * CAST(0.0002 AS DECIMAL(5,4))
    AS DOUBLE) AS upper_edge,
  (SELECT count(*) FROM daily WHERE least((rev - lo) * 50 // (hi - lo), 49) = range) AS days
FROM range(50), edge""")

SQL["n20_revenue_box"] = q(QUARTILES + """,
marked AS (SELECT rev / 100.0 AS v, rev / 100.0 BETWEEN lo AND hi AS inside, q1, q2, q3
  FROM daily, fence)""", """
SELECT round(any_value(q1), 4) AS q1, round(any_value(q2), 4) AS median,
  round(any_value(q3), 4) AS q3,
  round(least(min(v) FILTER (WHERE inside), any_value(q1)), 4) AS lower_whisker,
  round(greatest(max(v) FILTER (WHERE inside), any_value(q3)), 4) AS upper_whisker,
  count(*) FILTER (WHERE NOT inside) AS fliers
FROM marked""")

# Quality -----------------------------------------------------------------------------------------

_SIZE = {
    "dim_time": "d_time",
    "dim_product": "d_product",
    "dim_customer": "d_customer",
    "dim_employee": "d_employee",
    "fact_sales": "fact",
}
_NULLS = {
    ("dim_customer", "join_date"): "count(*)",
    ("fact_sales", "dim_employee_id"): "count(*) - count(employee_id)",
    ("fact_sales", "unit_price"): "count(*) - count(unit_price)",
    ("fact_sales", "unit_cost"): "count(*) - count(unit_cost)",
    ("dim_product", "subcategory"): "count(*) - count(subcategory)",
}


def _null_row(table: str, column: str) -> str:
    nulls = _NULLS.get((table, column), "0")
    source = _SIZE.get(table, "(VALUES (1), (2), (3), (4))")
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, {big(nulls)} AS null_rows, "
        f"{percent(nulls, 'count(*)', 2)} AS null_pct FROM {source}"
    )


_PROFILE = "\nUNION ALL ".join(
    _null_row(name, column) for name in STAR_TABLES for column in STAR[name].names
)
SQL["q01_null_profile"] = q(DIMS, _PROFILE)
SQL["q01_columns_with_nulls"] = q(DIMS, f"SELECT * FROM ({_PROFILE}) WHERE null_pct > 0")

# The dimensions as (name, key on the fact, rows of the key); ids of the star stand for these keys.
_KEYED = {
    "dim_product_id": ("dim_product", "product_id", "SELECT product_id AS k FROM d_product"),
    "dim_customer_id": ("dim_customer", "customer_id", "SELECT customer_id AS k FROM d_customer"),
    "dim_employee_id": ("dim_employee", "employee_id", "SELECT employee_id AS k FROM d_employee"),
    "dim_payment_method_id": ("dim_payment_method", "payment_method",
                              "SELECT unnest(['cash', 'credit', 'debit', 'mobile']) AS k"),
    "dim_time_id": ("dim_time", "(CAST(simulated_day AS BIGINT) - 1) * 14 + hour_of_day - 7",
                    "SELECT id AS k FROM d_time"),
}  # fixed values: the accepted methods, and 14 open hours from 8
SQL["q02_duplicate_ids"] = q(DIMS, "SELECT 'fact_sales' AS table_name, "
    "count(*) - count(DISTINCT id) AS duplicates FROM fact"
    + "".join(f"\nUNION ALL SELECT '{d}', count(*) - count(DISTINCT k) FROM ({rows})"
              for d, _, rows in _KEYED.values()))

SQL["q03_orphan_keys"] = q(DIMS, "\nUNION ALL ".join(
    f"SELECT '{key}' AS foreign_key, count(*) AS orphaned_rows FROM fact "
    f"WHERE NOT EXISTS (SELECT 1 FROM ({rows}) WHERE k = {column})"
    for key, (_, column, rows) in _KEYED.items()
))

_FACT_COLUMN = {
    "dim_time_id": "hour_of_day", "dim_product_id": "product_id",
    "dim_customer_id": "customer_id", "dim_payment_method_id": "payment_method",
    "source_transaction_id": "txn", "simulated_day": "simulated_day",
    "quantity_sold": "quantity", "unit_price": "unit_price", "unit_cost": "unit_cost",
    "revenue": "rev", "cost": "cst", "profit": "prf",
}
_MEASURE_TESTS = [
    ("revenue = quantity x price", "abs(quantity * unit_price * 100 - rev) > 1"),
    ("profit = revenue - cost", "abs(rev - cst - prf) > 1"),
    *[(f"{c} not negative", f"{_FACT_COLUMN[c]} < 0") for c in NON_NEGATIVE],
    *[(f"{c} present", f"{_FACT_COLUMN[c]} IS NULL") for c in MANDATORY],
]
SQL["q04_measure_checks"] = q(FACT, "\nUNION ALL ".join(
    f"SELECT '{name}' AS check_name, count(*) AS failing_rows FROM fact WHERE {test}"
    for name, test in _MEASURE_TESTS
))

SQL["q07_payment_violations"] = q(SOURCE, """
SELECT payment_method, count(*) AS failing_rows FROM tx
WHERE payment_method NOT IN ('cash', 'credit', 'debit', 'mobile') GROUP BY payment_method""")

SQL["q08_day_range"] = q(FACT, f"""
SELECT min(simulated_day) AS first_day, max(simulated_day) AS last_day,
  {big('max(simulated_day) - min(simulated_day) + 1 - count(DISTINCT simulated_day)')}
    AS missing_days, CAST(NULL AS BOOLEAN) AS as_expected
FROM fact""")
SQL["q08_missing_days"] = q(FACT, """
SELECT CAST(d AS INTEGER) AS simulated_day
FROM (SELECT unnest(range(min(simulated_day), max(simulated_day) + 1)) AS d FROM fact)
WHERE d NOT IN (SELECT simulated_day FROM fact)""")

SQL["q09_join_row_counts"] = q(DIMS, "\nUNION ALL ".join(
    f"SELECT '{d}' AS dimension, (SELECT count(*) FROM fact) AS rows_before, count(*) AS rows_after, "
    f"count(*) = (SELECT count(*) FROM fact) AS preserved "
    f"FROM fact LEFT JOIN ({rows}) ON k = {column}"
    for d, column, rows in _KEYED.values()
))

# The total on the header as the shop has it: off by five cents on every hundredth sale.
_TOTALS_OFF = f"""
SELECT txn AS transaction_id, CAST({money('header')} AS DECIMAL(10,2)) AS total_amount,
  {money('lines')} AS items_total
FROM (
  SELECT o_orderkey AS txn, coalesce(sum(CAST(unit_price * 100 AS BIGINT) * quantity), 0) AS lines,
    lines + CASE WHEN o_orderkey % 100 = 0 THEN 5 ELSE 0 END AS header
  FROM orders LEFT JOIN item ON o_orderkey = txn GROUP BY o_orderkey)
WHERE abs(header - lines) > 1"""
SQL["q10_unbalanced_sales"] = q(SOURCE, _TOTALS_OFF)

_FILLED = {
    "customers": "customer", "employees": "supplier", "inventory": "part", "products": "part",
    "suppliers": "supplier", "transaction_items": "lineitem", "transactions": "orders",
    "purchase_orders": "led JOIN prod USING (product_id) JOIN tx USING (txn) WHERE reorders > earlier",
}
SQL["q11_source_not_empty"] = q(LEDGER, "\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count, count(*) > 0 AS ready FROM {source}"
    for name, source in _FILLED.items()
))

SQL["q12_duplicate_members"] = q(DIMS, "\nUNION ALL ".join(
    f"SELECT '{d}' AS table_name, {k} AS source_id, count(*) AS members FROM {t} "
    f"GROUP BY {k} HAVING count(*) > 1"
    for d, t, k in (
        ("dim_time", "d_time", "CAST((simulated_day - 1) * 14 + hour_of_day - 7 AS BIGINT)"),
        ("dim_product", "d_product", "product_id"),
        ("dim_customer", "d_customer", "customer_id"),
        ("dim_employee", "d_employee", "employee_id"),
        ("dim_payment_method", "(SELECT CAST(unnest(range(1, 5)) AS BIGINT) AS id)", "id"),
    )
))


def _check(sql: str, check: str, table: str, failing: str) -> str:
    return (
        f"SELECT {check} AS check_name, {table} AS table_name, {big(failing)} AS failing_rows "
        f"FROM ({sql})"
    )


_ALL_CHECKS = "\nUNION ALL ".join([
    _check(SQL["q01_null_profile"], "'no nulls in ' || column_name", "table_name", "null_rows"),
    _check(SQL["q02_duplicate_ids"], "'unique id'", "table_name", "duplicates"),
    _check(SQL["q03_orphan_keys"], "'known ' || foreign_key", "'fact_sales'", "orphaned_rows"),
    _check(SQL["q04_measure_checks"], "check_name", "'fact_sales'", "failing_rows"),
    _check(SQL["q09_join_row_counts"], "'join keeps rows: ' || dimension", "'fact_sales'",
           "abs(rows_after - rows_before)"),
    _check(SQL["q08_day_range"], "'no missing days'", "'fact_sales'", "missing_days"),
    _check(SQL["q07_payment_violations"], "'allowed payment method'", "'transactions'",
           "coalesce(sum(failing_rows), 0)"),
    _check(SQL["q10_unbalanced_sales"], "'total = sum of lines'", "'transactions'", "count(*)"),
    _check(SQL["q11_source_not_empty"], "'has rows'", "table_name",
           "CASE WHEN ready THEN 0 ELSE 1 END"),
    _check(SQL["q12_duplicate_members"], "'one member per key'", "'dimensions'", "count(*)"),
])
SQL["q13_check_summary"] = f"""
SELECT check_name, table_name, failing_rows, CASE WHEN failing_rows = 0 THEN 'Good'
  ELSE format('{{:,}}', failing_rows) || ' failing rows' END AS status
FROM ({_ALL_CHECKS})"""

SQL["r01_from_rollups"] = SQL["r01_daily_revenue"]
SQL["r08_from_rollups"] = SQL["r08_rush_hour_split"]
SQL["r09_from_rollups"] = SQL["r09_category_by_day"]
SQL["r12_approximate_sales"] = q(FACT, f"""
, bounds AS (SELECT min(simulated_day) AS a, max(simulated_day) AS b FROM fact),
ranges AS (
  SELECT CAST(unnest(range(a, b + 1, 90)) AS INTEGER) AS first_day, first_day + 89 AS last_day FROM bounds
  UNION ALL SELECT a, b FROM bounds)
SELECT first_day, last_day, {TXNS} AS sales, true AS close
FROM ranges JOIN fact ON simulated_day BETWEEN first_day AND last_day
GROUP BY first_day, last_day""")
_UPTO = "ORDER BY simulated_day, txn, id, rev, prf ROWS"
SQL["n21_running_revenue"] = q(FACT, f"""
SELECT simulated_day, txn AS source_transaction_id, id,
  {money(f'sum(rev) OVER ({_UPTO} UNBOUNDED PRECEDING)')} AS running_revenue,
  {money(f'sum(prf) OVER ({_UPTO} UNBOUNDED PRECEDING)')} AS running_profit,
  CASE WHEN count(*) OVER ({_UPTO} 29 PRECEDING) = 30
    THEN {per_unit(f'sum(rev) OVER ({_UPTO} 29 PRECEDING)', '30', 4)} END AS mean_revenue
FROM fact""")
SQL["n22_line_revenue_box"] = q(FACT, f"""
, qs AS (
  SELECT quantile_cont(rev::DOUBLE, 0.25) AS q1, quantile_cont(rev::DOUBLE, 0.5) AS q2,
    quantile_cont(rev::DOUBLE, 0.75) AS q3 FROM fact),
fence AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM qs)
SELECT count(*) AS lines, {', '.join(
    f"CAST(CAST(any_value({c}) * 100 AS BIGINT) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(20,4)) AS {n}"
    for c, n in (('q1', 'q1'), ('q2', 'median'), ('q3', 'q3')))},
  {money('min(rev) FILTER (WHERE rev >= lo)')} AS low_whisker,
  {money('max(rev) FILTER (WHERE rev <= hi)')} AS high_whisker,
  count(*) FILTER (WHERE rev < lo OR rev > hi) AS outliers
FROM fact, fence""")

# Load --------------------------------------------------------------------------------------------

_EXTRACT = """
FROM item JOIN tx ON item.txn = tx.txn JOIN prod ON item.product_id = prod.product_id
  JOIN cust ON tx.customer_id = cust.customer_id
  LEFT JOIN emp ON tx.employee_id = emp.employee_id"""
SQL["j01_extract"] = q(SOURCE, f"""
SELECT tx.txn AS transaction_id, tx.customer_id, tx.employee_id, tx.transaction_time,
  tx.payment_method, item.product_id, item.quantity, item.unit_price AS unit_price_at_sale,
  CAST(item.quantity * item.unit_price AS DECIMAL(10,2)) AS subtotal, prod.unit_cost,
  prod.name AS product_name, prod.category, prod.subcategory, prod.supplier_id,
  cust.name AS customer_name,
  CASE WHEN is_loyalty THEN cust.name || '@email.com' END AS email,
  emp.name AS employee_name, emp.role {_EXTRACT}""")
SQL["j01_extract_size"] = q(SOURCE, f"""
SELECT count(*) AS line_items, count(DISTINCT tx.txn) AS transactions {_EXTRACT}""")

SQL["k01_dim_time"] = q(DIMS, """
SELECT id, simulated_day, hour_of_day, time_label, part_of_day, is_rush_hour FROM d_time""")
SQL["k02_dim_product"] = q(DIMS, """
SELECT product_id AS source_id, name, category, subcategory, unit_cost FROM d_product""")
SQL["k03_dim_customer"] = q(DIMS, """
SELECT customer_id AS source_id, name, is_loyalty, CAST(NULL AS DATE) AS join_date
FROM d_customer""")
SQL["k04_dim_employee"] = q(DIMS, """
SELECT employee_id AS source_id, name, role FROM d_employee""")
SQL["k04_dim_payment_method"] = q(SOURCE, """
SELECT CAST(id AS BIGINT) AS id, method, count(txn) AS sales
FROM (VALUES (1, 'cash'), (2, 'credit'), (3, 'debit'), (4, 'mobile')) m(id, method)
  LEFT JOIN tx ON payment_method = method
GROUP BY id, method""")

_EXACT = "CAST({} AS DECIMAL(10,2))"
SQL["k05_fact_sales"] = q(FACT, f"""
SELECT id, txn AS source_transaction_id, simulated_day, fact.hour_of_day, time_label,
  fact.product_id, sold_name AS product, fact.customer_id, is_loyalty, employee_id, payment_method,
  quantity AS quantity_sold, unit_price, unit_cost,
  {_EXACT.format(money('rev'))} AS revenue, {_EXACT.format(money('cst'))} AS cost,
  {_EXACT.format(money('prf'))} AS profit
FROM fact JOIN hr ON fact.hour_of_day = hr.hour_of_day
  JOIN (SELECT product_id, name AS sold_name FROM prod) p ON fact.product_id = p.product_id
  JOIN cust ON fact.customer_id = cust.customer_id""")

SQL["k06_star_totals"] = q(FACT, f"""
SELECT count(*) AS accepted_lines, count(employee_id) AS lines_with_employee, {UNITS} AS units,
  {REV} AS revenue, {PRF} AS profit FROM fact""")

SQL["k11_rejected_lines"] = q(LINES, """
SELECT id, txn AS source_transaction_id, simulated_day, hour_of_day, product_id, customer_id,
  payment_method, quantity AS quantity_sold, unit_price,
  concat_ws(', ', CASE WHEN time_ok THEN NULL ELSE 'time' END,
    CASE WHEN product_ok THEN NULL ELSE 'product' END,
    CASE WHEN customer_ok THEN NULL ELSE 'customer' END,
    CASE WHEN payment_ok THEN NULL ELSE 'payment method' END) AS reasons
FROM line
WHERE (time_ok AND product_ok AND customer_ok AND payment_ok) IS NOT TRUE""")

SQL["k10_replace_days"] = q(LINES, f"""
SELECT simulated_day, CAST(14 AS BIGINT) AS open_hours,
  count(*) FILTER (WHERE time_ok AND product_ok AND customer_ok AND payment_ok) AS accepted_lines,
  count(*) FILTER (WHERE NOT (time_ok AND product_ok AND customer_ok AND payment_ok))
    AS rejected_lines,
  {money('sum(rev) FILTER (WHERE time_ok AND product_ok AND customer_ok AND payment_ok)')} AS revenue
FROM line WHERE simulated_day NOT IN (1, 2, 3) GROUP BY simulated_day""")

SQL["k10_mixed_widths"] = SQL["k10_replace_days"].replace("WHERE simulated_day NOT IN (1, 2, 3) ", "")

SQL["k11_lines_without_sale"] = q(LINES, """
SELECT id, txn AS source_transaction_id,
  concat_ws(', ', 'time', CASE WHEN product_ok THEN NULL ELSE 'product' END, 'customer',
    'payment method') AS reasons
FROM line WHERE txn % 100 IN (7, 8)""")

SQL["s09_surrogate_keys"] = q(DIMS, "\nUNION ALL ".join(
    f"SELECT '{d}' AS table_name, count(*) AS members, count(*) AS distinct_ids, "
    f"CAST(1 AS BIGINT) AS lowest_id, count(*) AS highest_id FROM {t}"
    for d, t in (("dim_product", "d_product"), ("dim_customer", "d_customer"),
                 ("dim_employee", "d_employee"))
) + """
UNION ALL SELECT 'dim_payment_method', 4, 4, 1, 4
UNION ALL SELECT 'dim_time', count(*), count(DISTINCT id), min(id), max(id) FROM d_time""")

SQL["s08_insert_if_absent"] = q(DIMS, f"""
SELECT 'unchanged' AS batch, CAST(0 AS BIGINT) AS added, CAST(NULL AS BIGINT) AS lowest_id,
  CAST(NULL AS BIGINT) AS highest_id, CAST(0 AS DECIMAL(20,2)) AS cost_sum
UNION ALL
SELECT 'one category dearer', count(*) FILTER (WHERE category = 'ECONOMY'), count(*) + 1,
  count(*) + count(*) FILTER (WHERE category = 'ECONOMY'),
  CAST(sum(unit_cost + 1) FILTER (WHERE category = 'ECONOMY') AS DECIMAL(20,2))
FROM d_product""")

_MEMBERS = {
    "dim_product": ("d_product", "product_id", "product_id"),
    "dim_customer": ("d_customer", "customer_id", "customer_id"),
    "dim_employee": ("d_employee", "employee_id", "employee_id"),
    "dim_payment_method": (
        "(VALUES (1, 'cash'), (2, 'credit'), (3, 'debit'), (4, 'mobile')) m(id, payment_method)",
        "m.id", "payment_method"),
}
SQL["k13_repaired_members"] = q(DIMS, "\nUNION ALL ".join(
    f"SELECT '{d}' AS table_name, {big(k)} AS source_id, CAST(1 AS BIGINT) AS members, "
    f"count(fact.id) AS lines, {big('coalesce(sum(rev), 0)')} AS revenue_cents "
    f"FROM {t} LEFT JOIN fact USING ({by}) GROUP BY {k}"
    for d, (t, k, by) in _MEMBERS.items()
))

# The version at or before the line's day, looked up line by line.
SQL["k14_costs_as_of_day"] = q(FACT, f"""
, version AS (
  SELECT product_id, 1 AS from_day, CAST(unit_cost * 100 AS BIGINT) AS cost FROM prod
  UNION ALL
  SELECT product_id, 1200, CAST(unit_cost * 100 AS BIGINT) + 100 FROM prod WHERE category = 'ECONOMY'),
dated AS (
  SELECT simulated_day, rev, quantity * (
    SELECT v.cost FROM version v WHERE v.product_id = fact.product_id AND v.from_day <= fact.simulated_day
    ORDER BY v.from_day DESC LIMIT 1) AS cst
  FROM fact)
SELECT simulated_day, count(*) AS lines, {CST} AS cost, {money('sum(rev - cst)')} AS profit
FROM dated GROUP BY simulated_day""")

# Inventory ---------------------------------------------------------------------------------------

SQL["k07_stock_ledger"] = q(LEDGER, f"SELECT product_id, {LEDGER_COLUMNS} FROM led")
SQL["k07_daily_stock_ledger"] = q(
    DAY_LEDGER, f"SELECT product_id, simulated_day, {LEDGER_COLUMNS} FROM led"
)
# Sale by sale, as the shop does it: independent of the running-minimum form used in Spark.
def _sale_by_sale(sales: str, keys: str, opening: str, threshold: str, order: int) -> str:
    """Sale by sale, as the shop does it: independent of the running-minimum form used in Spark."""
    columns = keys.split(", ")
    same = " AND ".join(f"s.{k} = p.{k}" for k in columns)
    return q(sales, f"""
SELECT {keys}, txn AS transaction_id, {big('quantity')} AS quantity,
  {big('sold')} AS units_sold, {big('reorders')} AS reorders, reordered,
  {big(f'{opening} - sold + {order} * reorders')} AS stock_on_hand
FROM steps""").replace("WITH ", "WITH RECURSIVE ", 1).replace(f"""
SELECT {keys}, txn AS""", f""",
steps AS (
  SELECT {keys}, txn, quantity, sold, n, CAST({opening} - sold <= {threshold} AS BIGINT) AS reorders,
    {opening} - sold <= {threshold} AS reordered FROM sale WHERE n = 1
  UNION ALL
  SELECT {', '.join(f's.{k}' for k in columns)}, s.txn, s.quantity, s.sold, s.n,
    p.reorders + CAST({opening.replace('product_id', 's.product_id')} - s.sold + {order} * p.reorders
      <= {threshold.replace('product_id', 's.product_id')} AS BIGINT),
    {opening.replace('product_id', 's.product_id')} - s.sold + {order} * p.reorders
      <= {threshold.replace('product_id', 's.product_id')}
  FROM steps p JOIN sale s ON {same} AND s.n = p.n + 1)
SELECT {keys}, txn AS""", 1)


SQL["k07_small_orders_ledger"] = _sale_by_sale(SALES, "product_id", "150", "20", 20)
_LEVELS = ("(60 + product_id % 7 * 30)", "(10 + product_id % 4 * 15)", 30)
SQL["k07_ledger_by_levels"] = _sale_by_sale(SALES, "product_id", *_LEVELS)
SQL["k07_daily_ledger_by_levels"] = _sale_by_sale(DAY_SALES, "product_id, simulated_day", *_LEVELS)

SQL["k08_purchase_orders"] = q(LEDGER, """
SELECT supplier_id, led.product_id, CAST(100 AS INTEGER) AS quantity_ordered,
  unit_cost AS cost_per_unit, transaction_time AS order_date,
  CAST(NULL AS TIMESTAMP) AS received_date, led.txn AS transaction_id
FROM led JOIN prod ON led.product_id = prod.product_id JOIN tx ON led.txn = tx.txn
WHERE reorders > earlier""")

SQL["k09_closing_stock"] = q(LEDGER, f"""
SELECT prod.product_id, coalesce({big('150 - max(sold) + 100 * max(reorders)')}, 150)
    AS quantity_on_hand, coalesce({big('max(reorders)')}, 0) AS reorders,
  arg_max(transaction_time, led.txn) FILTER (WHERE reorders > earlier) AS last_restocked
FROM prod LEFT JOIN led ON prod.product_id = led.product_id LEFT JOIN tx ON led.txn = tx.txn
GROUP BY prod.product_id""")
SQL["k09_daily_closing_stock"] = q(DAY_LEDGER, f"""
SELECT product_id, led.simulated_day, {big('150 - max(sold) + 100 * max(reorders)')}
    AS quantity_on_hand, {big('max(reorders)')} AS reorders,
  arg_max(transaction_time, led.txn) FILTER (WHERE reorders > earlier) AS last_restocked
FROM led JOIN tx ON led.txn = tx.txn GROUP BY product_id, led.simulated_day""")

SQL["k12_roster"] = q(FACT, """
SELECT hr.hour_of_day,
  coalesce(c.employee_id, (SELECT min(employee_id) FROM emp WHERE role = 'Cashier')) AS employee_id,
  c.employee_id IS NULL AS is_fallback
FROM hr LEFT JOIN (SELECT * FROM emp WHERE role = 'Cashier') c
  ON c.shift_start <= hr.hour_of_day AND hr.hour_of_day < c.shift_start + 8""")

# Files -------------------------------------------------------------------------------------------

SQL["s01_headerless_csv"] = f"""
SELECT table_name, row_count, CAST(0 AS BIGINT) AS differing_rows FROM ({SQL["r11_row_counts"]})"""
SQL["s10_views"] = q(FACT, f"""
SELECT category, is_loyalty, count(*) AS lines, {UNITS} AS units
FROM sold JOIN cust ON sold.customer_id = cust.customer_id GROUP BY category, is_loyalty""")
SQL["s07_insert_dump"] = SQL["k02_dim_product"]
SQL["s07_dump_over_lines"] = q(DIMS, """
SELECT product_id AS source_id, replace(name, ' ', chr(10) || chr(39) || ' -- ') AS name,
  category, subcategory, unit_cost
FROM d_product""")
SQL["o05_table_samples"] = q(DIMS, "\nUNION ALL ".join(
    f"(SELECT '{name}' AS table_name, CAST(id AS BIGINT) AS id FROM {ids} "
    "ORDER BY md5('42:' || id), id LIMIT 5)"
    for name, ids in {
        "dim_time": "d_time",
        "fact_sales": "fact",
        "dim_payment_method": "(SELECT unnest(range(1, 5)) AS id)",
        **{
            d: f"(SELECT unnest(range(1, (SELECT count(*) + 1 FROM {t}))) AS id)"
            for d, t in (("dim_product", "d_product"), ("dim_customer", "d_customer"),
                         ("dim_employee", "d_employee"))
        },
    }.items()
))

# Streams -----------------------------------------------------------------------------------------

SQL["l01_sale_events"] = q(FEED, """
SELECT seq, ts, day, hour, sim_time, customer, payment, total, items_text
FROM ev WHERE type = 'transaction'""")
SQL["l01_reorder_events"] = q(FEED, """
SELECT seq, day, sim_time, product FROM ev WHERE type = 'reorder'""")
SQL["l02_sales_so_far"] = q(FEED, """
SELECT day, count(*) AS transactions, CAST(sum(total) AS DECIMAL(20,2)) AS revenue
FROM ev WHERE type = 'transaction' GROUP BY day""")
_HOURS = """
SELECT date_trunc('hour', ts) AS hour_start, hour,
  printf('%02d:00 - %02d:00', hour, hour + 1) AS label,
  count(*) FILTER (WHERE type = 'transaction') AS customers,
  count(*) FILTER (WHERE type = 'reorder') AS reorders
FROM ev GROUP BY 1, 2"""
SQL["l03_hour_summary"] = q(FEED, _HOURS)
_DAYS = f"""
SELECT s.simulated_day, s.transactions, {big('sum(quantity)')} AS items_sold, {REV} AS revenue,
  {CST} AS cost, {money('sum(rev) - sum(cst)')} AS profit
FROM (SELECT simulated_day, count(*) AS transactions FROM tx GROUP BY 1) s
  LEFT JOIN line l ON l.simulated_day = s.simulated_day
GROUP BY s.simulated_day, s.transactions"""
SQL["l04_day_summary"] = q(LINES, _DAYS)
SQL["l05_stock_alerts"] = q(LEDGER, f"""
SELECT product_id, txn AS transaction_id, {big('sold')} AS units_sold,
  {big('reorders')} AS reorders, {big('150 - sold + 100 * reorders')} AS stock_on_hand
FROM led WHERE reorders > earlier""")
SQL["l06_feed_lines"] = q(FEED_LINES, "SELECT seq, ts, type, line FROM feed")
SQL["l06_summary_lines"] = q(LINES + "," + FEED, f"""
SELECT 'hour' AS type, 'HOUR ' || label || ' — ' || customers || ' customers — ' || reorders
  || ' reorder(s)' AS line FROM ({_HOURS})
UNION ALL
SELECT 'day_start', 'DAY ' || simulated_day || ' — Store opening at 08:00' FROM ({_DAYS})
UNION ALL
SELECT 'day_end', 'DAY ' || simulated_day || ' CLOSED Transactions: ' || transactions
  || ' — Revenue: $' || revenue || ' — Profit: $' || profit FROM ({_DAYS})""")
SQL["l07_latest_lines"] = q(FEED_LINES, """
SELECT seq, ts, type, line FROM feed ORDER BY seq DESC LIMIT 300""")
SQL["l07_running_latest"] = SQL["l07_latest_lines"]
SQL["l03_hours_and_late"] = q(FEED, """
SELECT date_trunc('hour', ts) AS hour_start, count(*) FILTER (WHERE type = 'transaction') AS customers,
  count(*) FILTER (WHERE type = 'reorder') AS reorders, count(*) AS events
FROM ev GROUP BY 1""")
SQL["l08_pushed_events"] = q(FEED, """
SELECT type, day, count(*) AS events FROM ev GROUP BY type, day""")
SQL["l09_lines_from_sales"] = q(LEDGER, """
SELECT txn AS seq, transaction_time AS ts, 'transaction' AS type,
  strftime(transaction_time, '%H:%M') || ' SALE ' || cust.name || ' — ' || items || ' — $'
    || CAST(CAST(cents AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(20,2))
    || ' [' || payment_method || ']' AS line
FROM tx JOIN cust USING (customer_id) JOIN (
  SELECT item.txn, string_agg(quantity || 'x ' || name, ', ' ORDER BY item.id, quantity, name) AS items,
    sum(CAST(item.unit_price * 100 AS BIGINT) * quantity) AS cents
  FROM item JOIN prod USING (product_id) GROUP BY item.txn) USING (txn)
UNION ALL
SELECT led.txn, transaction_time, 'reorder', strftime(transaction_time, '%H:%M') || ' REORDER '
  || name || ' stock low — purchase order placed (+100 units)'
FROM led JOIN prod USING (product_id) JOIN tx ON led.txn = tx.txn WHERE reorders > earlier""")
SQL["l09_load_lines"] = q(LINES, """
SELECT 'etl' AS type, simulated_day AS day, 'ETL day ' || simulated_day || ': '
  || count(*) FILTER (WHERE time_ok AND product_ok AND customer_ok AND payment_ok) || ' lines loaded, '
  || count(*) FILTER (WHERE NOT (time_ok AND product_ok AND customer_ok AND payment_ok)) || ' rejected'
  AS line
FROM line WHERE simulated_day IS NOT NULL GROUP BY simulated_day""")
SQL["l09_malformed_events"] = """
SELECT 'events' AS value, count(*) AS n FROM events WHERE event_id % 50 <> 0
UNION ALL
SELECT substr('{"seq":' || event_id || ',"ts":"', 1, 10), count(*) FROM events
WHERE event_id % 50 = 0 GROUP BY 1"""

_CONSTRAINTS = {
    "customers": ("customer", "id join_date", {"id": "c_custkey",
        "email": "CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN c_name || '@email.com' END",
        "join_date": "DATE '1995-01-01'"}),
    "suppliers": ("supplier", "id name lead_time_days",
        {"id": "s_suppkey", "name": "s_name", "lead_time_days": "1"}),
    "products": ("prod", "id name category unit_price unit_cost", {"id": "product_id"}),
    "inventory": ("part", "product_id quantity_on_hand reorder_threshold",
        {"product_id": "p_partkey", "quantity_on_hand": "150", "reorder_threshold": "20"}),
    "employees": ("emp", "id name role", {"id": "employee_id"}),
    "transactions": ("tx", "id customer_id transaction_time payment_method total_amount",
        {"id": "txn", "total_amount": "0"}),
    "transaction_items": ("item",
        "id transaction_id product_id quantity unit_price_at_sale subtotal",
        {"transaction_id": "txn", "unit_price_at_sale": "unit_price", "subtotal": "unit_price"}),
    "purchase_orders": ("placed",
        "id supplier_id product_id quantity_ordered cost_per_unit order_date",
        {"quantity_ordered": "100", "cost_per_unit": "unit_cost", "order_date": "transaction_time"}),
}
_PLACED = LEDGER + """,
placed AS (
  SELECT txn * (SELECT max(product_id) + 1 FROM prod) + product_id AS id, supplier_id, product_id,
    unit_cost, transaction_time
  FROM led JOIN prod USING (product_id) JOIN tx USING (txn) WHERE reorders > earlier)"""


def _constraint(table: str, what: str, source: str, failing: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{what}' AS constraint_name, "
            f"CAST(coalesce({failing}, 0) AS BIGINT) AS failing_rows FROM {source}")


SQL["q14_operational_constraints"] = q(_PLACED, "\nUNION ALL ".join([
    *(_constraint(t, f"{c} required", source, f"count(*) FILTER (WHERE {names.get(c, c)} IS NULL)")
      for t, (source, required, names) in _CONSTRAINTS.items() for c in required.split()),
    *(_constraint(t, f"{c} unique", source,
                  f"count({names.get(c, c)}) - count(DISTINCT {names.get(c, c)})")
      for t, (source, _, names) in _CONSTRAINTS.items()
      for c in {"customers": ("id", "email"), "inventory": ("product_id",)}.get(t, ("id",))),
    *(_constraint(t, f"{c} in {other}", f"{source} a LEFT JOIN {known} b ON a.{column} = b.{key}",
                  f"count(*) FILTER (WHERE a.{column} IS NOT NULL AND b.{key} IS NULL)")
      for t, c, other, source, column, known, key in (
          ("products", "supplier_id", "suppliers", "prod", "supplier_id", "supplier", "s_suppkey"),
          ("inventory", "product_id", "products", "part", "p_partkey", "prod", "product_id"),
          ("transactions", "customer_id", "customers", "tx", "customer_id", "customer", "c_custkey"),
          ("transactions", "employee_id", "employees", "tx", "employee_id", "emp", "employee_id"),
          ("transaction_items", "transaction_id", "transactions", "item", "txn", "tx", "txn"),
          ("transaction_items", "product_id", "products", "item", "product_id", "prod", "product_id"),
          ("purchase_orders", "supplier_id", "suppliers", "placed", "supplier_id", "supplier", "s_suppkey"),
          ("purchase_orders", "product_id", "products", "placed", "product_id", "prod", "product_id"),
      )),
]))
