from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyhouse import catalog, workspace
from tallyhouse import schemas as S
from tallyhouse.functions import labels, money
from tallyhouse.plans import inventory
from tallyhouse.sources import dumps, files
from tallyhouse.storage import fresh_path
from tallyhouse.streaming import feed, runs

from tests.shop import FIRST_DAY, at, shop

EVENTS = [
    '{"seq":1,"ts":"2025-01-01T08:00:00.000000","type":"day_start","day":1}',
    '{"seq":2,"ts":"2025-01-01T09:30:05.123456","type":"transaction","day":1,"hour":9,'
    '"sim_time":"09:30","customer":"Ann","items":[{"quantity":2,"product":"Pears"},'
    '{"quantity":1,"product":"Oats"}],"total":7.5,"payment":"cash"}',
    '{"seq":3,"ts":"2025-01-01T09:31:00.000000","type":"reorder","sim_time":"09:31","product":"Oats"}',
    '{"seq":4,"ts":"2025-01-01T10:00:00.000000","type":"hour","hour":9,"label":"09:00 - 10:00",'
    '"customers":1,"reorders":1}',
    '{"seq":5,"ts":"2025-01-01T21:00:00.000000","type":"day_end","day":1,"transactions":1,'
    '"revenue":7.5,"profit":2.25}',
    '{"seq":6,"ts":"2025-01-01T21:01:00.000000","type":"etl","message":"done"}',
    '{"seq":7,"ts":"2025-01-02T08:00:00.000000","type":"system","time":"08:00","message":"up"}',
    '{"seq":8,"ts":"2025-01-02T09:00:00.000000","type":"transaction","day":2,"hour":9,'
    '"sim_time":"09:00","customer":"Bo","items":[{"quantity":3,"product":"Plums"}],'
    '"total":12,"payment":"debit"}',
]


def feed_folder(spark, per_file=3):
    folder = fresh_path(spark, "events")
    for n in range(0, len(EVENTS), per_file):
        part = spark.createDataFrame([(e,) for e in EVENTS[n : n + per_file]], "value STRING")
        part.coalesce(1).write.mode("append").text(folder)
    return folder


def stream(spark):
    return feed.read_json_feed(spark, feed_folder(spark), files_per_batch=1)


def test_every_event_type_has_its_line(spark):
    lines = runs.append_to_table(feed.feed_lines(stream(spark)), "lines").orderBy("seq").collect()
    assert [r["line"] for r in lines] == [
        "DAY 1 — Store opening at 08:00",
        "09:30 SALE Ann — 2x Pears, 1x Oats — $7.50 [cash]",
        "09:31 REORDER Oats stock low — purchase order placed (+100 units)",
        "HOUR 09:00 - 10:00 — 1 customers — 1 reorder(s)",
        "DAY 1 CLOSED Transactions: 1 — Revenue: $7.50 — Profit: $2.25",
        "ETL done",
        "08:00 up",
        "09:00 SALE Bo — 3x Plums — $12.00 [debit]",
    ]
    assert lines[1]["ts"] == datetime(2025, 1, 1, 9, 30, 5, 123456)


def test_running_totals_over_several_micro_batches(spark):
    out = runs.totals_to_table(feed.sales_so_far(stream(spark)), "totals").orderBy("day").collect()
    assert [tuple(r) for r in out] == [(1, 1, Decimal("7.50")), (2, 1, Decimal("12.00"))]


def test_hour_summary_equals_its_batch_twin(spark):
    batch = feed.hour_summary(feed.decode(spark.createDataFrame([(e,) for e in EVENTS], "value STRING")))
    streamed = runs.totals_to_table(feed.hour_summary(stream(spark)), "hours")
    order = lambda df: [tuple(r) for r in df.orderBy("hour_start").collect()]
    assert order(streamed) == order(batch)
    assert (datetime(2025, 1, 1, 9), 9, "09:00 - 10:00", 1, 1) in order(batch)


def test_hours_close_behind_a_watermark(spark):
    hours = runs.append_to_table(feed.hour_summary(stream(spark), late_by="10 minutes"), "closed")
    closed = [r["hour_start"] for r in hours.orderBy("hour_start").collect()]
    assert closed[:2] == [datetime(2025, 1, 1, 8), datetime(2025, 1, 1, 9)]
    assert datetime(2025, 1, 2, 9) not in closed  # the last hour is still open


def test_events_survive_encoding(spark):
    events = feed.decode(spark.createDataFrame([(e,) for e in EVENTS], "value STRING"))
    again = feed.decode(feed.encode(events))
    assert events.exceptAll(again).count() == 0 and again.count() == len(EVENTS)


def test_unknown_type_is_refused(spark):
    events = feed.decode(spark.createDataFrame([], "value STRING"))
    try:
        feed.of_type(events, "refund")
    except ValueError as e:
        assert "refund" in str(e)
    else:
        raise AssertionError("accepted an unknown type")


def test_push_without_a_sink_runs_nothing(spark):
    runs.push(stream(spark), None)
    seen = []
    runs.push(stream(spark), lambda batch, number: seen.append((number, batch.count())))
    assert sum(n for _, n in seen) == len(EVENTS)


def test_headerless_csv_takes_both_spellings_of_flags(spark):
    path = fresh_path(spark, "csv")
    text = ["1,1,Ann,t,2024-01-05", "2,2,Bo,False,", "3,3,Cy,,"]
    spark.createDataFrame([(t,) for t in text], "value STRING").write.text(path)
    out = files.read_headerless_csv(spark, path, S.STAR["dim_customer"]).orderBy("id").collect()
    assert [tuple(r) for r in out] == [
        (1, 1, "Ann", True, date(2024, 1, 5)), (2, 2, "Bo", False, None), (3, 3, "Cy", None, None)
    ]


BOATS = "hull BIGINT, title STRING, harbour STRING, length DECIMAL(6,2), sold BOOLEAN"


def dumped(spark, *lines):
    path = fresh_path(spark, "dump")
    spark.createDataFrame([("\n".join(lines),)], "value STRING").coalesce(1).write.text(path)
    schema = spark.createDataFrame([], BOATS).schema
    return sorted((tuple(r) for r in files.read_insert_dump(spark, path, schema).collect()), key=str)


def test_insert_dump_in_all_its_shapes(spark):
    got = dumped(
        spark,
        "-- boats of two harbours",
        'insert into quay.boats (hull, "title", harbour, length, sold) VALUES',
        "  (70,'Wave''s End, II','Oban',12.50,true),",
        "  (71,'NULL',NULL,3,false);",
        "",
        "INSERT INTO boats VALUES (72,'a (b) c',  'x',NULL ,NULL), (73,E'two\\nlines \\\\','y',1.1,'t');",
    )
    assert got == [
        (70, "Wave's End, II", "Oban", Decimal("12.50"), True),
        (71, "NULL", None, Decimal("3.00"), False),
        (72, "a (b) c", "x", None, None),
        (73, "two\nlines \\", "y", Decimal("1.10"), True),
    ]


def dump_file(spark, tmp_path, *lines):
    (tmp_path / "boats.sql").write_text("\n".join(lines))
    schema = spark.createDataFrame([], BOATS).schema
    got = dumps.read_dump(spark, f"file://{tmp_path}/boats.sql", schema).collect()
    return sorted((tuple(r) for r in got), key=str)


SCRIPT = [
    "-- boats: it's a comment",
    "INSERT INTO quay.boats",
    "  (hull, title, harbour, length, sold)",
    "VALUES",
    "  (70,'first line",
    "-- it''s text; ON CONFLICT (",
    "",
    "last','Oban',12.50,true), -- don't read",
    "  (71,",
    "   NULL, 'x''s)', -- ((",
    "   3,false)",
    "ON CONFLICT (hull)",
    "  DO UPDATE SET title = 'a;",
    "b', length = (1 + 2);",
    "",
    "INSERT INTO boats VALUES (72,'','',NULL,NULL) RETURNING hull; INSERT INTO boats VALUES (73,E'two\\nlines','y',1,'t')",
    "ON DUPLICATE KEY UPDATE title = VALUES(title);",
]
SCRIPT_ROWS = [
    (70, "first line\n-- it's text; ON CONFLICT (\n\nlast", "Oban", Decimal("12.50"), True),
    (71, None, "x's)", Decimal("3.00"), False),
    (72, "", "", None, None),
    (73, "two\nlines", "y", Decimal("1.00"), True),
]


def test_dump_over_several_lines(spark, tmp_path):
    assert dump_file(spark, tmp_path, *SCRIPT) == SCRIPT_ROWS
    (tmp_path / "empty").mkdir()
    assert dump_file(spark, tmp_path / "empty") == []


def test_dump_over_many_blocks_of_a_file(spark, tmp_path):
    """Blocks of 97 bytes begin inside texts, tuples, heads and clauses."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = dump_file(spark, tmp_path, *SCRIPT * 5)
        blocks = dumps.whole_lines(spark, f"file://{tmp_path}/boats.sql").select("block").distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == sorted(SCRIPT_ROWS * 5, key=str) and blocks > 10


@pytest.mark.parametrize(
    "lines",
    [
        ["INSERT INTO boats SELECT * FROM ships;"],
        ["INSERT INTO boats VALUES (1,'open,'b',1,true);"],
        ["INSERT INTO boats VALUES (1,'a','b',1,true", ";"],
        ["(1,'a','b',1,true);"],
        ["INSERT INTO boats VALUES (1,'a','b',1);"],
        ["INSERT INTO boats VALUES (1,'a','b',1,true);", "DELETE FROM boats;"],
    ],
)
def test_dump_that_is_no_statement_of_rows(spark, tmp_path, lines):
    with pytest.raises(Exception):
        dump_file(spark, tmp_path, *lines)


@pytest.mark.parametrize(
    "line",
    [
        "(1,'a','b',1,true) ON CONFLICT DO NOTHING;",
        "(1,'broken",
        "(1,'a','b',1);",
        "(x,'a','b',1,true);",
        "DELETE FROM boats;",
    ],
)
def test_what_is_not_a_row_is_refused(spark, line):
    with pytest.raises(Exception):
        dumped(spark, "INSERT INTO boats VALUES", line)


def test_dump_round_trip(spark):
    df = spark.createDataFrame(
        [(1, "it's, 'so'", None), (2, "b", "r"), (3, "NULL", "line\nbreak \\n"), (4, "", "(x);")],
        "source_id BIGINT, name STRING, role STRING",
    )
    path = fresh_path(spark, "dump")
    files.write_insert_dump(df, path, "dim_employee")
    back = files.read_insert_dump(spark, path, df.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_unknown_flag_text_is_refused(spark):
    path = fresh_path(spark, "csv")
    spark.createDataFrame([("1,1,Ann,maybe,2024-01-05",)], "value STRING").write.text(path)
    with pytest.raises(Exception, match="not a flag"):
        files.read_headerless_csv(spark, path, S.STAR["dim_customer"]).collect()


def test_malformed_events_are_refused_or_set_aside(spark):
    texts = spark.createDataFrame([('{"seq":1,"type":"system"}',), ('{"seq":2,"ty',), ("",)], "value STRING")
    with pytest.raises(Exception, match="not an event"):
        feed.decode(texts).select("type").collect()
    assert [r["seq"] for r in feed.well_formed(texts).collect()] == [1]
    assert sorted(r["value"] for r in feed.malformed(texts).collect()) == ["", '{"seq":2,"ty']


def test_events_made_from_sales(spark):
    oltp = shop(spark, [(1, 2, 1, at(2, 9, 5), "cash")], [(1, 2, 140, "3.50"), (1, 1, 2, "2.00")])
    sale = feed.sale_events(oltp, FIRST_DAY)
    line = feed.feed_lines(feed.decode(feed.encode(feed.conform(sale)))).first()["line"]
    assert line == "09:05 SALE Ann — 140x Oats, 2x Pears — $494.00 [cash]"
    stock = inventory.ledger(oltp["transaction_items"], levels=oltp["inventory"])
    event = feed.reorder_events(stock, oltp, FIRST_DAY).first()
    assert (event["product"], event["sim_time"], event["day"]) == ("Oats", "09:05", 2)


def test_sample_is_repeatable_and_exact_in_size(spark):
    df = spark.range(1000)
    first = sorted(r[0] for r in files.seeded_sample(df, "id", 5, 1).collect())
    assert first == sorted(r[0] for r in files.seeded_sample(df.repartition(7), "id", 5, 1).collect())
    assert len(first) == 5
    assert first != sorted(r[0] for r in files.seeded_sample(df, "id", 5, 2).collect())


def test_registered_views_answer_sql(spark):
    files.register_views({"t": spark.range(3)}, prefix="shop_")
    assert spark.sql("SELECT count(*) FROM shop_t").first()[0] == 3


def test_reference_rows_and_empty_tables(spark):
    assert [r["method"] for r in S.payment_methods(spark).orderBy("id").collect()] == [
        "cash", "credit", "debit", "mobile"
    ]
    assert S.walk_in_customer(spark, date(2025, 1, 1)).first()["email"] is None
    empty = S.empty_tables(spark, S.OPERATIONAL)
    assert empty["transactions"].schema == S.OPERATIONAL["transactions"]
    assert empty["transactions"].count() == 0


def test_scalar_helpers(spark):
    row = spark.createDataFrame(
        [(date(2025, 1, 2), [(2, Decimal("1.50")), (1, Decimal("0.25"))], Decimal("-1234.5"))],
        "d DATE, cart ARRAY<STRUCT<quantity: INT, unit_price: DECIMAL(8,2)>>, m DECIMAL(10,2)",
    ).select(
        labels.at_clock(F.col("d"), F.lit(9), F.lit(5), F.lit(7)).alias("at"),
        money.cart_total(F.col("cart")).alias("total"),
        money.currency_text(F.col("m")).alias("text"),
        money.percent_text(F.lit(12.345), 1).alias("pct"),
        labels.recode(F.lit("x"), {"y": "z"}).alias("unmapped"),
        labels.or_default(F.lit(None).cast("int"), 10).alias("default"),
        labels.hour_range_label(F.lit(8)).alias("range"),
    ).first()
    assert row["at"] == datetime(2025, 1, 2, 9, 5, 7)
    assert row["total"] == Decimal("3.25")
    assert row["text"] == "-$1,234.50"
    assert row["pct"] == "12.3%"
    assert row["unmapped"] is None and row["default"] == 10 and row["range"] == "08:00 - 09:00"


# Bounded and late ----------------------------------------------------------------------------------


def _batches(spark, tmp_path, *batches, columns="seq BIGINT, ts TIMESTAMP, type STRING"):
    """A stream that takes one file, and so one of ``batches``, at a time."""
    folder = str(tmp_path / "in")
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, columns).coalesce(1).write.mode("append").parquet(f"{folder}/n={n}")
    like = spark.createDataFrame([], columns)
    return runs.stream_table(spark, f"{folder}/*", like, files_per_batch=1)


def test_only_the_latest_rows_are_stored(spark, tmp_path):
    noon = datetime(2025, 1, 1, 12)
    batches = [[(10 * n + k, noon, "system") for k in (3, 1, 9, 0)] for n in (2, 5, 1, 3)]
    path = str(tmp_path / "out" / "latest")
    got = runs.latest_to_table(_batches(spark, tmp_path, *batches), "seq", rows=5, path=path)
    assert sorted(r["seq"] for r in got.collect()) == [39, 50, 51, 53, 59]
    assert spark.read.parquet(path).count() == 5  # nothing else is kept


def test_late_events_are_kept_apart(spark, tmp_path):
    def at(hour, minute=0):
        return datetime(2025, 1, 1, hour, minute)

    batches = [
        [(1, at(8, 10), "transaction"), (2, at(9, 5), "reorder")],  # 8 stays open: 9:05 is not 9:15
        [(3, at(8, 59), "transaction"), (4, at(9, 20), "transaction")],  # closes 8
        [(5, at(8, 30), "transaction"), (6, at(9, 59), "system"), (7, at(11, 0), "system")],  # 8:30 late; closes 9
        [(8, at(9, 0), "reorder"), (9, at(11, 1), "transaction")],  # 9:00 late
    ]
    stream = _batches(spark, tmp_path, *batches)
    hours, late = runs.hours_with_late(stream.drop("seq"), "15 MINUTES", str(tmp_path / "out" / "hours"))
    assert sorted((r["hour_start"].hour, r["customers"], r["reorders"], r["events"], r["closed"]) for r in hours.collect()) == [
        (8, 2, 0, 2, True), (9, 1, 1, 3, True), (11, 1, 0, 2, False),
    ]
    assert sorted((r["ts"].hour, r["type"]) for r in late.collect()) == [(8, "transaction"), (9, "reorder")]


def test_parts_of_the_lines_have_as_many_files_as_they_call_for(spark, monkeypatch):
    sf_dir = "/root/testdata/sf0.001"
    whole = catalog.queries()["l05_stock_alerts"](spark, sf_dir).collect()
    monkeypatch.setattr(workspace, "LINES_PER_FILE", 300)
    monkeypatch.setattr(workspace, "_BUILT", {})
    parts = list(Path(workspace.split_lines(spark, sf_dir)).iterdir())
    assert len(parts) == workspace.PARTS and {len(list(p.glob("*.parquet"))) for p in parts} == {4}
    assert sorted(catalog.queries()["l05_stock_alerts"](spark, sf_dir).collect()) == sorted(whole)
