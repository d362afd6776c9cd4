"""What the registered queries share: the star and the JSON feed, each built once per input."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.plans import inventory, star
from tallyhouse.schemas import OPERATIONAL, Tables
from tallyhouse.sources import benchmark_tables as bench
from tallyhouse.storage import fresh_path, path_exists, stage
from tallyhouse.streaming import feed, runs

# The given tables spread few lines over 2,400 days, far too few for a file per day.
DAYS_PER_PARTITION = 256

_BUILT: dict[tuple[str, str, str], str] = {}
_LOCK = threading.RLock()


def _built_once(
    spark: SparkSession, what: str, sf_dir: str, probe: str, build: Callable[[str], str]
) -> str:
    """Path of a stored table set, built by the first query that needs it and shared by the rest of
    the application. Reports over a warehouse read it; they do not each load it again."""
    key = (spark.sparkContext.applicationId, what, sf_dir)
    with _LOCK:
        path = _BUILT.get(key)
        if path is None or not path_exists(spark, f"{path}{probe}"):
            path = _BUILT[key] = build(fresh_path(spark, what))
    return path


def star_root(spark: SparkSession, sf_dir: str) -> str:
    def build(root: str) -> str:
        oltp = bench.operational(spark, sf_dir)
        star.load_days(spark, oltp, root, bench.FIRST_DAY, DAYS_PER_PARTITION)
        return root

    return _built_once(spark, "star", sf_dir, "/sales_lines", build)


def star_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return star.read_star(spark, star_root(spark, sf_dir))


def all_sources(spark: SparkSession, sf_dir: str) -> Tables:
    """The operational tables with the purchase orders that the given sales make the stock ledger
    place, numbered by sale and product."""
    oltp = bench.operational(spark, sf_dir)

    def build(path: str) -> str:
        ledger = inventory.ledger(oltp["sold_quantities"], levels=oltp["inventory"])
        orders = inventory.purchase_orders(stage(ledger, "ledger"), oltp)
        products = oltp["products"].agg((F.max("id") + 1).alias("n")).scalar()
        number = F.col("transaction_id") * products + F.col("product_id")
        columns = OPERATIONAL["purchase_orders"].names
        orders.withColumn("id", number).select(*columns).write.parquet(path)
        return path

    path = _built_once(spark, "orders", sf_dir, "", build)
    return oltp | {"purchase_orders": spark.read.schema(OPERATIONAL["purchase_orders"]).parquet(path)}


# Files that a source is split into where a stream is to take it in several micro-batches.
PARTS = 6
# Lines that one task writes into a file of a part.
LINES_PER_FILE = 1 << 21


def split_events(spark: SparkSession, sf_dir: str) -> str:
    def build(path: str) -> str:
        bench.table(spark, sf_dir, "events").repartitionByRange(PARTS, "event_id").write.parquet(path)
        return path

    return _built_once(spark, "events", sf_dir, "", build)


def files_per_part(rows: int) -> int:
    return max(1, -(-rows // (PARTS * LINES_PER_FILE)))


def split_lines(spark: SparkSession, sf_dir: str) -> str:
    """The sale lines as consecutive parts, written one after the other. The parts are cut by line,
    so a sale may begin in one and end in the next. A part has as many files, each written by one task,
    as all lines call for."""

    def build(path: str) -> str:
        lines = bench.table(spark, sf_dir, "lineitem")
        number = F.col("l_orderkey") * 8 + F.col("l_linenumber")
        shares = [n / PARTS for n in range(1, PARTS)]
        cuts, rows = lines.agg(F.percentile_approx(number, shares), F.count(F.lit(1))).first()
        cuts, files = cuts or [], files_per_part(rows)
        for n, (low, high) in enumerate(zip([None, *cuts], [*cuts, None])):
            above = F.lit(True) if low is None else number > low
            below = F.lit(True) if high is None else number <= high
            lines.where(above & below).repartition(files).write.parquet(f"{path}/part={n}")
        return path

    return _built_once(spark, "lines", sf_dir, "/part=0", build)


def line_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sale lines as a stream of several micro-batches, each a part."""
    like = bench.table(spark, sf_dir, "lineitem")
    folder = split_lines(spark, sf_dir)
    files = files_per_part(like.count())
    return runs.stream_table(spark, f"{folder}/*", like, files_per_batch=files)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    like = bench.table(spark, sf_dir, "events")
    return bench.feed_events(
        runs.stream_table(spark, split_events(spark, sf_dir), like, files_per_batch=1)
    )


def feed_files(spark: SparkSession, sf_dir: str) -> str:
    """The events as JSON files, which a stream wrote in several micro-batches."""

    def build(_: str) -> str:
        return runs.append_to_text(feed.encode(event_stream(spark, sf_dir)), "feed")

    return _built_once(spark, "feed", sf_dir, "", build)


def feed_stream(
    spark: SparkSession, sf_dir: str, files_per_batch: int | None = None
) -> DataFrame:
    """The events as a stream of typed events read from JSON files."""
    return feed.read_json_feed(spark, feed_files(spark, sf_dir), files_per_batch)
