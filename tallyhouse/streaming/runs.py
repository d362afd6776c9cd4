"""Driving the feed as Structured Streaming queries.

Checkpoints, state and results live below one path. Given the same path again, a stream goes on
where it stopped and takes in only what has arrived since; without one it starts anew in the shared
folder. Every sink is idempotent per micro-batch, so a batch repeated after a failure leaves the
same result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tallyhouse.plans import inventory
from tallyhouse.storage import delete, fresh_path, is_complete, path_exists, stage

Sink = Callable[[DataFrame, int], None]


def finish(query: StreamingQuery) -> None:
    query.awaitTermination()


def _or_empty(stream: DataFrame, path: str) -> DataFrame:
    """A stored result; an empty table where the stream had nothing to store."""
    spark = stream.sparkSession
    if not path_exists(spark, path):
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(path)


def append_to_table(stream: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Run a row-by-row stream over everything available into a table and read it back."""
    spark = stream.sparkSession
    path = path or fresh_path(spark, label)
    finish(
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", f"{path}-checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    return _or_empty(stream, path)


def append_to_text(stream: DataFrame, label: str) -> str:
    """Run a stream of texts into text files; returns their folder."""
    path = fresh_path(stream.sparkSession, label)
    finish(
        stream.writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", f"{path}-checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    return path


def totals_to_table(stream: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Run a grouped stream over everything available and read back its final totals.

    Complete mode: each micro-batch carries the whole result, which overwrites the previous one.
    Only for groupings with few keys, such as days or hours.
    """
    spark = stream.sparkSession
    path = path or fresh_path(spark, label)

    def replace(totals: DataFrame, batch: int) -> None:
        totals.write.mode("overwrite").parquet(path)

    finish(
        stream.writeStream.outputMode("complete")
        .foreachBatch(replace)
        .option("checkpointLocation", f"{path}-checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    return _or_empty(stream, path)


class _Versions:
    """A small table that every micro-batch replaces: one version per batch, of which the last stays. A
    batch that is repeated finds its own version, or starts from the one before."""

    def __init__(self, spark: SparkSession, path: str, schema: str) -> None:
        self.spark, self.path, self.schema = spark, path, schema

    def read(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], f"{self.schema}, batch BIGINT")
        return self.spark.read.schema(f"{self.schema}, batch BIGINT").parquet(self.path)

    def has(self, batch: int) -> bool:
        return is_complete(self.spark, f"{self.path}/batch={batch}")

    def write(self, rows: DataFrame, batch: int) -> None:
        rows.drop("batch").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def forget_before(self, batch: int) -> None:
        for row in self.read().select("batch").distinct().collect():
            if row["batch"] < batch:
                delete(self.spark, f"{self.path}/batch={row['batch']}")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)


def latest_to_table(stream: DataFrame, order: str, rows: int = 300, label: str = "latest", path: str | None = None) -> DataFrame:
    """The ``rows`` rows of a stream with the largest ``order`` so far. A micro-batch merges its own
    latest rows with those kept; nothing else is ever stored, and each task passes on its own latest
    rows only."""
    spark = stream.sparkSession
    path = path or fresh_path(spark, label)
    kept = _Versions(spark, path, _ddl(stream))

    def merge(batch: DataFrame, number: int) -> None:
        if not kept.has(number):
            before = kept.read().where(F.col("batch") < number).drop("batch")
            newest = batch.orderBy(F.desc(order)).limit(rows).unionByName(before)
            kept.write(newest.orderBy(F.desc(order)).limit(rows), number)
        kept.forget_before(number)

    push(stream, merge, path=f"{path}-run")
    return kept.read().drop("batch")


def hours_with_late(events: DataFrame, late_by: str, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Customers and reorders per hour, each hour closed ``late_by`` after its end, and the events that
    came after their hour was closed: (hours, late events). Nothing is dropped, so the events of the
    hours and the late ones are all events.

    An event is late if its hour was closed by the latest time seen in earlier micro-batches. Only open
    hours are state; a closed hour is written once, by the batch that closes it. Hours that are still
    open when the stream has taken in everything are among the hours with ``closed`` false.
    """
    spark = events.sparkSession
    path = path or fresh_path(spark, "hours")
    sums = "hour_start TIMESTAMP_NTZ, customers BIGINT, reorders BIGINT, events BIGINT, latest TIMESTAMP_NTZ"
    open_ = _Versions(spark, f"{path}-open", sums)
    counted = [F.sum(c).alias(c) for c in ("customers", "reorders", "events")]

    def closed_by(latest: Column) -> Column:
        return F.col("hour_start") + F.expr("INTERVAL 1 HOUR") <= latest - F.expr(f"INTERVAL {late_by}")

    def advance(batch: DataFrame, number: int) -> None:
        if open_.has(number):
            return
        batch = stage(batch.withColumn("hour_start", F.date_trunc("hour", "ts").cast("timestamp_ntz")), "events")
        before = open_.read().where(F.col("batch") < number).drop("batch")
        # One row of state carries the latest time seen; it is an hour of its own without events.
        seen = before.agg(F.max("latest").alias("latest")).first()["latest"]
        late = F.lit(False) if seen is None else F.coalesce(closed_by(F.lit(seen)), F.lit(False))
        batch.where(late).drop("hour_start").write.mode("overwrite").parquet(f"{path}-late/batch={number}")
        fresh = batch.where(~late).groupBy("hour_start").agg(
            F.count_if(F.col("type") == "transaction").alias("customers"),
            F.count_if(F.col("type") == "reorder").alias("reorders"),
            F.count(F.lit(1)).alias("events"),
            F.max("ts").cast("timestamp_ntz").alias("latest"),
        )
        merged = before.unionByName(fresh).groupBy("hour_start").agg(*counted, F.max("latest").alias("latest"))
        merged = stage(merged, "merged-hours")
        latest = merged.agg(F.max("latest").alias("latest")).first()["latest"]
        done = F.lit(False) if latest is None else F.coalesce(closed_by(F.lit(latest)), F.lit(False))
        # What has been closed stays closed: the row without an hour keeps the latest time.
        merged.where(done & (F.col("events") > 0)).write.mode("overwrite").parquet(f"{path}-closed/batch={number}")
        mark = spark.createDataFrame([(None, 0, 0, 0, latest)], sums)
        open_.write(merged.where(~done & F.col("hour_start").isNotNull()).unionByName(mark), number)
        open_.forget_before(number)

    push(events, advance, path=f"{path}-run")
    closed = _Versions(spark, f"{path}-closed", sums).read()
    still_open = open_.read().where("hour_start IS NOT NULL")
    hours = closed.withColumn("closed", F.lit(True)).unionByName(still_open.withColumn("closed", F.lit(False)))
    columns = ["hour_start", "customers", "reorders", "events", "closed"]
    late = _Versions(spark, f"{path}-late", _ddl(events)).read().drop("batch")
    return hours.select(*columns), late


def push(
    stream: DataFrame, sink: Sink | None, label: str = "push", path: str | None = None
) -> None:
    """Hand every micro-batch to ``sink``; without one nothing is run at all."""
    if sink is None:
        return
    path = path or fresh_path(stream.sparkSession, label)
    finish(
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", f"{path}-checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def stock_ledger(
    items: DataFrame, label: str = "stock", path: str | None = None, **ledger_options: object
) -> DataFrame:
    """Continue the stock ledger with every micro-batch of sale lines.

    The state is a table of what each product had reached before its last sale, and that sale, which
    is still open: lines of it that come later are added to it, and its row is written again. The
    result takes the last row of a sale. A line of a sale before the open one ends the stream with an
    error, as rows after it would have to change. A batch reads the version before it and writes
    its own ledger rows and version, so a repeated batch overwrites exactly what it wrote; the version
    before that is deleted. Inside a batch the ledger is the same set-based plan as over a whole
    table: a product on a third of the lines is split over many tasks, which state keyed by product
    could not do.
    """
    spark = items.sparkSession
    root = path or fresh_path(spark, label)
    state_schema = (
        "product_id BIGINT, units_sold BIGINT, reorders BIGINT, open_sale BIGINT, open_quantity BIGINT"
    )
    rows_schema = (
        "product_id BIGINT, transaction_id BIGINT, quantity BIGINT, units_sold BIGINT, reorders BIGINT, "
        "reordered BOOLEAN, stock_on_hand BIGINT"
    )

    def advance(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        if number == 0:
            state = session.createDataFrame([], state_schema)
        else:  # reading fails rather than starts over if the version before is gone
            state = session.read.schema(state_schema).parquet(f"{root}/state/batch={number - 1}")
        open_sales = state.select(F.col("product_id").alias("_of"), "open_sale")
        arrived = batch.join(open_sales, F.col("product_id") == F.col("_of"), "left")
        late = F.when(
            F.col("transaction_id") < F.col("open_sale"),
            F.raise_error(F.lit("a sale line out of order")),
        ).otherwise(F.col("transaction_id"))
        arrived = arrived.select("product_id", late.alias("transaction_id"), "quantity")
        reopened = state.join(batch.select("product_id"), "product_id", "left_semi").select(
            "product_id",
            F.col("open_sale").alias("transaction_id"),
            F.col("open_quantity").alias("quantity"),
        )
        rows_path = f"{root}/ledger/batch={number}"
        inventory.ledger(arrived.unionByName(reopened), state=state, **ledger_options).write.mode(
            "overwrite"
        ).parquet(rows_path)
        reached = session.read.schema(rows_schema).parquet(rows_path)
        last = reached.groupBy("product_id").agg(F.max_by(F.struct("*"), "transaction_id").alias("r"))
        last = last.select(
            "product_id",
            (F.col("r.units_sold") - F.col("r.quantity")).alias("units_sold"),
            (F.col("r.reorders") - F.col("r.reordered").cast("int")).alias("reorders"),
            F.col("r.transaction_id").alias("open_sale"),
            F.col("r.quantity").alias("open_quantity"),
        )
        untouched = state.join(last.select("product_id"), "product_id", "left_anti")
        last.unionByName(untouched).write.mode("overwrite").parquet(f"{root}/state/batch={number}")
        if number > 1:
            delete(session, f"{root}/state/batch={number - 2}")

    finish(
        items.writeStream.foreachBatch(advance)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    if not path_exists(spark, f"{root}/ledger"):
        return spark.createDataFrame([], f"{rows_schema}, batch INT")
    rows = spark.read.schema(f"{rows_schema}, batch INT").parquet(f"{root}/ledger")
    return rows.groupBy("product_id", "transaction_id").agg(
        *[F.max_by(c, "batch").alias(c) for c in rows.columns[2:]]
    )


def low_stock_alerts(stock: DataFrame) -> DataFrame:
    """Ledger rows on which stock ran low and an order was placed."""
    return stock.where(F.col("reordered")).select(
        "product_id", "transaction_id", "units_sold", "reorders", "stock_on_hand"
    )


def stream_table(
    spark: SparkSession, folder: str, like: DataFrame, files: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """A stream over the parquet files of a folder whose names match ``files``."""
    reader = spark.readStream.schema(like.schema).option("pathGlobFilter", files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)
