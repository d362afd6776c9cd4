"""Readers and writers for the file shapes a shop exchanges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions import labels
from tallyhouse.schemas import OPERATIONAL, STAR, Tables


def read_headerless_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV without header. Types come from ``schema``, never from a pass over the data;
    booleans may be spelled t/f or True/False."""
    flags = {f.name for f in schema if isinstance(f.dataType, T.BooleanType)}
    raw = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in flags else f.dataType) for f in schema]
    )
    df = spark.read.schema(raw).option("header", False).option("mode", "FAILFAST").csv(path)

    def flag(name: str) -> Column:
        """The flag; unknown text ends the job like any other malformed value."""
        text, known = F.col(name), labels.flag_from_text(F.col(name))
        unknown = F.raise_error(F.concat(F.lit(f"not a flag in {name}: "), text))
        return F.when(text.isNotNull() & known.isNull(), unknown).otherwise(known).alias(name)

    return df.select(*[flag(f.name) if f.name in flags else F.col(f.name) for f in schema])


def write_headerless_csv(df: DataFrame, path: str) -> None:
    """The export the reader above takes back: t/f booleans, empty text for NULL."""
    cols = [
        F.when(F.col(f.name), "t").when(~F.col(f.name), "f").alias(f.name)
        if isinstance(f.dataType, T.BooleanType)
        else F.col(f.name)
        for f in df.schema
    ]
    df.select(*cols).write.option("header", False).csv(path)


def read_star_csv(spark: SparkSession, folder: str) -> Tables:
    """All star tables from ``<folder>/<table>`` headerless CSV."""
    return {name: read_headerless_csv(spark, f"{folder}/{name}", s) for name, s in STAR.items()}


def write_tables(tables: Tables, folder: str) -> None:
    """Tables as ``<folder>/<table>`` in Parquet, each appended to what is there."""
    for name, df in tables.items():
        df.write.mode("append").parquet(f"{folder}/{name}")


def read_operational_parquet(spark: SparkSession, folder: str) -> Tables:
    return {
        name: spark.read.schema(schema).parquet(f"{folder}/{name}")
        for name, schema in OPERATIONAL.items()
    }


def read_operational_jdbc(
    spark: SparkSession, url: str, properties: dict[str, str], rows_per_task: int = 1_000_000
) -> Tables:
    """The operational tables over JDBC. The two tables that grow with sales are read in id ranges
    by many tasks; their bounds are one-row queries the database answers."""
    shift_hours = """(SELECT id, name, role,
        CAST(extract(hour FROM shift_start) AS INT) AS shift_start_hour,
        CAST(extract(hour FROM shift_end) AS INT) AS shift_end_hour FROM employees) AS e"""

    def read(name: str) -> DataFrame:
        if name not in ("transactions", "transaction_items"):
            source = shift_hours if name == "employees" else name
            return spark.read.jdbc(url, source, properties=properties)
        bounds = spark.read.jdbc(
            url, f"(SELECT min(id) AS lo, max(id) AS hi FROM {name}) AS b", properties=properties
        ).first()
        if bounds is None or bounds["lo"] is None:
            return spark.read.jdbc(url, name, properties=properties)
        low, high = bounds["lo"], bounds["hi"] + 1
        return spark.read.jdbc(
            url,
            name,
            column="id",
            lowerBound=low,
            upperBound=high,
            numPartitions=max(1, (high - low) // rows_per_task),
            properties=properties,
        )

    return {
        name: read(name).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        for name, schema in OPERATIONAL.items()
    }


# The pieces of an INSERT dump. A text in apostrophes doubles those it contains; one
# written as E'...' has its line breaks and backslashes escaped.
_TEXT = r"[Ee]?'(?:[^']++|'')*+'"
_TUPLE = rf"\((?:{_TEXT}|[^'()])*\)"
_HEAD = r"(?i)^\s*INSERT\s+INTO\s+[^\s(]+\s*(?:\([^()']*\))?\s*VALUES"
_VALUE = rf"{_TEXT}|[^,\s'](?:[^,']*[^,\s'])?"


def read_insert_dump(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of a dump of multi-row INSERT ... VALUES statements for one table.

    Lines are parsed independently by all tasks: a line may hold the head of a statement, any number
    of whole tuples, or both; blank lines and ``--`` comments are skipped. Anything else, such as a
    clause after the tuples or a tuple broken over lines, ends the job with an error, and so does a
    tuple of another length or a value that its column does not take. A quoted text is a text, also
    if it reads NULL.
    """
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^\s*(--.*)?$"))
    line = F.col("value")
    body = F.regexp_replace(line, _HEAD, "")
    rest = F.regexp_replace(body, _TUPLE, "")
    refused = F.raise_error(F.concat(F.lit("not a statement of rows: "), line))
    tuples = F.when(
        rest.rlike(r"^[\s,;]*$"), F.regexp_extract_all(body, F.lit(f"({_TUPLE})"), F.lit(1))
    ).otherwise(refused)
    return rows_of_tuples(lines.select(F.explode(tuples).alias("tuple")), schema)


def rows_of_tuples(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The values of texts like ``(1,'a')`` as columns."""
    inner = F.expr("substring(tuple, 2, length(tuple) - 2)")
    values = F.regexp_extract_all(inner, F.lit(f"({_VALUE})"), F.lit(1))
    short = F.raise_error(F.concat(F.lit("a tuple of another length: "), F.col("tuple")))
    rows = rows.select(F.when(F.size(values) == len(schema), values).otherwise(short).alias("v"))
    return rows.select(
        *[_from_literal(F.col("v")[i]).cast(f.dataType).alias(f.name) for i, f in enumerate(schema)]
    )


def _from_literal(value: Column) -> Column:
    """The text of an SQL literal; null for the keyword."""
    plain = F.regexp_replace(value, r"^[Ee]?'|'$", "")
    plain = F.replace(plain, F.lit("''"), F.lit("'"))
    mark = F.lit("\x00")
    unescaped = F.replace(plain, F.lit("\\\\"), mark)
    for escape, character in (("\\n", "\n"), ("\\r", "\r")):
        unescaped = F.replace(unescaped, F.lit(escape), F.lit(character))
    unescaped = F.replace(unescaped, mark, F.lit("\\"))
    return (
        F.when(F.upper(value) == "NULL", F.lit(None).cast("string"))
        .when(value.rlike("^[Ee]'"), unescaped)
        .when(value.startswith("'"), plain)
        .otherwise(value)
    )


def write_insert_dump(df: DataFrame, path: str, table: str) -> None:
    """The dump the reader above takes back, one statement of one tuple per row, so that every
    task writes valid statements on its own."""

    def literal(field: T.StructField) -> Column:
        text = F.col(field.name).cast("string")
        if isinstance(field.dataType, T.StringType):
            quoted = F.replace(text, F.lit("'"), F.lit("''"))
            escaped = F.replace(quoted, F.lit("\\"), F.lit("\\\\"))
            for character, escape in (("\n", "\\n"), ("\r", "\\r")):
                escaped = F.replace(escaped, F.lit(character), F.lit(escape))
            text = F.when(text.rlike(r"[\n\r]"), F.concat(F.lit("E'"), escaped, F.lit("'"))).otherwise(
                F.concat(F.lit("'"), quoted, F.lit("'"))
            )
        elif not isinstance(field.dataType, T.NumericType):
            text = F.concat(F.lit("'"), text, F.lit("'"))
        return F.coalesce(text, F.lit("NULL"))

    head = F.lit(f"INSERT INTO {table} ({','.join(df.columns)}) VALUES\n\t (")
    row = F.concat_ws(",", *[literal(f) for f in df.schema])
    df.select(F.concat(head, row, F.lit(");")).alias("value")).write.text(path)


def register_views(tables: Tables, prefix: str = "") -> None:
    """Make every frame of a name-to-frame registry queryable by SQL text."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")


def seeded_sample(df: DataFrame, key: str, rows: int, seed: int) -> DataFrame:
    """``rows`` rows picked at random but repeatably: the smallest digests of key and seed. Each
    task keeps only its own smallest rows, so nothing but those is shuffled."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")))
    return df.orderBy(digest, key).limit(rows)
