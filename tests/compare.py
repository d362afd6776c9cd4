"""Run registered queries against their SQL on DuckDB and compare names, types and values."""

from __future__ import annotations

import sys
import time

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    rows = list(zip(*[table.column(n).to_pylist() for n in names])) if names else []
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def _types(table: pa.Table) -> dict[str, str]:
    plain = {"large_string": "string", "string_view": "string"}
    return {f.name: plain.get(str(f.type), str(f.type)) for f in table.schema}


def difference(got: pa.Table, want: pa.Table) -> str | None:
    if _types(got) != _types(want):
        pairs = set(_types(got).items()) ^ set(_types(want).items())
        return f"types differ: {sorted(pairs)}"
    a, b = _rows(got), _rows(want)
    if len(a) != len(b):
        return f"{len(a)} rows, expected {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"first difference: {x} != {y} ({sum(p != q for p, q in zip(a, b))} rows)"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    from tallyhouse import catalog

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    sqls = catalog.oracle_sql()
    bad = 0
    for name, run in catalog.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            got = run(spark, sf_dir).toArrow()
            took = time.time() - start
            if name not in sqls:
                print(f"{name:28s} {took:6.2f}s {got.num_rows} rows, no oracle", flush=True)
                continue
            want = con.sql(sqls[name]).to_arrow_table()
            problem = difference(got, want)
        except Exception as e:  # report and go on with the next query
            took, problem = time.time() - start, f"{type(e).__name__}: {str(e)[:600]}"
            got = None
        bad += problem is not None
        size = got.num_rows if got is not None else 0
        print(f"{name:28s} {took:6.2f}s {size:7d} {problem or 'ok'}", flush=True)
    print("problems:", bad)


if __name__ == "__main__":
    main()
