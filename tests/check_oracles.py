"""Compare registered queries with their DuckDB SQL: ``python -m tests.check_oracles sf_dir [name ...]``."""

from __future__ import annotations

import contextlib
import decimal
import io
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

import __spark_entry__ as entry
from workload.inputs import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return round(float(value), 6)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def plan(df: DataFrame) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


TYPES = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


def compare(df: DataFrame, con, name: str) -> str:
    """Empty when both results are equal, else what differs."""
    got = rows_of(df.columns, df.collect())
    result = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    expected = rows_of(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    types = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    if dict(df.dtypes) != types:
        return f"types {sorted(set(df.dtypes) ^ set(types.items()))}"
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}: {got[:2]} / {expected[:2]}"
    for a, b in zip(got, expected):
        if a != b:
            return f"{a} != {b}"
    return "" if got else "no rows"


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    for name in names:
        start = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            if name in entry.oracle_sql():
                problem = compare(df, con, name)
            else:
                problem = "" if df.count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        print(f"{name:26} {time.time() - start:6.1f}s {'ok' if not problem else 'DIFFERS ' + problem}", flush=True)


if __name__ == "__main__":
    main()
