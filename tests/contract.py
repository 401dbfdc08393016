"""Run registered queries against their SQL in the checking database.

``python -m tests.contract [query ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rowsmith")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


def rows_of(df: DataFrame) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    rows = df.select(*[f"`{c}`" for c in names]).collect()
    return names, Counter(tuple((type(v).__name__, plain(v)) for v in row) for row in rows)


def sql_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = Counter(
        tuple((type(row[i]).__name__, plain(row[i])) for i in order) for row in result.fetchall()
    )
    return [columns[i] for i in order], rows


def compare(spark, con, folder: str, name: str, run, sql: str) -> str | None:
    """None where both agree, else a short account of the difference."""
    names, ours = rows_of(run(spark, folder))
    theirs_names, theirs = sql_rows(con, sql)
    if names != theirs_names:
        return f"columns {names} vs {theirs_names}"
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        return (
            f"{sum(ours.values())} vs {sum(theirs.values())} rows; extra "
            f"{list(extra.items())[:2]}; missing {list(missing.items())[:2]}"
        )
    return None


if __name__ == "__main__":
    import __spark_entry__ as contract

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.01")
    spark, con = session(), database(folder)
    oracles = contract.oracle_sql()
    failed = 0
    for name, run in contract.queries().items():
        if sys.argv[1:] and name not in sys.argv[1:]:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, folder, name, run, oracles[name])
            else:
                problem = None
                print(f"{name}: {sum(rows_of(run(spark, folder))[1].values())} rows, no SQL")
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print("failed:", failed)
