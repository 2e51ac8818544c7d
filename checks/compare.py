"""Run every query and its SQL side by side: ``python -m checks.compare [sf_dir] [name ...]``."""

import glob
import math
import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def _plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def _rows(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted(
        (tuple(_plain(row[k]) for k in order) for row in rows), key=lambda r: [(v is None, v) for v in r]
    )


def compare(spark: SparkSession, connection, sf: str, name: str) -> str:
    """Empty if the query gives the rows and types of its SQL, else what differs."""
    df = QUERIES[name](spark, sf)
    ours = _rows(df.columns, df.collect())
    if name not in ORACLES:
        return "" if ours[1] else "no rows"
    result = connection.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    theirs = _rows(columns, result.fetchall())
    names = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN", "double": "DOUBLE"}
    types = [f"{c}: {k} / {kinds.get(c)}" for c, k in df.dtypes if names.get(k, k) != kinds.get(c)]
    if types:
        return f"types {types}"
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if ours[1] != theirs[1]:
        wrong = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b][:2]
        return f"rows {len(ours[1])} / {len(theirs[1])}, first differences {wrong}"
    return ""


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf)
    failed = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            wrong = compare(spark, connection, sf, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            wrong = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(wrong)
        print(f"{'FAIL' if wrong else 'ok  '} {name:32s} {time.time() - start:6.2f}s {wrong}", flush=True)
    print(f"{failed} failed")
    spark.stop()


if __name__ == "__main__":
    main()
