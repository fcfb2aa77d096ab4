"""Run registered queries next to their SQL in DuckDB and compare all rows."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

# how DuckDB names what Spark's simple types hold
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _sorted_rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(df, con, sql: str) -> list[str]:
    """What differs between the Spark frame and the SQL result; empty when nothing does."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    problems = [
        f"type of {f.name}: {f.dataType.simpleString()} != {types[f.name]}"
        for f in df.schema.fields
        if SAME_TYPE.get(f.dataType.simpleString()) != types[f.name]
    ]
    ours, theirs = _sorted_rows(df.collect(), df.columns), _sorted_rows(result.fetchall(), names)
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    wrong = [(a, b) for a, b in zip(ours, theirs, strict=False) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first ({sorted(names)}): {wrong[0][0]} != {wrong[0][1]}")
    return problems


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for name, build in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = build(spark, sf)
            problems = differences(df, con, entry.oracle_sql()[name])
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        print(f"{time.time() - start:7.2f}s {name}: {'ok' if not problems else problems}", flush=True)
