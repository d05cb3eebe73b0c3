"""Run registered queries against their SQL: `python -m checks.compare [folder] [query ...]`."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from .oracles import ORACLES
from .queries import QUERIES


def local_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _sorted(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows[sorted(rows.columns)]
    for name in rows.columns:
        if str(rows[name].dtype).startswith("datetime64"):
            rows = rows.assign(**{name: rows[name].astype("datetime64[us]")})
    return rows.sort_values(list(rows.columns), ignore_index=True)


def differences(got: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """How a result differs from its SQL: names, types, row count, values (exactly)."""
    relation = con.sql(sql)
    if sorted(got.columns) != sorted(relation.columns):
        return [f"columns {sorted(got.columns)} != {sorted(relation.columns)}"]
    same = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
    }
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    found = [
        f"type of {name}: {kind} != {kinds[name]}" for name, kind in got.dtypes if same.get(kind) != kinds[name]
    ]
    mine, other = _sorted(got.toPandas()), _sorted(relation.df())
    if len(mine) != len(other):
        return [*found, f"rows {len(mine)} != {len(other)}"]
    try:
        pd.testing.assert_frame_equal(mine, other, check_dtype=False, check_exact=True)
    except AssertionError as error:
        found.append(" ".join(str(error).split())[:400])
    return found


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(), tables(sf_dir)
    for name in sys.argv[2:] or QUERIES:
        begin = time.perf_counter()
        try:
            result = QUERIES[name](spark, sf_dir)
            found = differences(result, con, ORACLES[name]) if name in ORACLES else [f"{result.count()} rows, no SQL"]
        except Exception as error:  # noqa: BLE001
            found = [" ".join(str(error).split())[:600]]
        print(f"{name:30} {time.perf_counter() - begin:6.2f}s {'ok' if not found else found}", flush=True)


if __name__ == "__main__":
    main()
