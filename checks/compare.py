"""Run registered queries in Spark and DuckDB and compare row sets.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from checks.queries import ORACLES, QUERIES


def duckdb_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(frame: pd.DataFrame) -> tuple[list[str], list[tuple[str, ...]]]:
    """Columns by name, rows as text in sorted order."""
    columns = sorted(frame.columns)
    text = frame[columns].astype(object).where(frame[columns].notna(), None)
    return columns, sorted(
        tuple(str(int(v)) if isinstance(v, float) and v.is_integer() else str(v) for v in row)
        for row in text.itertuples(index=False, name=None)
    )


def difference(result: DataFrame, con: duckdb.DuckDBPyConnection, name: str) -> str | None:
    """None if both engines agree, else what differs."""
    columns, rows = canonical(result.toPandas())
    if name not in ORACLES:
        return None if rows else "no rows"
    other_columns, other = canonical(con.sql(ORACLES[name]).df())
    if columns != other_columns:
        return f"columns {columns} against {other_columns}"
    if rows != other:
        mine, theirs = set(rows) - set(other), set(other) - set(rows)
        return f"{len(rows)} rows against {len(other)}; {list(mine)[:3]} / {list(theirs)[:3]}"
    return None if rows else "no rows on either side"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb_connection(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            found = difference(QUERIES[name](spark, sf_dir), con, name)
        except Exception as e:  # noqa: BLE001 - reported per query
            found = f"{type(e).__name__}: {str(e)[:600]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
