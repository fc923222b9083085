"""Compare registered queries with their SQL on one data folder.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    """Rows as comparable text, columns by name, order-insensitive."""
    frame = frame[sorted(frame.columns)]

    def text(value) -> str:
        if value is None or value is pd.NaT or value is pd.NA or value != value:
            return "NULL"
        if hasattr(value, "isoformat"):
            return pd.Timestamp(value).isoformat()
        if hasattr(value, "item"):
            value = value.item()
        return repr(value)

    return sorted(tuple(text(v) for v in row) for row in frame.astype(object).itertuples(index=False))


def whole(table) -> pd.DataFrame:
    """All values as they are: a column of whole numbers stays one beside NULLs."""
    return pd.DataFrame({n: pd.Series(table.column(n).to_pylist(), dtype=object) for n in table.column_names})


def difference(spark, con, name: str, run, sql: str, folder: str) -> str | None:
    """None when equal, otherwise what differs."""
    got = whole(run(spark, folder).toArrow())
    want = whole(con.execute(sql).to_arrow_table())
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    left, right = rows(got), rows(want)
    if left == right:
        return None
    a, b = set(left) - set(right), set(right) - set(left)
    return (
        f"rows {len(left)} != {len(right)}; only spark {len(a)} {sorted(a)[:2]}; "
        f"only sql {len(b)} {sorted(b)[:2]}"
    )


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles = duck(folder), entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = difference(spark, con, name, run, oracles[name], folder)
                state = "ok" if problem is None else f"DIFF {problem}"
            else:
                state = f"rows only: {run(spark, folder).count()}"
        except Exception as error:  # report and go on
            state = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        bad += state.startswith(("DIFF", "ERROR"))
        print(f"{name:34s} {time.time() - start:6.2f}s  {state}", flush=True)
    print("unknown oracles:", sorted(set(oracles) - set(entry.queries())), "bad:", bad)


if __name__ == "__main__":
    main()
