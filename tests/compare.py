"""Compare registered queries with their SQL: python tests/compare.py SF_DIR [NAME-PREFIX...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def oracle(sf_dir: str):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for p in sorted(Path(sf_dir).glob("*.parquet")):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return c


def plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{v:.6f}"
    if type(v).__name__ == "Decimal":
        return f"{float(v):.6f}" if v != int(v) else str(int(v))
    return str(v)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, x or "") for x in t))


def differences(spark, name: str, query, sql: str | None, sf_dir: str) -> str:
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return f"rows only: {len(got)}"
    res = oracle(sf_dir).execute(sql)
    columns = [d[0] for d in res.description]
    want = rows_of(columns, res.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} != {sorted(columns)}"
    if got != want:
        a, b = set(got), set(want)
        return f"DIFFER {len(got)} rows, SQL {len(want)}; only Spark {sorted(a - b, key=str)[:3]}, only SQL {sorted(b - a, key=str)[:3]}"
    return f"equal: {len(got)}"


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    import __spark_entry__ as e

    spark, sql = session(), e.oracle_sql()
    for name, q in e.queries().items():
        if len(sys.argv) < 3 or any(name.startswith(p) for p in sys.argv[2:]):
            t = time.time()
            try:
                said = differences(spark, name, q, sql.get(name), sys.argv[1])
            except Exception as x:
                said = f"ERROR {type(x).__name__} {str(x)[:600]}"
            print(f"{name}: {said} ({time.time() - t:.1f} s)", flush=True)
