"""Run registered queries in Spark and their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def plain(value):
    """A value in a form that both engines share."""
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def close(a: tuple, b: tuple) -> bool:
    return all(
        x == y or (isinstance(x, (int, float)) and isinstance(y, (int, float)) and math.isclose(x, y, rel_tol=1e-9))
        for x, y in zip(a, b)
    )


def compare(spark, connection, name: str, fn, sql: str, folder: str) -> tuple[str, str]:
    """(verdict, detail): EXACT, CLOSE (float noise) or DIFF."""
    df = fn(spark, folder)
    found = canonical(df.columns, df.collect())
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    wanted = canonical(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return "DIFF", f"columns {sorted(df.columns)} against {sorted(columns)}"
    if len(found) != len(wanted):
        return "DIFF", f"{len(found)} rows against {len(wanted)}"
    if not found:
        return "DIFF", "no rows"
    if found == wanted and repr(found) == repr(wanted):
        return "EXACT", f"{len(found)} rows"
    off = [(a, b) for a, b in zip(found, wanted) if repr(a) != repr(b)]
    verdict = "CLOSE" if all(close(a, b) for a, b in zip(found, wanted)) else "DIFF"
    return verdict, f"{len(off)} of {len(found)} rows, first {off[0][0]} against {off[0][1]}"


def main(folder: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from tidewright.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(folder)
    sqls = oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sqls:
                verdict, detail = compare(spark, connection, name, fn, sqls[name], folder)
            else:
                verdict, detail = "ROWS", f"{len(fn(spark, folder).collect())} rows"
        except Exception as problem:  # report every query
            verdict, detail = "ERROR", str(problem)[:900]
        bad += verdict not in ("EXACT", "ROWS")
        print(f"{verdict:6} {time.time() - start:6.2f}s {name}" + (f"  {detail}" if verdict not in ("EXACT",) else f"  {detail}"))
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
