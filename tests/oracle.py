"""Compare registered queries with their SQL in DuckDB.

    python tests/oracle.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (float(f"{value:.9g}"))
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, bool) or value is None or isinstance(value, (int, str)):
        return value
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr), sorted(names)


def compare(df, con, sql: str):
    """None when equal, else what differs."""
    got, got_names = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want, want_names = _rows(names, cursor.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}; e.g. {got[:1]} / {want[:1]}"
    for a, b in zip(got, want):
        if any(x != y or isinstance(x, bool) != isinstance(y, bool) for x, y in zip(a, b)):
            return f"row {a} != {b}"
    return None if got else "no rows on either side"


def main() -> int:
    import __spark_entry__ as contract
    from itemloom.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    spark = build_session("local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    oracle = contract.oracle_sql()
    for name, query in contract.queries().items():
        if name not in oracle or (wanted and name not in wanted):
            continue
        start = time.time()
        try:
            found = compare(query(spark, sf_dir), con, oracle[name])
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {'ok' if found is None else found[:900]}", flush=True)
    print(f"{bad} differences")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
