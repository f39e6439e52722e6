"""Run registered queries and their SQL side by side: ``python tests/compare.py <sf_dir> [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def canonical(columns, rows):
    """Rows with columns in name order, as text, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, con, name, query, sql, sf_dir):
    """None if both sides agree, else a short description."""
    frame = query(spark, sf_dir)
    ours = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    theirs = canonical([d[0] for d in cursor.description], cursor.fetchall())
    if ours == theirs:
        return None, len(ours[1])
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} against {theirs[0]}", len(ours[1])
    mine, other = set(ours[1]) - set(theirs[1]), set(theirs[1]) - set(ours[1])
    return (
        f"{len(ours[1])} rows against {len(theirs[1])}; {ours[0]}\n  only here {sorted(mine)[:3]}\n"
        f"  only in SQL {sorted(other)[:3]}"
    ), len(ours[1])


if __name__ == "__main__":
    import __spark_entry__ as contract
    from pulseframe.session import monitoring_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = monitoring_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = duck(sf_dir), contract.oracle_sql(), []
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            found, rows = differences(spark, con, name, query, sqls[name], sf_dir)
        except Exception as error:  # noqa: BLE001 - the loop goes on to the next query
            found, rows = f"{type(error).__name__}: {str(error)[:900]}", 0
        print(f"{'ok  ' if found is None else 'DIFF'} {name} rows={rows} {time.time() - start:.1f}s", found or "", flush=True)
        failed += [name] if found else []
    print("failed:", failed)
