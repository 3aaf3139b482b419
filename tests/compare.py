"""Runs registered queries in Spark and their SQL in DuckDB and compares the rows.

    python tests/compare.py [-d SF_DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value) if value % 1 else int(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, connection, run, sql: str | None, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    frame = run(spark, sf_dir)
    mine = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if sql is None:
        return None
    relation = connection.sql(sql)
    theirs = rows_of(relation.columns, relation.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} / {theirs[0]}"
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    for field in frame.schema.fields:
        pair = (field.dataType.simpleString(), kinds[field.name])
        if pair[0] in ("bigint", "int", "double", "string", "boolean") and pair not in (
            ("bigint", "BIGINT"), ("int", "INTEGER"), ("double", "DOUBLE"), ("string", "VARCHAR"), ("boolean", "BOOLEAN"),
        ):
            return f"type of {field.name}: {pair}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} / {len(theirs[1])}; first of ours {mine[1][:2]}, theirs {theirs[1][:2]}"
    wrong = [(a, b) for a, b in zip(mine[1], theirs[1]) if repr(a) != repr(b)]
    if wrong:
        return f"{len(wrong)} of {len(mine[1])} rows differ, columns {mine[0]}:\n   {str(wrong[0][0])[:600]}\n   {str(wrong[0][1])[:600]}"
    return None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("-d", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    import __spark_entry__ as entry
    from chatterlens.session import local_session

    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(options.d)
    oracles, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if options.names and not any(n in name for n in options.names):
            continue
        began = time.time()
        try:
            wrong = difference(spark, connection, run, oracles.get(name), options.d)
        except Exception as error:  # report and go on with the next query
            wrong = f"{type(error).__name__}: {str(error)[:900]}"
        bad += wrong is not None
        state = wrong or ("ok" if name in oracles else "ok (no SQL)")
        print(f"{name:32s} {time.time() - began:6.2f}s  {state}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
