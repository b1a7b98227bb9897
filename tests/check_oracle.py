"""Run the named queries next to their SQL: ``python tests/check_oracle.py [sf] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from weftline.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(columns, rows):
    """Rows as tuples in column-name order, sorted."""
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in places) for row in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    df = queries()[name](spark, sf_dir)
    start = time.time()
    got = rows_of(df.columns, [tuple(row) for row in df.collect()])
    spark_time = time.time() - start
    sql = oracle_sql().get(name)
    if sql is None:
        return True, f"no SQL, {len(got)} rows, {spark_time:.1f}s"
    start = time.time()
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    note = f"{len(got)} rows, spark {spark_time:.1f}s, duckdb {time.time() - start:.1f}s"
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    sql_types = {d[0]: SPARK_TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    if types != sql_types:
        return False, f"types {types} against {sql_types}"
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} against {sorted(columns)}"
    if got != want:
        only_got = [r for r in got if r not in set(want)][:3]
        only_want = [r for r in want if r not in set(got)][:3]
        return False, f"{note}; {len(want)} expected\n   spark only {str(only_got)[:600]}\n   duckdb only {str(only_want)[:600]}"
    return True, f"{note} {types}"


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(queries())
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(
        master="local[8]", spark_sql_shuffle_partitions=8, spark_ui_enabled="false", spark_driver_memory="12g",
        spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = []
    for name in names:
        begin = time.time()
        try:
            good, note = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            good, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print("ok  " if good else "BAD ", name, f"[{time.time() - begin:.1f}s]", note, flush=True)
        if not good:
            bad.append(name)
    print(f"{len(names) - len(bad)} of {len(names)} agree", bad)
