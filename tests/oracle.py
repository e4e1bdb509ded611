"""Run the registered queries beside their oracle SQL and compare the results.

    python tests/oracle.py [sf directory] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def kind(name: str) -> str:
    """One name for a column type in both engines."""
    same = {
        "bigint": "int64", "int": "int32", "integer": "int32", "double": "double", "string": "text", "varchar": "text",
        "boolean": "bool", "date": "date", "float": "float",
    }
    return same.get(name.lower(), name.lower())


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def table(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark_df, con, sql: str) -> list[str]:
    """What is not equal: column names, types, row count or values."""
    result = con.execute(sql)
    theirs = [d[0] for d in result.description]
    their_types = {d[0]: kind(str(d[1])) for d in result.description}
    their_rows = result.fetchall()
    ours = spark_df.columns
    our_types = {n: kind(t) for n, t in spark_df.dtypes}
    our_rows = [tuple(r) for r in spark_df.collect()]
    found = []
    if sorted(ours) != sorted(theirs):
        return [f"columns {sorted(ours)} <> {sorted(theirs)}"]
    for name in ours:
        if our_types[name] != their_types[name]:
            found.append(f"type of {name}: {our_types[name]} <> {their_types[name]}")
    if len(our_rows) != len(their_rows):
        found.append(f"rows {len(our_rows)} <> {len(their_rows)}")
    a, b = table(ours, our_rows), table(theirs, their_rows)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first:\n    {str(wrong[0][0])[:600]}\n    {str(wrong[0][1])[:600]}")
    return found


def main() -> int:
    import __spark_entry__ as registered
    from ledgerlens.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session(cores=8)
    con = connect(sf_dir)
    oracle = registered.oracle_sql()
    bad = 0
    for name, run in registered.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracle:
                found = differences(df, con, oracle[name])
                verdict = "ok" if not found else "DIFFERENT " + "; ".join(found)
            else:
                rows = df.collect()
                found = [] if rows else ["no rows"]
                verdict = f"{len(rows)} rows, no oracle" + (f": {rows[:30]}" if names else "")
        except Exception as error:
            found = [str(error)]
            verdict = f"FAILED {type(error).__name__}: {str(error)[:1500]}"
        bad += bool(found)
        print(f"{name:26s} {time.time() - start:7.2f}s  {verdict}", flush=True)
    print(f"{bad} not as expected")
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
