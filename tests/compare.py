"""Run registered queries against their SQL on the same tables.

python -m tests.compare [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
KINDS = {"tinyint": "int", "smallint": "int", "integer": "int", "bigint": "int", "hugeint": "huge", "double": "double",
         "float": "double", "varchar": "string", "string": "string", "timestamp_ntz": "timestamp"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def _kind(name: str) -> str:
    name = name.lower()
    return KINDS.get(name, name)


def difference(frame, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {r[0]: _kind(r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    expected = _bag(names, con.execute(sql).fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    mine = {f.name: _kind(f.dataType.simpleString()) for f in frame.schema}
    if mine != kinds:
        return "types " + str({c: (mine[c], kinds[c]) for c in mine if mine[c] != kinds[c]})
    got = _bag(frame.columns, (tuple(r) for r in frame.collect()))
    if got != expected:
        extra, missing = got - expected, expected - got
        return (f"rows {sum(got.values())} != {sum(expected.values())}; {sum(extra.values())} extra like "
                f"{list(extra)[:2]}; {sum(missing.values())} missing like {list(missing)[:2]}")
    return None if got else "no rows"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from parcelle.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="12g",
                          spark__checkpoint__dir=tempfile.mkdtemp(prefix="parcelle-compare-"))
    spark.sparkContext.setLogLevel("ERROR")
    con, runs, texts = connect(folder), queries(), oracle_sql()
    bad = 0
    for name in wanted or runs:
        start = time.time()
        try:
            frame = runs[name](spark, folder)
            if name in texts:
                problem = difference(frame, con, texts[name])
            else:
                n = frame.count()
                problem = None if n else "no rows"
                name += " (rows only)"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        took = time.time() - start
        if problem:
            bad += 1
        if problem or took > 5:
            print(f"{'FAIL' if problem else 'slow'} {name} {took:.1f}s {problem or ''}", flush=True)
    print(f"{len(wanted or runs)} queries, {bad} failed")


if __name__ == "__main__":
    main()
