"""Compare registered queries with their SQL on DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        v = float(v)
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


_FAMILY = {"INTEGER": "int", "BIGINT": "int", "SMALLINT": "int", "TINYINT": "int", "HUGEINT": "huge", "VARCHAR": "str", "BOOLEAN": "bool", "DOUBLE": "float", "FLOAT": "float"}
_SPARK = {"int": "int", "bigint": "int", "smallint": "int", "string": "str", "boolean": "bool", "double": "float", "float": "float"}


def compare(spark, con, sf_dir, run, sql) -> str:
    """Empty text if both agree, else what differs."""
    return compare_df(run(spark, sf_dir), con, sql)


def compare_df(df, con, sql) -> str:
    rows = df.collect()
    if sql is None:
        return "" if df.columns else "no columns"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    types = {d[0]: _FAMILY.get(str(d[1]), str(d[1])) for d in result.description}
    expected = result.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    for name, kind in df.dtypes:
        if _SPARK.get(kind, kind) != types[name]:
            return f"type of {name}: {kind} / {types[name]}"
    a, b = bag(df.columns, rows), bag(columns, expected)
    if a != b:
        return f"{len(rows)} / {len(expected)} rows; only Spark {list((a - b).items())[:3]}; only SQL {list((b - a).items())[:3]}"
    return "" if rows else "EMPTY"


def main(names: list[str], sf_dir: str, block: str = "65536") -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from gridloom.queries.registry import load
    from gridloom.session import local_session

    spark = local_session(cores=8, spark__sql__shuffle__partitions="8", spark__ui__showConsoleProgress="false", spark__gridloom__blockRows=block)
    con = connect(sf_dir)
    queries, sql = load()
    bad = 0
    for name in names or list(queries):
        begin = time.time()
        try:
            problem = compare(spark, con, sf_dir, queries[name], sql.get(name))
        except Exception as e:
            problem = f"{type(e).__name__} {str(e)[:1500]}"
        bad += bool(problem)
        mark = "ok " if not problem else "BAD"
        print(f"{mark} {name:32s} {time.time() - begin:6.2f}s {'' if name in sql else 'rows only'} {problem}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sf = next((a for a in sys.argv[1:] if a.startswith("/")), "/root/testdata/sf0.01")
    block = next((a.split("=")[1] for a in sys.argv[1:] if a.startswith("block=")), "65536")
    sys.exit(main([a for a in sys.argv[1:] if not a.startswith("/") and "=" not in a], sf, block))
