"""Run catalogue queries in Spark and their SQL twins in DuckDB and compare.

Usable from pytest and from the command line::

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# DuckDB type -> Spark simpleString
TYPE_MAP = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "FLOAT": "float",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9) + 0.0
    return v


def _rows(cols: list[str], rows) -> Counter:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, name: str, build, sql: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    df = build(spark, sf_dir)
    spark_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    duck_rows = rel.fetchall()
    t2 = time.time()
    s_cols = df.columns
    d_cols = rel.columns
    s_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    d_types = {c: TYPE_MAP.get(str(t), str(t)) for c, t in zip(d_cols, rel.types)}
    result = {
        "name": name,
        "spark_rows": len(spark_rows),
        "oracle_rows": len(duck_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "types_match": s_types == d_types,
        "values_match": _rows(s_cols, spark_rows) == _rows(list(d_cols), duck_rows),
        "spark_sec": round(t1 - t0, 2),
        "oracle_sec": round(t2 - t1, 2),
    }
    result["ok"] = (
        result["columns_match"] and result["types_match"] and result["values_match"]
        and result["spark_rows"] == result["oracle_rows"]
    )
    if not result["ok"]:
        result["spark_types"] = s_types
        result["oracle_types"] = d_types
        a, b = _rows(s_cols, spark_rows), _rows(list(d_cols), duck_rows)
        result["only_spark"] = list((a - b).items())[:5]
        result["only_oracle"] = list((b - a).items())[:5]
    return result


def main(argv: list[str]) -> int:
    import json

    import __spark_entry__ as entry
    from encore.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    queries, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(queries):
        if name not in sqls:
            t0 = time.time()
            n = queries[name](spark, sf_dir).count()
            print(json.dumps({"name": name, "rows_only": n, "sec": round(time.time() - t0, 2)}), flush=True)
            continue
        try:
            res = compare(spark, sf_dir, name, queries[name], sqls[name], con)
        except Exception as exc:  # report and go on
            res = {"name": name, "ok": False, "error": repr(exc)[:2000]}
        bad += not res["ok"]
        print(json.dumps(res, default=str), flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
