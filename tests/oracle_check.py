"""Compare registered Spark queries with their SQL oracle (DuckDB).

Usable from tests and from the command line:

    python tests/oracle_check.py /root/testdata/sf0.01 [query ...]

Results are brought to the test process only here, for comparison of small
test outputs; the library itself never collects.
"""

from __future__ import annotations

import math
import os
import sys
from datetime import datetime

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return ("nan",)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((v is None, "" if v is None else str(v)) for v in row)


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()),
                        key=_key)


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in order]
    rows = [tuple(_norm(r[i]) for i in order) for r in rel.fetchall()]
    return cols, sorted(rows, key=_key), rel.types


def compare(spark, sf_dir: str, names=None) -> dict[str, dict]:
    import __spark_entry__ as entry
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        df = qs[name](spark, sf_dir)
        s_cols, s_rows = rows_of_spark(df)
        res = {"spark_rows": len(s_rows)}
        if name in sqls:
            d_cols, d_rows, _ = rows_of_duck(con, sqls[name])
            res["oracle_rows"] = len(d_rows)
            res["columns_match"] = s_cols == d_cols
            diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b]
            res["values_match"] = (len(s_rows) == len(d_rows) and not diff
                                   and s_cols == d_cols)
            if diff:
                res["first_diff"] = diff[0]
            if s_cols != d_cols:
                res["columns"] = (s_cols, d_cols)
        out[name] = res
    return out


if __name__ == "__main__":
    from marlstone.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    for k, v in compare(spark, sf, sys.argv[2:] or None).items():
        print(k, v)
