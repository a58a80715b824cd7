"""Compare queries with their SQL in DuckDB: python tests/check_oracles.py [name-part] [sf]."""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry  # noqa: E402
from jobmill.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def canon(value):
    if isinstance(value, float):
        return repr(value)
    return str(value)


def compare(spark, con, name, folder):
    started = time.time()
    df = entry.queries()[name](spark, folder)
    cols = sorted(df.columns)
    mine = sorted(tuple(canon(v) for v in r) for r in df.select(*cols).collect())
    spent = time.time() - started
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return "rows", len(mine), spent, None
    rel = con.sql(sql)
    types = dict(zip(rel.columns, map(str, rel.types)))
    want_cols = sorted(rel.columns)
    if want_cols != cols:
        return "COLUMNS", len(mine), spent, (cols, want_cols)
    index = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(canon(r[i]) for i in index) for r in rel.fetchall())
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    off = [(c, t, types[c]) for c, t in df.dtypes if kinds.get(t) != types[c]]
    if mine != want:
        extra = sorted(set(mine) - set(want))[:3]
        missing = sorted(set(want) - set(mine))[:3]
        return "DIFF", len(mine), spent, (len(want), "only spark", extra, "only sql", missing, off)
    return ("types" if off else "ok"), len(mine), spent, off or None


def main():
    part = sys.argv[1] if len(sys.argv) > 1 else ""
    folder = f"/root/testdata/sf{sys.argv[2] if len(sys.argv) > 2 else '0.01'}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES.split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    bad = 0
    for name in entry.queries():
        if not any(p in name for p in part.split(",")):
            continue
        try:
            status, rows, spent, detail = compare(spark, con, name, folder)
        except Exception as e:  # noqa: BLE001
            status, rows, spent, detail = "ERROR", 0, 0, str(e)[:1500]
        bad += status not in ("ok", "rows")
        print(f"{status:8} {name:32} {rows:8} {spent:6.1f}s {detail if detail else ''}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
