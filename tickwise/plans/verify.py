"""Run registered queries against their DuckDB oracles (the correctness gate,
locally): row count, column names and an order-insensitive comparison of the
values (doubles rounded to 6 places)."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

from ..sources.tables import TABLES, table_path


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = table_path(sf_dir, t)
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    pdf = pdf[cols].astype(object).where(pdf[cols].notna(), None)
    out = [tuple(_norm(v) for v in row) for row in pdf.itertuples(index=False, name=None)]
    return cols, sorted(out, key=repr)


def compare(spark, name: str, build, sql: str | None, sf_dir: str, con=None) -> dict:
    con = con or oracle_connection(sf_dir)
    t0 = time.time()
    got = build(spark, sf_dir).toPandas()
    t1 = time.time()
    res = {"query": name, "spark_rows": len(got), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    exp = con.sql(sql).df()
    res["oracle_rows"] = len(exp)
    res["oracle_sec"] = round(time.time() - t1, 2)
    gc, gr = _rows(got)
    ec, er = _rows(exp)
    if gc != ec:
        res["status"] = f"schema {gc} != {ec}"
    elif len(gr) != len(er):
        res["status"] = "rowcount"
    elif gr != er:
        diff = [(a, b) for a, b in zip(gr, er) if a != b]
        res["status"] = f"values ({len(diff)} differ) e.g. {diff[:2]}"
    else:
        res["status"] = "match"
    return res


def main(argv=None):
    argv = sys.argv[1:] if argv is None else argv
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    from ..session import local_session
    from . import catalog

    spark = local_session()
    con = oracle_connection(sf_dir)
    sqls = catalog.oracle_sql()
    for name, build in catalog.queries().items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, name, build, sqls.get(name), sf_dir, con)
        except Exception as e:  # report and go on
            r = {"query": name, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        print(r, flush=True)


if __name__ == "__main__":
    main()
