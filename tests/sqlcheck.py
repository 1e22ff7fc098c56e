"""Compares a query with its SQL on one folder of test tables."""

import glob
import math
import os


def connection(sf_dir):
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return f"{float(v):.9g}"
    if isinstance(v, (list, tuple)):
        return str([_value(x) for x in v])
    return str(v)


def rows(table):
    cols = sorted(table.column_names)
    return cols, sorted(zip(*([_value(v) for v in table.column(c).to_pylist()] for c in cols), strict=True)) if cols else []


def same(spark, con, query, sql, sf_dir):
    got, want = rows(query(spark, sf_dir).toArrow()), rows(con.execute(sql).to_arrow_table())
    assert got[0] == want[0], (got[0], want[0])
    assert len(got[1]) == len(want[1]), (len(got[1]), len(want[1]))
    bad = [(a, b) for a, b in zip(got[1], want[1], strict=True) if a != b]
    assert not bad, bad[:3]
