"""Comparing rows of Spark and of DuckDB."""

import decimal
import math


def canon(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return tuple((k, canon(x)) for k, x in v.items())
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def sorted_rows(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(canon(r[i]) for i in order) for r in rows), key=repr)


def same_as_sql(df, con, sql):
    got = sorted_rows(df.columns, df.collect())
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == sorted_rows(columns, cur.fetchall())
