"""Order-insensitive comparison of Spark results with DuckDB results."""

import math
from decimal import Decimal


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, Decimal)):
        f = float(v)
        return "NaN" if math.isnan(f) else repr(round(f, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    return sorted("|".join(norm(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return [c.lower() for c in df.columns], [tuple(r) for r in df.collect()]


def duck_rows(con, sql):
    res = con.execute(sql)
    return [d[0].lower() for d in res.description], res.fetchall()


def assert_same(spark_df, con, sql):
    sc, sr = spark_rows(spark_df)
    oc, orows = duck_rows(con, sql)
    assert sorted(sc) == sorted(oc), (sc, oc)
    a, b = canon(sc, sr), canon(oc, orows)
    assert len(a) == len(b), (len(a), len(b))
    assert a == b, (sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3])
