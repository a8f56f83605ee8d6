"""Every registered query against its SQL text on DuckDB: names, types of value and all rows."""

import datetime
import decimal

import pytest

from fieldglean import queries as registry

registry.load_all()


def norm(v):
    if isinstance(v, float):
        return ("num", round(v, 6))
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, (int, decimal.Decimal)):
        return ("num", round(float(v), 6))
    if isinstance(v, (datetime.date, datetime.datetime)):
        return ("t", str(v))
    return ("s", str(v)) if v is not None else ("null", "")


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = registry.QUERIES[name](spark, sf_dir)
    got = df.collect()
    assert df.columns
    if name not in registry.ORACLES:
        assert got
        return
    res = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(names)
    a, b = rows_of(df.columns, got), rows_of(names, want)
    assert len(a) == len(b)
    assert a == b, [x for x in zip(a, b) if x[0] != x[1]][:3]
    assert got or name in MAY_BE_EMPTY


MAY_BE_EMPTY = {"email_contacts"}
