"""Queries against their SQL."""

import pytest

from tagloom.llm import catalog


def same(a, b):
    if isinstance(a, float) or isinstance(b, float):
        return (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9)
    return a == b


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, duck, sf, name):
    df = catalog.QUERIES[name](spark, sf)
    got = sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
    told = duck.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in told.description]
    by = sorted(range(len(names)), key=lambda i: names[i])
    want = sorted((tuple(r[i] for i in by) for r in told.fetchall()), key=repr)
    assert sorted(df.columns) == sorted(names)
    assert len(got) == len(want) > 0
    for x, y in zip(got, want, strict=True):
        assert all(same(a, b) for a, b in zip(x, y, strict=True)), (x, y)
