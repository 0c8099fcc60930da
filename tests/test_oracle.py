"""Every query with an oracle equals its DuckDB SQL on sf0.001 (order-insensitive)."""

import math

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

ORACLE = E.oracle_sql()
NAMES = sorted(ORACLE)


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return round(float(v), 6)
    except ImportError:
        pass
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "boolean": "BOOLEAN", "float": "FLOAT"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    res = duck.sql(ORACLE[name])
    assert sorted(sdf.columns) == sorted(res.columns)
    duck_types = dict(zip(res.columns, [str(t) for t in res.types]))
    for f in sdf.schema.fields:
        st = f.dataType.simpleString()
        assert SPARK_TO_DUCK.get(st, st) == duck_types[f.name], (f.name, st, duck_types[f.name])
    assert _rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == _rows(res.columns, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["city", "count", "avg_salary", "median_salary", "min_salary", "max_salary"]
