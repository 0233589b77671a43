"""Every SQL-expressible operator equals its DuckDB oracle (sf0.001).

Same comparison as the driver's: column names, types, row count and an
order-insensitive comparison of values with columns sorted by name.
"""

import math

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TYPES = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
         "DateType": "DATE", "BooleanType": "BOOLEAN", "TimestampNTZType": "TIMESTAMP"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    otypes = {d[0]: str(d[1]) for d in res.description}
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    stypes = {f.name: TYPES.get(type(f.dataType).__name__, type(f.dataType).__name__) for f in df.schema.fields}
    assert stypes == otypes
    assert _canon(df.columns, rows) == _canon(ocols, orows)
