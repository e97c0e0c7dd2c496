"""Every query with SQL gives what DuckDB gives; shared frames are kept, so that the suite stays quick."""

import datetime
import decimal
import math

import duckdb
import pytest

from shoplark.plans import queries
from shoplark.plans.oracles import ORACLES

DATA = "/root/testdata/sf0.01"


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v.isoformat() if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def both(spark):
    held, kept = {}, {}
    for name in ("clean", "history", "wide_rows", "labeled", "d14_item_popularity"):
        kept[name] = getattr(queries, name)

        def shared(s, sf, name=name):
            if name not in held:
                held[name] = kept[name](s, sf).persist()
            return held[name]

        setattr(queries, name, shared)
    duck = duckdb.connect()
    duck.execute(f"create view events as select * from '{DATA}/events.parquet'")
    yield spark, duck
    for name, f in kept.items():
        setattr(queries, name, f)
    for df in held.values():
        df.unpersist()


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n in ORACLES])
def test_query_equals_sql(both, name):
    spark, duck = both
    df = queries.QUERIES[name](spark, DATA)
    got = duck.sql(ORACLES[name])
    names = sorted(got.columns)
    assert sorted(df.columns) == names
    at = [got.columns.index(c) for c in names]
    want = sorted((tuple(plain(r[i]) for i in at) for r in got.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr) == want


def test_names():
    assert set(ORACLES) <= set(queries.QUERIES)
