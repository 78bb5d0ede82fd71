"""Every registered query of the engine runs, and equals its SQL where it has one."""

import os

import duckdb
import pytest

from threshline.plans import registry

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in os.listdir(DIR):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{DIR}/{f}')")
    return c


def rows(df):
    names = sorted(df.columns)
    values = df[names].astype(object).where(df[names].notna(), None).values.tolist()
    return names, sorted([tuple(map(str, r)) for r in values])


@pytest.mark.parametrize("name", registry.QUERIES)
def test_query(spark, db, name):
    got = registry.QUERIES[name](spark, DIR).toPandas()
    if name in registry.ORACLES:
        assert rows(got) == rows(db.sql(registry.ORACLES[name]).df())


def test_flagship_is_registered():
    assert registry.FLAGSHIP in registry.QUERIES
    assert set(registry.ORACLES) <= set(registry.QUERIES)
