"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from subsidia.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(v.date()) if isinstance(v, pd.Timestamp) and v == v.normalize() else str(v)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_equals_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    if name not in registry.ORACLE_SQL:
        assert len(got)
        return
    want = duck.execute(registry.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    assert rows(got[cols]) == rows(want[cols])


def rows(d):
    return sorted(str([None if pd.isna(v) else plain(v) for v in r]) for r in d.astype(object).itertuples(index=False))
