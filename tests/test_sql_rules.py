"""Queries against their SQL on tables that the fixtures don't cover."""

import duckdb
import pytest

from subsidia.plans import registry
from tests.test_queries import rows


def equal(spark, name, **tables):
    c = duckdb.connect()
    for t, path in tables.items():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    got, want = registry.QUERIES[name](spark, str(next(iter(tables.values())).parent)).toPandas(), c.execute(registry.ORACLE_SQL[name]).df()
    cols = sorted(got.columns)
    return rows(got[cols]) == rows(want[cols])


def test_a_slope_that_rounds_to_0_is_data(spark, tmp_path):
    path = tmp_path / "embeddings.parquet"
    duckdb.sql(f"COPY (SELECT i AS vec_id, (i % 10)::INT AS label, [((e * 7 + i) % 5 * i * 1e-9)::FLOAT FOR e IN range(64)] AS embedding FROM range(40) t(i)) TO '{path}'")
    assert equal(spark, "a07_linear_velocity_zero_filled", embeddings=path)


@pytest.mark.parametrize("first, last", [(1, 199), (49_900, 50_400)])  # frames 1 and 2 end in one row; rows beyond 1,000
def test_stitching_order_and_places(spark, tmp_path, first, last):
    path = tmp_path / "part.parquet"
    duckdb.sql(f"COPY (SELECT k AS p_partkey, (k * 7 % 11 % 50 + 1)::INT AS p_size, 900 + k % 1000 / 10 AS p_retailprice FROM range({first}, {last + 1}) t(k)) TO '{path}'")
    assert equal(spark, "a32_stitch_three_frames", part=path)
