"""Every registered query of the core against DuckDB on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from stratalake.plans import catalog


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    return c


@pytest.mark.parametrize("name", list(catalog.SQL))
def test_query_matches_sql(spark, duck, data, name):
    got, want = catalog.QUERIES[name](spark, data).toPandas(), duck.execute(catalog.SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    got, want = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
    pd.testing.assert_frame_equal(got, want, check_exact=True, check_dtype=len(got) > 0)


def test_every_query_has_sql_and_rows(spark, data):
    assert set(catalog.QUERIES) == set(catalog.SQL)
    assert catalog.metadata_triples(spark, data).distinct().count() == 63 * spark.read.parquet(f"{data}/supplier.parquet").count() + 30
    n = spark.read.parquet(f"{data}/customer.parquet").count()
    assert catalog.cave_context_triples(spark, data).count() == 22 * n


def test_entry(spark, data):
    if os.path.isdir("/root/testdata/sf0.001"):
        import __spark_entry__

        assert __spark_entry__.entry(spark).columns == ["event_id", "variant", "x"]
        assert set(catalog.QUERIES) <= set(__spark_entry__.queries())
        assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
