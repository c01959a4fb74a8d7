"""A few registered queries next to their SQL on the smallest tables; tools/check.py runs them all."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from skyledger.plans.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", [
    "s4_freshest_response", "s4_hot_request", "s1_read_catalog", "t5_page_order", "i4_merge_schema", "p7_promote_properties", "g1_geojson_to_wkt", "q8_render_requests", "q9_search_batch", "q9_batch_times", "q9_batch_crowded",
])
def test_query_agrees_with_sql(spark, tables, name):
    df = entry.queries()[name](spark, SF_DIR)
    result = tables.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert ordered(df.columns, [tuple(r) for r in df.collect()]) == ordered(columns, result.fetchall())


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry(spark):
    assert entry.entry(spark).columns == ["id", "collection", "price"]
