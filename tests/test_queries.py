"""Every named query against its SQL, run by DuckDB over the same tables."""

import os
from glob import glob

import duckdb
import pytest
from conftest import plan_of

import __spark_entry__ as contract
from salesflow.checks.oracles import ORACLES
from salesflow.checks.queries import QUERIES
from salesflow.plans import sales_from_lines
from salesflow.sources import star

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def normal(rows):
    def value(v):
        return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v

    return sorted([tuple(value(v) for v in r) for r in rows], key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    expected = duck.sql(ORACLES[name])
    assert sorted(expected.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    found = normal(tuple(r) for r in result.select(*columns).collect())
    assert found == normal(expected.select(quoted).fetchall())
    assert found or name in ("reconcile",)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
    assert contract.queries().keys() >= QUERIES.keys() and contract.oracle_sql().items() >= ORACLES.items()


@pytest.mark.parametrize("name", star.SCHEMAS)
def test_declared_schemas_are_those_of_the_files(spark, name):
    stored = spark.read.parquet(f"{SF_DIR}/{name}.parquet").schema
    assert star.table(spark, SF_DIR, name).schema == stored


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["daily_city_sales"](spark, SF_DIR))
    assert "EqualTo(l_returnflag,R)" in plan
    assert "l_tax" not in plan and "o_orderpriority" not in plan and "c_name" not in plan


def test_the_plans_own_filter_reaches_the_scan(spark, tmp_path):
    """On a table with a column payment_status the filter on paid orders is pushed down."""
    star.order_lines(spark, SF_DIR).write.parquet(f"{tmp_path}/lines")
    lines = spark.read.parquet(f"{tmp_path}/lines")
    tables = sales_from_lines(star.customers(spark, SF_DIR), star.refunds(spark, SF_DIR), lines)
    plan = plan_of(tables.daily_city_sales)
    assert "EqualTo(payment_status,paid)" in plan and "item_sku" not in plan


def test_a_date_filter_prunes_folders(spark):
    filtered = QUERIES["sink_partitioned_filter"](spark, SF_DIR)
    plan = plan_of(filtered)
    assert "PartitionFilters: [isnotnull(date_key" in plan
    assert 0 < filtered.count() < QUERIES["sink_partitioned"](spark, SF_DIR).count()
