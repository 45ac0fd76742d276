"""Every query that has an SQL statement gives exactly its rows; the others give rows at all."""

from __future__ import annotations

import re

import duckdb
import pytest

import __spark_entry__ as driver
from haulage import catalogue
from tests import oracle

SMALL = "/root/testdata/sf0.001"
TEXTS = catalogue.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return oracle.database(SMALL)


def test_every_statement_belongs_to_a_query():
    assert set(TEXTS) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(catalogue.queries()) - set(TEXTS) == {"demand_forecast", "forecast_metrics", "feature_importance"}


@pytest.mark.parametrize("name", sorted(TEXTS))
def test_query_matches_its_statement(spark, db, name):
    assert oracle.compare(catalogue.queries()[name](spark, SMALL), db, TEXTS[name]) is None


@pytest.mark.parametrize("name", ["demand_forecast", "forecast_metrics", "feature_importance"])
def test_query_gives_rows(spark, name):
    frame = catalogue.queries()[name](spark, SMALL)
    assert frame.columns and frame.schema == catalogue.queries()[name](spark, SMALL).schema
    if name in ("forecast_metrics", "feature_importance"):
        assert frame.count() > 0


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory):
    """A third of all lines in one order, of all orders at one customer, of all events on one load."""
    out = str(tmp_path_factory.mktemp("skewed"))
    heavy = {
        "orders": "CASE WHEN n % 3 = 0 THEN 11 ELSE o_custkey END AS o_custkey",
        "lineitem": "CASE WHEN n % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey, "
        "CASE WHEN n % 6 = 0 THEN 3 ELSE l_linenumber END AS l_linenumber, "
        "CASE WHEN n % 3 = 1 THEN 5 ELSE l_suppkey END AS l_suppkey",
        "events": "CASE WHEN n % 3 = 0 THEN 3 ELSE user_id END AS user_id",
    }
    for name in oracle.TABLES:
        source = f"(SELECT *, ROW_NUMBER() OVER () AS n FROM '{SMALL}/{name}.parquet')"
        change = f"REPLACE ({heavy[name]})" if name in heavy else ""
        duckdb.sql(f"COPY (SELECT * EXCLUDE (n) {change} FROM {source}) TO '{out}/{name}.parquet'")
    return out


@pytest.mark.parametrize(
    "name",
    ["route_volume", "item_flatten", "nested_totals", "interpolated_positions", "kpi_row", "match_top3", "stream_ingest_orders"],
)
def test_query_matches_with_hot_keys(spark, skewed_dir, name):
    assert oracle.compare(catalogue.queries()[name](spark, skewed_dir), oracle.database(skewed_dir), TEXTS[name]) is None


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["route_volume", "delivery_map", "match_top3"])
def test_plans_have_no_cross_product_and_prune_columns(spark, name):
    plan = catalogue.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    scans = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan) if "l_quantity" in s]
    assert scans and all("l_tax" not in s and "l_shipdate" not in s for s in scans)
