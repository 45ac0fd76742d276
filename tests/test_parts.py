"""Exports by parts: what has been ingested goes before the next part lands."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from haulage import session
from haulage.catalogue import published, routes, streams
from haulage.operators import nesting
from haulage.operators.skew import held
from haulage.plans import product, refresh
from haulage.sources import landing, schemas

ORDERS, LINES = 40, 3


@pytest.fixture
def tables(spark, tmp_path, monkeypatch):
    """A small star schema, whose order ids lie in many blocks. Orders without lines, and one without a key, are among them."""
    day = dt.date(2024, 5, 1)
    orders = [(i * 4096 + i, i % 5, day, "1-URGENT" if i % 2 else "5-LOW", "F" if i % 3 else "O", 10.0) for i in range(ORDERS)]
    orders.append((None, 1, day, "5-LOW", "O", 1.0))
    lines = [
        (i * 4096 + i, n, (i + n) % 7, i % 3, float(1 + n), 100.0 * i + n, day) for i in range(ORDERS) if i % 10 for n in range(LINES)
    ]
    made = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderdate date, o_orderpriority string, o_orderstatus string, o_totalprice double"),
        "lineitem": (
            lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate date",
        ),
        "customer": ([(i, f"c{i}", i % 2, "BUILDING") for i in range(5)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "supplier": ([(i, f"s{i}", i % 2, 1.0) for i in range(3)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "part": ([(i, f"p{i}", "b", i, 1.5) for i in range(7)], "p_partkey long, p_name string, p_brand string, p_size int, p_retailprice double"),
        "nation": ([(0, "PERU"), (1, "CHILE")], "n_nationkey int, n_name string"),
        "events": ([(i, i % 6, "click", dt.datetime(2024, 5, 1, 0, i)) for i in range(20)], "event_id long, user_id long, event_type string, ts timestamp"),
    }
    for name, (rows, ddl) in made.items():
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{tmp_path}/sf/{name}.parquet")
    monkeypatch.setattr(routes, "ORDERS_PER_PART", 12)
    return f"{tmp_path}/sf"


@pytest.fixture
def lying(spark, monkeypatch):
    """Documents that lie in the landing folder of the orders after each export, and that folder."""
    found, plain = [], landing.write_json

    def counted(df, path, *args, **named):
        plain(df, path, *args, **named)
        if "pedidos_json" in path:
            found.append((path, landing.read_json(spark, path, schemas.ORDER, named.get("layout", args[1] if len(args) > 1 else "lines")).count()))

    monkeypatch.setattr(landing, "write_json", counted)
    return found


def landed(lying, times=1):
    """Checks that all documents landed, none of them beside all others, and that the folder is empty now."""
    counts = [n for _, n in lying]
    assert len(counts) == 4 * times and sum(counts) == (ORDERS + 1) * times and max(counts) < ORDERS / 2
    for folder in {path for path, _ in lying}:
        assert not [f for f in os.listdir(folder) if not f.startswith(".")]


def test_parts_hold_every_order_once(spark, tables, rows):
    parts = routes._parts(spark, tables)
    assert parts == [(k, 4) for k in range(4)]
    whole = rows(routes._nested(spark, tables), "id_pedido", "valor_frete")
    each = [rows(routes._nested(spark, tables, p), "id_pedido", "valor_frete") for p in parts]
    assert all(each) and sorted(map(str, sum(each, []))) == sorted(map(str, whole)) and len(whole) == ORDERS + 1


def test_lines_of_a_part_are_read_alone(spark, tables):
    plan = routes._nested(spark, tables, (1, 4))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    reads = [k for k, line in enumerate(plan) if "Relation [" in line and ("l_orderkey" in line or "o_orderkey" in line)]
    assert len(reads) == 4 and all("Filter" in plan[k - 1] and "xxhash64" in plan[k - 1] for k in reads)


@pytest.mark.parametrize("name", ["stream_invoices", "stream_orders", "stream_ingest_orders"])
def test_streams_land_by_parts(spark, tables, lying, rows, monkeypatch, name):
    found = rows(streams.QUERIES[name](spark, tables))
    landed(lying)
    monkeypatch.setattr(routes, "ORDERS_PER_PART", 1000)
    assert found == rows(streams.QUERIES[name](spark, tables)) and len(found) == {"stream_invoices": 36 * LINES, "stream_orders": 36, "stream_ingest_orders": 41}[name]
    assert len(lying) == 5


def test_refresh_lands_by_parts(spark, tables, lying, rows, monkeypatch):
    lake, _ = streams._landed_twice(spark, tables)
    landed(lying, 2)
    stored = refresh.read(spark, lake, "gold_volume_por_rota")
    # Replays are known again, though their documents were put together a second time: corrected ones and those without a key are added.
    wrong = sum((i * 4096 + i) % 7 == 0 for i in range(ORDERS))
    assert spark.read.parquet(lake.table("bronze_pedidos")).count() == ORDERS + wrong + 2
    monkeypatch.setattr(routes, "ORDERS_PER_PART", 1000)
    again, _ = streams._landed_twice(spark, tables)
    assert rows(stored) == rows(refresh.read(spark, again, "gold_volume_por_rota"))


def test_two_feeds_land_by_parts(spark, tables, lying, rows, monkeypatch):
    name = "invoices_two_feeds"
    found = rows(published.QUERIES[name](spark, tables))
    landed(lying)
    monkeypatch.setattr(routes, "ORDERS_PER_PART", 1000)
    assert found == rows(published.QUERIES[name](spark, tables)) and found


def test_the_data_step_gets_the_last_part(spark, tables, lying, monkeypatch):
    def run(spark, lake, given, masters, prefix):
        before = refresh.read(spark, lake, "bronze_pedidos").count()
        refresh.ingest(spark, lake, given)
        assert before + lying[-1][1] == refresh.read(spark, lake, "bronze_pedidos").count() == ORDERS + 1
        return spark.range(1)

    monkeypatch.setattr(product, "run", run)
    published._delivered(spark, tables)
    landed(lying)


def test_shuffles_go_with_their_job(spark, tmp_path):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with pytest.raises(ValueError), session.short_lived_shuffles(spark):
        assert spark.conf.get(name) == "true"
        raise ValueError
    assert spark.conf.get(name) == before
    with held(spark.range(3), "meio") as stored:
        folder = stored.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
        assert stored.count() == 3 and os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_long_orders_are_looked_for_once(spark, tables, lying, rows, monkeypatch):
    asked, plain = [], nesting.kept
    monkeypatch.setattr(nesting, "kept", lambda frame, label: asked.append(label) or plain(frame, label))
    assert routes._short(spark, tables)
    found = rows(streams.stream_ingest_orders(spark, tables))
    landed(lying)
    assert "longos" not in asked
    monkeypatch.setattr(nesting, "INVOICES_PER_DOCUMENT", LINES - 1)
    assert not routes._short(spark, tables)
    assert found == rows(streams.stream_ingest_orders(spark, tables)) and asked.count("longos") == 4
