from __future__ import annotations

import json

import pytest

from haulage.operators import checks
from haulage.plans import gold, views
from haulage.sources import schemas, tables
from haulage.streaming import silver
from tests import logistics


@pytest.fixture(scope="module")
def layers(spark):
    tables.create_layers(spark)
    tables.save(logistics.clientes(spark), "raw.clientes", "clientes d'água", "raw")
    tables.copy(spark, "raw.clientes", "bronze.bronze_clientes", "cópia")
    return spark


def test_layers_exist(layers):
    assert all(layers.catalog.databaseExists(x) for x in tables.LAYERS)


def test_saved_table_carries_comment_and_quality(layers):
    assert tables.table_comment(layers, "raw.clientes") == "clientes d'água"
    shown = dict(tuple(r) for r in layers.sql("SHOW TBLPROPERTIES raw.clientes").collect())
    assert shown["quality"] == "raw"
    assert layers.read.table("bronze.bronze_clientes").count() == 5


def test_overwrite_then_append_and_partitions(layers):
    df = layers.range(4).selectExpr("id", "id % 2 AS mes")
    tables.save(df, "silver.t", partition_by=["mes"])
    tables.save(df, "silver.t", partition_by=["mes"], mode="append")
    assert tables.load(layers, "silver.t").count() == 8
    tables.save(df, "silver.t", partition_by=["mes"])
    assert tables.load(layers, "silver.t").count() == 4 and tables.preview(df, 2).count() == 2


def test_published_views_are_commented(layers, rows):
    spark = layers
    ref = schemas.status_reference(spark)
    events = silver.status(logistics.status(spark), ref, metrics=None)
    orders = silver.orders(logistics.pedidos(spark).selectExpr("*", "0 AS parte"), logistics.clientes(spark), metrics=None)
    loads = logistics.cargas(spark)
    current = views.order_status(events, loads)
    frames = {
        "vw_mapa_entregas": views.delivery_map(orders, current, logistics.clientes(spark)),
        "vw_kpis_operacionais": views.kpi_row(orders, current, loads),
        "vw_volume_diario": views.daily_volume(orders),
        "vw_performance_motoristas": views.driver_performance(logistics.motoristas(spark), loads, orders),
        "vw_rotas_mais_frequentes": views.top_routes(gold.route_volume(orders)),
    }
    names = views.publish(spark, frames)
    assert len(names) == 5
    assert rows(checks.view_checks(spark, [*names, "gold.vw_falta"]), "status") == [("ERRO",)] + [("OK",)] * 5
    assert rows(checks.comment_checks(spark, [*names, "silver.t"]), "status") == [("FALHA",)] + [("OK",)] * 5
    described = {r["col_name"]: r["comment"] for r in spark.sql("DESCRIBE TABLE gold.vw_mapa_entregas").collect()}
    assert described["status_atual"] == views.COMMENTS["vw_mapa_entregas"][1]["status_atual"]
    for name, frame in frames.items():
        assert rows(spark.read.table(f"gold.{name}")) == rows(frame.select(*views.COMMENTS[name][1]))


def test_inventory_lists_views_and_broken_tables(layers, rows):
    spark = layers
    tables.save(spark.range(3).toDF("x"), "ml.base")
    tables.create_view(spark, "ml.vista", "SELECT x FROM ml.base")
    tables.create_view(spark, "ml.quebrada", "SELECT x FROM ml.base")
    tables.save(spark.range(3).toDF("y"), "ml.base")  # the views lost their column
    tables.create_view(spark, "ml.vista", "SELECT y FROM ml.base")
    got = {r["table_name"]: (r["row_count"], r["last_updated"]) for r in tables.inventory(spark, ["ml", "falta"]).collect()}
    assert got["ml.vista"] == (3, tables.VIEW_AGE)
    assert got["ml.base"][0] == 3 and got["ml.base"][1].startswith("20")
    assert got["ml.quebrada"][0] == -1 and got["ml.quebrada"][1].startswith("ERRO")
    listed = tables.inventory(spark, ["ml"])
    assert rows(tables.inventory_totals(listed)) == [(3, 6)]
    text = json.loads(tables.inventory_json(listed).head()[0])
    assert text["total_registros"] == 6 and len(text["tabelas"]) == 3
    assert tables.inventory(spark, ["falta"]).count() == 0


def test_minimum_rows_reports_missing_tables(layers, rows):
    got = rows(checks.minimum_rows_in(layers, "raw", {"clientes": 5, "pedidos": 1}))
    assert got == [("clientes", 5, 5, "OK"), ("pedidos", 0, 1, "FALHA")]


def test_empty_frames_have_their_schema(spark):
    for ddl in [*schemas.RAW.values(), schemas.ORDER, schemas.INVOICE, schemas.STATUS]:
        frame = schemas.empty(spark, ddl)
        assert frame.schema == schemas.struct(ddl)
    assert schemas.empty(spark, schemas.STATUS).count() == 0
    assert schemas.status_reference(spark).count() == 15
