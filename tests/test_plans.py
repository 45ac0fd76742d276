from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from haulage import catalogue
from haulage.operators import checks
from haulage.plans import demand, dispatch, gold, questions, views
from haulage.sources import schemas, star_schema
from haulage.streaming import silver
from tests import logistics


@pytest.fixture(scope="module")
def data(spark):
    ref = schemas.status_reference(spark)
    events = silver.status(logistics.status(spark), ref, metrics=None)
    orders = silver.orders(
        logistics.pedidos(spark).withColumn("parte", F.lit(0)), logistics.clientes(spark), metrics=None
    )
    out = {
        "events": events.cache(),
        "orders": orders.cache(),
        "clientes": logistics.clientes(spark),
        "caminhoes": logistics.caminhoes(spark),
        "motoristas": logistics.motoristas(spark),
        "cargas": logistics.cargas(spark),
    }
    out["status"] = views.order_status(out["events"], out["cargas"]).cache()
    return out


def test_silver_orders_apply_rules_and_normalise(data, rows):
    got = rows(data["orders"], "id_pedido", "prioridade", "cidade_cliente", "ano", "mes", "dia")
    assert got == [
        (1, "Expressa", "São Paulo", 2025, 1, 1), (2, "Normal", "Rio de Janeiro", 2025, 1, 1),
        (3, "Urgente", "Salvador", 2025, 1, 2), (4, "Expressa", None, 2025, 1, 8), (5, "Normal", "Sao Paulo", 2025, 1, 8),
        (6, "Normal", "Sao Paulo", None, None, None),
    ]


def test_silver_status_keeps_unknown_codes_and_unreadable_times(data, rows):
    got = rows(data["events"].filter("id_carga = 3"), "id_status", "descricao_status", "timestamp")
    assert got == [
        (77, None, dt.datetime(2025, 1, 1, 9)), (9, "Em Trânsito", dt.datetime(2025, 1, 3, 10)), (9, "Em Trânsito", None),
    ]
    assert data["events"].filter("id_carga IS NULL").count() == 0


def test_latest_status_by_time_then_step(data, rows):
    assert rows(gold.latest_status(data["events"]), "id_carga", "id_status") == [(1, 12), (2, 12), (3, 9)]
    assert rows(gold.status_summary(data["events"]), "id_status", "ordem", "total_cargas") == [(12, 12, 2), (9, 9, 1)]


def test_status_share_adds_counts_instead_of_counting_rows(spark, rows):
    summary = spark.createDataFrame([("A", 1, 5), ("A", 2, 3), ("B", 3, 4)], "descricao_status string, id_status int, total_cargas bigint")
    assert rows(views.status_share(summary)) == [("A", 8), ("B", 4)]


def test_order_status_goes_through_the_load_list(data, rows):
    # Order 2 is on loads 1 (delivered on the 2nd) and 3 (on the road on the 3rd): the newest event counts.
    assert rows(data["status"], "id_pedido", "id_status") == [(1, 12), (2, 9), (3, 12), (4, 9)]


def test_city_centroid_is_one_row_per_city(data, rows):
    got = rows(views.city_centroids(data["clientes"]))
    assert ("SAO PAULO", "SP", pytest.approx(-23.52), pytest.approx(-46.62)) in got and len(got) == 3


def test_delivery_map_has_one_row_per_order(data, rows):
    mapped = views.delivery_map(data["orders"], data["status"], data["clientes"])
    got = rows(mapped, "id_pedido", "status_atual", "cidade_cliente", "cidade_destino")
    assert [r[0] for r in got] == [1, 2, 3, 4, 5, 6]
    assert got[0][1:] == ("Entrega Realizada", "São Paulo", "Rio de Janeiro") and got[4][1] == "Sem Status"
    assert rows(mapped.filter("lat_origem IS NULL"), "id_pedido") == [(4,)]
    assert rows(mapped.filter("lat_destino IS NULL"), "id_pedido") == [(5,)]
    assert mapped.columns == list(views.COMMENTS["vw_mapa_entregas"][1])


def test_kpis_keep_equal_freights_apart_and_count_a_replay_once(data):
    doubled = gold.one_per_order(data["orders"].unionByName(data["orders"].filter("id_pedido = 1")))
    row = views.kpi_row(doubled, data["status"], data["cargas"]).head().asDict()
    assert row == {
        "total_pedidos": 6, "total_entregas_realizadas": 2, "total_em_transito": 2, "taxa_entrega_pct": 33.3,
        "peso_total_transportado": 28100.0, "valor_frete_total": 280.0, "frete_medio": 46.67, "total_caminhoes_ativos": 2,
    }


def test_daily_volume_counts_priorities(data, rows):
    got = rows(views.daily_volume(data["orders"]).filter("data IS NOT NULL"))
    assert got[0] == (dt.date(2025, 1, 1), 2, 3000.0, 100.0, 1, 0)
    assert got[1] == (dt.date(2025, 1, 2), 1, 5000.0, 80.0, 0, 1)


def test_driver_km_is_not_multiplied_by_orders(data, rows):
    got = rows(views.driver_performance(data["motoristas"], data["cargas"], data["orders"]))
    assert got == [
        (1, "Ana", "C", 2, 100.0, 4.5, 100.0, 50.0), (2, "Ana", "D", 3, 450.0, 4.9, 130.0, 150.0),
    ]


def test_fleet_keeps_loads_of_unknown_trucks(data, rows):
    got = rows(gold.fleet_performance(data["cargas"], data["caminhoes"]))
    assert got == [("Truck", 2, 14.0, 450, pytest.approx((50 + 100 / 14) / 2)), ("VUC", 1, 3.5, 100, 50.0), (None, 1, None, 10, None)]


def test_routes(data, rows):
    volume = gold.route_volume(data["orders"])
    got = rows(views.top_routes(volume, 1))
    assert got == [("Manaus -> São Paulo", 1, 100.0, 0.0, 0.0, 0.0)]
    assert rows(questions.routes_by_freight(volume, 1)) == [("Sao Paulo -> Manaus", 1, 90.0)]


def test_questions(data, rows):
    mapped = views.delivery_map(data["orders"], data["status"], data["clientes"])
    assert rows(questions.delivery_rate(data["orders"], data["status"])) == [(3, 1, 33.3)]
    assert rows(questions.open_express(mapped)) == [(1,)]
    assert rows(questions.pending_map(mapped), "id_pedido") == [(2,), (4,), (6,)]
    assert ("BA", 2) in rows(questions.state_volume(mapped))
    performance = views.driver_performance(data["motoristas"], data["cargas"], data["orders"])
    assert rows(questions.best_rated(performance, 1), "id_motorista") == [(2,)]
    assert rows(questions.busiest_drivers(performance, 1), "id_motorista") == [(2,)]
    assert rows(questions.mean_freight_by_state(mapped).filter("uf_destino = 'SP'")) == [("SP", 40.0)]
    assert len(rows(questions.mean_weight_by_route(data["orders"]))) == 6
    assert rows(questions.daily_last_week(views.daily_volume(data["orders"])), "total_pedidos") == [(1,), (2,)]


def test_free_truck_needs_delivery_as_its_newest_event(data, rows):
    got = rows(dispatch.free_trucks(data["events"], data["cargas"], data["caminhoes"]), "id_caminhao", "lat_caminhao", "cidade_atual")
    assert got == [(1, -23.55, "São Paulo")]
    assert rows(dispatch.last_position(data["events"], data["cargas"]), "id_caminhao", "id_carga") == [(1, 1), (2, 3)]


def test_pending_orders_and_recommendation(data, rows):
    pending = dispatch.pending_orders(data["orders"], data["status"], data["clientes"])
    assert rows(pending, "id_pedido") == [(2,), (5,), (6,)]
    free = dispatch.free_trucks(data["events"], data["cargas"], data["caminhoes"])
    for points in (None, dispatch.pickup_points(data["clientes"])):
        found = dispatch.recommend(pending, free, points)
        assert rows(dispatch.saved_form(found), "id_pedido", "id_caminhao", "placa", "rank", "cidade_origem") == [
            (2, 1, "AAA1A11", 1, "São Paulo")
        ]
    assert found.select("distancia_km").head()[0] < 10
    assert rows(dispatch.matches_by_rank(found)) == [(1, 1)]
    assert rows(dispatch.distance_histogram(found)) == [(1, 1, 0.0)]


def test_surprise_order_checks_weight_volume_and_driver(data, rows):
    positions = dispatch.last_position(data["events"], data["cargas"]).unionByName(
        dispatch.last_position(data["events"], data["cargas"]).filter("id_caminhao = 1").withColumn("id_caminhao", F.lit(4)).withColumn("id_carga", F.lit(9).cast("bigint"))
    )
    def ask(kg, m3):
        return rows(dispatch.nearest_for(data["caminhoes"], data["motoristas"], positions, kg, m3, -23.5, -46.6), "id_caminhao")

    assert ask(1000.0, 4.0) == [(1,), (2,), (4,)]
    assert ask(1000.0, 12.0) == [(2,)]  # truck 4 carries 37 t but only 5 m3
    assert ask(20000.0, 50.0) == []  # truck 3 would fit, but its driver is on leave


def test_fleet_position_free_capacity(data, rows):
    positions = dispatch.last_position(data["events"], data["cargas"])
    got = rows(dispatch.fleet_position(positions, data["caminhoes"], data["clientes"]), "id_caminhao", "capacidade_livre")
    assert got == [(1, 3500.0), (2, 13000.0)]


def weekly_orders(spark):
    days = ["2025-12-28", "2025-12-29", "2025-12-31", "2026-01-01", "2026-01-05", "2026-01-19", "2026-12-31", "2027-01-01"]
    rows = [(i, d + " 10:00:00", 10.0 * i, 5.0, "A", "B") for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "id_pedido bigint, d string, peso_total_kg double, valor_frete double, cidade_origem string, cidade_destino string")
    return df.withColumn("data_pedido", F.to_timestamp("d"))


def test_weeks_follow_iso_years_and_gaps_break_the_lag(spark, rows):
    got = rows(demand.weekly_features(weekly_orders(spark)), "inicio_semana", "ano", "semana", "total_pedidos", "total_pedidos_semana_anterior")
    assert got == [
        (dt.date(2025, 12, 22), 2025, 52, 1, None), (dt.date(2025, 12, 29), 2026, 1, 3, 1), (dt.date(2026, 1, 5), 2026, 2, 1, 3),
        (dt.date(2026, 1, 19), 2026, 4, 1, None), (dt.date(2026, 12, 28), 2026, 53, 2, None),
    ]


def test_strict_reference_weeks_split_by_month_and_lag_by_row(spark, rows):
    got = rows(demand.weekly_features(weekly_orders(spark), True), "ano", "semana", "mes", "total_pedidos", "total_pedidos_semana_anterior")
    assert (2026, 4, 1, 1, 1) in got and (2027, 53, 1, 1, 1) in got and (2025, 1, 12, 2, None) in got
    assert sum(r[3] for r in got) == 8


def test_model_round_trip_and_runs(spark, tmp_path, rows):
    orders = star_schema.silver_orders(spark, "/root/testdata/sf0.001")
    weeks = demand.weekly_features(orders).withColumn("total_pedidos_semana_anterior", F.coalesce("total_pedidos_semana_anterior", F.lit(0))).cache()
    train, test = demand.split(weeks)
    assert train.count() + test.count() == weeks.count() and 0.7 < train.count() / weeks.count() < 0.9
    model = demand.train(train, trees=5, depth=3)
    predicted = demand.predict(model, test)
    found = demand.scores(predicted)
    row = demand.score_frame(predicted).head()
    assert found["mae"] == pytest.approx(row["mae"]) and found["rmse"] == pytest.approx(row["rmse"])
    weights = demand.importance(spark, model)
    assert weights.count() == 7 and weights.agg(F.sum("importance")).head()[0] == pytest.approx(1.0)
    again = demand.load_model(demand.save_model(model, str(tmp_path / "model"), 1))
    assert demand.predict(again, test).exceptAll(predicted).isEmpty()
    assert demand.forecast_table(predicted).columns == ["rota", "semana", "total_pedidos", "peso_medio", "previsao"]
    runs = str(tmp_path / "runs")
    for i, rmse in enumerate((3.0, 1.0, 2.0)):
        demand.log_run(spark, runs, f"r{i}", "demanda", "p", {**found, "rmse": rmse}, trees=5)
    assert rows(demand.best_run(spark.read.parquet(runs)), "run_id") == [("r1",)]


def test_forecast_covers_every_route_week_and_the_next(spark):
    weeks = demand.weekly_features(weekly_orders(spark)).withColumn("valor_medio", F.lit(None).cast("double"))
    model = demand.train(weeks.fillna(0), trees=2, depth=2)
    got = demand.forecast_table(demand.forecast(model, weeks)).collect()
    routes = weeks.select("rota").distinct().count()
    assert len(got) == weeks.count() + routes and all(r.previsao is not None for r in got)
    assert sorted(r.semana for r in got if r.total_pedidos is None) == sorted(
        r.s for r in weeks.groupBy("rota").agg(F.date_add(F.max("inicio_semana"), 7).alias("d")).selectExpr(
            "concat(extract(YEAROFWEEK FROM d), '_W', lpad(weekofyear(d), 2, '0')) s").collect()
    )


def test_demand_forecast_covers_all_route_weeks(spark):
    weeks = demand.weekly_features(star_schema.silver_orders(spark, "/root/testdata/sf0.001"))
    got = catalogue.queries()["demand_forecast"](spark, "/root/testdata/sf0.001")
    assert got.count() == weeks.count() + weeks.select("rota").distinct().count()


def test_split_by_time_keeps_newest_weeks_for_the_test(spark):
    rows = [("r", 2025, w, 1, 1) for w in range(1, 11)]
    df = spark.createDataFrame(rows, "rota string, ano bigint, semana bigint, mes bigint, total_pedidos_semana_anterior bigint")
    train, test = demand.split(df, by_time=True)
    assert train.agg(F.max("semana")).head()[0] < test.agg(F.min("semana")).head()[0]
    assert (train.count(), test.count()) == (8, 2)


def test_checks(spark, data, rows):
    raw = logistics.pedidos(spark)
    found = checks.run(
        spark,
        {
            "nulos": lambda: checks.null_checks(raw, ["id_pedido", "valor_frete"], "pedidos"),
            "frete": lambda: checks.freight_check(data["orders"]),
            "rotas": lambda: checks.route_checks(gold.route_volume(data["orders"])),
            "unico": lambda: checks.unique_check(data["motoristas"], "nome", "motoristas"),
            "quebrado": lambda: checks.null_checks(raw, ["nao_existe"], "pedidos"),
        },
    )
    got = {r["check"].split(":")[0]: (r["resultado"], r["status"]) for r in found.collect()}
    assert got["NULL em id_pedido (pedidos)"] == (1, "FALHA") and got["valor_frete <= 0 (silver_pedidos)"] == (1, "FALHA")
    assert got["gold_volume_por_rota tem dados"] == (6, "OK") and got["peso_total negativo (gold_volume_por_rota)"] == (0, "OK")
    assert got["nome repetido (motoristas)"] == (1, "FALHA") and got["quebrado"] == (None, "ERRO")
    row = checks.summary(found).head()
    assert (row["total"], row["falhas"]) == (8, 5) and row["resultado"] == "FALHA: 5 de 8 checks"
    with pytest.raises(checks.CheckFailed):
        checks.require(found)
    checks.require(checks.route_checks(gold.route_volume(data["orders"])))


def test_orphans_minimum_and_duplicates(spark, data, rows):
    got = rows(checks.orphan_check(data["motoristas"], data["caminhoes"], "id_caminhao", "m -> c"))
    assert got == [("m -> c", 1, 0, "FALHA")]
    counts = checks.minimum_rows({"a": (data["clientes"], 5), "b": (data["clientes"], 6), "c": (None, 1)})
    assert rows(counts) == [("a", 5, 5, "OK"), ("b", 5, 6, "FALHA"), ("c", 0, 1, "FALHA")]
    assert rows(checks.duplicates(data["motoristas"], "nome")) == [("Ana", 2)]
    assert rows(checks.profile(data["orders"].filter("data_pedido IS NOT NULL")), "total", "rotas") == [(5, 5)]
