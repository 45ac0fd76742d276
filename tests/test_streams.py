from __future__ import annotations

import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from haulage.catalogue import streams
from haulage.operators import nesting
from haulage.plans import refresh
from haulage.session import scratch, scratch_root
from haulage.sources import landing, schemas
from haulage.streaming import bronze, live, silver
from haulage.streaming.seen import Seen, tagged
from tests import logistics


def order(i, **changed):
    item = {
        "id_item": i, "descricao": "peça", "ncm": "8708.80.00", "quantidade": 2, "unidade": "UN", "valor_unitario": 1.5,
        "valor_total": 3.0, "peso_kg": 1.0, "dimensoes": {"comprimento_cm": 10.5, "largura_cm": 2, "altura_cm": 3},
    }
    none = {**item, "id_item": 1000, "quantidade": 0}
    invoice = {
        "id_nf": i, "numero_nf": "000001", "id_pedido": i, "data_emissao": "2025-01-01 00:00:00", "valor_total": 3.0,
        "chave_acesso": "1" * 44, "itens": [item, none],
    }
    return {
        "id_pedido": i, "id_cliente": 1, "data_pedido": "2025-01-01 10:00:00", "peso_total_kg": 1.0,
        "volume_total_m3": 1.0, "valor_mercadoria": 3.0, "valor_frete": 10.0, "tipo_frete": "CIF", "prioridade": "NORMAL",
        "cidade_origem": "Sao Paulo", "uf_origem": "SP", "cidade_destino": "Salvador", "uf_destino": "BA",
        "notas_fiscais": [invoice], **changed,
    }


def put(folder, name, documents):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w", encoding="utf-8") as f:
        json.dump(documents, f, ensure_ascii=False, indent=2)


@pytest.fixture
def given(spark, tmp_path):
    return refresh.Inputs(
        customers=logistics.clientes(spark), orders=f"{tmp_path}/pedidos", invoices=f"{tmp_path}/nfs",
        status=f"{tmp_path}/status", loads=logistics.cargas(spark), trucks=logistics.caminhoes(spark),
    )


def event(load, status, time):
    return {"id_carga": load, "id_status": status, "timestamp": time, "observacao": "o", "latitude": 1.0, "longitude": 2.0}


def fill(given):
    put(given.orders, "a", [order(1), order(2, valor_frete=-1.0), order(3, peso_total_kg=0.0), order(None)])
    put(given.invoices, "a", order(1)["notas_fiscais"])
    put(given.status, "a", [event(1, 8, "2025-01-01 10:00:00"), event(1, 99, "x"), event(None, 1, "2025-01-01 10:00:00")])


def test_refresh_reads_each_file_once(spark, tmp_path, given, rows):
    fill(given)
    put(f"{given.orders}/_schema", "ignored", [order(77)])
    lake = refresh.refresh(spark, refresh.Lake(str(tmp_path / "lake")), given)
    read = lambda name: refresh.read(spark, lake, name)
    assert read("bronze_pedidos").count() == 4 and read("bronze_nfs").count() == 1
    assert rows(read("silver_pedidos"), "id_pedido", "prioridade", "mes") == [(1, "Normal", 1), (3, "Normal", 1)]
    assert rows(read("silver_status"), "id_status", "descricao_status") == [(8, "Saiu para Entrega"), (99, None)]
    assert read("silver_itens_nf").count() == 4  # one item of quantity 0 per order is dropped
    assert set(r[0] for r in rows(read("silver_itens_nf"), "ncm", "comprimento_cm")) == {"87088000"}
    assert rows(read("silver_itens_nf"), "comprimento_cm")[0] == (10.5,)
    assert rows(read("gold_volume_por_rota"), "total_pedidos") == [(2,)]
    assert read("bronze_pedidos").filter("arquivo_origem LIKE '%a.json' AND data_ingestao IS NOT NULL").count() == 4

    put(given.orders, "a", [order(50), order(51)])  # a rewritten file is not read again
    put(given.orders, "b", [order(4, data_pedido="ontem")])
    refresh.refresh(spark, lake, given)
    assert rows(read("silver_pedidos"), "id_pedido", "ano") == [(1, 2025), (3, 2025), (4, None)]
    assert rows(read("gold_volume_por_rota"), "total_pedidos") == [(3,)]
    assert read("silver_status").count() == 2

    again = refresh.refresh(spark, lake, given, full_refresh=True)
    assert again.generation != lake.generation
    assert rows(refresh.read(spark, again, "silver_pedidos"), "id_pedido") == [(4,), (50,), (51,)]
    assert read("silver_pedidos").count() == 3


def test_rule_counts_of_a_stream(spark, tmp_path, given):
    fill(given)
    lake = refresh.Lake(str(tmp_path / "lake"))
    refresh.ingest(spark, lake, given)
    stream = silver.orders(bronze.table_stream(spark, lake.table("bronze_pedidos")), given.customers)
    query = bronze.finish(bronze.append(stream, lake.table("s"), lake.checkpoint("s")))
    seen = [p.observedMetrics["regras_pedidos"].asDict() for p in query.recentProgress if p.observedMetrics]
    total = {k: sum(m[k] for m in seen) for k in seen[0]}
    assert total == {"linhas": 4, "id_pedido_valido": 1, "peso_positivo": 1, "valor_frete_valido": 1, "data_pedido_legivel": 0}


def test_max_files_splits_the_backlog(spark, tmp_path, given):
    for name in "abc":
        put(given.orders, name, [order(ord(name))])
    stream = bronze.landing_stream(spark, given.orders, schemas.ORDER, max_files=1)
    query = bronze.finish(bronze.append(stream, f"{tmp_path}/t", f"{tmp_path}/c"))
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3


def test_stream_enrichment_does_not_shuffle(spark, tmp_path, given):
    fill(given)
    lake = refresh.Lake(str(tmp_path / "lake"))
    refresh.ingest(spark, lake, given)
    same = silver.orders(refresh.read(spark, lake, "bronze_pedidos"), given.customers, metrics=None)
    plan = same._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_newest_status_on_a_stream(spark, tmp_path, rows):
    ref = schemas.status_reference(spark)
    silver.status(logistics.status(spark), ref, metrics=None).filter("timestamp IS NOT NULL").write.parquet(f"{tmp_path}/in")
    stream = live.newest_status(bronze.table_stream(spark, f"{tmp_path}/in"))
    query = stream.writeStream.format("memory").queryName("newest").outputMode("complete").trigger(availableNow=True).start()
    bronze.finish(query)
    assert rows(spark.table("newest"), "id_carga", "id_status") == [(1, 12), (2, 12), (3, 9)]


def test_replays_are_dropped_and_late_events_kept(spark, tmp_path, rows):
    """Micro-batches out of order: repeats within a batch, over batches and over runs go, the first of each key stays."""
    folder, out, done = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/c"

    def land(*events):
        spark.createDataFrame(events, "e long, timestamp string").coalesce(1).write.mode("append").parquet(folder)

    def run():
        bronze.finish(bronze.append_new(bronze.table_stream(spark, folder, max_files=1), out, done, ["e"]))
        return rows(spark.read.parquet(out), "e")

    land((1, "2025-01-01 10:00:00"), (1, "2025-01-01 10:00:00"), (2, "2025-01-01 12:00:00"))
    land((2, "2025-01-01 12:00:00"), (3, "2024-01-01 08:00:00"), (None, None))
    land((4, "2019-01-01 00:00:00"), (1, "2025-01-01 10:00:00"), (None, None))
    assert run() == [(1,), (2,), (3,), (4,), (None,)]
    land((5, "2000-01-01 00:00:00"), (3, "2024-01-01 08:00:00"))
    assert run() == [(1,), (2,), (3,), (4,), (5,), (None,)] == run()


def test_no_invoice_is_lost(spark, tmp_path, given):
    """1,000 invoices in one order, and 20,000 equal items in one invoice: lists keep to the limits, nothing goes missing."""
    header = spark.createDataFrame([(1, 10.0), (2, 20.0)], "id_pedido long, valor_frete double")
    notes = spark.range(1001).select(
        F.col("id").alias("id_nf"), F.lit("000001").alias("numero_nf"), F.when(F.col("id") < 1000, 1).otherwise(2).cast("long").alias("id_pedido"),
        F.lit("2025-01-01 00:00:00").alias("data_emissao"), F.lit(3.0).alias("valor_total"), F.lit("k").alias("chave_acesso"),
    )
    items = spark.range(21_000).select(
        F.lit(7).cast("long").alias("id_item"), F.when(F.col("id") < 20_000, 1000).otherwise(F.col("id") - 20_000).alias("id_nf"),
        F.lit("x").alias("descricao"), F.lit("1").alias("ncm"), F.lit(1).alias("quantidade"), F.lit("UN").alias("unidade"),
        *[F.lit(0.5).alias(n) for n in ("valor_unitario", "valor_total", "peso_kg", "comprimento_cm", "largura_cm", "altura_cm")],
    )
    nested = nesting.nest_orders(header, notes, items)
    path = str(tmp_path / "nested")
    nested.write.parquet(path)
    nested = spark.read.parquet(path)
    sizes = nested.select(F.size("notas_fiscais").alias("n"), F.array_max(F.transform("notas_fiscais", lambda nf: F.size(nf["itens"]))).alias("m"))
    assert sizes.filter(f"n > {nesting.INVOICES_PER_DOCUMENT} OR m > {nesting.ITEMS_PER_INVOICE}").count() == 0
    assert nested.filter("parte = 0").count() == 2
    found = nesting.invoices(silver.invoices(nested))
    assert found.agg(F.count("*"), F.sum("itens"), F.sum("valor_itens")).head() == (1001, 21_000, 10_500.0)
    assert found.filter("id_nf = 1000").select("itens", "valor_itens").collect() == [(20_000, 10_000.0)]
    assert nesting.explode_items(nested, ["id_pedido"]).count() == 21_000


def test_invoices_of_one_document_stay_where_they_are(spark, rows):
    ddl = "id_nf long, numero_nf string, id_pedido long, data_emissao string, valor_total double, chave_acesso string, itens long, " \
        "valor_itens decimal(38,4), peso_itens_kg decimal(38,4)"
    whole = spark.sql("SELECT id, 'n', id, NULL, 1.5D, 'c', 2L, 3.25BD, NULL FROM range(6)").toDF(*[c.split()[0] for c in ddl.split(", ")])
    found = nesting.invoices(whole.select([F.col(c.split()[0]).cast(c.split(" ", 1)[1]) for c in ddl.split(", ")]))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    parts = nesting.invoices(whole.unionByName(whole.where("id_nf = 4").withColumn("valor_itens", F.lit(1.0))))
    assert rows(parts, "id_nf", "itens", "valor_itens", "peso_itens_kg") == [(i, 4 if i == 4 else 2, 4.25 if i == 4 else 3.25, None) for i in range(6)]


def test_documents_land_without_a_shuffle(spark, tmp_path):
    folder, frame = f"{tmp_path}/out", spark.range(100, numPartitions=3).select(F.col("id").alias("id_pedido"))
    streams._land(frame, folder, 8)
    files = [f for f in os.listdir(folder) if f.startswith("part-")]
    assert 8 <= len(files) <= 16 and landing.read_json(spark, folder, schemas.ORDER, "lines").count() == 100
    assert {int(f.split("-")[1]) for f in files} == {0, 1, 2}  # the tasks that read the rows write them


def test_stored_documents_are_compressed_well(spark, tmp_path, given):
    put(given.orders, "a", [order(1)])
    lake, given = refresh.Lake(f"{tmp_path}/lake"), replace(given, invoices=None, status=None)
    refresh.ingest(spark, lake, given)
    refresh.clean(spark, lake, given, ["silver_notas_fiscais"])
    for name in ("bronze_pedidos", "silver_notas_fiscais"):
        files = [f for _, _, names in os.walk(lake.table(name)) for f in names if f.startswith("part-")]
        assert files and all(f.endswith(".zstd.parquet") for f in files)


@pytest.mark.parametrize("layout", landing.LAYOUTS)
def test_export_layouts_round_trip(spark, tmp_path, layout, rows):
    df = spark.range(25).select(F.col("id").alias("id_carga"), F.lit(3).alias("id_status"), F.lit("2025-01-01").alias("timestamp"),
                                F.lit("ação").alias("observacao"), F.lit(1.5).alias("latitude"), F.lit(2.5).alias("longitude"))
    folder = f"{tmp_path}/out"
    landing.write_json(df.coalesce(1), folder, 10, layout)
    files = [f for f in os.listdir(folder) if f.startswith("part-")]
    assert len(files) == 3
    back = landing.read_json(spark, folder, schemas.STATUS, layout)
    assert rows(back, "id_carga", "observacao") == rows(df, "id_carga", "observacao")
    if layout == "array":
        assert sum(len(json.load(open(f"{folder}/{f}", encoding="utf-8"))) for f in files) == 25


@pytest.mark.parametrize("layout", landing.LAYOUTS)
def test_whole_exports_are_compressed(spark, tmp_path, layout, rows):
    df = spark.range(1200).select(F.col("id").alias("id_pedido"), F.lit("x").alias("tipo_frete"))
    folder = f"{tmp_path}/out"
    landing.write_orders(df.coalesce(1), folder, layout)
    files = [f for f in os.listdir(folder) if f.startswith("part-")]
    assert len(files) == 3 and all(f.endswith(".gz") for f in files)
    assert rows(landing.read_json(spark, folder, schemas.ORDER, layout), "id_pedido", "tipo_frete") == rows(df)


def test_a_backlog_takes_as_many_batches_at_any_size(spark, tmp_path):
    for files in (1, 20, 40):
        folder = str(tmp_path / f"n{files}")
        spark.range(400).repartition(files).write.parquet(f"{folder}/lote=0")
        share = bronze.share_of_files(spark, folder, 8, 3)
        assert share == max(3, -(-files // 8))


def test_documents_that_come_once_are_not_shuffled(spark, tmp_path, rows):
    known = Seen(str(tmp_path / "vistos"), ("k",), "k bigint")
    table = str(tmp_path / "tabela")

    def batch(*values):
        return spark.createDataFrame(values, "k bigint, v string, arquivo_momento int").coalesce(1)

    tags = tagged(batch((1, "a", 0), (None, "n", 0)), ("k",))
    keyed = tags.where("_perto IS NOT NULL")
    sizes = keyed.groupBy("_um", "_dois").agg(F.count(F.lit(1)).alias("_n"))
    assert known._chosen(tags, tags, keyed, sizes, ["_um", "_dois"]) is tags
    known.add(batch((1, "a", 0), (2, "a", 0), (2, "b", 1), (3, "a", 0), (None, "n", 0), (None, "n", 0)), 0, table)
    # A replay, a correction that comes twice, an old and a new version of a new document, one that comes once, one without a key.
    known.add(batch((1, "a", 2), (3, "c", 2), (3, "c", 3), (4, "a", 2), (4, "b", 3), (5, "a", 2), (None, "n", 2)), 1, table)
    known.add(batch(*[(n, "a", 4) for n in range(6, 12)], (5, "a", 4)), 2, table)
    known.add(batch((1, "a", 5), (5, "a", 5)), 3, table)
    stored = spark.read.schema("k bigint, v string, lote int").parquet(table)
    late = [(n, "a", 2) for n in range(6, 12)]
    first = [(1, "a", 0), (2, "b", 0), (3, "a", 0), (None, "n", 0), (None, "n", 0)]
    assert rows(stored) == rows(spark.createDataFrame([*first, (3, "c", 1), (4, "b", 1), (5, "a", 1), (None, "n", 1), *late], stored.schema))
    assert rows(known.old.read(spark), "k", "origem") == [(3, 0)]


def test_a_large_export_lands_in_few_files(spark, tmp_path, rows):
    df = spark.range(4000).select(F.col("id").alias("id_pedido"), F.lit("x").alias("tipo_frete"))
    for layout in landing.LAYOUTS:
        folder = f"{tmp_path}/{layout}"
        landing.write_orders(df.coalesce(1), folder, layout, documents=landing.FILES * 2000)
        assert len([f for f in os.listdir(folder) if f.startswith("part-")]) == 2
        assert landing.read_json(spark, folder, schemas.ORDER, layout).count() == 4000
    assert landing.per_file(10**9, 500) == landing.MOST_IN_FILE["lines"] and landing.per_file(10**9, 500, "array") == landing.MOST_IN_FILE["array"]


def test_documents_of_a_batch_are_read_once(spark, tmp_path, rows):
    known, table, read = Seen(str(tmp_path / "vistos"), ("k",), "k bigint"), str(tmp_path / "tabela"), spark.sparkContext.accumulator(0)

    def seen_row(k):
        read.add(1)
        return k

    each = F.udf(seen_row, "bigint").asNondeterministic()

    def add(number, *values):
        read.value = 0
        batch = spark.createDataFrame(values, "k bigint, v string").coalesce(1)
        known.add(batch.select(each("k").alias("k"), "v"), number, table)
        return read.value

    assert add(0, (1, "a"), (2, "a")) == 2
    assert add(1, (2, "a"), (3, "a"), (3, "b"), (4, "a")) == 4  # a replay, one that comes twice, a new one
    assert add(1, (2, "a"), (3, "a"), (4, "a")) == 3  # the same micro-batch again
    stored = spark.read.schema("k bigint, v string, lote int").parquet(table)
    assert rows(stored) == [(1, "a", 0), (2, "a", 0), (3, "a", 1), (4, "a", 1)]
    assert not (tmp_path / "tabela/_novos/lote=0").exists() and not (tmp_path / "tabela/_novos/lote=1").exists()


def test_the_index_is_read_from_files_alone(spark, tmp_path):
    known = Seen(str(tmp_path / "s"), ("k",), "k bigint")
    known.add(spark.createDataFrame([(1, "a")], "k bigint, v string"), 0, str(tmp_path / "t"))
    assert "ExistingRDD" not in known.index.read(spark)._jdf.queryExecution().executedPlan().toString()


def test_unknown_layout_is_refused(spark):
    with pytest.raises(ValueError):
        landing.read_options("csv")


def test_scratch_follows_the_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == root and scratch(spark, "x").startswith(root)
    assert scratch(spark, "x") != scratch(spark, "x")
