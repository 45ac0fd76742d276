"""Streams: the tables are exported as landing files and come back through the incremental path."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.catalogue.routes import _nested, _parts, _short
from haulage.catalogue.shared import oracle, plain
from haulage.operators import rules
from haulage.plans import refresh
from haulage.session import scratch, short_lived_shuffles
from haulage.sources import landing, schemas
from haulage.sources import star_schema as star
from haulage.streaming import bronze, silver

_MOMENT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
#: Micro-batches that a large backlog is worked off in: their number must not grow with the tables, as each has a cost of its own.
BATCHES = 8
_MOST_IN_FILE = 50_000


def documents(spark: SparkSession, sf_dir: str, part: tuple[int, int] = (0, 1), short: bool = False) -> DataFrame:
    """Nested orders, or a part of them, as they land: times are texts."""
    return _nested(spark, sf_dir, part, short).withColumn("data_pedido", F.date_format("data_pedido", _MOMENT))


def land_orders(spark: SparkSession, sf_dir: str, layout: str = "lines") -> refresh.Inputs:
    """Export the nested orders as landing files."""
    folder, parts = scratch(spark, "pedidos_json"), _parts(spark, sf_dir)
    rows = star.table(spark, sf_dir, "orders").count() // len(parts)
    with short_lived_shuffles(spark):
        short = _short(spark, sf_dir)
        for part in parts:
            landing.write_orders(documents(spark, sf_dir, part, short), folder, layout, "append", rows)
    return refresh.Inputs(customers=star.customers(spark, sf_dir), orders=folder, layout=layout)


def land_in_parts(spark: SparkSession, sf_dir: str, lake: refresh.Lake, layout: str = "lines") -> refresh.Inputs:
    """Export the nested orders part by part. Each part but the last is ingested, and its landing files go, before the next one lands;
    the last is left for the caller to ingest. So all landing files never lie beside all of bronze."""
    given = refresh.Inputs(customers=star.customers(spark, sf_dir), orders=scratch(spark, "pedidos_json"), layout=layout)
    parts = _parts(spark, sf_dir)
    rows = star.table(spark, sf_dir, "orders").count() // len(parts)
    short = _short(spark, sf_dir)
    for part in parts:
        landing.write_orders(documents(spark, sf_dir, part, short), given.orders, layout, "append", rows)
        if part != parts[-1]:
            refresh.ingest(spark, lake, given)
            landing.clear(spark, given.orders)
    if len(parts) == 1:
        return given
    return replace(given, max_stored=bronze.share_of_files(spark, lake.table("bronze_pedidos"), len(parts) - 1, 8))


def land_status(spark: SparkSession, sf_dir: str, layout: str = "lines") -> refresh.Inputs:
    """Export the status events as landing files."""
    folder = scratch(spark, "status_json")
    events = star.status_events(spark, sf_dir).drop("id_movimento")
    texts = events.withColumn("timestamp", F.date_format("timestamp", _MOMENT))
    landing.write_events(texts, folder, layout, documents=star.table(spark, sf_dir, "events").count())
    return refresh.Inputs(customers=star.customers(spark, sf_dir), status=folder, layout=layout)


def _bronze_orders(spark: SparkSession, sf_dir: str, layout: str = "lines") -> tuple[refresh.Lake, refresh.Inputs]:
    """A lake with all orders in bronze, and what it was given; the landing files are gone."""
    lake = refresh.Lake(scratch(spark, "lake"))
    with short_lived_shuffles(spark):
        given = land_in_parts(spark, sf_dir, lake, layout)
        refresh.ingest(spark, lake, given)
    landing.clear(spark, given.orders)
    return lake, given


def _run(spark: SparkSession, sf_dir: str, *targets: str) -> refresh.Lake:
    lake, given = _bronze_orders(spark, sf_dir)
    with short_lived_shuffles(spark):
        refresh.clean(spark, lake, given, targets)
    return lake


def stream_ingest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files in array layout to the bronze table."""
    lake, _ = _bronze_orders(spark, sf_dir, layout="array")
    stored = refresh.read(spark, lake, "bronze_pedidos")
    # A very large order spans several documents, and a very large invoice occurs in several of them.
    invoices = stored.select("id_pedido", F.explode("notas_fiscais.id_nf").alias("id_nf"))
    counted = invoices.groupBy("id_pedido").agg(F.count_distinct("id_nf").alias("total_nfs"))
    heads = silver.first_parts(stored).select(
        "id_pedido", "id_cliente", F.to_date("data_pedido").alias("data"), "valor_frete", "prioridade"
    )
    return plain(heads.join(counted, "id_pedido", "left").withColumn("total_nfs", F.coalesce("total_nfs", F.lit(0))))


def stream_ingest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = land_status(spark, sf_dir)
    lake = refresh.Lake(scratch(spark, "lake"))
    refresh.ingest(spark, lake, given)
    stored = refresh.read(spark, lake, "bronze_status")
    return plain(stored.select("id_carga", "id_status", "timestamp", "observacao", "latitude", "longitude"))


def stream_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders through bronze and silver: rules, customer join and date parts on the stream."""
    lake = _run(spark, sf_dir, "silver_pedidos")
    stored = refresh.read(spark, lake, "silver_pedidos")
    return plain(stored.select("id_pedido", "razao_social", "cidade_cliente", "data_pedido", "valor_frete", "ano", "mes", "dia"))


def stream_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items exploded on the stream."""
    lake = _run(spark, sf_dir, "silver_itens_nf")
    stored = refresh.read(spark, lake, "silver_itens_nf")
    return plain(stored.select("id_pedido", "id_nf", "id_item", "descricao", "ncm", "quantidade", "valor_total_item", "comprimento_cm"))


def stream_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts that the stream observed while silver was written, and the rows left in silver."""
    lake = _run(spark, sf_dir, "silver_pedidos")
    found = rules.totals(refresh.ledger(spark, lake)).select("regra", "acao", "total", "aprovadas", "violacoes")
    kept = refresh.read(spark, lake, "silver_pedidos").agg(F.count(F.lit(1))).scalar()
    return plain(found.withColumn("mantidas", kept))


def stream_status_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status events joined to the names of their codes on the stream."""
    given, lake = land_status(spark, sf_dir), refresh.Lake(scratch(spark, "lake"))
    refresh.ingest(spark, lake, given)
    refresh.clean(spark, lake, given, ["silver_status"])
    stored = refresh.read(spark, lake, "silver_status")
    return plain(stored.select("id_carga", "id_status", "descricao_status", "ordem", "timestamp", "latitude", "longitude"))


def stream_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices through bronze and silver: none is lost or counted twice, whatever the limits of a document."""
    lake = _run(spark, sf_dir, "silver_notas_fiscais")
    with short_lived_shuffles(spark):
        found = refresh.invoices(spark, lake)
    return plain(found.select("id_pedido", "id_nf", "itens", "valor_itens"))


def stream_without_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events land twice, in several micro-batches and not in order; one of each is stored."""
    folder, lake = scratch(spark, "replayed"), refresh.Lake(scratch(spark, "lake"))
    events = star.status_events(spark, sf_dir)
    for mode, part in (("error", "id_movimento % 3 <> 0"), ("append", "id_movimento % 2 = 0"), ("append", "true")):
        events.where(part).coalesce(2).write.mode(mode).parquet(folder)
    source = bronze.table_stream(spark, folder, max_files=2)
    bronze.finish(bronze.append_new(source, lake.table("eventos"), lake.checkpoint("eventos"), ["id_movimento"]))
    return plain(refresh.read(spark, lake, "eventos").select("id_movimento", "id_carga", "id_status", "timestamp"))


def _land(rows: DataFrame, path: str, files: int, count: int | None = None) -> None:
    """Export in `files` files at least, twice as many at most, without a shuffle of whole documents. `count`: about as many rows."""
    most = max(1, -(-(rows.count() if count is None else count) // files))
    landing.write_json(rows.coalesce(files), path, most, mode="append", compression="gzip")


def _in_order(nested: DataFrame) -> DataFrame:
    """The documents with sorted lists, so that an order that is put together again says the same."""
    whole = F.transform("notas_fiscais", lambda nf: nf.withField("itens", F.sort_array(nf["itens"])))
    return nested.withColumn("notas_fiscais", F.sort_array(whole))


def _landed_twice(spark: SparkSession, sf_dir: str) -> tuple[refresh.Lake, refresh.Inputs]:
    """A lake after two refreshes of several micro-batches each. First the orders land, a seventh of them with wrong figures, and
    half of the events; then all orders with the right figures, that is six of seven a second time, and all events.

    Large tables land by parts: what has been ingested goes before the next part lands, and the last part comes with the refresh."""
    orders, events, lake = scratch(spark, "pedidos_json"), scratch(spark, "status_json"), refresh.Lake(scratch(spark, "lake"))
    parts = _parts(spark, sf_dir)
    rows = -(-star.table(spark, sf_dir, "orders").count() // len(parts))
    files = max(8 if len(parts) == 1 else 24, -(-rows // _MOST_IN_FILE))
    wrong = F.col("id_pedido") % 7 == 0
    mistakes = {
        "valor_frete": F.when(wrong, F.col("valor_frete") + F.lit(1000.25)).otherwise(F.col("valor_frete")),
        "cidade_destino": F.when(wrong, F.lit("LONGE")).otherwise(F.col("cidade_destino")),
        "notas_fiscais": F.when(wrong, F.slice("notas_fiscais", 1, 1)).otherwise(F.col("notas_fiscais")),
    }
    moves = star.status_events(spark, sf_dir).withColumn("timestamp", F.date_format("timestamp", _MOMENT))
    given = refresh.Inputs(
        customers=star.customers(spark, sf_dir), orders=orders, status=events, layout="lines",
        max_files=files // 2 if len(parts) == 1 else 2 * files, loads=star.loads(spark, sf_dir), trucks=star.trucks(spark, sf_dir),
    )
    with short_lived_shuffles(spark):
        short = _short(spark, sf_dir)
        for changed, some in ((mistakes, "id_movimento % 2 = 0"), ({}, "true")):
            for part in parts:
                _land(_in_order(documents(spark, sf_dir, part, short)).withColumns(changed), orders, files, rows)
                if part != parts[-1]:
                    refresh.ingest(spark, lake, replace(given, status=None))
                    landing.clear(spark, orders)
                    given = replace(given, max_stored=bronze.share_of_files(spark, lake.table("bronze_pedidos"), len(parts) - 1, 8))
            _land(moves.where(some).drop("id_movimento"), events, files)
            refresh.refresh(spark, lake, given)
            landing.clear(spark, orders)
            landing.clear(spark, events)
    return lake, given


def refresh_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and sums of every table after orders and events came twice and some orders were corrected."""
    lake, _ = _landed_twice(spark, sf_dir)
    tables = {
        "silver_pedidos": ("count(1)", "sum(cast(valor_frete AS decimal(18,4)))"),
        "silver_itens_nf": ("count(1)", "sum(cast(valor_total_item AS decimal(18,4)))"),
        "silver_status": ("count(1)", "sum(id_status)"),
        "estado_cargas": ("count(1)", "sum(id_status)"),
        "gold_volume_por_rota": ("sum(total_pedidos)", "sum(cast(valor_frete_total AS decimal(18,4)))"),
        "gold_status_entregas": ("sum(total_cargas)", "sum(total_cargas * id_status)"),
    }
    frames = []
    for name, (rows, total) in tables.items():
        stored = refresh.state(lake).read(spark) if name == "estado_cargas" else refresh.read(spark, lake, name)
        frames.append(stored.selectExpr(f"'{name}' AS tabela", f"{rows} AS linhas", f"cast({total} AS double) AS soma"))
    notes = refresh.invoices(spark, lake)
    frames.append(notes.selectExpr("'notas' AS tabela", "count(1) AS linhas", "cast(sum(itens) AS double) AS soma"))
    return plain(reduce(DataFrame.unionByName, frames))


def refresh_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route volumes carried forward by counters through replays and corrections."""
    lake, _ = _landed_twice(spark, sf_dir)
    return plain(refresh.read(spark, lake, "gold_volume_por_rota"))


def refresh_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily volumes carried forward by counters through replays and corrections."""
    lake, _ = _landed_twice(spark, sf_dir)
    return plain(refresh.read(spark, lake, "gold_volume_diario"))


def rule_counts_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule ledger of orders, items and events over several micro-batches, of which the first of each table runs twice."""
    orders, events = land_orders(spark, sf_dir), land_status(spark, sf_dir)
    lake = refresh.Lake(scratch(spark, "lake"))
    for feed in (replace(orders, status=None), replace(events, orders=None)):
        files = bronze.share_of_files(spark, feed.orders or feed.status, BATCHES, 3)
        refresh.ingest(spark, lake, replace(feed, max_files=files))
        landing.clear(spark, feed.orders or feed.status)
    given = replace(orders, status=events.status)
    for step in refresh.steps(spark, given):

        def attempts(batch: DataFrame, number: int, step=step) -> None:
            for _ in range(2 if number == 0 else 1):
                refresh.clean_batch(lake, step, batch, number)

        files = bronze.share_of_files(spark, lake.table(step.source), BATCHES, 4)
        rows = bronze.table_stream(spark, lake.table(step.source), max_files=files)
        bronze.finish(bronze.each_batch(rows, lake.checkpoint(step.target), attempts))
    return plain(rules.totals(refresh.ledger(spark, lake)))


def newest_status_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of the newest status of each load after many small micro-batches, out of order, with bases in between."""
    given = replace(land_status(spark, sf_dir), max_files=1)
    folder, lake = scratch(spark, "status_json"), refresh.Lake(scratch(spark, "lake"))
    spark.read.text(given.status).repartition(30).write.option("compression", "gzip").text(folder)
    given = replace(given, status=folder)
    refresh.ingest(spark, lake, replace(given, max_files=10))
    refresh.clean(spark, lake, given)
    return plain(refresh.state(lake).read(spark).drop("data_ingestao"))


QUERIES = {
    f.__name__: f
    for f in (
        stream_ingest_orders, stream_ingest_status, stream_orders, stream_items, stream_rules, stream_status_lookup,
        stream_invoices, stream_without_replays, refresh_replayed, refresh_routes, refresh_daily, rule_counts_stored,
        newest_status_stored,
    )
}

ORACLE = {
    "stream_ingest_orders": oracle(
        """SELECT p.id_pedido, id_cliente, CAST(CAST(data_pedido AS DATE) AS VARCHAR) AS data, valor_frete, prioridade,
        COALESCE(n, 0) AS total_nfs FROM pedidos p LEFT JOIN
        (SELECT l_orderkey, COUNT(DISTINCT l_linenumber) AS n FROM lineitem GROUP BY 1) ON l_orderkey = p.id_pedido"""
    ),
    "stream_ingest_status": oracle(
        """SELECT id_carga, id_status, STRFTIME(timestamp, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, observacao, latitude,
        longitude FROM eventos"""
    ),
    "stream_orders": oracle(
        """SELECT id_pedido, razao_social, c.cidade AS cidade_cliente, data_pedido, valor_frete, YEAR(data_pedido) AS ano,
        MONTH(data_pedido) AS mes, DAY(data_pedido) AS dia FROM silver s LEFT JOIN clientes c ON s.id_cliente = c.id_cliente"""
    ),
    "stream_items": oracle(
        """SELECT id_pedido, id_nf, id_item, descricao, ncm, quantidade, valor_total AS valor_total_item, comprimento_cm
        FROM itens WHERE quantidade > 0"""
    ),
    "stream_rules": oracle(
        """SELECT regra, acao, total, aprovadas, total - aprovadas AS violacoes, (SELECT COUNT(*) FROM silver) AS mantidas FROM (
        SELECT 'id_pedido_valido' AS regra, 'drop' AS acao, COUNT(*) AS total, COUNT(id_pedido) AS aprovadas FROM pedidos
        UNION ALL SELECT 'peso_positivo', 'warn', COUNT(*), COUNT(*) FILTER (peso_total_kg > 0) FROM pedidos
        UNION ALL SELECT 'valor_frete_valido', 'drop', COUNT(*), COUNT(*) FILTER (valor_frete >= 0) FROM pedidos
        UNION ALL SELECT 'data_pedido_legivel', 'warn', COUNT(*), COUNT(data_pedido) FROM pedidos)"""
    ),
    "stream_invoices": oracle(
        """SELECT id_pedido, id_nf, COUNT(*) AS itens, CAST(SUM(CAST(valor_total AS DECIMAL(18,4))) AS DOUBLE) AS valor_itens
        FROM itens GROUP BY 1, 2"""
    ),
    "stream_status_lookup": oracle(
        "SELECT id_carga, id_status, descricao_status, ordem, timestamp, latitude, longitude FROM silver_eventos"
    ),
    "stream_without_replays": oracle("SELECT id_movimento, id_carga, id_status, timestamp FROM eventos"),
    "refresh_replayed": oracle(
        """SELECT 'silver_pedidos' AS tabela, COUNT(*) AS linhas, CAST(SUM(CAST(valor_frete AS DECIMAL(18,4))) AS DOUBLE) AS soma FROM silver
        UNION ALL SELECT 'silver_itens_nf', COUNT(*), CAST(SUM(CAST(valor_total AS DECIMAL(18,4))) AS DOUBLE) FROM itens WHERE quantidade > 0
        UNION ALL SELECT 'notas', COUNT(DISTINCT id_nf), CAST(COUNT(*) AS DOUBLE) FROM itens
        UNION ALL SELECT 'silver_status', COUNT(*), CAST(SUM(id_status) AS DOUBLE) FROM silver_eventos
        UNION ALL SELECT 'estado_cargas', COUNT(*), CAST(SUM(id_status) AS DOUBLE) FROM ultimo_evento
        UNION ALL SELECT 'gold_status_entregas', COUNT(*), CAST(SUM(id_status) AS DOUBLE) FROM ultimo_evento
        UNION ALL SELECT 'gold_volume_por_rota', COUNT(*), CAST(SUM(CAST(valor_frete AS DECIMAL(18,4))) AS DOUBLE) FROM silver"""
    ),
    "refresh_routes": oracle("SELECT * FROM rotas"),
    "refresh_daily": oracle("SELECT * FROM diario"),
    "rule_counts_stored": oracle(
        """SELECT tabela, regra, acao, total, total - violacoes AS aprovadas, violacoes FROM (
        SELECT 'silver_pedidos' AS tabela, 'id_pedido_valido' AS regra, 'drop' AS acao, COUNT(*) AS total, COUNT(*) FILTER (id_pedido IS NULL) AS violacoes FROM pedidos
        UNION ALL SELECT 'silver_pedidos', 'peso_positivo', 'warn', COUNT(*), COUNT(*) FILTER (peso_total_kg IS NULL OR peso_total_kg <= 0) FROM pedidos
        UNION ALL SELECT 'silver_pedidos', 'valor_frete_valido', 'drop', COUNT(*), COUNT(*) FILTER (valor_frete IS NULL OR valor_frete < 0) FROM pedidos
        UNION ALL SELECT 'silver_pedidos', 'data_pedido_legivel', 'warn', COUNT(*), COUNT(*) FILTER (data_pedido IS NULL) FROM pedidos
        UNION ALL SELECT 'silver_itens_nf', 'quantidade_valida', 'drop', COUNT(*), COUNT(*) FILTER (quantidade IS NULL OR quantidade <= 0) FROM itens
        UNION ALL SELECT 'silver_status', 'carga_valida', 'drop', COUNT(*), COUNT(*) FILTER (id_carga IS NULL) FROM eventos
        UNION ALL SELECT 'silver_status', 'momento_legivel', 'warn', COUNT(*), COUNT(*) FILTER (timestamp IS NULL) FROM eventos)"""
    ),
    "newest_status_stored": oracle(
        "SELECT id_carga, id_status, descricao_status, ordem, timestamp, latitude, longitude FROM ultimo_evento"
    ),
}
