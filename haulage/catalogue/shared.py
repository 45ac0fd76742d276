"""SQL building blocks of the oracle statements, and output casts of the queries."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, ShortType, TimestampType

from haulage.sources.schemas import STATUS_NAMES
from haulage.sources.star_schema import BASE_TONNES, STATUS_OF_EVENT, TRUCK_TYPES


def plain(df: DataFrame) -> DataFrame:
    """Portable output types: BIGINT for ints, zone-free timestamps, dates as text."""

    def cast(field) -> Column:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (IntegerType, ShortType)):
            return col.cast("bigint").alias(field.name)
        if isinstance(field.dataType, TimestampType):
            return col.cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, DateType):
            return col.cast("string").alias(field.name)
        return col

    return df.select(*[cast(f) for f in df.schema.fields])


def esum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,4))) AS DOUBLE)"


def eavg(x: str) -> str:
    return f"({esum(x)} / NULLIF(COUNT({x}), 0))"


def half_up(x: str, digits: int) -> str:
    f = f"CAST({10**digits} AS DOUBLE)"
    return f"(FLOOR({x} * {f} + CAST(0.5 AS DOUBLE)) / {f})"


def km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        "CAST(12742 AS DOUBLE) * ASIN(SQRT("
        f"POW(SIN((RADIANS({lat2}) - RADIANS({lat1})) / 2), 2) + COS(RADIANS({lat1})) * COS(RADIANS({lat2})) * "
        f"POW(SIN((RADIANS({lon2}) - RADIANS({lon1})) / 2), 2)))"
    )


def _case(subject: str, pairs) -> str:
    return f"CASE {subject} " + " ".join(f"WHEN {k} THEN {v}" for k, v in pairs) + " END"


def _lat(k: str) -> str:
    return f"(CAST(-33 AS DOUBLE) + CAST(({k}) * 7919 % 38000 AS DOUBLE) / CAST(1000 AS DOUBLE))"


def _lon(k: str) -> str:
    return f"(CAST(-73 AS DOUBLE) + CAST(({k}) * 104729 % 38000 AS DOUBLE) / CAST(1000 AS DOUBLE))"


def _mil(x: str) -> str:
    return f"(CAST({x} AS DOUBLE) / CAST(1000 AS DOUBLE))"


_TYPE = _case("s_suppkey % 6", [(i, f"'{t}'") for i, t in enumerate(TRUCK_TYPES)])
_TONNES = f"CAST({_case('s_suppkey % 6', enumerate(BASE_TONNES))} AS DOUBLE)"
_PLACE = "(CAST(c_nationkey AS BIGINT) * 100 + ASCII(c_mktsegment))"
_SHIFT = _mil("(c_custkey % 101) - 50")
_SITE = "((user_id % 25) * 100 + ASCII('BUILDING'))"
_PRIORITY = "CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgente' WHEN '2-HIGH' THEN 'Expressa' ELSE 'Normal' END"
_RATE = "CAST(CASE prioridade WHEN 'Normal' THEN 1 WHEN 'Expressa' THEN 1.5 WHEN 'Urgente' THEN 2.5 END AS DOUBLE)"
FREIGHT = half_up(
    f"({_RATE} * (peso_total_kg * CAST(0.15 AS DOUBLE) + volume_total_m3 * CAST(50 AS DOUBLE) "
    "+ valor_mercadoria * CAST(0.02 AS DOUBLE)))",
    2,
)
_STATUS_ROWS = ", ".join(f"({i}, '{name}', {i})" for i, name in enumerate(STATUS_NAMES, start=1))
_STATUS_OF = _case("event_type", [(f"'{k}'", v) for k, v in STATUS_OF_EVENT.items()])
_PAD8C = "LPAD(CAST(c_custkey AS VARCHAR), CAST(GREATEST(8, LENGTH(CAST(c_custkey AS VARCHAR))) AS INT), '0')"
_PAD3S = "LPAD(CAST(s_suppkey AS VARCHAR), CAST(GREATEST(3, LENGTH(CAST(s_suppkey AS VARCHAR))) AS INT), '0')"
_PAD8S = "LPAD(CAST(s_suppkey AS VARCHAR), CAST(GREATEST(8, LENGTH(CAST(s_suppkey AS VARCHAR))) AS INT), '0')"
BOX = "(comprimento_cm * largura_cm * altura_cm * CAST(quantidade AS DOUBLE) / CAST(1000000 AS DOUBLE))"

BLOCKS: dict[str, str] = {
    "clientes": f"""SELECT CAST(c_custkey AS BIGINT) AS id_cliente, c_name AS razao_social, n_name AS uf,
        SUBSTR({_PAD8C}, 1, 2) || '.' || SUBSTR({_PAD8C}, 3, 3) || '.' || SUBSTR({_PAD8C}, 6, 3) || '/0001-'
            || SUBSTR({_PAD8C}, 7, 2) AS cnpj,
        n_name || ' ' || c_mktsegment AS cidade,
        {_lat(_PLACE)} + {_SHIFT} AS latitude, {_lon(_PLACE)} - {_SHIFT} AS longitude
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "caminhoes": f"""SELECT CAST(s_suppkey AS BIGINT) AS id_caminhao, {_TYPE} AS tipo,
        'HLG' || SUBSTR({_PAD3S}, 1, 1) || 'A' || SUBSTR({_PAD3S}, 2, 18) AS placa,
        {_TONNES} AS capacidade_toneladas, {_TONNES} * CAST(2.5 AS DOUBLE) AS volume_m3 FROM supplier""",
    "motoristas": f"""SELECT CAST(s_suppkey AS BIGINT) AS id_motorista, s_name AS nome,
        '1' || SUBSTR({_PAD8S}, 1, 2) || '.' || SUBSTR({_PAD8S}, 3, 3) || '.1' || SUBSTR({_PAD8S}, 6, 2) || '-'
            || SUBSTR({_PAD8S}, 7, 2) AS cpf,
        '(11)9' || SUBSTR({_PAD8S}, 1, 4) || '-' || SUBSTR({_PAD8S}, 5, 4) AS celular,
        CASE WHEN s_suppkey % 6 <= 1 THEN 'C' WHEN s_suppkey % 6 = 2 THEN 'D' ELSE 'E' END AS cnh_categoria,
        CAST(s_suppkey AS BIGINT) AS id_caminhao,
        CASE WHEN s_acctbal < 0 THEN 'Afastado' WHEN s_acctbal < 1000 THEN 'Férias' ELSE 'Ativo' END AS status,
        CAST(3 AS DOUBLE) + CAST(s_suppkey % 21 AS DOUBLE) / CAST(10 AS DOUBLE) AS avaliacao FROM supplier""",
    "linhas": f"""SELECT l_orderkey, {esum('l_quantity * CAST(50 AS DOUBLE)')} AS peso_total_kg,
        {esum('l_quantity * CAST(0.15 AS DOUBLE)')} AS volume_total_m3,
        {esum('l_extendedprice')} AS valor_mercadoria, MIN(l_suppkey) AS l_suppkey
        FROM lineitem GROUP BY l_orderkey""",
    "pedidos_base": f"""SELECT CAST(o_orderkey AS BIGINT) AS id_pedido, CAST(o_custkey AS BIGINT) AS id_cliente,
        o_orderdate AS data_pedido, peso_total_kg, volume_total_m3, valor_mercadoria,
        CASE WHEN o_orderstatus = 'F' THEN 'FOB' ELSE 'CIF' END AS tipo_frete, {_PRIORITY} AS prioridade,
        sn.n_name || ' BUILDING' AS cidade_origem, sn.n_name AS uf_origem,
        cn.n_name || ' ' || c_mktsegment AS cidade_destino, cn.n_name AS uf_destino
        FROM orders LEFT JOIN linhas ON o_orderkey = l_orderkey
        LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
        LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey""",
    "pedidos": f"SELECT *, {FREIGHT} AS valor_frete FROM pedidos_base",
    "silver": "SELECT * FROM pedidos WHERE id_pedido IS NOT NULL AND valor_frete >= 0",
    "cargas": f"""SELECT g.id_carga, g.id_caminhao, placa, sn.n_name || ' BUILDING' AS cidade_origem, sn.n_name AS uf_origem,
        cn.n_name || ' ' || c_mktsegment AS cidade_destino, cn.n_name AS uf_destino,
        CAST(100 + g.id_carga * 37 % 1900 AS BIGINT) AS km_total, valor * CAST(0.01 AS DOUBLE) AS peso_total_kg
        FROM (SELECT CAST(o_orderkey // 8 AS BIGINT) AS id_carga, MAX(o_orderkey) AS ultimo, {esum('o_totalprice')} AS valor,
              CAST((o_orderkey // 8) * 7919 % (SELECT COUNT(*) FROM supplier) AS BIGINT) AS id_caminhao
              FROM orders GROUP BY o_orderkey // 8) g
        JOIN orders o ON o.o_orderkey = g.ultimo JOIN customer ON o_custkey = c_custkey
        JOIN nation cn ON c_nationkey = cn.n_nationkey LEFT JOIN caminhoes t ON t.id_caminhao = g.id_caminhao
        LEFT JOIN supplier ON s_suppkey = g.id_caminhao LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey""",
    "status_ref": f"SELECT * FROM (VALUES {_STATUS_ROWS}) AS v(id_status, descricao_status, ordem)",
    "eventos": f"""SELECT CAST(user_id AS BIGINT) AS id_carga, CAST({_STATUS_OF} AS BIGINT) AS id_status,
        ts AS timestamp, event_type AS observacao, CAST(event_id AS BIGINT) AS id_movimento,
        {_lat(_SITE)} + {_mil('(event_id * 37 % 3001) - 1500')} AS latitude,
        {_lon(_SITE)} + {_mil('(event_id * 91 % 3001) - 1500')} AS longitude FROM events""",
    "silver_eventos": """SELECT e.*, descricao_status, CAST(ordem AS BIGINT) AS ordem
        FROM eventos e LEFT JOIN status_ref USING (id_status)""",
    "ultimo_evento": """SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id_carga
        ORDER BY timestamp DESC, id_status DESC, latitude DESC, longitude DESC) AS n FROM silver_eventos)
        WHERE n = 1""",
    "pedido_status": """SELECT p.id_pedido, e.id_carga, e.id_status, e.descricao_status, e.timestamp FROM (SELECT
        CAST(o_orderkey AS BIGINT) AS id_pedido FROM orders) p JOIN ultimo_evento e ON p.id_pedido // 8 = e.id_carga""",
    "centros": """SELECT UPPER(cidade) AS cidade, uf, CAST(SUM(CAST(latitude AS DECIMAL(18,6))) AS DOUBLE) / COUNT(*) AS latitude,
        CAST(SUM(CAST(longitude AS DECIMAL(18,6))) AS DOUBLE) / COUNT(*) AS longitude FROM clientes GROUP BY 1, 2""",
    "itens": """SELECT CAST(l_orderkey AS BIGINT) AS id_pedido, CAST(l_orderkey AS BIGINT) * 8 + l_linenumber AS id_nf,
        CAST(l_partkey AS BIGINT) AS id_item, p_name AS descricao, REGEXP_REPLACE(p_brand, '[^0-9]', '', 'g') AS ncm,
        CAST(l_quantity AS BIGINT) AS quantidade, 'UN' AS unidade, p_retailprice AS valor_unitario,
        l_extendedprice AS valor_total, l_quantity * CAST(50 AS DOUBLE) AS peso_kg,
        CAST(p_size AS DOUBLE) + CAST(0.5 AS DOUBLE) AS comprimento_cm,
        CAST(10 AS DOUBLE) + CAST(l_partkey % 40 AS DOUBLE) AS largura_cm,
        CAST(5 AS DOUBLE) + CAST(l_partkey % 25 AS DOUBLE) AS altura_cm
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "notas": f"SELECT id_nf, id_pedido, {esum('valor_total')} AS valor FROM itens GROUP BY 1, 2",
    "rotas": f"""SELECT cidade_origem, uf_origem, cidade_destino, uf_destino, COUNT(id_pedido) AS total_pedidos,
        {esum('peso_total_kg')} AS peso_total, {esum('valor_frete')} AS valor_frete_total,
        {eavg('valor_frete')} AS frete_medio FROM silver GROUP BY 1, 2, 3, 4""",
    "resumo_status": """SELECT descricao_status, id_status, ordem, COUNT(id_carga) AS total_cargas,
        MIN(timestamp) AS primeira_atualizacao, MAX(timestamp) AS ultima_atualizacao
        FROM ultimo_evento GROUP BY 1, 2, 3""",
    "mapa": """SELECT s.id_pedido, s.cidade_origem, s.uf_origem, o.latitude AS lat_origem, o.longitude AS long_origem,
        s.cidade_destino, s.uf_destino, d.latitude AS lat_destino, d.longitude AS long_destino,
        c.cidade AS cidade_cliente, s.peso_total_kg, s.valor_frete, s.tipo_frete, s.prioridade,
        COALESCE(e.descricao_status, 'Sem Status') AS status_atual, e.id_status
        FROM silver s LEFT JOIN clientes c ON s.id_cliente = c.id_cliente
        LEFT JOIN centros o ON s.cidade_origem = o.cidade AND s.uf_origem = o.uf
        LEFT JOIN centros d ON s.cidade_destino = d.cidade AND s.uf_destino = d.uf
        LEFT JOIN pedido_status e ON s.id_pedido = e.id_pedido""",
    "diario": f"""SELECT CAST(CAST(data_pedido AS DATE) AS VARCHAR) AS data, COUNT(*) AS total_pedidos,
        {half_up(esum('peso_total_kg'), 2)} AS peso_total, {half_up(esum('valor_frete'), 2)} AS valor_total,
        COUNT(*) FILTER (prioridade = 'Expressa') AS pedidos_expressos,
        COUNT(*) FILTER (prioridade = 'Urgente') AS pedidos_urgentes FROM silver GROUP BY 1""",
    "km_caminhao": "SELECT id_caminhao, CAST(SUM(km_total) AS BIGINT) AS total_km FROM cargas GROUP BY 1",
    "frete_caminhao": f"""SELECT c.id_caminhao, COUNT(*) AS n, {esum('s.valor_frete')} AS frete
        FROM (SELECT CAST(o_orderkey AS BIGINT) AS id_pedido FROM orders) p JOIN cargas c ON p.id_pedido // 8 = c.id_carga
        LEFT JOIN silver s ON s.id_pedido = p.id_pedido GROUP BY 1""",
    "desempenho": f"""SELECT m.id_motorista, m.nome AS nome_motorista, m.cnh_categoria AS categoria_cnh,
        COALESCE(f.n, 0) AS total_entregas, CAST(k.total_km AS DOUBLE) AS total_km,
        {half_up('m.avaliacao', 2)} AS avaliacao_media, {half_up('f.frete', 2)} AS valor_frete_total,
        {half_up('(CAST(k.total_km AS DOUBLE) / CAST(f.n AS DOUBLE))', 1)} AS km_medio_por_entrega
        FROM motoristas m JOIN km_caminhao k USING (id_caminhao) LEFT JOIN frete_caminhao f USING (id_caminhao)""",
    "posicoes": """SELECT * FROM (SELECT c.id_caminhao, c.placa, c.cidade_destino, c.uf_destino, c.peso_total_kg AS peso_carga_kg,
        e.id_carga, e.id_status, e.timestamp, e.latitude, e.longitude, ROW_NUMBER() OVER (PARTITION BY c.id_caminhao
        ORDER BY e.timestamp DESC, e.id_status DESC, e.latitude DESC, e.longitude DESC, e.id_carga DESC) AS n
        FROM silver_eventos e JOIN cargas c USING (id_carga)) WHERE n = 1""",
    "livres": """SELECT p.id_caminhao, p.placa, p.latitude AS lat_caminhao, p.longitude AS lon_caminhao,
        p.cidade_destino AS cidade_atual, p.uf_destino AS uf_atual, t.capacidade_toneladas,
        t.volume_m3 AS capacidade_volume_m3 FROM posicoes p JOIN caminhoes t USING (id_caminhao) WHERE p.id_status = 12""",
    "pendentes": """SELECT s.id_pedido, s.cidade_origem, s.uf_origem, s.peso_total_kg, s.volume_total_m3, s.valor_frete,
        s.prioridade, o.latitude AS lat_pedido, o.longitude AS lon_pedido
        FROM silver s JOIN centros o ON s.cidade_origem = o.cidade AND s.uf_origem = o.uf
        LEFT JOIN pedido_status e ON s.id_pedido = e.id_pedido
        WHERE e.id_status IS NULL OR e.id_status NOT IN (12, 13, 14)""",
    "combinados": f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id_pedido ORDER BY distancia_km, id_caminhao) AS rank
        FROM (SELECT p.id_pedido, l.id_caminhao, l.placa, l.capacidade_toneladas, p.peso_total_kg, l.cidade_atual,
              p.cidade_origem, {km('l.lat_caminhao', 'l.lon_caminhao', 'p.lat_pedido', 'p.lon_pedido')} AS bruto,
              {half_up(km('l.lat_caminhao', 'l.lon_caminhao', 'p.lat_pedido', 'p.lon_pedido'), 3)} AS distancia_km
              FROM livres l CROSS JOIN pendentes p WHERE l.capacidade_toneladas * CAST(1000 AS DOUBLE) >= p.peso_total_kg
              AND l.capacidade_volume_m3 >= p.volume_total_m3) WHERE bruto <= 200) WHERE rank <= 3""",
    "semanal": f"""SELECT *, CASE WHEN LAG(inicio_semana) OVER w = inicio_semana - INTERVAL 7 DAY
        THEN LAG(total_pedidos) OVER w END AS total_pedidos_semana_anterior FROM (
        SELECT CAST(DATE_TRUNC('week', data_pedido) AS DATE) AS inicio_semana, CAST(WEEK(data_pedido) AS BIGINT) AS semana,
        CAST(ISOYEAR(data_pedido) AS BIGINT) AS ano, cidade_origem || ' -> ' || cidade_destino AS rota,
        CAST(MONTH(DATE_TRUNC('week', data_pedido)) AS BIGINT) AS mes,
        COUNT(id_pedido) AS total_pedidos, {eavg('peso_total_kg')} AS peso_medio, {eavg('valor_frete')} AS valor_medio,
        {eavg('CAST(DAYOFWEEK(data_pedido) + 1 AS DOUBLE)')} AS dia_da_semana_medio
        FROM silver GROUP BY 1, 2, 3, 4, 5) WINDOW w AS (PARTITION BY rota ORDER BY inicio_semana)""",
}


def oracle(body: str) -> str:
    """The statement with the blocks it uses, directly or through others, as a WITH list."""
    used: set[str] = set()
    todo = [body]
    while todo:
        words = set(re.findall(r"[a-z_]+", todo.pop()))
        for name in BLOCKS:
            if name in words and name not in used:
                used.add(name)
                todo.append(BLOCKS[name])
    parts = [f"{name} AS ({BLOCKS[name]})" for name in BLOCKS if name in used]
    return (f"WITH {', '.join(parts)} " if parts else "") + body
