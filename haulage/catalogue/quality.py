"""Table checks and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.catalogue.shared import oracle, plain
from haulage.functions import formats
from haulage.operators import checks, rules
from haulage.plans import gold
from haulage.sources import star_schema as star
from haulage.sources import tables
from haulage.streaming import silver

# Fixed minimum sizes.
LEAST = {"clientes": 1000, "caminhoes": 1000, "motoristas": 1000, "pedidos": 50000}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def check_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = {"clientes": "customer", "caminhoes": "supplier", "motoristas": "supplier", "pedidos": "orders"}
    given = {name: (star.table(spark, sf_dir, source[name]), n) for name, n in LEAST.items()}
    return plain(checks.minimum_rows(given))


def check_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    crew, fleet = star.drivers(spark, sf_dir), star.trucks(spark, sf_dir)
    seen = star.table(spark, sf_dir, "events").select("user_id")
    first = checks.orphan_check(crew, fleet, "id_caminhao", "motoristas -> caminhoes")
    return plain(first.unionByName(checks.orphan_check(seen, fleet, "user_id", "eventos -> caminhoes", "id_caminhao")))


def orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of whom no event tells."""
    people = star.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return plain(checks.orphans(people, star.table(spark, sf_dir, "events"), "c_custkey", "user_id"))


def check_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["id_pedido", "peso_total_kg", "valor_frete", "cidade_origem"]
    return plain(checks.null_checks(star.orders(spark, sf_dir), columns, "pedidos"))


def check_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star.silver_orders(spark, sf_dir)
    return plain(checks.union([checks.freight_check(orders), checks.route_checks(gold.route_volume(orders))]))


def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        checks.union(
            [
                checks.unique_check(star.customers(spark, sf_dir), "cnpj", "clientes"),
                checks.unique_check(star.trucks(spark, sf_dir), "placa", "caminhoes"),
                checks.unique_check(star.drivers(spark, sf_dir), "cpf", "motoristas"),
                checks.unique_check(star.table(spark, sf_dir, "part"), "p_name", "produtos"),
            ]
        )
    )


def check_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    invoice = {"numero_nf": formats.INVOICE_NUMBER, "chave_acesso": formats.ACCESS_KEY}
    return plain(
        checks.union(
            [
                checks.format_checks(star.customers(spark, sf_dir), {"cnpj": formats.CNPJ}, "clientes"),
                checks.format_checks(star.trucks(spark, sf_dir), {"placa": formats.PLATE}, "caminhoes"),
                checks.format_checks(star.drivers(spark, sf_dir), {"cpf": formats.CPF, "celular": formats.PHONE}, "motoristas"),
                checks.format_checks(star.invoices(spark, sf_dir), invoice, "notas_fiscais"),
            ]
        )
    )


def check_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = checks.union(
        [
            checks.null_checks(star.orders(spark, sf_dir), ["id_pedido", "valor_frete"], "pedidos"),
            checks.freight_check(star.silver_orders(spark, sf_dir)),
        ]
    )
    return plain(checks.summary(found))


def rule_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of the order rules over the unfiltered orders."""
    return plain(rules.report(star.orders(spark, sf_dir), silver.ORDER_RULES))


def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(checks.profile(star.silver_orders(spark, sf_dir)))


def table_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each input table and whether its age is known. The rows come from the footers of the files: no column is read."""
    measured = checks.union([tables.measured(star.table(spark, sf_dir, t), t) for t in TABLES])
    dated = F.when(F.col("last_updated").rlike(r"^20\d\d-\d\d-\d\d "), "sim").otherwise("não")
    return plain(measured.select("table_name", "row_count", dated.alias("com_data")))


def inventory_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(tables.inventory_totals(table_inventory(spark, sf_dir)))


QUERIES = {
    f.__name__: f
    for f in (
        check_counts, check_orphans, orphan_rows, check_nulls, check_ranges, check_unique, check_format, check_summary,
        rule_report, table_profile, table_inventory, inventory_totals,
    )
}


def _zero(name: str, count: str, source: str, text: str) -> str:
    return (
        f"SELECT '{name}' AS \"check\", n AS resultado, '{text}' AS esperado, "
        f"CASE WHEN n = 0 THEN 'OK' ELSE 'FALHA' END AS status FROM (SELECT {count} AS n FROM {source})"
    )


def _all(*parts: str) -> str:
    return oracle("SELECT * FROM (" + " UNION ALL ".join(parts) + ")")


def _nulls(column: str) -> str:
    return _zero(f"NULL em {column} (pedidos)", f"COUNT(*) FILTER ({column} IS NULL)", "pedidos", "0 registros NULL")


_FREIGHT = _zero(
    "valor_frete <= 0 (silver_pedidos)", "COUNT(*) FILTER (valor_frete <= 0)", "silver", "0 registros com frete <= 0"
)


def _repeated(column: str, source: str, name: str) -> str:
    inner = f"(SELECT {column} FROM {source} GROUP BY 1 HAVING COUNT(*) > 1)"
    return _zero(f"{column} repetido ({name})", "COUNT(*)", inner, "0 valores repetidos")


def _form(column: str, pattern: str, source: str, name: str) -> str:
    bad = f"COUNT(*) FILTER (NOT COALESCE(REGEXP_MATCHES({column}, '{pattern}'), FALSE))"
    return _zero(f"formato de {column} ({name})", bad, source, "0 registros fora do formato")


_NF = """(SELECT LPAD(CAST((CAST(l_orderkey AS BIGINT) * 8 + l_linenumber) % 1000000 AS VARCHAR), 6, '0') AS numero_nf,
    LPAD(CAST(CAST(l_orderkey AS BIGINT) * 8 + l_linenumber AS VARCHAR), 44, '0') AS chave_acesso
    FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))"""


def _least(name: str, source: str) -> str:
    n = LEAST[name]
    return (
        f"SELECT '{name}' AS tabela, COUNT(*) AS contagem, CAST({n} AS BIGINT) AS minimo_esperado, "
        f"CASE WHEN COUNT(*) >= {n} THEN 'OK' ELSE 'FALHA' END AS status FROM {source}"
    )


def _orphan(name: str, source: str, key: str) -> str:
    return (
        f"SELECT '{name}' AS tabela, COUNT(*) AS contagem, CAST(0 AS BIGINT) AS minimo_esperado, "
        f"CASE WHEN COUNT(*) = 0 THEN 'OK' ELSE 'FALHA' END AS status FROM {source} "
        f"WHERE NOT EXISTS (SELECT 1 FROM supplier t WHERE t.s_suppkey = {key})"
    )


ORACLE = {
    "table_inventory": " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, 'sim' AS com_data FROM {t}" for t in TABLES),
    "check_counts": " UNION ALL ".join(
        [_least("clientes", "customer"), _least("caminhoes", "supplier"), _least("motoristas", "supplier"), _least("pedidos", "orders")]
    ),
    "check_orphans": _orphan("motoristas -> caminhoes", "supplier m", "m.s_suppkey")
    + " UNION ALL "
    + _orphan("eventos -> caminhoes", "events e", "e.user_id"),
    "orphan_rows": "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)",
    "check_nulls": _all(_nulls("id_pedido"), _nulls("peso_total_kg"), _nulls("valor_frete"), _nulls("cidade_origem")),
    "check_ranges": _all(
        _FREIGHT,
        """SELECT 'gold_volume_por_rota tem dados' AS "check", COUNT(*) AS resultado, '> 0 registros' AS esperado,
        CASE WHEN COUNT(*) > 0 THEN 'OK' ELSE 'FALHA' END AS status FROM rotas""",
        _zero("total_pedidos negativo (gold_volume_por_rota)", "COUNT(*) FILTER (total_pedidos < 0)", "rotas", "0 registros negativos"),
        _zero("peso_total negativo (gold_volume_por_rota)", "COUNT(*) FILTER (peso_total < 0)", "rotas", "0 registros negativos"),
    ),
    "check_unique": _all(
        _repeated("cnpj", "clientes", "clientes"),
        _repeated("placa", "caminhoes", "caminhoes"),
        _repeated("cpf", "motoristas", "motoristas"),
        _repeated("p_name", "part", "produtos"),
    ),
    "check_format": _all(
        _form("cnpj", formats.CNPJ, "clientes", "clientes"),
        _form("placa", formats.PLATE, "caminhoes", "caminhoes"),
        _form("cpf", formats.CPF, "motoristas", "motoristas"),
        _form("celular", formats.PHONE, "motoristas", "motoristas"),
        _form("numero_nf", formats.INVOICE_NUMBER, _NF, "notas_fiscais"),
        _form("chave_acesso", formats.ACCESS_KEY, _NF, "notas_fiscais"),
    ),
    "check_summary": oracle(
        """SELECT COUNT(*) AS total, COUNT(*) FILTER (n > 0) AS falhas,
        CASE WHEN COUNT(*) FILTER (n > 0) = 0 THEN 'SUCESSO: ' || COUNT(*) || ' checks'
        ELSE 'FALHA: ' || COUNT(*) FILTER (n > 0) || ' de ' || COUNT(*) || ' checks' END AS resultado FROM (
        SELECT COUNT(*) FILTER (id_pedido IS NULL) AS n FROM pedidos UNION ALL
        SELECT COUNT(*) FILTER (valor_frete IS NULL) FROM pedidos UNION ALL
        SELECT COUNT(*) FILTER (valor_frete <= 0) FROM silver)"""
    ),
    "rule_report": oracle(
        "SELECT regra, acao, total, aprovadas, total - aprovadas AS violacoes FROM ("
        + " UNION ALL ".join(
            f"SELECT '{r.name}' AS regra, '{'drop' if r.drop else 'warn'}' AS acao, COUNT(*) AS total, "
            f"COUNT(*) FILTER ({r.condition}) AS aprovadas FROM pedidos"
            for r in silver.ORDER_RULES
        )
        + ")"
    ),
    "table_profile": oracle(
        """SELECT COUNT(*) AS total, MIN(data_pedido) AS primeiro, MAX(data_pedido) AS ultimo,
        (SELECT COUNT(*) FROM (SELECT DISTINCT cidade_origem, cidade_destino FROM silver)) AS rotas FROM silver"""
    ),
    "inventory_totals": "SELECT 8 AS total_tabelas, "
    + " + ".join(f"(SELECT COUNT(*) FROM {t})" for t in TABLES)
    + " AS total_registros",
}
ORACLE["inventory_totals"] = ORACLE["inventory_totals"].replace("SELECT 8 AS", "SELECT CAST(8 AS BIGINT) AS", 1)
