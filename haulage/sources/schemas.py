"""Fixed formats: columns of the landing files and of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Dimensions are doubles: a decimal number read into an int field would silently become NULL.
ITEM = (
    "id_item bigint, descricao string, ncm string, quantidade int, unidade string, "
    "valor_unitario double, valor_total double, peso_kg double, "
    "dimensoes struct<comprimento_cm: double, largura_cm: double, altura_cm: double>"
)
INVOICE = (
    "id_nf bigint, numero_nf string, id_pedido bigint, data_emissao string, valor_total double, "
    f"chave_acesso string, itens array<struct<{ITEM}>>"
)
ORDER_HEADER = (
    "id_pedido bigint, id_cliente int, data_pedido string, peso_total_kg double, "
    "volume_total_m3 double, valor_mercadoria double, valor_frete double, tipo_frete string, "
    "prioridade string, cidade_origem string, uf_origem string, cidade_destino string, uf_destino string"
)
# `parte` is ours and optional: the number of a continuation document of a very large order.
ORDER = f"{ORDER_HEADER}, notas_fiscais array<struct<{INVOICE}>>, parte int"
STATUS = (
    "id_carga bigint, id_status int, timestamp string, observacao string, latitude double, longitude double"
)

RAW = {
    "clientes": "id_cliente int, cnpj string, razao_social string, uf string, cidade string, cep string, "
    "latitude double, longitude double",
    "caminhoes": "id_caminhao int, placa string, tipo string, capacidade_toneladas double, comprimento_m double, "
    "largura_m double, altura_m double, volume_m3 double, ano_fabricacao int, marca string, modelo string",
    "motoristas": "id_motorista int, cpf string, nome string, celular string, cnh_categoria string, "
    "cnh_validade date, id_caminhao int, data_admissao date, status string, avaliacao double, km_total_rodados int",
    "status_transporte_ref": "id_status int, descricao string, ordem int",
    "produtos_referencia": "id_produto int, descricao string, ncm string, categoria string, "
    "peso_medio_kg double, valor_medio double",
    "pedidos": "id_pedido bigint, id_cliente int, data_pedido timestamp, peso_total_kg double, "
    "volume_total_m3 double, valor_mercadoria double, valor_frete double, tipo_frete string, prioridade string, "
    "cidade_origem string, uf_origem string, cidade_destino string, uf_destino string, nf_ids_json string",
    "notas_fiscais": "id_nf bigint, numero_nf string, id_pedido bigint, data_emissao timestamp, "
    "valor_total double, chave_acesso string",
    "itens_nf": "id_item bigint, id_nf bigint, id_produto int, descricao string, ncm string, quantidade int, "
    "unidade string, valor_unitario double, valor_total double, peso_kg double, comprimento_cm double, "
    "largura_cm double, altura_cm double",
    "movimento_cargas": "id_carga bigint, id_caminhao int, placa string, tipo_frete string, cidade_origem string, "
    "uf_origem string, cidade_destino string, uf_destino string, data_saida timestamp, "
    "data_prevista_chegada timestamp, km_total int, peso_total_kg double, volume_total_m3 double, "
    "status_atual string, pedidos_json string",
    "historico_status": "id_movimento bigint, id_carga bigint, id_status int, timestamp timestamp, "
    "observacao string, latitude double, longitude double",
}

# Fixed status codes; the order of the codes is the order of the process.
STATUS_NAMES = (
    "Pedido Recebido",
    "Aguardando Coleta",
    "Coleta Realizada",
    "Em Trânsito para CD",
    "Recebido no CD",
    "Em Separação",
    "Carga Consolidada",
    "Saiu para Entrega",
    "Em Trânsito",
    "Parada para Descanso",
    "Tentativa de Entrega",
    "Entrega Realizada",
    "Devolvido ao Remetente",
    "Extraviado",
    "Avaria Registrada",
)
ON_THE_ROAD, DELIVERED = 9, 12
# Nothing is left to carry for these: delivered, returned, lost.
CLOSED = (12, 13, 14)


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    """A typed frame without rows."""
    return spark.createDataFrame([], struct(ddl))


def status_reference(spark: SparkSession) -> DataFrame:
    """The lookup of the fixed status codes (15 rows)."""
    rows = ", ".join(f"({i}, '{name}', {i})" for i, name in enumerate(STATUS_NAMES, start=1))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS v(id_status, descricao, ordem)")
