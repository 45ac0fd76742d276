"""A few hand-written rows of every logistics table, with the awkward cases."""

from __future__ import annotations

from haulage.sources import schemas


def clientes(spark):
    rows = [
        # One city with three slightly different points, with and without accents; one far away.
        (1, "11.111.111/0001-11", "Um", "SP", "São Paulo", "0", -23.50, -46.60),
        (2, "22.222.222/0001-22", "Dois", "SP", "Sao Paulo", "0", -23.52, -46.62),
        (3, "33.333.333/0001-33", "Tres", "SP", "SAO PAULO", "0", -23.54, -46.64),
        (4, "44.444.444/0001-44", "Quatro", "RJ", "Rio de Janeiro", "0", -22.90, -43.20),
        (5, "55.555.555/0001-55", "Cinco", "BA", "Salvador", "0", -12.97, -38.50),
    ]
    return spark.createDataFrame(rows, schemas.struct(schemas.RAW["clientes"]))


def caminhoes(spark):
    def truck(i, plate, kind, tonnes, m3):
        return (i, plate, kind, tonnes, 1.0, 1.0, 1.0, m3, 2020, "M", "X")

    rows = [
        truck(1, "AAA1A11", "VUC", 3.5, 10.0),
        truck(2, "BBB1B22", "Truck", 14.0, 40.0),
        truck(3, "CCC1C33", "Bitrem", 37.0, 90.0),
        truck(4, "DDD1D44", "Bitrem", 37.0, 5.0),
    ]
    return spark.createDataFrame(rows, schemas.struct(schemas.RAW["caminhoes"]))


def motoristas(spark):
    ddl = "id_motorista int, cpf string, nome string, celular string, cnh_categoria string, id_caminhao int, status string, avaliacao double"
    rows = [
        (1, "111.111.111-11", "Ana", "(11)91111-1111", "C", 1, "Ativo", 4.5),
        (2, "222.222.222-22", "Ana", "(11)92222-2222", "D", 2, "Ativo", 4.9),
        (3, "333.333.333-33", "Bia", "(11)93333-3333", "E", 3, "Férias", 4.9),
        (4, "444.444.444-44", "Cau", "(11)94444-4444", "E", 99, "Ativo", 3.0),
        (5, "555.555.555-55", "Dea", "(11)95555-5555", "E", 4, "Ativo", 3.0),
    ]
    return spark.createDataFrame(rows, ddl)


def cargas(spark):
    ddl = (
        "id_carga bigint, id_caminhao int, placa string, cidade_destino string, uf_destino string, km_total int, "
        "peso_total_kg double, pedidos_json string"
    )
    rows = [
        (1, 1, "AAA1A11", "São Paulo", "SP", 100, 1750.0, "[1, 2]"),
        (2, 2, "BBB1B22", "Rio de Janeiro", "RJ", 400, 7000.0, "[3]"),
        (3, 2, "BBB1B22", "Salvador", "BA", 50, 1000.0, "[2, 4]"),  # order 2 is on two loads
        (4, 98, None, "Salvador", "BA", 10, 500.0, "[]"),  # unknown truck
    ]
    return spark.createDataFrame(rows, ddl)


def status(spark):
    ddl = "id_carga bigint, id_status int, timestamp string, observacao string, latitude double, longitude double"
    rows = [
        (1, 12, "2025-01-02 10:00:00", "entregue", -23.55, -46.65),
        (1, 8, "2025-01-02 10:00:00", "mesma hora", -23.0, -46.0),  # same second, earlier step
        (1, 13, "2025-01-01 10:00:00", "antes", 0.0, 0.0),  # later step, earlier time
        (2, 12, "2025-01-01 10:00:00", "entregue", -22.9, -43.2),  # old delivery of truck 2 …
        (3, 9, "2025-01-03 10:00:00", "na estrada", -20.0, -41.0),  # … which is on a newer load
        (3, 77, "2025-01-01 09:00:00", "codigo desconhecido", -20.0, -41.0),
        (None, 9, "2025-01-03 10:00:00", "sem carga", 0.0, 0.0),
        (3, 9, "ontem", "hora ilegivel", 1.0, 1.0),
    ]
    return spark.createDataFrame(rows, ddl)


def pedidos(spark):
    ddl = (
        "id_pedido bigint, id_cliente int, data_pedido string, peso_total_kg double, volume_total_m3 double, "
        "valor_mercadoria double, valor_frete double, tipo_frete string, prioridade string, cidade_origem string, "
        "uf_origem string, cidade_destino string, uf_destino string"
    )
    rows = [
        (1, 1, "2025-01-01 08:00:00", 1000.0, 5.0, 100.0, 50.0, "CIF", "EXPRESSA", "SAO PAULO", "SP", "Rio de Janeiro", "RJ"),
        (2, 4, "2025-01-01 09:00:00", 2000.0, 8.0, 100.0, 50.0, "FOB", "Normal", "São Paulo", "SP", "Salvador", "BA"),
        (3, 5, "2025-01-02 09:00:00", 5000.0, 12.0, 100.0, 80.0, "CIF", "urgente", "Rio de Janeiro", "RJ", "São Paulo", "SP"),
        (4, 9, "2025-01-08 09:00:00", 100.0, 1.0, 100.0, 0.0, "CIF", "Expressa", "Manaus", "AM", "São Paulo", "SP"),
        (5, 2, "2025-01-08 10:00:00", 20000.0, 50.0, 100.0, 90.0, "FOB", "Normal", "Sao Paulo", "SP", "Manaus", "AM"),
        (6, 2, "ontem", 0.0, 1.0, 100.0, 10.0, "FOB", "Normal", "Rio de Janeiro", "RJ", "Salvador", "BA"),
        (7, 1, "2025-01-08 10:00:00", 10.0, 1.0, 10.0, -1.0, "FOB", "Normal", "Rio de Janeiro", "RJ", "Salvador", "BA"),
        (8, 1, "2025-01-08 10:00:00", 10.0, 1.0, 10.0, None, "FOB", "Normal", "Rio de Janeiro", "RJ", "Salvador", "BA"),
        (None, 1, "2025-01-08 10:00:00", 10.0, 1.0, 10.0, 5.0, "FOB", "Normal", "Rio de Janeiro", "RJ", "Salvador", "BA"),
    ]
    return spark.createDataFrame(rows, ddl)
