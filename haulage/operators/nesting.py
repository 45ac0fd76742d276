"""Orders with their invoices and items as one nested document, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulage.operators.lookup import sized
from haulage.operators.skew import kept, number_within

ITEMS_PER_INVOICE = 500
INVOICES_PER_DOCUMENT = 200

ITEM_FIELDS = (
    "id_item",
    "descricao",
    "ncm",
    "quantidade",
    "unidade",
    "valor_unitario",
    "valor_total",
    "peso_kg",
)
DIMENSIONS = ("comprimento_cm", "largura_cm", "altura_cm")
INVOICE_FIELDS = ("id_nf", "numero_nf", "id_pedido", "data_emissao", "valor_total", "chave_acesso")


def _oversized(df: DataFrame, key: str, limit: int) -> bool:
    """Whether any key has more than `limit` rows; reads the key column alone."""
    return not df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit).isEmpty()


def _parted(df: DataFrame, key: str, limit: int, name: str, spread_by: list[str]) -> DataFrame:
    """Number that cuts a key with more than `limit` rows into parts of at most `limit` rows; 0 always exists.

    Rows of long keys are numbered within their key. Equal rows are first counted and get an index each, so
    that they can be told apart and are spread like others.
    """
    columns = df.columns
    big = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit).select(F.col(key).alias("_key"))
    marked = df.join(sized(big), F.col(key).eqNullSafe(F.col("_key")), "left")
    short = marked.filter(F.col("_key").isNull()).select(*columns, F.lit(0).alias(name))
    long = marked.filter(F.col("_key").isNotNull()).groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    each = long.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
    coded = each.withColumn("_code", F.xxhash64(*spread_by))
    numbered = number_within(coded, [key], ["_code", "_copy"], index="_at", total="_all")
    return short.unionByName(numbered.select(*columns, F.floor((F.col("_at") - 1) / limit).cast("int").alias(name)))


def nest_orders(
    orders: DataFrame,
    invoices: DataFrame,
    items: DataFrame,
    items_per_invoice: int = ITEMS_PER_INVOICE,
    invoices_per_document: int = INVOICES_PER_DOCUMENT,
    short: bool = False,
) -> DataFrame:
    """Nested documents, one per order; `notas_fiscais` is NULL for an order without invoices.

    A list is never longer than the limits: an order beyond them continues in further
    documents with `parte` 1, 2, …, which repeat the header. Readers take headers from parte 0 only,
    and an invoice cut into several structs repeats its header: see `explode_invoices`.

    Items may name their order in `id_pedido`; they belong to an invoice of that order then. Items and invoices of an order meet by its
    id alone in that case, so that items are shuffled once (not at all, if they come dealt by it). Orders with more items or invoices
    than one list may hold, which are counted first, take the longer way by parts. With `short` the caller has made sure that there
    are none.
    """
    if "id_pedido" not in items.columns:
        return _documents(orders, _by_parts(invoices, items, items_per_invoice, invoices_per_document))
    invoices, items = (x.filter("id_pedido IS NOT NULL") for x in (invoices, items))
    if short:
        return _documents(orders, _by_order(invoices, items))
    long = [
        x.groupBy("id_pedido").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most).select("id_pedido")
        for x, most in ((invoices, invoices_per_document), (items, items_per_invoice))
    ]
    over = kept(long[0].unionByName(long[1]).distinct(), "longos")
    if over.isEmpty():
        return _documents(orders, _by_order(invoices, items))
    few, many = ([x.join(sized(over), "id_pedido", how) for x in (invoices, items)] for how in ("left_anti", "left_semi"))
    return _documents(orders, _by_order(*few).unionByName(_by_parts(*many, items_per_invoice, invoices_per_document)))


def _documents(orders: DataFrame, lists: DataFrame) -> DataFrame:
    return orders.join(lists, "id_pedido", "left").withColumn("parte", F.coalesce("parte", F.lit(0)))


def _by_order(invoices: DataFrame, items: DataFrame) -> DataFrame:
    """(id_pedido, notas_fiscais, parte) of orders within the limits: the lists of an order are put together inside its row."""
    item = F.struct("id_nf", F.struct(*ITEM_FIELDS, F.struct(*DIMENSIONS).alias("dimensoes")).alias("item"))
    lines = items.groupBy("id_pedido").agg(F.collect_list(item).alias("_itens"))
    heads = invoices.groupBy("id_pedido").agg(F.collect_list(F.struct(*INVOICE_FIELDS)).alias("_notas"))

    def filled(nf):
        own = F.transform(F.filter("_itens", lambda x: x["id_nf"] == nf["id_nf"]), lambda x: x["item"])
        return F.struct(*[nf[c].alias(c) for c in INVOICE_FIELDS], F.when(F.size(own) > 0, own).alias("itens"))

    return heads.join(lines, "id_pedido", "left").select("id_pedido", F.transform("_notas", filled).alias("notas_fiscais"), F.lit(0).alias("parte"))


def _by_parts(invoices: DataFrame, items: DataFrame, items_per_invoice: int, invoices_per_document: int) -> DataFrame:
    """(id_pedido, notas_fiscais, parte) for lists of any length. Group sizes are counted first; only if one is over its limit is the
    extra join for parts made."""
    keys = [k for k in ("id_nf", "id_pedido") if k in items.columns]
    long_invoices = _oversized(items, "id_nf", items_per_invoice)
    if long_invoices:
        parted = _parted(items, "id_nf", items_per_invoice, "_i", list(items.columns))
    else:
        parted = items.withColumn("_i", F.lit(0))
    item = F.struct(*ITEM_FIELDS, F.struct(*DIMENSIONS).alias("dimensoes"))
    lists = parted.groupBy(*keys, "_i").agg(F.collect_list(item).alias("itens"))
    filled = invoices.join(lists, keys, "left").withColumn("_i", F.coalesce("_i", F.lit(0)))
    # Without cut invoices there is one row per invoice, and the short table can be counted instead.
    if _oversized(filled if long_invoices else invoices, "id_pedido", invoices_per_document):
        filled = _parted(filled, "id_pedido", invoices_per_document, "parte", ["id_nf", "_i"])
    else:
        filled = filled.withColumn("parte", F.lit(0))
    invoice = F.struct(*INVOICE_FIELDS, "itens")
    return filled.groupBy("id_pedido", "parte").agg(F.collect_list(invoice).alias("notas_fiscais")).select("id_pedido", "notas_fiscais", "parte")


def explode_items(orders: DataFrame, carry: list[str]) -> DataFrame:
    """One row per item. Orders and invoices with a NULL or empty list give no row."""
    return (
        orders.select(*carry, F.explode("notas_fiscais").alias("nf"))
        .select(
            *carry,
            "nf.id_nf",
            "nf.numero_nf",
            F.col("nf.data_emissao").alias("data_emissao_nf"),
            F.col("nf.valor_total").alias("valor_total_nf"),
            F.explode("nf.itens").alias("it"),
        )
        .select(
            *carry,
            "id_nf",
            "numero_nf",
            "data_emissao_nf",
            "valor_total_nf",
            *[F.col(f"it.{c}").alias("valor_total_item" if c == "valor_total" else c) for c in ITEM_FIELDS],
            *[F.col(f"it.dimensoes.{c}").alias(c) for c in DIMENSIONS],
        )
    )


def explode_invoices(orders: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per invoice struct: header, number, value and weight of its items, and columns of the document. Works on a stream.

    An invoice over the limits gives several rows; `invoices` brings them together.
    """
    def total(field):
        return _array_sum(F.coalesce("nf.itens", F.array()), lambda it: it[field].cast("decimal(18,4)"))

    return orders.select(*carry, F.explode("notas_fiscais").alias("nf")).select(
        *carry,
        *[f"nf.{c}" for c in INVOICE_FIELDS],
        F.greatest(F.size("nf.itens"), F.lit(0)).cast("bigint").alias("itens"),
        total("valor_total").alias("valor_itens"),
        total("peso_kg").alias("peso_itens_kg"),
    )


def invoices(rows: DataFrame) -> DataFrame:
    """Invoice grain: the rows of `explode_invoices` with one row for each id_nf, its items summed over all parts.

    Short hashes of the headers are counted first; only rows whose hash occurs several times are brought together, the others stay
    where they are.
    """
    marked = rows.withColumn("_marca", F.xxhash64(*INVOICE_FIELDS))
    again = marked.groupBy("_marca").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_marca")
    again = kept(again, "notas_em_partes")
    sums = ("valor_itens", "peso_itens_kg")
    once = [F.col("itens").cast("bigint").alias("itens"), *[F.col(c).cast("double").alias(c) for c in sums]]
    if again.isEmpty():
        return rows.select(*INVOICE_FIELDS, *once)
    again = sized(again)
    whole = marked.join(again, "_marca", "left_semi").groupBy(*INVOICE_FIELDS).agg(
        F.sum("itens").alias("itens"), *[F.sum(c).cast("double").alias(c) for c in sums]
    )
    return marked.join(again, "_marca", "left_anti").select(*INVOICE_FIELDS, *once).unionByName(whole)


def _array_sum(array: Column, value) -> Column:
    zero = F.lit(0).cast("decimal(38,4)")
    return F.aggregate(array, zero, lambda acc, x: (acc + F.coalesce(value(x), zero)).cast("decimal(38,4)"))


def document_totals(orders: DataFrame) -> DataFrame:
    """Value and weight of each order, summed inside the arrays first and then over its documents."""
    def in_invoice(field):
        return lambda nf: _array_sum(F.coalesce(nf["itens"], F.array()), lambda it: it[field].cast("decimal(18,4)"))

    notes = F.col("notas_fiscais")
    sums = orders.filter(notes.isNotNull()).select(
        "id_pedido", _array_sum(notes, in_invoice("valor_total")).alias("v"), _array_sum(notes, in_invoice("peso_kg")).alias("w")
    )
    return sums.groupBy("id_pedido").agg(
        F.sum("v").cast("double").alias("valor_itens"), F.sum("w").cast("double").alias("peso_itens_kg")
    )
