"""Business expressions: freight price, volumes, labels, normalisers and exact arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the domain.
PRIORITY_RATE = {"Normal": 1.0, "Expressa": 1.5, "Urgente": 2.5}
FREIGHT_PER_KG, FREIGHT_PER_M3, FREIGHT_PER_VALUE = 0.15, 50.0, 0.02
LICENCE_BY_TYPE = {
    "VUC": "C",
    "Toco": "C",
    "Truck": "D",
    "Carreta": "E",
    "Bitrem": "E",
    "Rodotrem": "E",
}
SIZE_LIMITS_KG = ((1.0, "pequeno"), (10.0, "medio"), (50.0, "grande"))
LARGEST_SIZE = "extra grande"
NO_STATUS = "Sem Status"
ACCENTED = "ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ"
PLAIN = "AAAAAEEEEIIIIOOOOOUUUUCN"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def num(value: float) -> Column:
    """A double literal; a bare 100.0 in SQL text would be a decimal."""
    return F.lit(float(value)).cast("double")


# ---- exact sums -----------------------------------------------------------------------------------


def exact_parts(c: Column | str, scale: int = 9) -> dict[str, Column]:
    """Aggregates of a double column that `exact_total` turns into its sum. Parts of several groups or batches add up, and a value
    that is taken back is one with its sign changed, so they can be kept and brought forward.

    `alto` and `baixo` are the halves of the whole units, `fino` the decimals in units of 1e-9, `n` the number of values, `torto`
    those that are no finite number.
    """
    value = _col(c).cast("double")
    odd = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    plain = F.when(odd, F.lit(None)).otherwise(value)
    checked = F.when(F.abs(plain) >= num(9e18), F.raise_error(F.lit("exact_sum: a value is out of range"))).otherwise(plain)
    whole = F.floor(checked)
    part = plain - whole.cast("double")

    def rounded(digits: int) -> Column:
        return F.floor(part * num(10**digits) + num(0.5)) * F.lit(10 ** (9 - digits))

    fine = F.when(F.abs(plain) >= num(1e5), rounded(min(scale, 4))).otherwise(rounded(scale))
    return {
        "alto": F.sum(F.shiftright(whole, 32)),
        "baixo": F.sum(whole.bitwiseAND(F.lit(2**32 - 1))),
        "fino": F.sum(fine),
        "n": F.count(value),
        "torto": F.count_if(odd),
    }


def exact_total(alto: Column, baixo: Column, fino: Column, torto: Column) -> Column:
    """The sum that added-up parts stand for; NaN when a value was no finite number, NULL without values."""
    high = alto.cast("decimal(18,0)") * F.lit(2**32).cast("decimal(10,0)")
    units = high.cast("decimal(28,0)") + baixo.cast("decimal(20,0)")
    decimals = fino.cast("decimal(19,0)") * F.lit("0.000000001").cast("decimal(9,9)")
    return F.when(torto > 0, F.lit(float("nan"))).otherwise((units.cast("decimal(28,0)") + decimals).cast("double"))


def exact_sum(c: Column | str, scale: int = 9) -> Column:
    """Sum of a double column in decimal units: the result does not depend on row order.

    Values count to `scale` decimals (at most 9), those from 1e5 on to 4 at most: as far as a double holds
    decimals. Whole units and decimals are summed as BIGINTs, the whole ones in two halves, which stays in generated code and holds
    2e9 rows of any size. A value that is not below 9e18 raises; one that is no finite number makes the sum NaN.
    """
    parts = exact_parts(c, scale)
    return exact_total(parts["alto"], parts["baixo"], parts["fino"], parts["torto"])


def exact_avg(c: Column | str, scale: int = 9) -> Column:
    """Mean of the non-null values built on exact_sum; NULL for an empty group."""
    return F.try_divide(exact_sum(c, scale), F.count(_col(c)).cast("double"))


def round_half_up(c: Column | str, digits: int) -> Column:
    """Half-up rounding of a value >= 0, in doubles only."""
    factor = num(10**digits)
    return F.floor(_col(c) * factor + num(0.5)).cast("double") / factor


def safe_ratio(top: Column | str, bottom: Column | str) -> Column:
    """top / bottom in doubles, NULL for a zero or missing denominator."""
    return F.try_divide(_col(top).cast("double"), _col(bottom).cast("double"))


def percent(top: Column | str, bottom: Column | str) -> Column:
    return F.try_divide(_col(top).cast("double") * num(100), _col(bottom).cast("double"))


def occupancy_pct(weight_kg: Column | str, capacity_t: Column | str) -> Column:
    return safe_ratio(weight_kg, _col(capacity_t).cast("double") * num(1000)) * num(100)


# ---- freight, volume, vehicle ---------------------------------------------------------------------


def priority_rate(priority: Column | str) -> Column:
    rates = F.create_map(*[F.lit(x) for kv in PRIORITY_RATE.items() for x in kv])
    return F.try_element_at(rates, _col(priority))


def freight_price(priority, weight_kg, volume_m3, goods_value) -> Column:
    base = (
        _col(weight_kg) * num(FREIGHT_PER_KG)
        + _col(volume_m3) * num(FREIGHT_PER_M3)
        + _col(goods_value) * num(FREIGHT_PER_VALUE)
    )
    return round_half_up(priority_rate(priority) * base, 2)


def item_volume_m3(length_cm, width_cm, height_cm, quantity) -> Column:
    box = _col(length_cm).cast("double") * _col(width_cm).cast("double") * _col(height_cm).cast("double")
    return round_half_up(box * _col(quantity).cast("double") / num(1_000_000), 4)


def size_class(unit_weight_kg: Column | str) -> Column:
    weight = _col(unit_weight_kg)
    out = None
    for limit, name in SIZE_LIMITS_KG:
        test = weight < num(limit)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.when(weight.isNotNull(), LARGEST_SIZE)


def licence_category(truck_type: Column | str) -> Column:
    table = F.create_map(*[F.lit(x) for kv in LICENCE_BY_TYPE.items() for x in kv])
    return F.try_element_at(table, _col(truck_type))


def fits(capacity_t, capacity_m3, weight_kg, volume_m3) -> Column:
    """The truck can carry the order by weight and by volume."""
    return (_col(capacity_t) * num(1000) >= _col(weight_kg)) & (_col(capacity_m3) >= _col(volume_m3))


def between(start, end, share) -> Column:
    """The point at `share` of the way from start to end."""
    return _col(start) + _col(share) * (_col(end) - _col(start))


# ---- labels and normalisers -----------------------------------------------------------------------


def route_key(origin: Column | str, destination: Column | str) -> Column:
    return F.concat(_col(origin), F.lit(" -> "), _col(destination))


def week_label(year: Column | str, week: Column | str) -> Column:
    return F.concat(_col(year).cast("string"), F.lit("_W"), F.lpad(_col(week).cast("string"), 2, "0"))


def place_key(name: Column | str) -> Column:
    """Upper case without accents: 'São Paulo' and 'SAO PAULO' meet."""
    return F.translate(F.upper(F.trim(_col(name))), ACCENTED, PLAIN)


def normal_priority(priority: Column | str) -> Column:
    return F.initcap(F.lower(F.trim(_col(priority))))


def digits_only(code: Column | str) -> Column:
    return F.regexp_replace(_col(code), "[^0-9]", "")


def or_no_status(status: Column | str) -> Column:
    return F.coalesce(_col(status), F.lit(NO_STATUS))


# ---- dates ----------------------------------------------------------------------------------------


def moment(text: Column | str) -> Column:
    """Text to a timestamp; NULL, not an error, for unreadable text."""
    return F.try_to_timestamp(_col(text))


def with_moment(df: DataFrame, name: str) -> DataFrame:
    """The column as a timestamp. Only text is parsed; a timestamp column is left alone."""
    kind = df.schema[name].dataType.typeName()
    if kind == "timestamp":
        return df
    return df.withColumn(name, moment(name) if kind == "string" else F.col(name).cast("timestamp"))


def calendar_parts(ts: Column | str) -> dict[str, Column]:
    c = _col(ts)
    return {"ano": F.year(c), "mes": F.month(c), "dia": F.dayofmonth(c)}
