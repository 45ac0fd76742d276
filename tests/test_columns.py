from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from haulage.functions import columns as c
from haulage.functions import formats, geo


def one(spark, column, **values):
    ddl = ", ".join(f"{k} {'string' if isinstance(v, str) else 'double'}" for k, v in values.items()) or "x string"
    df = spark.createDataFrame([tuple(values.values()) or ("",)], ddl)
    return df.select(column.alias("r")).head()[0]


def test_freight_price_by_priority(spark):
    price = c.freight_price("p", "kg", "m3", "v")
    assert one(spark, price, p="Normal", kg=100.0, m3=2.0, v=1000.0) == 135.0
    assert one(spark, price, p="Expressa", kg=100.0, m3=2.0, v=1000.0) == 202.5
    assert one(spark, price, p="Urgente", kg=100.0, m3=2.0, v=1000.0) == 337.5
    assert one(spark, price, p="outra", kg=100.0, m3=2.0, v=1000.0) is None


def test_item_volume_counts_quantity(spark):
    assert one(spark, c.item_volume_m3("l", "w", "h", "q"), l=100.0, w=50.0, h=20.0, q=3.0) == 0.3


@pytest.mark.parametrize("kg, name", [(0.99, "pequeno"), (1.0, "medio"), (9.9, "medio"), (10.0, "grande"), (50.0, "extra grande")])
def test_size_class_borders(spark, kg, name):
    assert one(spark, c.size_class("kg"), kg=kg) == name


def test_licence_and_labels(spark):
    assert [one(spark, c.licence_category("t"), t=t) for t in ("VUC", "Truck", "Bitrem", "Moto")] == ["C", "D", "E", None]
    assert one(spark, c.week_label(F.lit(2025), F.lit(7))) == "2025_W07"
    assert one(spark, c.route_key("a", "b"), a="X", b="Y") == "X -> Y"


def test_normalisers(spark):
    assert one(spark, c.place_key("n"), n=" São Paulo ") == one(spark, c.place_key("n"), n="SAO PAULO")
    assert one(spark, c.normal_priority("p"), p=" EXPRESSA") == "Expressa"
    assert one(spark, c.digits_only("n"), n="8708.80.00") == "87088000"


def test_ratio_and_moment_survive_bad_input(spark):
    assert one(spark, c.safe_ratio("a", "b"), a=1.0, b=0.0) is None
    assert one(spark, c.percent("a", "b"), a=1.0, b=8.0) == 12.5
    assert one(spark, c.moment("t"), t="not a date") is None
    assert one(spark, c.moment("t"), t="2025-02-03 04:05:06") == dt.datetime(2025, 2, 3, 4, 5, 6)
    assert one(spark, c.between("a", "b", "f"), a=10.0, b=20.0, f=0.25) == 12.5


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-(10**12), 10**12), min_size=1, max_size=40))
def test_exact_sum_equals_integer_sum(spark, cents):
    df = spark.createDataFrame([(x / 100,) for x in cents], "x double").repartition(3)
    assert df.agg(c.exact_sum("x", 2)).head()[0] == sum(cents) / 100


@pytest.mark.parametrize("value, rows, total", [(0.00001, 1000, 0.01), (1e15, 1000, 1e18), (-1e15, 1000, -1e18), (-0.25, 7, -1.75)])
def test_exact_sum_of_small_and_large_values(spark, value, rows, total):
    df = spark.range(rows).select(c.num(value).alias("x"))
    assert df.agg(c.exact_sum("x")).head()[0] == total


def test_exact_sum_refuses_what_it_cannot_hold(spark):
    with pytest.raises(Exception, match="out of range"):
        spark.createDataFrame([(1e19,)], "x double").agg(c.exact_sum("x")).collect()


def test_exact_sum_beyond_bigint_units(spark):
    df = spark.range(4000).select(F.lit(5e11).alias("x"))
    assert df.agg(c.exact_sum("x")).head()[0] == 2e15


def test_exact_avg_ignores_null_and_empty(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,)], "x double")
    assert df.agg(c.exact_avg("x")).head()[0] == 1.5
    assert df.filter("x > 9").agg(c.exact_avg("x"), c.exact_sum("x")).head() == (None, None)


def test_haversine_known_distance_null_and_antipode(spark):
    km = geo.haversine_km("a", "b", "c", "d")
    assert abs(one(spark, km, a=-23.5505, b=-46.6333, c=-22.9068, d=-43.1729) - 360.7488) < 1e-3
    assert one(spark, km, a=0.0, b=0.0, c=0.0, d=180.0) == pytest.approx(20015.0868, abs=1e-3)
    df = spark.createDataFrame([(None, 1.0, 2.0, 3.0)], "a double, b double, c double, d double")
    assert df.select(km).head()[0] is None


def test_sql_haversine_matches_and_needs_no_python(spark):
    geo.register_haversine(spark)
    df = spark.range(200).select(
        (F.col("id") % 90 - 45.0).alias("a"), (F.col("id") * 1.7 % 360 - 180).alias("b"),
        (F.col("id") * 2.3 % 90 - 45).alias("c"), (F.col("id") * 3.1 % 360 - 180).alias("d"),
    )
    both = df.select(geo.haversine_km("a", "b", "c", "d").alias("x"), F.expr("haversine(a, b, c, d)").alias("y"))
    assert both.filter("abs(x - y) > 1e-9 OR x IS NULL").count() == 0
    assert "Python" not in both._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "pattern, good, bad",
    [
        (formats.CNPJ, "12.345.678/0001-90", "12.345.678/0002-90"),
        (formats.PLATE, "ABC1D23", "ABC1234"),
        (formats.CPF, "123.456.789-01", "12345678901"),
        (formats.PHONE, "(11)91234-5678", "11 91234-5678"),
        (formats.ACCESS_KEY, "1" * 44, "1" * 43),
        (formats.INVOICE_NUMBER, "000123", "123"),
    ],
)
def test_formats(spark, pattern, good, bad):
    assert one(spark, formats.matches("x", pattern), x=good) is True
    assert one(spark, formats.matches("x", pattern), x=bad) is False
