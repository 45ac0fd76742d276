"""Named queries over the sample tables, each with an independent SQL statement where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from haulage.catalogue import dispatch, forecasts, published, quality, routes, status, streams, views

MODULES = (routes, status, views, dispatch, quality, streams, published, forecasts)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: make for module in MODULES for name, make in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for module in MODULES for name, text in module.ORACLE.items()}
