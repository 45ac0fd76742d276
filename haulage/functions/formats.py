"""Text formats of identifiers, as rules over a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the domain.
CNPJ = r"^[0-9]{2}\.[0-9]{3}\.[0-9]{3}/0001-[0-9]{2}$"
PLATE = r"^[A-Z]{3}[0-9][A-Z][0-9]{2}$"
CPF = r"^[0-9]{3}\.[0-9]{3}\.[0-9]{3}-[0-9]{2}$"
PHONE = r"^\([0-9]{2}\)9[0-9]{4}-[0-9]{4}$"
ACCESS_KEY = r"^[0-9]{44}$"
INVOICE_NUMBER = r"^[0-9]{6}$"


def matches(column: str, pattern: str) -> Column:
    """TRUE only for a present value of the right form."""
    return F.coalesce(F.col(column).rlike(pattern), F.lit(False))
