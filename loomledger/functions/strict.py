"""Opt-in cleansing that recovers dirt the default rules turn into NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomledger.functions import columns as c
from loomledger.functions import fixed

# Date formats tried after ISO and epoch, in this order. Slashed
# dates are ambiguous; the first format that fits wins.
DATE_FORMATS = ["MM/dd/yyyy", "dd-MM-yyyy", "dd/MM/yyyy"]
# Key spellings that are not a change of case.
KEY_ALIASES = {"valuation_amt": "valuation"}

_WHOLE = r"^-?\d+$"


def snake_case(key: Column) -> Column:
    """customerId, Customer_ID and CustomerID all become customer_id."""
    plain = F.lower(F.regexp_replace(key, r"([a-z0-9])([A-Z])", "$1_$2"))
    for alias, name in KEY_ALIASES.items():
        plain = F.when(plain == alias, name).otherwise(plain)
    return plain


def parse_any_date(text: Column) -> Column:
    shaped = F.when(text.rlike(r"^\d{2}[/-]\d{2}[/-]\d{4}$"), text)
    fallbacks = [F.try_to_date(shaped, form).cast(c.NTZ) for form in DATE_FORMATS]
    return F.coalesce(c.parse_date(text), *fallbacks)


def is_whole_text(text: Column) -> Column:
    return text.rlike(_WHOLE)


def pair_text(text: Column) -> Column:
    """EURUSD, EUR/USD and USD_EUR style texts as six letters; else NULL."""
    letters = F.regexp_replace(F.upper(text), "[^A-Z]", "")
    return F.when(F.length(letters) == 6, letters)


def risk_rating(text: Column) -> Column:
    return F.when(text.isin(*fixed.RISK_RATINGS), text)


def direct_rate(rate: Column, typical: Column) -> Column:
    """Invert a rate whose inverse lies nearer the pair's typical rate."""
    distance = F.abs(F.ln(rate / typical))
    inverse_distance = F.abs(F.ln(F.lit(1.0) / rate / typical))
    return F.when((rate > 0) & (typical > 0) & (inverse_distance < distance), F.lit(1.0) / rate).otherwise(rate)
