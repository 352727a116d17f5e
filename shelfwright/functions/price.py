"""Price texts, price gates and ratio metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwright.schemas import MAX_PRICE


def parse_price(c: Column, locale: str = "de") -> Column:
    """Number of a price text.

    ``de``: dots group thousands and the comma is decimal, so a text without a
    comma loses all its dots (``784.73`` is 78473). ``en``: commas group.
    """
    digits = F.regexp_replace(c, r"[^0-9,.]", "")
    if locale == "de":
        number = F.replace(F.replace(digits, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    elif locale == "en":
        number = F.replace(digits, F.lit(","), F.lit(""))
    else:
        raise ValueError(f"unknown price locale: {locale}")
    return number.try_cast("double")


def valid_price(c: Column, cap: float = MAX_PRICE) -> Column:
    """``0 < price <= cap``; NULL and NaN are not valid."""
    return c.isNotNull() & (c > 0) & (c <= cap)


def ratio(a: Column, b: Column, digits: int | None = None) -> Column:
    """``a / b``, NULL at zero, rounded when ``digits`` is given."""
    value = F.try_divide(a.cast("double"), F.nullif(b.cast("double"), F.lit(0.0)))
    return value if digits is None else F.round(value, digits)


def exact_avg(c: Column, scale: int = 8) -> Column:
    """Average whose value does not depend on the order of summation.

    For comparing runs only: digits past ``scale`` are cut and values from 1e20 are an error. The plans average plainly
    unless they are given this function.
    """
    total = F.sum(c.cast(f"decimal(28,{scale})")).cast("double")
    return F.try_divide(total, F.count(c).cast("double"))
