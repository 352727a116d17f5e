"""Expression helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once however often it is used.

    Catalyst repeats a costly expression inside the branches of a condition;
    bound as the one element of an array it is not repeated.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
