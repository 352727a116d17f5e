"""Typed values from loosely typed JSON scalars, and range cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwright.functions.expr import let
from shelfwright.functions.text import strip

_INT = r"^[+-]?\d+(_\d+)*$"
_FLOAT = r"^[+-]?(\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"
_SPECIAL = r"(?i)^[+-]?(inf|infinity)$"


def text_to_str(c: Column) -> Column:
    """Stripped text; blank text is NULL."""
    return F.nullif(strip(c), F.lit(""))


def text_to_int(c: Column, dtype: str = "int") -> Column:
    """Integer literal as a number; ``'303.5'`` and other text are NULL."""
    return let(strip(c), lambda t: F.when(
        t.rlike(_INT), F.replace(t, F.lit("_"), F.lit("")).try_cast(dtype)
    ))


def text_to_float(c: Column) -> Column:
    """Decimal literal as a double; ``'5d'`` and other text are NULL."""
    return let(strip(c), lambda t: (
        F.when(t.rlike(_FLOAT), F.replace(t, F.lit("_"), F.lit("")).try_cast("double"))
        .when(t.rlike(_SPECIAL), t.try_cast("double"))
        .when(t.rlike(r"(?i)^[+-]?nan$"), F.lit(float("nan")))
    ))


def float_text(c: Column) -> Column:
    """Text of a double without Spark's early exponent: ``10000000.0``, ``1e-05``."""
    return let(c, _float_text)


def _float_text(c: Column) -> Column:
    plain = F.regexp_replace(c.cast("decimal(38,18)").cast("string"), r"(\.\d*?[1-9])0+$|(\.0)0+$", "$1$2")
    raw = c.cast("string")
    exponent = F.regexp_extract(raw, r"E-?(\d+)$", 1)
    science = F.concat(
        F.regexp_replace(F.regexp_extract(raw, r"^(.*)E", 1), r"\.0$", ""),
        F.when(F.contains(raw, F.lit("E-")), F.lit("e-")).otherwise(F.lit("e+")),
        F.lpad(exponent, F.greatest(F.length(exponent), F.lit(2)), F.lit("0")),
    )
    size = F.abs(c)
    return (
        F.when(F.isnan(c), F.lit("nan"))
        .when(size == float("inf"), F.when(c > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when(((size >= 1e7) & (size < 1e16)) | ((size >= 1e-4) & (size < 1e-3)), plain)
        .when((size >= 1e16) | ((size < 1e-4) & (size > 0)), science)
        .otherwise(raw)
    )


def _by_kind(v: Column, boolean: Column, text: Column, fraction: Column, other: Column) -> Column:
    """The value for the JSON type of ``v``, whose type is looked up once."""
    def pick(kind: Column) -> Column:
        broken = kind.isin("DOUBLE", "FLOAT") | (kind.startswith("DECIMAL") & ~kind.endswith(",0)"))
        return F.when(kind == "BOOLEAN", boolean).when(kind == "STRING", text).when(broken, fraction).otherwise(other)

    return let(F.schema_of_variant(v), pick)


def to_str(v: Column) -> Column:
    """Stripped text of a JSON scalar; blank and null are NULL."""
    plain = F.try_variant_get(v, "$", "string")
    text = _by_kind(v, F.initcap(plain), plain, float_text(F.try_variant_get(v, "$", "double")), plain)
    return let(text, text_to_str)


def to_int(v: Column, dtype: str = "int") -> Column:
    """Number rounded half-even, integer text as it is, everything else NULL."""
    exact = F.try_variant_get(v, "$", dtype)
    number = F.bround(F.try_variant_get(v, "$", "double"), 0).try_cast(dtype)
    text = text_to_int(F.try_variant_get(v, "$", "string"), dtype)
    return _by_kind(v, F.lit(None).cast(dtype), text, number, F.coalesce(exact, number))


def to_float(v: Column) -> Column:
    """Number or decimal text as a double, everything else NULL."""
    number = F.try_variant_get(v, "$", "double")
    text = text_to_float(F.try_variant_get(v, "$", "string"))
    return _by_kind(v, F.lit(None).cast("double"), text, number, number)


def clip_range(c: Column, lo=None, hi=None, *, open_lo: bool = False) -> Column:
    """``c`` inside ``[lo, hi]`` (``(lo, hi]`` with ``open_lo``), else NULL."""
    ok = F.lit(True)
    if lo is not None:
        ok = ok & ((c > lo) if open_lo else (c >= lo))
    if hi is not None:
        ok = ok & (c <= hi)
    return F.when(ok, c)


def positive(c: Column) -> Column:
    return clip_range(c, 0, open_lo=True)


def non_negative(c: Column) -> Column:
    return clip_range(c, 0)


def in_vocab(c: Column, values: Sequence) -> Column:
    """``c`` when it is one of ``values``, else NULL."""
    return F.when(c.isin(*values), c)
