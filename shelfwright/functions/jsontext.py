"""JSON inside text: strict parsing and staged repair."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwright.functions.expr import let
from shelfwright.functions.text import strip


def parse_strict(c: Column) -> Column:
    """Variant of a text that is one JSON value and nothing else, or NULL.

    The parser stops after the first value and ignores what follows. Read as the
    only element of an array and as the only field of an object, no tail can
    close both, so a tail of any kind makes one of the two fail.
    """
    elements = F.try_variant_get(
        F.try_parse_json(F.concat(F.lit("["), c, F.lit("]"))), "$", "array<variant>"
    )
    as_field = F.try_parse_json(F.concat(F.lit('{"v":'), c, F.lit("}")))
    parsed = let(elements, lambda e: F.when(F.size(e) == 1, F.when(as_field.isNotNull(), F.get(e, F.lit(0)))))
    # A failing parse raises inside the task; most text that is no JSON shows at its ends.
    return F.when(c.rlike(r'(?s)^\s*(?:[0-9]|[\[{"tfn0-9-].*[\]}"el0-9])\s*$'), parsed)


def is_json(c: Column) -> Column:
    return parse_strict(c).isNotNull()


def repair_json(c: Column) -> Column:
    """Struct ``value, stage``: whole text, fenced block, outermost braces.

    ``stage`` is ``direct``, ``fenced``, ``braces`` or ``error``. A later attempt
    runs only where the earlier ones failed.
    """
    text = strip(c)
    attempts = (
        ("direct", text),
        ("fenced", F.regexp_extract(text, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)),
        ("braces", F.regexp_extract(text, r"(?s)\{.*\}", 0)),
    )

    def result(value: Column, stage: str) -> Column:
        return F.struct(value.alias("value"), F.lit(stage).alias("stage"))

    repaired = result(F.lit(None).cast("variant"), "error")
    for stage, candidate in reversed(attempts):
        repaired = _attempt(candidate, stage, result, repaired)
    return repaired


def _attempt(candidate: Column, stage: str, result: Callable[[Column, str], Column], other: Column) -> Column:
    return let(parse_strict(candidate), lambda v: F.when(v.isNotNull(), result(v, stage)).otherwise(other))
