"""One evidence schema from the payloads of several producers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIELDS = {
    "aib_manufacturer": "string", "aib_model_suffix": "string", "chipset_manufacturer": "string",
    "chipset_model": "string", "vram_gb": "int", "is_oc": "boolean", "factory_boost_mhz": "int",
    "part_number": "string", "length_mm": "int", "width_slots": "double", "height_mm": "double",
    "power_connectors": "string", "cooling_type": "string", "fan_count": "int",
    "displayport_count": "int", "displayport_version": "string", "hdmi_count": "int",
    "hdmi_version": "string", "warranty_years": "int",
}
# Values a producer's own schema fills in when a field is absent.
FLAT_DEFAULTS = {"is_oc": False, "cooling_type": "Air", "displayport_count": 0, "hdmi_count": 0}
NESTED_DEFAULTS = {"displayport_count": 0, "hdmi_count": 0}


def _pick(df: DataFrame, names: dict[str, str], defaults: dict[str, object]) -> list[Column]:
    """Every canonical field: mapped column, same-named column, default or NULL.

    A value that is no text of the field's type counts as absent.
    """
    columns = []
    for field, kind in FIELDS.items():
        source = names.get(field, field)
        known = source in df.columns
        value = F.col(source).try_cast(kind) if known else F.lit(None).cast(kind)
        if field in defaults:
            value = F.coalesce(value, F.lit(defaults[field]).cast(kind))
        columns.append(value.alias(field))
    return columns


# Renamed fields and defaults per producer: ``search`` uses the canonical names,
# ``flat`` fills in cooling, ports and overclocking, ``nested`` carries one
# ``chipset`` text whose first word is the manufacturer.
PRODUCERS: dict[str, tuple[dict[str, str], dict[str, object]]] = {
    "search": ({}, {}),
    "flat": ({}, FLAT_DEFAULTS),
    "nested": ({"aib_model_suffix": "model_suffix", "chipset_model": "chipset"}, NESTED_DEFAULTS),
}


def conform(df: DataFrame, source: str, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, ``source`` and the canonical extraction fields.

    Where the payload holds its fields in a struct ``extraction``, they are read from there.
    """
    names, defaults = PRODUCERS[source]
    if "extraction" in df.columns and isinstance(df.schema["extraction"].dataType, T.StructType):
        inner = [f.name for f in df.schema["extraction"].dataType]
        df = df.select(*[c for c in df.columns if c != "extraction" and c not in inner], "extraction.*")
    if source == "nested":
        df = df.withColumn("chipset_manufacturer", F.substring_index("chipset", " ", 1))
    return df.select(*keep, F.lit(source).alias("source"), *_pick(df, names, defaults))


def conform_union(parts: dict[str, DataFrame], keep: Sequence[str] = ()) -> DataFrame:
    """All producers' rows under one schema."""
    frames = [conform(df, source, keep) for source, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
