"""Nine hint columns from one listing name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwright.functions import text

HINTS = (
    "vendor_hint", "series_hint", "model_name_hint", "brand_hint", "suffix_hint",
    "vram_gb_hint", "memory_type_hint", "hdmi_count_hint", "displayport_count_hint",
)


def normalize_listings(df: DataFrame, name_col: str) -> DataFrame:
    """Add the hints of ``name_col``; an empty or NULL name gives only NULLs.

    Each stage is used more than once by the next, so Catalyst keeps the stages
    apart and runs the cleaning and the model pattern once per row.
    """
    name, c = F.col(name_col), F.col
    cleaned = df.withColumns({
        "_name": text.clean_text(name),
        "_head": text.clean_text(F.substring_index(name, ",", 1)),
    })
    found = cleaned.withColumns({"_found": text.model_match(c("_name")), "_alias": text.brand_alias(c("_head"))})
    no_words = F.array().cast("array<string>")
    parsed = found.withColumns({f"_{n}": part for n, part in text.model_fields(c("_found")).items()})
    parsed = parsed.withColumn("_drop", F.concat("_tokens", F.coalesce(F.split("_alias", " "), no_words)))
    words = parsed.withColumn("_words", text.suffix_words(c("_head"), c("_drop"), c("_number")))
    return words.withColumns({
        "vendor_hint": F.coalesce(c("_vendor"), text.infer_vendor(c("_name"))),
        "series_hint": c("_series"),
        "model_name_hint": c("_model"),
        "brand_hint": text.brand(c("_alias")),
        "suffix_hint": F.when(F.size("_words") > 0, F.array_join("_words", " ")),
        "vram_gb_hint": text.capacity_gb(c("_name")),
        "memory_type_hint": text.memory_type(c("_name")),
        "hdmi_count_hint": text.port_count(c("_name"), "hdmi"),
        "displayport_count_hint": text.port_count(c("_name"), "displayport"),
    }).drop(
        "_name", "_head", "_found", "_alias", "_vendor", "_series", "_model", "_number", "_tokens", "_drop", "_words"
    )
