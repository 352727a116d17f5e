"""Text features of product names as native column expressions.

Every function takes and returns a ``Column``: no Python runs per row, so the
expressions stay inside code generation and can be pushed towards the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwright.functions.expr import let
from shelfwright.schemas import (
    BRAND_ALIASES,
    MEMORY_TYPES,
    MODEL_KEY_NOISE,
    MODEL_PATTERNS,
    PORT_PATTERNS,
    PORT_WORDS,
    VENDOR_PATTERNS,
    VENDOR_WORDS,
)

# Unicode white space plus the four ASCII separators that also count as blank,
# spelled out because that class is faster than the Unicode mode of ``\s``.
_BLANK = r"[\t-\r\x1c- \x85\xa0  -     　]"
_BLANKS = "".join(map(chr, (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def _none_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def strip(c: Column) -> Column:
    """Remove white space of every kind at both ends."""
    return F.btrim(c, F.lit(_BLANKS))


def has_text(c: Column) -> Column:
    """Whether there is anything but white space; false for NULL."""
    return F.coalesce(c.rlike(_BLANK.replace("[", "[^", 1)), F.lit(False))


def collapse_ws(c: Column) -> Column:
    """Replace each run of white space by one blank and trim the ends."""
    return F.trim(F.regexp_replace(c, rf"{_BLANK}+", " "))


def first_line(c: Column) -> Column:
    """Strip, then keep what precedes the first line break."""
    return F.regexp_extract(strip(c), r"^[^\r\n]*", 0)


def clean_text(c: Column) -> Column:
    """Upper-case ASCII words, ``-`` and ``+``; everything else is one blank."""
    return F.trim(F.regexp_replace(F.upper(c), r"[^A-Z0-9\-+]+", " "))


def reference_key(c: Column) -> Column:
    """Lower-case letters and digits only: ``RDNA 3`` and ``rdna-3`` agree."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")


def model_key(c: Column) -> Column:
    """Comparable form of a model name; NULL and noise-only names give ``''``."""
    noise = "|".join(MODEL_KEY_NOISE)
    words = F.regexp_replace(F.lower(c), rf"(?U)\b({noise})\b", " ")
    split = F.regexp_replace(words, r"(?U)(?<=\d)(?=[a-z])|(?<=[a-z])(?=\d)", " ")
    return F.coalesce(collapse_ws(split), F.lit(""))


def append_capacity(key: Column, gb: Column) -> Column:
    """``key`` plus ``' <gb> gb'`` when the size is known and not inside already."""
    return F.when(
        gb.isNotNull() & ~F.contains(key, F.lit("gb")),
        F.concat(key, F.lit(" "), gb.cast("string"), F.lit(" gb")),
    ).otherwise(key)


def model_key_with_capacity(c: Column, gb: Column) -> Column:
    """``model_key`` plus ``' <gb> gb'``; NULL when the bare key is empty."""
    return let(model_key(c), lambda key: F.when(key != "", append_capacity(key, gb)))


def attempt_key(c: Column, gb: Column) -> Column:
    """Key of a match attempt: the capacity is appended even to an empty key."""
    return let(model_key(c), lambda key: append_capacity(key, gb))


def capacity_gb(c: Column) -> Column:
    """First ``<1-3 digits> GB`` of a cleaned text."""
    return _none_if_empty(
        F.regexp_extract(c, r"\b(\d{1,3})\s*GB\b", 1)
    ).try_cast("int")


def enum_token(c: Column, tokens: Sequence[str]) -> Column:
    """First of ``tokens`` that occurs as a whole word."""
    return _none_if_empty(F.regexp_extract(c, rf"\b({'|'.join(tokens)})\b", 1))


def memory_type(c: Column) -> Column:
    return enum_token(c, MEMORY_TYPES)


def sum_matches(c: Column, pattern: str) -> Column:
    """Sum of group 1 over all matches; NULL without a match or at zero."""
    found = F.regexp_extract_all(c, F.lit(pattern), F.lit(1))
    total = F.aggregate(
        found,
        F.lit(0).cast("bigint"),
        lambda acc, x: acc + F.coalesce(x.try_cast("bigint"), F.lit(0).cast("bigint")),
    )
    return F.nullif(total, F.lit(0).cast("bigint"))


def port_count(c: Column, kind: str) -> Column:
    """Number of ports of ``kind`` (``hdmi`` or ``displayport``) spelled ``<n>x``."""
    return sum_matches(c, PORT_PATTERNS[kind])


def model_match(c: Column) -> Column:
    """Text of the model in a cleaned name: NVIDIA, AMD and Intel spelling in this order.

    A spelling is searched only where the ones before it do not occur.
    """
    return F.coalesce(*[
        _none_if_empty(F.regexp_extract(c, pattern, 0))
        for pattern in MODEL_PATTERNS
    ])


def model_fields(found: Column) -> dict[str, Column]:
    """``vendor, series, model, number, tokens`` of the text of ``model_match``."""
    number = F.regexp_extract(found, r"[0-9]{3,4}", 0)
    rtx, rx = F.startswith(found, F.lit("RTX")), F.startswith(found, F.lit("RX"))
    ti, sup = F.contains(found, F.lit("TI")), F.contains(found, F.lit("SUPER"))
    tail = _none_if_empty(F.regexp_extract(found, r"(XTX|XT|GRE)$", 1))
    code = F.concat(F.regexp_extract(found, r"^ARC[\s\-]*([A-Z])", 1), number)
    long_number = F.length(number) >= 4
    vendor = F.when(rtx, F.lit("NVIDIA")).when(rx, F.lit("AMD")).when(found.isNotNull(), F.lit("INTEL"))
    series = (
        F.when(rtx & long_number, F.concat(F.lit("GeForce RTX "), F.substring(number, 1, 2)))
        .when(rx & long_number, F.concat(F.lit("Radeon RX "), F.substring(number, 1, 1), F.lit("000")))
    )
    model = (
        F.when(rtx, F.concat_ws(" ", F.lit("RTX"), number, F.when(ti, F.lit("Ti")), F.when(sup, F.lit("SUPER"))))
        .when(rx, F.concat_ws(" ", F.lit("RX"), number, tail))
        .when(found.isNotNull(), F.concat(F.lit("ARC "), code))
    )
    words = (
        F.when(rtx, F.concat_ws(" ", F.lit("RTX"), number, F.when(ti, F.lit("TI")), F.when(sup, F.lit("SUPER"))))
        .when(found.isNotNull(), model)
    )
    return {"vendor": vendor, "series": series, "model": model, "number": number, "tokens": F.split(words, " ")}


def parse_model(c: Column) -> Column:
    """Struct ``vendor, series, model, number, tokens`` of a cleaned name."""
    return let(model_match(c), lambda found: F.struct(*[
        part.alias(name) for name, part in model_fields(found).items()
    ]))


def _first_of(c: Column, patterns: Sequence[str]) -> Column:
    """Text of the leftmost match of any pattern; NULL without one.

    At one position the alternative listed first wins, so one scan of the text
    finds the earliest pattern with ties in declared order.
    """
    return _none_if_empty(F.regexp_extract(c, "(" + "|".join(f"(?:{p})" for p in patterns) + ")", 1))


def earliest(c: Column, labels: Sequence[tuple[str, str]]) -> Column:
    """Label of the ``(label, pattern)`` pair that occurs first in ``c``.

    Equal positions go to the label declared first. Patterns must not match the
    empty text and must recognise their match without its surroundings.
    """
    def label_of(found: Column) -> Column:
        (label, pattern), *rest = labels
        chain = F.when(found.rlike(rf"^(?:{pattern})$"), F.lit(label))
        for label, pattern in rest:
            chain = chain.when(found.rlike(rf"^(?:{pattern})$"), F.lit(label))
        return chain

    return let(_first_of(c, [pattern for _, pattern in labels]), label_of)


def infer_vendor(c: Column) -> Column:
    return earliest(c, VENDOR_PATTERNS)


def brand_alias(head: Column, aliases: Sequence[tuple[str, str]] = BRAND_ALIASES) -> Column:
    """Earliest brand alias in the cleaned part before the first comma."""
    return _first_of(head, [rf"\b{alias}\b" for _, alias in aliases])


def brand(alias: Column, aliases: Sequence[tuple[str, str]] = BRAND_ALIASES) -> Column:
    """Brand that a matched alias stands for."""
    names = F.create_map(*[F.lit(v) for name, word in aliases for v in (word, name)])
    return F.try_element_at(names, alias)


def suffix_words(head: Column, drop: Column, number: Column) -> Column:
    """Words of ``head`` that are not vendor, memory, port, size or model words.

    ``drop`` holds the model's own words and those of the brand alias; words that
    contain the model number go too. A NULL number leaves no words.
    """
    fixed = "|".join((*VENDOR_WORDS, *MEMORY_TYPES, *PORT_WORDS))
    return F.filter(
        F.split(head, " "),
        lambda t: ~t.rlike(rf"^(?:(?:{fixed}|\d+|\d{{1,3}}GB?)$|\d{{1,3}}G\b)")
        & ~F.contains(t, number) & ~F.array_contains(drop, t),
    )


def suffix(head: Column, alias: Column, model: Column) -> Column:
    """Model suffix of a cleaned head; NULL without a model or without words.

    ``alias`` is the matched brand alias, ``model`` the struct of ``parse_model``.
    """
    drop = F.concat(model["tokens"], F.coalesce(F.split(alias, " "), F.array().cast("array<string>")))
    return let(drop, lambda d: _none_if_empty(F.array_join(suffix_words(head, d, model["number"]), " ")))


def canonical_vendor(c: Column, vendors: Sequence[str] = ("NVIDIA", "AMD")) -> Column:
    """Vendor id when it is one of ``vendors``, else NULL."""
    return let(F.upper(strip(c)), lambda key: F.when(key.isin(*vendors), key))


def slug(
    brand_name: Column, model_suffix: Column, vendor: Column, model: Column, gb: Column, oc: Column
) -> Column:
    """``asus_dual_nvidia_rtx5070_16gb_oc``: absent parts are skipped."""
    parts = [F.nullif(F.lower(c), F.lit("")) for c in (brand_name, model_suffix, vendor)]
    # An empty model is skipped, one that only says "geforce" leaves an empty part.
    compact = F.when(model != "", F.replace(F.replace(F.lower(model), F.lit("geforce"), F.lit("")), F.lit(" "), F.lit("")))
    joined = F.concat_ws(
        "_", *parts, compact,
        F.concat(gb.cast("string"), F.lit("gb")), F.when(oc, F.lit("oc")),
    )
    return F.regexp_replace(joined, r"[^a-z0-9_]", "")


# The listing rules as they are, and without the letter that they clip from the next word.
_CLIPPING = r"(?U)(GEFORCE RTX \d{4}\s?TI?|GEFORCE RTX \d{4}|RADEON RX \d{4}\s?XT?)"
_CLEAN = r"(?U)(GEFORCE RTX \d{4}(?:\s?TI\b)?|RADEON RX \d{4}(?:\s?XTX?\b)?)"


def derive_chipset(name: Column, compat: bool = False) -> Column:
    """Struct ``manufacturer, model, vram_gb, is_oc`` by fixed listing rules.

    ``compat`` keeps the known clipping of the rules: ``RTX 5070 TUF`` gives ``5070 T``.
    """
    text = F.upper(name)
    found = _none_if_empty(F.regexp_extract(text, _CLIPPING if compat else _CLEAN, 1))
    # Title case also raises a letter that follows a digit.
    titled = F.initcap(F.lower(found))
    for small in ("t", "x"):
        titled = F.regexp_replace(titled, rf"(?<![A-Za-z]){small}", small.upper())
    return F.struct(
        F.when(text.rlike("RTX|GEFORCE"), F.lit("NVIDIA"))
        .when(text.rlike("RADEON|RX"), F.lit("AMD")).alias("manufacturer"),
        titled.alias("model"),
        _none_if_empty(F.regexp_extract(text, r"(?U)(\d{2})\s*GB", 1)).try_cast("int").alias("vram_gb"),
        text.rlike(r" OC|-OC| O\.C| OVERCLOCK").alias("is_oc"),
    )


def derive_suffix(extracted: Column, name: Column) -> Column:
    """Extracted suffix without chipset words, else a known product line.

    A non-empty extracted value that cleans to nothing gives NULL, not the line.
    """
    cleaned = _none_if_empty(strip(F.regexp_replace(extracted, r"(?i)GEFORCE RTX.*", "")))
    line = _none_if_empty(F.regexp_extract(
        F.upper(name), r"(PRIME|STRIX|TUF|GAMING|VENTUS|SUPRIM|PULSE|NITRO\+?)", 1
    ))
    return F.when(extracted != "", cleaned).otherwise(F.initcap(F.lower(line)))


def full_name(series: Column, model: Column) -> Column:
    """``series || ' ' || model``, NULL if either is."""
    return F.concat(series, F.lit(" "), model)


def entity_label(entity_id: Column, vendor: Column, model: Column, gb: Column) -> Column:
    """``vendor model (<n>GB)``; no bracket without a size; the bare id if unknown."""
    base = F.concat(vendor, F.lit(" "), model)
    sized = F.when(gb != 0, F.concat(base, F.lit(" ("), gb.cast("string"), F.lit("GB)")))
    return F.coalesce(sized, base, entity_id.cast("string"))
