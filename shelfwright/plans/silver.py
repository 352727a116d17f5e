"""Silver load: evidence to variants, listings to observations, with reasons.

Evidence is matched once per document and joined to the index at product size.
Listings, the large side, are then exchanged once on the url hash. Each row
gets one outcome; accepted and rejected rows together are the input.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwright.functions import coerce
from shelfwright.functions.ids import stable_id
from shelfwright.functions.text import has_text
from shelfwright.functions.times import iso_text
from shelfwright.operators.counters import ACCEPTED, TOTAL, counted, tally
from shelfwright.operators.lookup import lookup_chain
from shelfwright.operators.matching import candidate_index, match_two_attempts
from shelfwright.operators.merge import append_new, append_stored, conform_to_target
from shelfwright.operators.normalize import normalize_listings
from shelfwright.operators.quality import reject_cascade
from shelfwright.schemas import COOLING_TYPES, EVIDENCE_TYPE, STOCK_STATUS
from shelfwright.session import spread, written

_ORDER = ("ref", "file", "pos")
ERRORS = ("unreadable", "unknown_variant")
#: Of tables at the size of the listings: their ids are hex digits, which it halves.
CODEC = "zstd"
#: What a listing can come to, besides being inserted or a duplicate.
OUTCOMES = (
    "unreadable", "no_index_entry", "ambiguous_index_entry", "no_hypothesis", "ambiguous_hypothesis", "missing_hypothesis_file",
    "wrong_type", "missing_brand", "missing_match_fields", "ambiguous_chip_match", "no_chip_match", "missing_identifiers",
    "missing_currency", "invalid_price", "invalid_stock_status", "unknown_variant",
)
_EVIDENCE_TEXT = (
    "aib_manufacturer", "aib_model_suffix", "chipset_manufacturer", "chipset_model", "part_number",
    "cooling_type", "power_connectors", "displayport_version", "hdmi_version",
)
_EVIDENCE_INT = (
    "vram_gb", "factory_boost_mhz", "length_mm", "height_mm", "fan_count", "displayport_count",
    "hdmi_count", "warranty_years",
)


def coerce_evidence(documents: DataFrame) -> DataFrame:
    """Flat typed evidence ``path, readable, hypothesis_type, name, …``.

    ``documents`` comes from ``read_documents``; its extraction fields are
    VARIANT and are coerced here by their JSON type.
    """
    e = F.col("extraction")
    # The first suffix that is no empty text counts, even if it is blank.
    given = F.coalesce(F.try_variant_get(e["aib_model_suffix"], "$", "string") != "", F.lit(False))
    own = F.when(given, coerce.to_str(e["aib_model_suffix"])).otherwise(coerce.to_str(e["model_suffix"]))
    columns = [own.alias(n) if n == "aib_model_suffix" else coerce.to_str(e[n]).alias(n) for n in _EVIDENCE_TEXT]
    columns += [coerce.to_int(e[n]).alias(n) for n in _EVIDENCE_INT]
    return documents.select(
        "path", "readable", "hypothesis_type", F.col("input.model_name").alias("name"),
        *columns, coerce.to_float(e["width_slots"]).alias("width_slots"),
    )


def coerce_evidence_text(rows: DataFrame) -> DataFrame:
    """The same from rows whose extraction fields are texts."""
    columns = {n: coerce.text_to_str(F.col(n)) for n in _EVIDENCE_TEXT}
    columns |= {n: coerce.text_to_int(F.col(n)) for n in _EVIDENCE_INT}
    columns["width_slots"] = coerce.text_to_float(F.col("width_slots"))
    if "readable" not in rows.columns:
        columns["readable"] = F.lit(True)
    return rows.withColumns(columns)


def match_evidence(evidence: DataFrame, dim: DataFrame) -> DataFrame:
    """Add both match attempts, the winner's columns and ``variant_id``.

    Attempt one uses hints parsed from ``name``, attempt two the extracted
    fields. ``dim`` has ``chip_id, vendor_id, model_name, vram_gb``. A match costs far more than reading
    a row, so the rows are dealt to many tasks first.
    """
    hinted = normalize_listings(spread(evidence), "name")
    c = F.col
    matched = match_two_attempts(
        # The winner's capacity is called vram_gb, so the extracted one moves aside.
        hinted.withColumnRenamed("vram_gb", "extracted_vram_gb"),
        candidate_index(dim),
        (c("vendor_hint"), c("model_name_hint"), c("vram_gb_hint"), c("brand_hint")),
        (c("chipset_manufacturer"), c("chipset_model"), c("extracted_vram_gb"), c("aib_manufacturer")),
    )
    parts = [c(n) for n in ("vendor_id", "model_key", "vram_gb", "brand", "aib_model_suffix", "part_number")]
    return matched.withColumn("variant_id", stable_id("var", *parts, stripped=True))


def _match_reasons() -> list[tuple[str, Column]]:
    state = F.col("state")
    return [
        ("missing_brand", F.col("brand").isNull()),
        ("missing_match_fields", F.col("chip_id").isNull() & (state == "missing")),
        ("ambiguous_chip_match", F.col("chip_id").isNull() & (state == "ambiguous")),
        ("no_chip_match", F.col("chip_id").isNull()),
    ]


def classify_evidence(matched: DataFrame, kind: str = EVIDENCE_TYPE) -> DataFrame:
    """Add ``outcome`` of the variant load; NULL means acceptable."""
    wrong = ~F.coalesce(F.col("hypothesis_type") == kind, F.lit(False))
    return reject_cascade(matched, [
        ("unreadable", ~F.col("readable")), ("wrong_type", wrong), *_match_reasons(),
    ])


def variant_rows(accepted: DataFrame) -> DataFrame:
    """Cleaned variant columns of accepted evidence."""
    c = F.col
    return accepted.select(
        "path", "variant_id", "chip_id", c("brand").alias("aib_manufacturer"),
        c("aib_model_suffix").alias("model_suffix"), "factory_boost_mhz",
        coerce.positive(c("length_mm")).alias("length_mm"),
        coerce.clip_range(c("width_slots"), 2.0, 4.0).alias("width_slots"),
        coerce.positive(c("height_mm")).alias("height_mm"),
        "power_connectors", coerce.in_vocab(c("cooling_type"), COOLING_TYPES).alias("cooling_type"),
        coerce.non_negative(c("fan_count")).alias("fan_count"),
        coerce.non_negative(c("displayport_count")).alias("displayport_count"), "displayport_version",
        coerce.non_negative(c("hdmi_count")).alias("hdmi_count"), "hdmi_version",
        coerce.non_negative(c("warranty_years")).alias("warranty_years"),
    )


def load_variants(evidence: DataFrame, dim: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """New variants: the first document per variant, unless it exists already."""
    accepted = classify_evidence(match_evidence(evidence, dim)).where("outcome is null")
    return append_new(target, variant_rows(accepted), "variant_id", ["path"]).drop("path")


def mark_loaded(matched: DataFrame, variants: DataFrame) -> DataFrame:
    """Add ``variant_known``: whether the document's variant is loaded."""
    known = variants.select("variant_id").distinct().withColumn("_known", F.lit(True))
    return matched.join(known, "variant_id", "left").withColumn("variant_known", F.col("_known").isNotNull()).drop("_known")


def classify_observations(
    listings: DataFrame,
    index: DataFrame,
    matched: DataFrame,
    variants: DataFrame | None = None,
    require_currency: bool = False,
    evidence_type: str | None = None,
) -> DataFrame:
    """Add ``outcome`` and ``observation_id`` to every listing.

    The first failing reason wins; NULL means acceptable, with duplicates still
    inside. ``matched`` comes from ``match_evidence``; it may have passed
    ``mark_loaded`` already, else ``variants`` says what is loaded. ``evidence_type`` gates
    the evidence kind, which this load does not do by default: evidence of
    another kind has no variant and then fails the reference check.
    """
    products = matched if variants is None else mark_loaded(matched, variants)
    columns = [
        "path", "readable", "hypothesis_type", "state", "brand", "chip_id", "variant_id", "variant_known",
        "vendor_id", "model_key", "vram_gb", "aib_model_suffix", "part_number",
        "first_attempt", "second_attempt",
    ]
    chained = lookup_chain(listings, index, products.select(*columns))
    c = F.col
    moment = c("observed_at")
    timed = moment.isNotNull() if dict(listings.dtypes)["observed_at"] != "string" else has_text(moment)
    named = has_text(c("retailer")) & has_text(c("product_url")) & has_text(c("run_id")) & timed
    price, status = c("price_eur"), c("stock_status")
    # The rules look at the raw texts: a filter on the outcome is pushed below
    # the cleaning, which it would otherwise repeat.
    reasons = [("unreadable", ~c("page_readable"))] if "page_readable" in listings.columns else []
    reasons += [
        ("no_index_entry", c("n_entries").isNull()),
        ("ambiguous_index_entry", c("n_entries") > 1),
        ("no_hypothesis", c("n_hypotheses") <= 0),
        ("ambiguous_hypothesis", c("n_hypotheses") > 1),
        ("missing_hypothesis_file", ~c("evidence_found")),
        ("unreadable", ~c("readable")),
    ]
    if evidence_type:
        reasons.append(("wrong_type", ~F.coalesce(c("hypothesis_type") == evidence_type, F.lit(False))))
    reasons += [*_match_reasons(), ("missing_identifiers", ~named)]
    if require_currency:
        reasons.append(("missing_currency", ~has_text(c("currency"))))
    reasons += [
        ("invalid_price", price.isNull() | F.isnan(price) | (price <= 0)),
        ("invalid_stock_status", has_text(status) & ~coerce.strip(status).isin(*STOCK_STATUS)),
        ("unknown_variant", ~c("variant_known")),
    ]
    classified = reject_cascade(chained, reasons)
    texts = ("retailer", "product_url", "run_id", "stock_status", "currency", "sku")
    cleaned = classified.withColumns({n: coerce.text_to_str(c(n)) for n in texts if n in listings.columns})
    observed = coerce.text_to_str(moment) if dict(listings.dtypes)["observed_at"] == "string" else iso_text(moment)
    ids = stable_id("obs", c("variant_id"), c("retailer"), c("product_url"), observed, stripped=True)
    return cleaned.withColumn("observation_id", F.when(c("outcome").isNull(), ids))


@dataclass(frozen=True)
class Load:
    """Tables of one run: new variants, judged listings, new facts, and ``kind, path`` of what could not be read."""

    variants: DataFrame
    classified: DataFrame
    observations: DataFrame
    unreadable: DataFrame
    counters: dict[str, int]


def silver_pipeline(
    spark: SparkSession, listings: DataFrame, index: DataFrame, evidence: DataFrame, dim: DataFrame,
    variants: DataFrame | None = None, observations: DataFrame | None = None, schema: T.StructType | None = None,
) -> Load:
    """The whole load, from what the bronze readers give to new variants and facts.

    ``listings`` comes from ``read_listings``, ``index`` from ``read_index`` and ``evidence`` from ``coerce_evidence``;
    ``variants`` and ``observations`` are the existing tables, if any. Evidence is matched once: the match and the judged
    listings are written to shared storage, because the variants, the facts and the reports all read them. The counters
    come from these writes. Pages that can't be read are rows with the outcome ``unreadable``.
    """
    new, products = load_products(spark, evidence, dim, variants)
    index = written(spark, index, "index")
    pages = listings.withColumnRenamed("readable", "page_readable")
    judged, seen = counted(classify_observations(pages, index, products), OUTCOMES)
    classified = written(spark, judged, "classified", CODEC)
    facts, inserted = tally(load_observations(classified, target=observations, schema=schema, stored=True))
    facts = written(spark, facts, "facts", CODEC)
    missing = [products.where("not readable").select(F.lit("evidence").alias("kind"), "path")]
    if "page_readable" in classified.columns:
        missing.append(classified.where("not page_readable").select(F.lit("listings"), "file"))
    if "readable" in index.columns:
        missing.append(index.where("not readable").select(F.lit("index"), "index_path"))
    return Load(new, classified, facts, reduce(DataFrame.union, missing), run_counters(seen.get, inserted.get))


def load_products(
    spark: SparkSession, evidence: DataFrame, dim: DataFrame, variants: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """New variants, and every matched document with ``variant_known``; both are written tables at product size."""
    matched = written(spark, match_evidence(evidence, dim), "matched")
    accepted = classify_evidence(matched).where("outcome is null")
    new = written(spark, append_new(variants, variant_rows(accepted), "variant_id", ["path"]).drop("path"), "variants")
    known = new.select("variant_id") if variants is None else new.select("variant_id").union(variants.select("variant_id"))
    return new, written(spark, mark_loaded(matched, known), "products")


def run_counters(judged: dict[str, int], inserted: dict[str, int]) -> dict[str, int]:
    """Rows per outcome from what the two writes counted: accepted rows that became no fact are duplicates."""
    new = inserted[TOTAL]
    return {k: n for k, n in judged.items() if k not in (ACCEPTED, TOTAL)} | {"inserted": new, "duplicate": judged[ACCEPTED] - new}


def outcome_counts(classified: DataFrame, key: str, target: DataFrame | None = None) -> DataFrame:
    """Rows per outcome, with accepted rows told apart as inserted or duplicate.

    Accepted rows are counted per key before anything is exchanged, so no
    ranking of a hot key is needed: a new key inserts one row, all its other
    rows are duplicates.
    """
    counted = classified.groupBy(
        "outcome", F.when(F.col("outcome").isNull(), F.col(key)).alias("_key")
    ).agg(F.count("*").alias("n"))
    if target is not None:
        known = target.select(F.col(key).alias("_key")).distinct().withColumn("_hit", F.lit(True))
        counted = counted.join(known, "_key", "left").withColumn("_new", F.when(F.col("_hit").isNull(), 1).otherwise(0))
    else:
        counted = counted.withColumn("_new", F.lit(1))
    ok = F.col("outcome").isNull()
    new = F.col("_new").cast("bigint")
    rows = F.when(ok, F.array(
        F.struct(F.lit("inserted").alias("outcome"), new.alias("n")),
        F.struct(F.lit("duplicate").alias("outcome"), (F.col("n") - new).alias("n")),
    )).otherwise(F.array(F.struct(F.col("outcome").alias("outcome"), F.col("n").alias("n"))))
    return (
        counted.select(F.explode(rows).alias("r"))
        .groupBy(F.col("r.outcome").alias("outcome")).agg(F.sum("r.n").alias("n_rows"))
        .where("n_rows > 0")
    )


#: What the facts need of a judged listing, besides its reference and outcome.
FACT_INPUTS = ("observation_id", "variant_id", "retailer", "product_url", "price_eur", "stock_status", "observed_at", "run_id", "sku", "currency", "file", "pos")


def accepted_observations(classified: DataFrame) -> DataFrame:
    """Fact columns of the acceptable rows, still with repeats, plus the order columns."""
    optional = [c for c in ("sku", "currency") if c in classified.columns]
    return classified.where("outcome is null").withColumnsRenamed({"run_id": "scrape_run_id"}).select(
        "observation_id", "variant_id", "retailer", "product_url", "price_eur", "stock_status",
        "observed_at", "scrape_run_id", *optional, *[c for c in _ORDER if c in classified.columns],
    )


def scan_order(rows: DataFrame) -> list[str]:
    """``file, pos`` where the rows carry them, else the reference."""
    return ["file", "pos"] if {"file", "pos"} <= set(rows.columns) else ["ref"]


def load_observations(
    classified: DataFrame, order: Sequence[str] | None = None, target: DataFrame | None = None,
    schema: T.StructType | None = None, stored: bool = False,
) -> DataFrame:
    """New fact rows in the target's columns and types: first per id, unless it exists.

    The order is that of the scan (file, then number within it) unless another is given. ``stored`` says that ``classified``
    is a written table, which can be read several times: then only repeats are exchanged as rows.
    """
    accepted = accepted_observations(classified)
    append = append_stored if stored else append_new
    rows = append(target, accepted, "observation_id", list(order or scan_order(accepted)))
    schema = target.schema if target is not None else schema
    return conform_to_target(rows, schema) if schema else rows.drop(*_ORDER)


#: Columns of the reject table, besides the reference and the number of copies.
REJECT_COLUMNS = (
    "product_url", "outcome", "path", "first_attempt", "second_attempt", "vendor_id",
    "model_key", "vram_gb", "brand", "aib_model_suffix", "part_number", "variant_id", "variant_known",
)


def reject_table(
    classified: DataFrame, target: DataFrame | None = None, ref: str = "ref",
    order: Sequence[str] | None = None, duplicates: bool = True,
) -> DataFrame:
    """Rejected listings with reason, both attempts and the would-be ids.

    Equal listings are one row with their number in ``n_copies``. Of the
    acceptable listings the first reference of a new id is inserted; what
    remains of it and all other references are duplicates. The work per hot id
    is a count and a minimum, both combined inside each task, and one join on
    the reference. Only short hashes of all rows are exchanged first: a rejected
    listing whose hash occurs once is its own row, an acceptable one whose id's
    hash occurs once is inserted, and only the others are counted, as whole rows.
    Write ``classified`` to a table first when it is costly: it is read three times.
    """
    columns = list(REJECT_COLUMNS)
    if not duplicates:
        failed = classified.where("outcome is not null")
        return failed.groupBy(ref, *columns).agg(F.count("*").alias("n_copies"))
    spark = classified.sparkSession
    key = F.when(F.col("outcome").isNull(), F.xxhash64("observation_id")).otherwise(F.xxhash64(ref, *columns))
    keyed = classified.withColumn("_key", key)
    keys = keyed.select("_key")
    if target is not None:
        keys = keys.union(target.select(F.xxhash64("observation_id")))
    again = written(spark, keys.groupBy("_key").agg(F.count("*").alias("n")).where("n > 1").select("_key"), "again")
    lone = keyed.where("outcome is not null").join(again, "_key", "left_anti").select(ref, *columns, F.lit(1).cast("bigint").alias("n_copies"))
    classified = written(spark, keyed.join(again, "_key", "left_semi").drop("_key"), "repeats")
    ok = classified.where("outcome is null")
    winners = ok.groupBy("observation_id").agg(F.min_by(ref, F.struct(*(order or scan_order(ok)))).alias(ref))
    if target is not None:
        winners = winners.join(target.select("observation_id"), "observation_id", "left_anti")
    inserted = winners.select(ref, F.lit(1).alias("_first"), F.lit("duplicate").alias("outcome"))
    rows = classified.withColumn("outcome", F.coalesce("outcome", F.lit("duplicate")))
    # Copies of one listing collapse inside each task; only then rows are exchanged.
    distinct = rows.groupBy(ref, *columns).agg(F.count("*").alias("_rows"))
    left = F.col("_rows") - F.coalesce("_first", F.lit(0))
    counted = distinct.join(inserted, [ref, "outcome"], "left").select(ref, *columns, left.alias("n_copies")).where("n_copies > 0")
    return lone.union(counted)
