"""User-facing views over the silver tables.

All functions take DataFrames in the silver column names and return lazy
DataFrames; ``register_views`` gives them SQL names.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwright.functions.price import ratio
from shelfwright.functions.text import full_name
from shelfwright.operators.joins import prefix_join
from shelfwright.operators.latest import latest_by_key, top_k
from shelfwright.operators.merge import rewrite_parts
from shelfwright.schemas import AVAILABLE_STATUS


def current_prices(observations: DataFrame, variants: DataFrame, tie: Sequence[str] = ("observation_id",)) -> DataFrame:
    """Newest observation per variant and retailer with the variant's names.

    ``tie`` decides between equal times and must be unique per observation.
    """
    columns = ["variant_id", "retailer", "price_eur", "stock_status", "product_url", "observed_at"]
    narrow = observations.select(*columns, *[c for c in tie if c not in columns])
    newest = latest_by_key(narrow, ["variant_id", "retailer"], "observed_at", list(tie))
    names = variants.select("variant_id", "chip_id", "aib_manufacturer", "model_suffix")
    return newest.join(names, "variant_id").select(
        "variant_id", "chip_id", "retailer", "price_eur", "stock_status", "product_url",
        F.col("observed_at").alias("last_seen_at"), "aib_manufacturer", "model_suffix",
    )


def technical_sheet(
    chip: DataFrame, vendor: DataFrame, architecture: DataFrame,
    memory: DataFrame, memory_type: DataFrame, features: DataFrame,
) -> DataFrame:
    """One row per chip with vendor-dependent labels; memory and features are optional."""
    sheet = (
        chip.join(vendor.select("vendor_id", F.col("full_name").alias("vendor_name")), "vendor_id")
        .join(architecture.select("architecture_id", F.col("generation").alias("architecture_gen")), "architecture_id")
        .join(memory, "chip_id", "left")
        .join(memory_type.select("memory_type_id", F.col("standard_name").alias("memory_type")), "memory_type_id", "left")
        .join(features, "chip_id", "left")
    )
    who = F.col("vendor_id")
    return sheet.select(
        "chip_id", "vendor_name", "architecture_gen",
        full_name(F.col("brand_series"), F.col("model_name")).alias("full_model_name"),
        "compute_units_count",
        F.when(who == "NVIDIA", F.lit("CUDA Cores"))
        .when(who == "AMD", F.lit("Stream Processors"))
        .when(who == "Intel", F.lit("Xe Cores"))
        .otherwise(F.col("compute_units_type")).alias("core_type_label"),
        "typical_clock_mhz",
        F.when(who == "AMD", F.lit("Game Clock")).otherwise(F.lit("Base Clock")).alias("typical_clock_label"),
        F.col("boost_clock_mhz").alias("reference_boost_clock_mhz"),
        "vram_gb", "memory_type", "memory_bus_bits", "memory_bandwidth_gbs",
        F.col("raytracing_hardware").alias("supports_rt_hardware"),
        F.when(who == "NVIDIA", F.col("dlss_version")).alias("dlss_version"),
        "fsr_support", "av1_encode", "tdp_watts", "recommended_psu_watts", "process_node_nm",
    )


def value_analysis(
    sheet: DataFrame, prices: DataFrame, available_only: bool = False, digits: int | None = 2,
    average: Callable[[Column], Column] = F.avg,
) -> DataFrame:
    """Market statistics per chip: variants, price span and price per GB.

    ``available_only`` keeps offers in or low in stock. ``average`` may be ``price.exact_avg``, which is the same for
    every partitioning.
    """
    offers = prices.where(F.col("stock_status").isin(*AVAILABLE_STATUS)) if available_only else prices
    stats = offers.groupBy("chip_id").agg(
        F.count_distinct("variant_id").alias("available_variants"),
        F.min("price_eur").alias("min_price_eur"),
        average(F.col("price_eur")).alias("avg_price_eur"),
        F.max("price_eur").alias("max_price_eur"),
    )
    facts = sheet.select("chip_id", "full_model_name", "vendor_name", "vram_gb", "memory_bandwidth_gbs", "tdp_watts")
    return facts.join(stats, "chip_id").select(
        "chip_id", "full_model_name", "vendor_name", "vram_gb",
        "available_variants", "min_price_eur", "avg_price_eur", "max_price_eur",
        ratio(F.col("min_price_eur"), F.col("vram_gb"), digits).alias("price_per_vram_gb"),
        "memory_bandwidth_gbs", "tdp_watts",
    )


def _offers(chip: DataFrame, memory: DataFrame, prices: DataFrame) -> DataFrame:
    return prices.select("chip_id", "price_eur", "retailer", "variant_id").join(chip, "chip_id").join(memory, "chip_id")


def price_performance(
    chip: DataFrame, memory: DataFrame, prices: DataFrame, digits: tuple[int | None, int | None] = (2, 3)
) -> DataFrame:
    """Compute and bandwidth per euro of every current offer."""
    power = F.col("compute_units_count").cast("bigint") * F.col("boost_clock_mhz")
    score = F.try_divide(ratio(power, F.col("price_eur")), F.lit(100.0))
    return _offers(chip, memory, prices).select(
        full_name(F.col("brand_series"), F.col("model_name")).alias("model"),
        "vendor_id", "price_eur",
        (score if digits[0] is None else F.round(score, digits[0])).alias("performance_per_euro_score"),
        ratio(F.col("memory_bandwidth_gbs"), F.col("price_eur"), digits[1]).alias("bandwidth_per_euro"),
        "retailer", "variant_id",
    )


def ai_suitability(
    chip: DataFrame, memory: DataFrame, features: DataFrame, prices: DataFrame,
    min_vram_gb: int = 12, digits: int | None = 2, ordered: bool = True,
) -> DataFrame:
    """Offers with enough memory, largest first and then cheapest per GB."""
    big = memory.where(F.col("vram_gb") >= min_vram_gb)
    rows = _offers(chip, big, prices).join(features.select("chip_id", "cuda_compute_capability"), "chip_id").select(
        full_name(F.col("brand_series"), F.col("model_name")).alias("model"),
        "vram_gb", "tensor_cores", "cuda_compute_capability",
        ratio(F.col("price_eur"), F.col("vram_gb"), digits).alias("eur_per_vram_gb"),
        "memory_bandwidth_gbs", "price_eur", "variant_id", "retailer",
    )
    if not ordered:
        return rows
    return rows.orderBy(F.desc_nulls_last("vram_gb"), F.asc_nulls_first("eur_per_vram_gb"), "variant_id", "retailer")


def price_segment(price: Column, low: float = 400, high: float = 800) -> Column:
    """Budget, mid-range (both bounds included) or high-end."""
    return (
        F.when(price < low, F.lit(f"Budget (<{low:g}€)"))
        .when(price.between(low, high), F.lit(f"Mid-Range ({low:g}-{high:g}€)"))
        .otherwise(F.lit(f"High-End (>{high:g}€)"))
    )


def best_per_segment(performance: DataFrame, k: int = 3, low: float = 400, high: float = 800) -> DataFrame:
    """Offers ranked ``<= k`` by score within their price segment, ties included."""
    banded = performance.withColumn("price_segment", price_segment(F.col("price_eur"), low, high))
    return top_k(banded, ["price_segment"], [F.desc_nulls_last("performance_per_euro_score")], k)


def capacity_per_watt(
    suitability: DataFrame, chip: DataFrame, min_vram_gb: int = 16, mode: str = "all",
    digits: int | None = 2, limit: int | None = None,
) -> DataFrame:
    """Memory per watt, pairing offers with chips whose full name they start with.

    With ``mode='all'`` a name also pairs with shorter chip names ("… 60 Ti"
    with "… 60"); ``'longest'`` keeps the most specific one.
    """
    chips = chip.select(
        F.col("chip_id").alias("chip_match"), F.col("tdp_watts").alias("chip_tdp_watts"),
        full_name(F.col("brand_series"), F.col("model_name")).alias("chip_name"),
    )
    large = suitability.where(F.col("vram_gb") >= min_vram_gb)
    # An offer's model is a chip's full name, so names pair at dimension size and the offers are read once.
    pairs = prefix_join(large, chips, "model", "chip_name", mode, chips.select("chip_name")).select(
        "model", "vram_gb", F.col("chip_tdp_watts").alias("tdp_watts"),
        ratio(F.col("vram_gb") * 1024.0, F.col("chip_tdp_watts"), digits).alias("vram_mb_per_watt"),
        "variant_id", "retailer", "chip_match",
    )
    if limit is None:
        return pairs
    return pairs.orderBy(
        F.desc_nulls_last("vram_mb_per_watt"), "variant_id", "retailer", "chip_match"
    ).limit(limit)


def price_history(
    observations: DataFrame, keys: Sequence[str] = ("variant_id",), time: str = "observed_at",
    price: str = "price_eur", tie: Sequence[str] = ("observation_id",), period: str | None = None,
    average: Callable[[Column], Column] = F.avg,
) -> DataFrame:
    """Count, span, average, first and last price per key and optional period.

    Every aggregate combines before the exchange, so a key with very many
    observations arrives as one row per task.
    """
    df = observations.where(F.col(price).isNotNull() & F.col(time).isNotNull())
    groups = list(keys)
    if period:
        df = df.withColumn("period", F.date_trunc(period, F.col(time)))
        groups.append("period")
    when = F.struct(time, *tie)
    return df.groupBy(*groups).agg(
        F.count("*").alias("n_observations"),
        F.min(price).alias("min_price"),
        average(F.col(price)).alias("avg_price"),
        F.max(price).alias("max_price"),
        F.min_by(price, when).alias("first_price"),
        F.max_by(price, when).alias("last_price"),
    )


def price_states(
    observations: DataFrame, time: str = "observed_at", price: str = "price_eur", tie: Sequence[str] = ("observation_id",), period: str = "month",
) -> DataFrame:
    """State of ``price_history`` of each row alone; ``merge_states`` makes one per key and period of them.

    ``part`` names the period in texts. ``last`` is NULL where it is ``first``: a state of one row holds its offer once.
    """
    df = observations.where(F.col(price).isNotNull() & F.col(time).isNotNull()).withColumn("period", F.date_trunc(period, F.col(time)))
    offer = F.struct(F.col(time).alias("at"), *tie, F.col(price).alias("price"))
    return df.withColumns({
        "n": F.lit(1).cast("bigint"), "total": F.col(price).cast("decimal(28,8)").cast("decimal(38,8)"), "low": F.col(price), "high": F.col(price),
        "first": offer, "part": F.date_format("period", "yyyy-MM-dd")}).withColumn("last", F.when(F.lit(False), F.col("first")))


def merge_states(states: DataFrame, keys: Sequence[str] = ("variant_id",)) -> DataFrame:
    """One state per key and period from any number of them: what two slices of rows have merges to what both together have.

    The sum is exact, so the order of merges does not matter. States combine in each task before the exchange.
    """
    merged = states.groupBy(*keys, "period", "part").agg(
        F.sum("n").alias("n"), F.sum("total").cast("decimal(38,8)").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("first").alias("first"), F.max(F.coalesce("last", "first")).alias("last"))
    return merged.withColumn("last", F.when(~F.col("last").eqNullSafe(F.col("first")), F.col("last")))


def history_of(states: DataFrame, keys: Sequence[str] = ("variant_id",)) -> DataFrame:
    """The columns of ``price_history`` from merged states."""
    return states.select(
        *keys, "period", F.col("n").alias("n_observations"), F.col("low").alias("min_price"),
        (F.col("total").cast("double") / F.col("n")).alias("avg_price"), F.col("high").alias("max_price"),
        F.col("first.price").alias("first_price"), F.coalesce("last", "first")["price"].alias("last_price"))


def update_history(spark: SparkSession, path: str, observations: DataFrame, keys: Sequence[str] = ("variant_id",), **options) -> list:
    """Merge a slice of new observations into the stored states; only the periods that the slice has rows of are read and written.

    Each row must come in one slice only, as the new facts of a load do. Old states and new rows cross the network once, together; the slice
    is read twice, first for its periods. Returns the periods.
    """
    new = price_states(observations, **options).select(*keys, "period", "n", "total", "low", "high", "first", "last", "part")
    return rewrite_parts(
        spark, path, new, "part", lambda old, add: merge_states(old.unionByName(add), keys).sortWithinPartitions("part", *keys), staged=False)


VIEWS = (
    "current_gpu_prices", "gpu_technical_sheet", "gpu_value_analysis",
    "gold_gpu_price_performance", "gold_gpu_ai_suitability",
)


def register_views(spark: SparkSession, tables: dict[str, DataFrame], replace: bool = True) -> list[str]:
    """Create the five views in dependency order; returns the names created.

    ``tables`` has ``chip, vendor, architecture, memory, memory_type, features,
    variant, observation``. Without ``replace`` existing views stay.
    """
    t = tables
    prices = current_prices(t["observation"], t["variant"])
    sheet = technical_sheet(
        t["chip"], t["vendor"], t["architecture"], t["memory"], t["memory_type"], t["features"]
    )
    frames = (
        prices, sheet, value_analysis(sheet, prices),
        price_performance(t["chip"], t["memory"], prices).drop("variant_id"),
        ai_suitability(t["chip"], t["memory"], t["features"], prices).drop("variant_id", "retailer"),
    )
    created = []
    for name, frame in zip(VIEWS, frames):
        if replace or not spark.catalog.tableExists(name):
            frame.createOrReplaceTempView(name)
            created.append(name)
    return created
