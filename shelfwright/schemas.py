"""Schemas, vocabularies and fixed lookup rows of the catalog domain."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "variant": T.VariantType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def struct(ddl: str) -> T.StructType:
    """Schema of ``"name type, name type"``; needs no session, unlike ``fromDDL``."""
    pairs = [field.split() for field in ddl.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# They decide results and therefore must stay as they are.
VENDOR_PATTERNS = (
    ("NVIDIA", r"\b(NVIDIA|GEFORCE|RTX)\b"),
    ("AMD", r"\b(AMD|RADEON|RX)\b"),
    ("INTEL", r"\b(INTEL|ARC)\b"),
)
VENDOR_WORDS = ("NVIDIA", "GEFORCE", "AMD", "RADEON", "INTEL", "ARC")
MODEL_PATTERNS = (
    r"\bRTX[\s\-]*([0-9]{3,4})(?:[\s\-]*(TI))?(?:[\s\-]*(SUPER))?\b",
    r"\bRX[\s\-]*([0-9]{3,4})(?:[\s\-]*(XTX|XT|GRE))?\b",
    r"\bARC[\s\-]*([A-Z])[\s\-]*([0-9]{3,4})\b",
)
MODEL_KEY_NOISE = ("nvidia", "amd", "geforce", "radeon", "rtx", "rx")
MEMORY_TYPES = ("GDDR6X", "GDDR7", "GDDR6")
PORT_WORDS = ("HDMI", "DP", "DISPLAYPORT", "DISPLAY", "PORT")
PORT_PATTERNS = {
    "hdmi": r"\b(\d+)\s*X\s*HDMI\b",
    "displayport": r"\b(\d+)\s*X\s*(DP|DISPLAYPORT|DISPLAY\s*PORT)\b",
}
BRAND_ALIASES = (
    ("ASUS", "ASUS"),
    ("GIGABYTE", "GIGABYTE"),
    ("MSI", "MSI"),
    ("SAPPHIRE", "SAPPHIRE"),
    ("POWERCOLOR", "POWERCOLOR"),
    ("POWERCOLOR", "POWER COLOR"),
    ("ASROCK", "ASROCK"),
    ("ASROCK", "AS ROCK"),
    ("XFX", "XFX"),
    ("ACER", "ACER"),
    ("GAINWARD", "GAINWARD"),
    ("PALIT", "PALIT"),
    ("ZOTAC", "ZOTAC"),
    ("NVIDIA", "NVIDIA"),
    ("INTEL", "INTEL"),
)
STOCK_STATUS = ("in_stock", "low_stock", "preorder", "out_of_stock", "discontinued")
AVAILABLE_STATUS = ("in_stock", "low_stock")
COOLING_TYPES = ("Air", "Liquid", "Hybrid")
COMPUTE_UNIT_TYPES = ("CUDA_CORES", "STREAM_PROCESSORS", "XE_CORES")
MEMORY_BUS_BITS = (64, 96, 128, 192, 256, 320, 384, 512, 1024, 2048, 4096)
PCIE_LANES = (8, 16)
EVIDENCE_TYPE = "gpu_variant"
MAX_PRICE = 20000.0
BLOCK_TITLE_WORDS = ("access denied", "robot", "human", "captcha")
BLOCK_BODY_WORDS = (
    "captcha",
    "access denied",
    "unusual traffic",
    "verify you are human",
    "robot",
    "bot protection",
    "cloudflare",
    "akamai",
    "attention required",
    "just a moment",
)
ITEM_MARKERS = ("galleryview__item", "productlist__product")
MIN_PAGE_LENGTH = 5000

# Fields a seed entry must name; a field may hold null.
SEED_FIELDS = {
    "chip": (
        "vendor", "brand_series", "model_name", "code_name", "architecture",
        "process_node_nm", "launch_date", "compute_units_type",
        "compute_units_count", "rt_cores", "tensor_cores", "typical_clock_mhz",
        "boost_clock_mhz", "tdp_watts", "recommended_psu_watts",
        "pcie_generation", "pcie_lanes",
    ),
    "memory": (
        "vram_gb", "memory_type", "memory_bus_bits", "memory_speed_gbps",
        "memory_bandwidth_gbs",
    ),
    "features": (
        "raytracing_hardware", "raytracing_api_support",
        "cuda_compute_capability", "dlss_version", "nvenc_generation",
        "nvidia_reflex", "fsr_support", "amd_fmf", "amd_hypr_rx",
        "xess_support", "av1_encode", "av1_decode", "resizable_bar",
    ),
}

# Field names of the files and of the two loaded tables.
LISTING = struct(
    "retailer string, product_name_raw string, product_url string, price_eur double, "
    "currency string, page_number int, position_in_page int, observed_at_utc string, "
    "scrape_run_id string, sku string, stock_status string"
)
# Fields that producers fill with numbers or text stay VARIANT until coerced.
EXTRACTION = struct(
    "aib_manufacturer variant, aib_model_suffix variant, model_suffix variant, "
    "chipset_manufacturer variant, chipset_model variant, vram_gb variant, is_oc boolean, "
    "factory_boost_mhz variant, part_number variant, length_mm variant, width_slots variant, "
    "height_mm variant, power_connectors variant, cooling_type variant, fan_count variant, "
    "displayport_count variant, displayport_version variant, hdmi_count variant, "
    "hdmi_version variant, warranty_years variant"
)
EVIDENCE = T.StructType([
    T.StructField("hypothesis_type", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("input", struct("model_name string")),
    T.StructField("extraction", EXTRACTION),
    T.StructField("evidence", struct("source_url string, citations array<string>")),
    T.StructField("raw", struct("llm_response string")),
])

OBSERVATION = struct(
    "observation_id string, variant_id string, retailer string, sku string, product_url string, "
    "price_eur double, stock_status string, observed_at timestamp, scrape_run_id string"
)
VARIANT = struct(
    "variant_id string, chip_id string, aib_manufacturer string, model_suffix string, "
    "factory_boost_mhz int, length_mm int, width_slots double, height_mm int, "
    "power_connectors string, cooling_type string, fan_count int, displayport_count int, "
    "displayport_version string, hdmi_count int, hdmi_version string, warranty_years int"
)

# Fixed reference rows of the three lookup dimensions.
VENDOR_ROWS = (
    ("NVIDIA", "NVIDIA Corporation", 1993, "Santa Clara, CA", "https://nvidia.com", "CUDA Cores", "RT Cores", "Tensor Cores"),
    ("AMD", "Advanced Micro Devices", 1969, "Santa Clara, CA", "https://amd.com", "Stream Processors", "Ray Accelerators", "AI Accelerators"),
    ("Intel", "Intel Corporation", 1968, "Santa Clara, CA", "https://intel.com", "Xe Cores", None, "XMX Engines"),
)
ARCHITECTURE_ROWS = (
    ("Blackwell", "NVIDIA", "5th Gen RTX", 5, "2024-03-18", "2025-01-30", True, True, True),
    ("Ada Lovelace", "NVIDIA", "4th Gen RTX", 5, "2022-09-20", "2022-10-12", True, True, True),
    ("Ampere", "NVIDIA", "3rd Gen RTX", 8, "2020-05-14", "2020-09-17", True, True, False),
    ("RDNA4", "AMD", "RDNA 4", 4, "2024-01-08", "2025-01-23", True, True, True),
    ("RDNA3", "AMD", "RDNA 3", 5, "2022-11-03", "2022-12-13", True, True, True),
    ("Xe2-HPG", "Intel", "Xe2", 5, "2024-12-03", "2024-12-12", True, True, True),
)
MEMORY_TYPE_ROWS = (
    ("GDDR7", 7, "GDDR7 SGRAM", 32.0, 1.1, 2024, "JESD239A"),
    ("GDDR6X", 6, "GDDR6X SGRAM", 24.0, 1.35, 2020, "JESD239"),
    ("GDDR6", 6, "GDDR6 SGRAM", 20.0, 1.35, 2018, "JESD232"),
    ("HBM3", 3, "High Bandwidth Memory 3", 8.0, 1.1, 2023, "JESD238"),
    ("HBM2", 2, "High Bandwidth Memory 2", 3.6, 1.2, 2016, "JESD235"),
)


_ARROW = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}


def literal_rows(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """Fixed rows as a local relation.

    Its size is known to the planner, so joins broadcast the rows and not the
    table on the other side, as they would next to rows of unknown size.
    """
    fields = [field.split() for field in ddl.split(",")]
    columns = list(zip(*rows))
    return spark.createDataFrame(pa.table({
        name: pa.array(values, _ARROW[kind]) for (name, kind), values in zip(fields, columns)
    }))


def vendors(spark: SparkSession) -> DataFrame:
    return literal_rows(
        spark, VENDOR_ROWS,
        "vendor_id string, full_name string, founded_year int, headquarters string, "
        "website_url string, compute_unit_name string, rt_core_name string, tensor_core_name string",
    )


def architectures(spark: SparkSession) -> DataFrame:
    df = literal_rows(
        spark, ARCHITECTURE_ROWS,
        "architecture_id string, vendor_id string, generation string, process_node_nm int, "
        "announcement_date string, first_product_launch string, supports_raytracing boolean, "
        "supports_mesh_shaders boolean, supports_direct_storage boolean",
    )
    return df.withColumns({c: df[c].cast("date") for c in ("announcement_date", "first_product_launch")})


def memory_types(spark: SparkSession) -> DataFrame:
    return literal_rows(
        spark, MEMORY_TYPE_ROWS,
        "memory_type_id string, generation int, standard_name string, max_speed_gbps double, "
        "typical_voltage double, release_year int, jedec_standard string",
    )
