"""Rules and defaults that travel with a table's schema.

A contract is a ``StructType``. The metadata of a field may hold ``rules`` (name and SQL text over the row) and ``default`` (SQL text), so a
contract can be stored, read back and given to any writer. All rules of a table become one expression that lists the broken ones, so
good and refused rows come out of one pass. A rule is broken where it is false; NULL passes. A default fills an omitted column
only; a column that is given keeps its NULLs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwright import schemas as S

_KINDS = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(),
          "timestamp": T.TimestampType()}


def column(name: str, kind: str, *checks: str | tuple[str, str], required: bool = False, default: str | None = None) -> T.StructField:
    """A field with its rules. A check is SQL text, or a name and SQL text."""
    rules = {f"{name} not null": f"{name} IS NOT NULL"} if required else {}
    for check in checks:
        label, sql = (check, check) if isinstance(check, str) else check
        rules[label] = sql
    metadata: dict = {"rules": rules} if rules else {}
    if default is not None:
        metadata["default"] = default
    return T.StructField(name, _KINDS[kind], True, metadata)


def known(name: str, values: Sequence[object]) -> tuple[str, str]:
    """Membership in a vocabulary."""
    return f"{name} known", f"{name} IN ({', '.join(map(repr, values))})"


# Columns, defaults and rules of the loaded tables.
CHIP = T.StructType([
    column("chip_id", "string", required=True), column("vendor_id", "string", required=True), column("architecture_id", "string", required=True),
    column("brand_series", "string", required=True), column("model_name", "string", required=True), column("code_name", "string"),
    column("process_node_nm", "int"), column("launch_date", "date"),
    column("compute_units_type", "string", known("compute_units_type", S.COMPUTE_UNIT_TYPES), required=True),
    column("compute_units_count", "int", "compute_units_count > 0", required=True),
    column("rt_cores", "int", default="0"), column("tensor_cores", "int", default="0"),
    column("typical_clock_mhz", "int", "typical_clock_mhz > 0"), column("boost_clock_mhz", "int", "boost_clock_mhz >= typical_clock_mhz"),
    column("tdp_watts", "int", "tdp_watts > 0", required=True), column("recommended_psu_watts", "int", "recommended_psu_watts >= tdp_watts"),
    column("pcie_generation", "string", required=True), column("pcie_lanes", "int", known("pcie_lanes", S.PCIE_LANES), default="16"),
])
MEMORY = T.StructType([
    column("chip_id", "string", required=True), column("vram_gb", "int", "vram_gb > 0", required=True), column("memory_type_id", "string", required=True),
    column("memory_bus_bits", "int", known("memory_bus_bits", S.MEMORY_BUS_BITS), required=True),
    column("memory_speed_gbps", "double", "memory_speed_gbps > 0"), column("memory_bandwidth_gbs", "double", "memory_bandwidth_gbs > 0"),
])
FEATURES = T.StructType([
    column("chip_id", "string", required=True), column("raytracing_hardware", "boolean", required=True, default="false"),
    *[column(n, "string") for n in ("raytracing_api_support", "cuda_compute_capability", "dlss_version", "nvenc_generation")],
    *[column(n, "boolean", default="false") for n in ("nvidia_reflex", "fsr_support", "amd_fmf", "amd_hypr_rx", "xess_support", "av1_encode", "av1_decode", "resizable_bar")],
])
VARIANT = T.StructType([
    column("variant_id", "string", required=True), column("chip_id", "string", required=True), column("aib_manufacturer", "string", required=True),
    column("model_suffix", "string"), column("factory_boost_mhz", "int"), column("length_mm", "int", "length_mm > 0"),
    column("width_slots", "double", ("width_slots in range", "width_slots BETWEEN 2.0D AND 4.0D")), column("height_mm", "int"),
    column("power_connectors", "string"), column("cooling_type", "string", known("cooling_type", S.COOLING_TYPES)),
    column("fan_count", "int", "fan_count >= 0"), column("displayport_count", "int", default="0"), column("displayport_version", "string"),
    column("hdmi_count", "int", default="0"), column("hdmi_version", "string"), column("warranty_years", "int"),
])
OBSERVATION = T.StructType([
    column("observation_id", "string", required=True), column("variant_id", "string", required=True), column("retailer", "string", required=True),
    column("sku", "string"), column("product_url", "string", required=True), column("price_eur", "double", "price_eur > 0", required=True),
    column("stock_status", "string", known("stock_status", S.STOCK_STATUS)), column("observed_at", "timestamp", required=True),
    column("scrape_run_id", "string", required=True),
])


def rules(contract: T.StructType) -> list[tuple[str, Column]]:
    """All rules of a contract: what must be there first, then the checks."""
    found = [(name, sql) for f in contract.fields for name, sql in f.metadata.get("rules", {}).items()]
    return [(name, F.expr(sql)) for name, sql in sorted(found, key=lambda r: not r[0].endswith(" not null"))]


def broken(contract: T.StructType) -> Column:
    """Names of the rules that a row breaks."""
    return F.array_compact(F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules(contract)]))


def split(df: DataFrame, contract: T.StructType, out: str = "broken_rules") -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules, and the others with the names of those that they break."""
    judged = df.withColumn(out, broken(contract))
    return judged.where(F.size(out) == 0).drop(out), judged.where(F.size(out) > 0)


def problems(tables: dict[str, tuple[DataFrame, T.StructType]]) -> dict[str, DataFrame]:
    """For an all-or-nothing load: the refused rows of each table."""
    return {f"rules of {name}": split(df, contract)[1] for name, (df, contract) in tables.items()}


def defaults(contract: T.StructType) -> dict[str, str]:
    return {f.name: f.metadata["default"] for f in contract.fields if "default" in f.metadata}


def with_defaults(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Columns and types of the contract; omitted columns have their default, or NULL."""
    own = defaults(contract)
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.expr(own.get(f.name, "NULL"))).cast(f.dataType).alias(f.name) for f in contract.fields])


def ddl(contract: T.StructType) -> str:
    """Columns with types and defaults, for a catalog table."""
    own = defaults(contract)
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + (f" DEFAULT {own[f.name]}" if f.name in own else "") for f in contract.fields)


def create_table(spark, name: str, contract: T.StructType, path: str) -> None:
    """Catalog table at ``path`` whose columns have the contract's defaults."""
    spark.sql(f"CREATE TABLE {name} ({ddl(contract)}) USING parquet LOCATION '{path}'")


def insert(spark, name: str, rows: DataFrame) -> None:
    """Insert by column names; the catalog fills omitted columns with their defaults."""
    columns = ", ".join(f"`{c}`" for c in rows.columns)
    spark.sql(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {{rows}}", rows=rows)
