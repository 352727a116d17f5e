"""Catalog-shaped frames derived from the given tables.

Products, evidence and index documents come from ``part``, listings from
``lineitem``; faults are planted by key arithmetic. ``frames_sql`` states the
same rules as SQL, so that both engines build the same rows.
"""

from __future__ import annotations

import io
import uuid
import zipfile

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwright.bindings.registry import table
from shelfwright.functions.ids import url_hash
from shelfwright.functions.times import iso_text
from shelfwright.schemas import literal_rows
from shelfwright.session import shuffles_freed, workspace

# Invented chips: chip_no, vendor, series, model, cores, boost, watts, GB, GB/s, tensor cores.
CHIPS = (
    (0, "NVIDIA", "GeForce RTX 60", "GeForce RTX 6010", 2560, 2400, 115, 8, 272.0, 80),
    (1, "NVIDIA", "GeForce RTX 60", "GeForce RTX 6010 Ti", 3072, 2450, 130, 8, 320.0, 96),
    (2, "NVIDIA", "GeForce RTX 60", "GeForce RTX 6010 Ti", 3072, 2450, 140, 16, 320.0, 96),
    (3, "NVIDIA", "GeForce RTX 60", "GeForce RTX 6030", 4608, 2500, 180, 12, 448.0, 144),
    (4, "NVIDIA", "GeForce RTX 60", "GeForce RTX 6030 Ti", 5120, 2520, 210, 16, 504.0, 160),
    (5, "NVIDIA", "GeForce RTX 60", "GeForce RTX 6030 Ti SUPER", 5632, 2540, 225, 16, 560.0, 176),
    (6, "NVIDIA", "GeForce RTX 60", "GeForce RTX 6050", 7168, 2550, 260, 16, 672.0, 224),
    (7, "NVIDIA", "GeForce RTX 60", "GeForce RTX 6050 SUPER", 8192, 2580, 285, 24, 768.0, 256),
    (8, "NVIDIA", "GeForce RTX 60", "GeForce RTX 6070", 10240, None, 320, 24, 960.0, 320),
    (9, "NVIDIA", "GeForce RTX 60", "GeForce RTX 6090", 18432, 2700, 500, 32, 1536.0, 576),
    (10, "AMD", "Radeon RX 8000", "Radeon RX 8810", 2048, 2300, 110, 8, 256.0, 0),
    (11, "AMD", "Radeon RX 8000", "Radeon RX 8810 XT", 2304, 2400, 125, 8, 288.0, 0),
    (12, "AMD", "Radeon RX 8000", "Radeon RX 8810 XT", 2304, 2400, 135, 16, 288.0, 0),
    (13, "AMD", "Radeon RX 8000", "Radeon RX 8830", 3072, 2450, 175, 12, 384.0, 0),
    (14, "AMD", "Radeon RX 8000", "Radeon RX 8830 XT", 3584, 2500, 205, 16, 448.0, 0),
    (15, "AMD", "Radeon RX 8000", "Radeon RX 8850 GRE", 4096, 2520, 235, 12, 512.0, 0),
    (16, "AMD", "Radeon RX 8000", "Radeon RX 8850 XT", 4608, 2540, 255, 16, 576.0, 0),
    (17, "AMD", "Radeon RX 8000", "Radeon RX 8850 XTX", 5120, 2560, 290, 24, 720.0, 0),
    (18, "AMD", "Radeon RX 8000", "Radeon RX 8870 XT", 5632, 2600, 310, 20, 800.0, 0),
    (19, "AMD", "Radeon RX 8000", "Radeon RX 8870 XT", 5640, 2610, 312, 20, 810.0, 0),
    (20, "AMD", "Radeon RX 8000", "Radeon RX 8890 XTX", 6144, 2650, 355, 24, 960.0, 0),
    (21, "Intel", "Arc B", "Arc B910", 2560, 2600, 190, 12, 456.0, 160),
    (22, "Intel", "Arc B", "Arc B930", 3072, 2650, 215, 16, 512.0, 192),
    (23, "NVIDIA", "GeForce RTX 60", "RTX 6100 10GB", 2816, 2420, 150, 10, 360.0, 88),
)
BRANDS = (
    "Asus", "Gigabyte", "MSI", "Sapphire", "Power Color", "AS Rock", "XFX",
    "Acer", "Gainward", "Palit", "Zotac", "Nvidia", "Intel",
)
SUFFIXES = (
    "Windforce", "Gaming OC", "Dual", "Nitro+", "Pulse", "Ventus 3X",
    "Prime", "Eagle 12G", "Shadow 2X OC",
)
URL_BASE = "https://shop.example/p/"


def _nth(values: tuple[str, ...], i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (i + 1).cast("int"))


def chips(spark: SparkSession) -> DataFrame:
    df = literal_rows(
        spark, CHIPS,
        "chip_no int, vendor_id string, brand_series string, model_name string, cores int, "
        "boost_mhz int, tdp_w int, capacity_gb int, bandwidth double, tensor_cores int",
    )
    return df.withColumn("chip_id", F.format_string("chip_%02d", "chip_no"))


def chip_dim(spark: SparkSession) -> DataFrame:
    """The columns entity matching needs."""
    return chips(spark).select("chip_id", "vendor_id", "model_name", F.col("capacity_gb").alias("vram_gb"))


def silver_chip(spark: SparkSession) -> DataFrame:
    return chips(spark).select(
        "chip_id", "vendor_id", "brand_series", "model_name", F.col("cores").alias("compute_units_count"),
        F.col("boost_mhz").alias("boost_clock_mhz"), F.col("tdp_w").alias("tdp_watts"), "tensor_cores",
    )


def silver_memory(spark: SparkSession) -> DataFrame:
    return chips(spark).select(
        "chip_id", F.col("capacity_gb").alias("vram_gb"), F.col("bandwidth").alias("memory_bandwidth_gbs")
    )


def silver_features(spark: SparkSession) -> DataFrame:
    capability = F.when(F.col("vendor_id") == "NVIDIA", F.lit("13.0"))
    return chips(spark).select("chip_id", capability.alias("cuda_compute_capability"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("product_id")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"), "p_size")
    df = part.withColumn("chip_no", (p % 24).cast("int")).join(
        chips(spark).select("chip_no", "chip_id", "vendor_id", "model_name", "capacity_gb"), "chip_no"
    )
    df = df.withColumns({
        "brand": _nth(BRANDS, p % 13),
        "model_suffix": _nth(SUFFIXES, F.col("p_size") % 9),
        "product_url": F.concat(F.lit(URL_BASE), p.cast("string")),
    })
    head = F.concat_ws(
        " ", F.when(p % 17 != 0, F.col("brand")), F.when(p % 19 != 0, F.col("model_name")), F.col("model_suffix")
    )
    name = F.concat(
        head, F.lit(", SKU-"), p.cast("string"), F.lit(", "), F.col("capacity_gb").cast("string"),
        F.lit("GB GDDR7, "), F.when(p % 5 == 0, F.lit("2x HDMI")).otherwise(F.lit("HDMI")), F.lit(", 3x DP"),
    )
    return df.withColumns({
        "name": F.when(p % 101 == 0, F.lit("   ")).when(p % 23 == 0, F.lower(name)).otherwise(name),
        "normalized_name": F.concat(
            F.lower(F.replace("brand", F.lit(" "), F.lit(""))), F.lit("_"), F.col("chip_no").cast("string")
        ),
    })


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("product_id")
    size = F.col("p_size")

    def fault(modulus: int, bad: str | None, good: Column) -> Column:
        return F.when(p % modulus == 0, F.lit(bad)).otherwise(good.cast("string"))

    return products(spark, sf_dir).select(
        F.concat(F.lit("evidence/"), p.cast("string")).alias("path"),
        "product_id", "name",
        fault(59, "gpu_review", F.lit("gpu_variant")).alias("hypothesis_type"),
        fault(29, None, F.col("brand")).alias("aib_manufacturer"),
        F.col("model_suffix").alias("aib_model_suffix"),
        F.col("vendor_id").alias("chipset_manufacturer"),
        F.col("model_name").alias("chipset_model"),
        F.when(p % 31 == 0, F.lit(None)).when(p % 37 == 0, F.lit("sixteen"))
        .otherwise(F.col("capacity_gb").cast("string")).alias("vram_gb"),
        (size * 10 + 2400).cast("string").alias("factory_boost_mhz"),
        F.concat(F.lit("PN-"), p.cast("string")).alias("part_number"),
        fault(43, "0", size * 2 + 200).alias("length_mm"),
        fault(47, "9.5", F.lit("2.5")).alias("width_slots"),
        fault(43, "-5", size + 100).alias("height_mm"),
        F.lit(" 1x 16-pin ").alias("power_connectors"),
        fault(53, "Passive", F.lit("Air")).alias("cooling_type"),
        fault(11, "-1", F.lit("3")).alias("fan_count"),
        F.lit("3").alias("displayport_count"), F.lit("2.1").alias("displayport_version"),
        fault(13, "one", F.lit("1")).alias("hdmi_count"), F.lit("2.1b").alias("hdmi_version"),
        F.lit("3").alias("warranty_years"),
    )


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("product_id")
    own = F.concat(F.when(p % 71 == 0, F.lit("nowhere/")).otherwise(F.lit("evidence/")), p.cast("string"))
    refs = (
        F.when(p % 61 == 0, F.array().cast("array<string>"))
        .when(p % 67 == 0, F.array(own, F.concat(F.lit("other/"), p.cast("string"))))
        .otherwise(F.array(own))
    )
    digest = url_hash(F.col("product_url"))
    return products(spark, sf_dir).where(p % 41 != 0).select(
        digest.alias("url_hash"), "product_url", "normalized_name",
        F.concat(F.lit("index/"), digest, F.lit(".json")).alias("index_path"), refs.alias("hypotheses"),
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    order = c("l_orderkey")
    cents = lambda name: F.floor(c(name) * 100 + 0.5).cast("string")
    day = c("l_shipdate").cast("date").cast("string")
    flag = c("l_returnflag")
    price = c("l_extendedprice") / c("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws(
            "|", *[c(k).cast("string") for k in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
            *[cents(k) for k in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
            flag, c("l_linestatus"), day,
        ).alias("ref"),
        c("l_partkey").alias("product_id"),
        F.concat(F.lit(URL_BASE), c("l_partkey").cast("string")).alias("product_url"),
        F.concat(F.lit("shop_"), (c("l_suppkey") % 5).cast("string")).alias("retailer"),
        F.when(order % 97 == 0, F.lit(None)).when(order % 103 == 0, -price).otherwise(price).alias("price_eur"),
        F.when(order % 89 == 0, F.lit("bogus")).when(flag == "A", F.lit("in_stock"))
        .when(flag == "R", F.lit("low_stock")).alias("stock_status"),
        F.when(order % 107 != 0, c("l_shipdate")).alias("observed_at"),
        F.concat(F.lit("run_"), F.substring(day, 1, 7)).alias("run_id"),
        F.when(order % 83 != 0, F.lit("EUR")).alias("currency"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings that pass the fact rules, in silver names; the url is the variant."""
    rows = listings(spark, sf_dir).where(
        "price_eur > 0 and observed_at is not null and coalesce(stock_status, 'in_stock') <> 'bogus'"
    )
    return rows.withColumn("variant_id", F.col("product_url"))


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products(spark, sf_dir).select(
        F.col("product_url").alias("variant_id"), "chip_id", F.col("brand").alias("aib_manufacturer"), "model_suffix"
    )


# --- the frames as files ----------------------------------------------------

PAGE_RECORDS = 500
#: Bytes of the files in one archive.
ARCHIVE_BYTES = 8 << 20


def array_pages(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``path, value``: JSON arrays of at most ``PAGE_RECORDS`` rows, named so that path order is the order of ``rows``."""
    def pages(batches):
        page, records = None, []
        for batch in batches:
            done = []
            for number, record in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number != page:
                    done += [(page, records)] if records else []
                    page, records = number, []
                records.append(record)
            yield made(done)
        yield made([(page, records)] if records else [])

    def made(done):
        numbers, values = [page for page, _ in done], [f"[{','.join(records)}]" for _, records in done]
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(values, pa.string())], ["page", "value"])

    # The rows of a page follow each other in a task: nothing is exchanged.
    page = F.floor(F.monotonically_increasing_id() / PAGE_RECORDS)
    return rows.select(page.alias("page"), F.to_json(F.struct(*columns)).alias("record")).mapInArrow(pages, "page long, value string").select(
        F.concat(F.lit("page_pg="), F.lpad(F.col("page").cast("string"), 20, "0"), F.lit(".products.json")).alias("path"), "value")


def unique_files(files: DataFrame) -> DataFrame:
    """One of the rows of each path, as a folder keeps one file of a name, dealt to as many tasks as a shuffle has."""
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(parts, "path").dropDuplicates(["path"])


def write_files(spark: SparkSession, files: DataFrame, base: str, packed: bool = False) -> None:
    """Each ``path, value`` as a file below ``base``, a folder that all executors share, or ``packed`` into archives in the files' folders. The store compresses ``.gz`` files."""
    call = uuid.uuid4().hex[:8]

    def put(batches):
        store, folder = fs.FileSystem.from_uri(base)
        made, folders, archives = 0, set(), 0
        held, size, at = [], 0, None

        def save(path: str, data: bytes) -> None:
            below = f"{folder}/{path}".rsplit("/", 1)[0]
            if below not in folders:
                store.create_dir(below, recursive=True)
                folders.add(below)
            with store.open_output_stream(f"{folder}/{path}") as out:
                out.write(data)

        def save_archive() -> None:
            archive = io.BytesIO()
            with zipfile.ZipFile(archive, "w") as members:
                for name, data in held:
                    members.writestr(zipfile.ZipInfo(name), data, zipfile.ZIP_DEFLATED)
            # A repeated task replaces what its first attempt wrote.
            save(f"{at}/{call}-{TaskContext.get().partitionId():06d}-{archives:06d}.zip", archive.getvalue())

        for batch in batches:
            for path, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                made += 1
                if not packed:
                    save(path, value.encode())
                    continue
                below, name = path.rsplit("/", 1)
                if held and (below != at or size >= ARCHIVE_BYTES):
                    save_archive()
                    held, size, archives = [], 0, archives + 1
                at = below
                held.append((name, value.encode()))
                size += len(held[-1][1])
        if held:
            save_archive()
        yield pa.RecordBatch.from_arrays([pa.array([made])], ["n"])

    with shuffles_freed(spark):
        files.select("path", "value").mapInArrow(put, "n long").agg(F.sum("n")).collect()


def listing_pages(rows: DataFrame, folder: str) -> DataFrame:
    """``path, value`` of listings as array pages below ``listings/<folder>``, in the order of ``ref``."""
    c = F.col
    ordered = rows.repartitionByRange("ref").sortWithinPartitions("ref")
    named = ordered.withColumnsRenamed({"run_id": "scrape_run_id"}).withColumn("observed_at_utc", iso_text(c("observed_at")))
    pages = array_pages(named, ["retailer", "product_url", "price_eur", "currency", "observed_at_utc", "scrape_run_id", "stock_status"])
    return pages.withColumn("path", F.concat(F.lit(f"listings/{folder}/"), "path"))


def bronze_files(spark: SparkSession, sf_dir: str, pages: bool = True) -> str:
    """Folder with ``listings`` (array pages of runs), ``index`` and ``evidence`` (a document per file), packed: a loose document takes a block each."""
    base, c = workspace(spark, "bronze files"), F.col
    if pages:
        write_files(spark, listing_pages(listings(spark, sf_dir), "runs/r1"), base, packed=True)
    entry = F.to_json(F.struct("product_url", "normalized_name", F.concat("hypotheses", F.array(F.lit("\t"))).alias("hypotheses")))
    # A row is a file, and a small table has few partitions: the files are dealt to many tasks.
    write_files(spark, unique_files(index(spark, sf_dir).select(c("index_path").alias("path"), entry.alias("value"))), base, packed=True)
    inner = [n for n in evidence(spark, sf_dir).columns if n not in ("path", "product_id", "name", "hypothesis_type")]
    document = F.to_json(F.struct("hypothesis_type", F.struct(c("name").alias("model_name")).alias("input"), F.struct(*inner).alias("extraction")))
    write_files(spark, unique_files(evidence(spark, sf_dir).select(F.concat("path", F.lit(".json")).alias("path"), document.alias("value"))), base, packed=True)
    return base


# --- the same rules as SQL -------------------------------------------------

CLEAN = "trim(regexp_replace(upper({0}), '[^A-Z0-9+-]+', ' ', 'g'))"


def clean_sql(x: str) -> str:
    return CLEAN.format(x)


def key_sql(x: str) -> str:
    noise = rf"regexp_replace(lower({x}), '\b(nvidia|amd|geforce|radeon|rtx|rx)\b', ' ', 'g')"
    split = rf"regexp_replace(regexp_replace({noise}, '([0-9])([a-z])', '\1 \2', 'g'), '([a-z])([0-9])', '\1 \2', 'g')"
    return rf"trim(regexp_replace({split}, '\s+', ' ', 'g'))"


def sized_key_sql(key: str, gb: str) -> str:
    return f"CASE WHEN {gb} IS NOT NULL AND NOT contains({key}, 'gb') THEN {key} || ' ' || {gb} || ' gb' ELSE {key} END"


def _literal(v: object) -> str:
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_VALUES = ",\n".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in CHIPS)
_NAME = """concat_ws(' ', CASE WHEN product_id % 17 <> 0 THEN brand END,
      CASE WHEN product_id % 19 <> 0 THEN model_name END, model_suffix)
      || ', SKU-' || product_id || ', ' || capacity_gb || 'GB GDDR7, '
      || CASE WHEN product_id % 5 = 0 THEN '2x HDMI' ELSE 'HDMI' END || ', 3x DP'"""
_ALIAS = "ASUS|GIGABYTE|MSI|SAPPHIRE|POWERCOLOR|POWER COLOR|ASROCK|AS ROCK|XFX|ACER|GAINWARD|PALIT|ZOTAC|NVIDIA|INTEL"
_STOP = _list(("NVIDIA", "GEFORCE", "AMD", "RADEON", "INTEL", "ARC", "GDDR6", "GDDR6X", "GDDR7",
               "HDMI", "DP", "DISPLAYPORT", "DISPLAY", "PORT"))

_NORM = rf"""SELECT *,
    CASE WHEN model_vendor IS NOT NULL THEN model_vendor
         WHEN vword IN ('NVIDIA','GEFORCE','RTX') THEN 'NVIDIA' WHEN vword IN ('AMD','RADEON','RX') THEN 'AMD'
         WHEN vword IN ('INTEL','ARC') THEN 'INTEL' END AS vendor_hint,
    CASE WHEN length(number) >= 4 AND model_vendor = 'NVIDIA' THEN 'GeForce RTX ' || number[1:2]
         WHEN length(number) >= 4 AND model_vendor = 'AMD' THEN 'Radeon RX ' || number[1:1] || '000' END AS series_hint,
    CASE model_vendor
      WHEN 'NVIDIA' THEN 'RTX ' || number || CASE WHEN tail1 <> '' THEN ' Ti' ELSE '' END || CASE WHEN tail2 <> '' THEN ' SUPER' ELSE '' END
      WHEN 'AMD' THEN 'RX ' || number || CASE WHEN tail1 <> '' THEN ' ' || tail1 ELSE '' END
      WHEN 'INTEL' THEN 'ARC ' || tail1 || number END AS model_name_hint,
    CASE alias WHEN '' THEN NULL WHEN 'POWER COLOR' THEN 'POWERCOLOR' WHEN 'AS ROCK' THEN 'ASROCK' ELSE alias END AS brand_hint,
    CASE WHEN model_vendor IS NOT NULL THEN nullif(array_to_string(list_filter(string_split(hd, ' '), lambda t:
        NOT list_contains({_STOP}, t)
        AND NOT list_contains([CASE model_vendor WHEN 'NVIDIA' THEN 'RTX' WHEN 'AMD' THEN 'RX' ELSE 'ARC' END, number, tail1, tail2], t)
        AND NOT list_contains(string_split(alias, ' '), t)
        AND NOT regexp_matches(t, '^([0-9]+$|[0-9]{{1,3}}GB?$|[0-9]{{1,3}}G\b)')
        AND NOT contains(t, number)), ' '), '') END AS suffix_hint,
    TRY_CAST(nullif(regexp_extract(nm, '\b([0-9]{{1,3}})\s*GB\b', 1), '') AS INTEGER) AS vram_gb_hint,
    nullif(regexp_extract(nm, '\b(GDDR6X|GDDR7|GDDR6)\b', 1), '') AS memory_type_hint,
    nullif(CAST(coalesce(list_sum(list_transform(regexp_extract_all(nm, '\b([0-9]+)\s*X\s*HDMI\b', 1), lambda x: CAST(x AS BIGINT))), 0) AS BIGINT), 0) AS hdmi_count_hint,
    nullif(CAST(coalesce(list_sum(list_transform(regexp_extract_all(nm, '\b([0-9]+)\s*X\s*(DP|DISPLAYPORT|DISPLAY\s*PORT)\b', 1), lambda x: CAST(x AS BIGINT))), 0) AS BIGINT), 0) AS displayport_count_hint
  FROM (SELECT *,
      CASE WHEN rtx <> '' THEN 'NVIDIA' WHEN rx <> '' THEN 'AMD' WHEN arc <> '' THEN 'INTEL' END AS model_vendor,
      CASE WHEN rtx <> '' THEN rtx WHEN rx <> '' THEN rx WHEN arc <> '' THEN arc END AS number,
      CASE WHEN rtx <> '' THEN regexp_extract(nm, '{{RTX}}', 2) WHEN rx <> '' THEN regexp_extract(nm, '{{RX}}', 2)
           WHEN arc <> '' THEN regexp_extract(nm, '{{ARC}}', 1) END AS tail1,
      CASE WHEN rtx <> '' THEN regexp_extract(nm, '{{RTX}}', 3) ELSE '' END AS tail2
    FROM (SELECT *, regexp_extract(nm, '{{RTX}}', 1) AS rtx, regexp_extract(nm, '{{RX}}', 1) AS rx,
        regexp_extract(nm, '{{ARC}}', 2) AS arc,
        regexp_extract(nm, '^.*?\b(NVIDIA|GEFORCE|RTX|AMD|RADEON|RX|INTEL|ARC)\b', 1) AS vword,
        regexp_extract(hd, '^.*?\b({_ALIAS})\b', 1) AS alias
      FROM (SELECT *, {clean_sql('name')} AS nm, {clean_sql("split_part(name, ',', 1)")} AS hd FROM {{SOURCE}})))"""


def normalize_sql(source: str) -> str:
    """All hints of ``source.name``."""
    return (
        _NORM.replace("{SOURCE}", source)
        .replace("{RTX}", r"\bRTX[\s-]*([0-9]{3,4})(?:[\s-]*(TI))?(?:[\s-]*(SUPER))?\b")
        .replace("{RX}", r"\bRX[\s-]*([0-9]{3,4})(?:[\s-]*(XTX|XT|GRE))?\b")
        .replace("{ARC}", r"\bARC[\s-]*([A-Z])[\s-]*([0-9]{3,4})\b")
    )


def attempt_sql(source: str, vendor: str, model: str, gb: str, brand: str, p: str) -> str:
    """One match attempt with prefix ``p`` added to all rows of ``source``."""
    pick = f"d.vendor_id = {p}v AND d.model_key = {p}k AND ({p}gb IS NULL OR d.vram_gb = {p}gb)"
    return f"""SELECT *, CASE WHEN {p}n = 1 THEN {p}lone END AS {p}chip,
    CASE WHEN NOT {p}ok THEN 'missing' WHEN {p}n = 0 THEN 'no_match' WHEN {p}n > 1 THEN 'ambiguous' END AS {p}state
  FROM (SELECT *,
      CASE WHEN {p}ok THEN (SELECT count(*) FROM dim d WHERE {pick}) ELSE 0 END AS {p}n,
      (SELECT min(chip_id) FROM dim d WHERE {pick}) AS {p}lone,
      CASE WHEN {p}ok THEN {p}brand0 END AS {p}brand
    FROM (SELECT *, coalesce({p}k <> '', false) AS {p}ok
      FROM (SELECT *, CASE WHEN {p}v IS NOT NULL AND {p}m <> '' THEN {sized_key_sql(key_sql(p + 'm'), p + 'gb')} END AS {p}k
        FROM (SELECT *, CASE WHEN upper(trim({vendor})) IN ('NVIDIA', 'AMD') THEN upper(trim({vendor})) END AS {p}v,
            {model} AS {p}m, {gb} AS {p}gb, {brand} AS {p}brand0 FROM {source}))))"""


def id_sql(prefix: str, *parts: str) -> str:
    joined = " || '|' || ".join(f"coalesce(lower(trim(CAST({p} AS VARCHAR))), '')" for p in parts)
    return f"'{prefix}_' || sha256({joined})"


CTES: dict[str, str] = {
    "chips": f"""SELECT *, 'chip_' || lpad(CAST(chip_no AS VARCHAR), 2, '0') AS chip_id
  FROM (VALUES {_VALUES}) AS t(chip_no, vendor_id, brand_series, model_name, cores, boost_mhz, tdp_w, capacity_gb, bandwidth0, tensor_cores)""",
    "chip": """SELECT chip_id, vendor_id, brand_series, model_name, cores, boost_mhz, tdp_w, capacity_gb,
    CAST(bandwidth0 AS DOUBLE) AS bandwidth, tensor_cores, chip_no FROM chips""",
    "dim": f"""SELECT chip_id, vendor_id, vram_gb, {sized_key_sql('key0', 'vram_gb')} AS model_key FROM (
    SELECT chip_id, vendor_id, capacity_gb AS vram_gb, {key_sql('model_name')} AS key0 FROM chip) WHERE key0 <> ''""",
    "products": f"""SELECT *, CASE WHEN product_id % 101 = 0 THEN '   ' WHEN product_id % 23 = 0 THEN lower({_NAME}) ELSE {_NAME} END AS name,
    lower(replace(brand, ' ', '')) || '_' || chip_no AS normalized_name
  FROM (SELECT p_partkey AS product_id, p_size, c.chip_no, c.chip_id, c.vendor_id, c.model_name, c.capacity_gb,
      {_list(BRANDS)}[p_partkey % 13 + 1] AS brand, {_list(SUFFIXES)}[p_size % 9 + 1] AS model_suffix,
      '{URL_BASE}' || p_partkey AS product_url
    FROM part JOIN chip c ON p_partkey % 24 = c.chip_no)""",
    "evidence": """SELECT 'evidence/' || product_id AS path, product_id, name,
    CASE WHEN product_id % 59 = 0 THEN 'gpu_review' ELSE 'gpu_variant' END AS hypothesis_type,
    CASE WHEN product_id % 29 <> 0 THEN brand END AS aib_manufacturer,
    model_suffix AS aib_model_suffix, vendor_id AS chipset_manufacturer, model_name AS chipset_model,
    CASE WHEN product_id % 31 <> 0 AND product_id % 37 <> 0 THEN capacity_gb END AS extracted_gb,
    p_size * 10 + 2400 AS factory_boost_mhz, 'PN-' || product_id AS part_number,
    CASE WHEN product_id % 43 <> 0 THEN p_size * 2 + 200 END AS length_mm,
    CASE WHEN product_id % 47 <> 0 THEN CAST(2.5 AS DOUBLE) END AS width_slots,
    CASE WHEN product_id % 43 <> 0 THEN p_size + 100 END AS height_mm, '1x 16-pin' AS power_connectors,
    CASE WHEN product_id % 53 <> 0 THEN 'Air' END AS cooling_type,
    CASE WHEN product_id % 11 <> 0 THEN 3 END AS fan_count, 3 AS displayport_count, '2.1' AS displayport_version,
    CASE WHEN product_id % 13 <> 0 THEN 1 END AS hdmi_count, '2.1b' AS hdmi_version, 3 AS warranty_years
  FROM products""",
    "idx": """SELECT sha256(product_url) AS url_hash, product_url, normalized_name,
    'index/' || sha256(product_url) || '.json' AS index_path,
    CASE WHEN product_id % 61 = 0 THEN CAST([] AS VARCHAR[]) WHEN product_id % 67 = 0 THEN [own, 'other/' || product_id] ELSE [own] END AS hypotheses
  FROM (SELECT *, CASE WHEN product_id % 71 = 0 THEN 'nowhere/' ELSE 'evidence/' END || product_id AS own FROM products)
  WHERE product_id % 41 <> 0""",
    "listings": f"""SELECT concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CAST(floor(l_quantity * 100 + 0.5) AS BIGINT), CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT),
      CAST(floor(l_discount * 100 + 0.5) AS BIGINT), CAST(floor(l_tax * 100 + 0.5) AS BIGINT),
      l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d')) AS ref,
    l_partkey AS product_id, '{URL_BASE}' || l_partkey AS product_url, 'shop_' || (l_suppkey % 5) AS retailer,
    CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 103 = 0 THEN -(l_extendedprice / l_quantity) ELSE l_extendedprice / l_quantity END AS price_eur,
    CASE WHEN l_orderkey % 89 = 0 THEN 'bogus' WHEN l_returnflag = 'A' THEN 'in_stock' WHEN l_returnflag = 'R' THEN 'low_stock' END AS stock_status,
    CASE WHEN l_orderkey % 107 <> 0 THEN l_shipdate END AS observed_at, 'run_' || strftime(l_shipdate, '%Y-%m') AS run_id,
    CASE WHEN l_orderkey % 83 <> 0 THEN 'EUR' END AS currency
  FROM lineitem""",
    "observations": """SELECT *, product_url AS variant_id FROM listings
  WHERE price_eur > 0 AND observed_at IS NOT NULL AND coalesce(stock_status, 'in_stock') <> 'bogus'""",
    "prices": """SELECT o.variant_id, p.chip_id, o.retailer, o.price_eur, o.stock_status, o.product_url,
    o.observed_at AS last_seen_at, p.brand AS aib_manufacturer, p.model_suffix
  FROM (SELECT *, row_number() OVER (PARTITION BY variant_id, retailer ORDER BY observed_at DESC NULLS LAST, ref) AS rn FROM observations) o
  JOIN products p ON o.variant_id = p.product_url WHERE o.rn = 1""",
    "normed": normalize_sql("evidence"),
    "att1": attempt_sql("normed", "vendor_hint", "model_name_hint", "vram_gb_hint", "brand_hint", "a_"),
    "att2": attempt_sql("att1", "chipset_manufacturer", "chipset_model", "extracted_gb", "aib_manufacturer", "b_"),
    "matched": f"""SELECT *, {id_sql('var', 'vendor_id', 'model_key', 'vram_gb', 'brand', 'aib_model_suffix', 'part_number')} AS variant_id
  FROM (SELECT *, CASE WHEN won THEN a_chip ELSE b_chip END AS chip_id, CASE WHEN won THEN a_state ELSE b_state END AS state,
    CASE WHEN won THEN a_v ELSE b_v END AS vendor_id, CASE WHEN won THEN a_k ELSE b_k END AS model_key,
    CASE WHEN won THEN a_gb ELSE b_gb END AS vram_gb, CASE WHEN won THEN a_n ELSE b_n END AS n_candidates,
    coalesce(nullif(a_brand, ''), nullif(b_brand, '')) AS brand, CASE WHEN won THEN 'normalize' ELSE 'extraction' END AS match_source
  FROM (SELECT *, a_chip IS NOT NULL AS won FROM att2))""",
    "classified_evidence": """SELECT *, CASE WHEN hypothesis_type <> 'gpu_variant' THEN 'wrong_type' WHEN brand IS NULL THEN 'missing_brand'
    WHEN chip_id IS NULL AND state = 'missing' THEN 'missing_match_fields' WHEN chip_id IS NULL AND state = 'ambiguous' THEN 'ambiguous_chip_match'
    WHEN chip_id IS NULL THEN 'no_chip_match' END AS outcome FROM matched""",
    "known": "SELECT DISTINCT variant_id FROM classified_evidence WHERE outcome IS NULL",
    "lookedup": """SELECT l.*, i.url_hash AS found_hash, i.hypotheses, CASE WHEN len(i.hypotheses) = 1 THEN i.hypotheses[1] END AS path, m.path AS document, m.chip_id, m.state, m.brand, m.variant_id,
    m.vendor_id, m.model_key, m.vram_gb, m.aib_model_suffix, m.part_number, m.a_state, m.b_state, k.variant_id IS NOT NULL AS variant_known
  FROM listings l LEFT JOIN idx i ON sha256(l.product_url) = i.url_hash
  LEFT JOIN matched m ON len(i.hypotheses) = 1 AND m.path = i.hypotheses[1] LEFT JOIN known k ON m.variant_id = k.variant_id""",
    "classified": f"""SELECT *, CASE WHEN outcome IS NULL THEN {id_sql('obs', 'variant_id', 'retailer', 'product_url', "strftime(observed_at, '%Y-%m-%dT%H:%M:%SZ')")} END AS observation_id
  FROM (SELECT *, CASE WHEN found_hash IS NULL THEN 'no_index_entry' WHEN len(hypotheses) = 0 THEN 'no_hypothesis'
    WHEN len(hypotheses) > 1 THEN 'ambiguous_hypothesis' WHEN document IS NULL THEN 'missing_hypothesis_file'
    WHEN brand IS NULL THEN 'missing_brand' WHEN chip_id IS NULL AND state = 'missing' THEN 'missing_match_fields'
    WHEN chip_id IS NULL AND state = 'ambiguous' THEN 'ambiguous_chip_match' WHEN chip_id IS NULL THEN 'no_chip_match'
    WHEN retailer IS NULL OR observed_at IS NULL OR run_id IS NULL THEN 'missing_identifiers'
    WHEN price_eur IS NULL OR price_eur <= 0 THEN 'invalid_price' WHEN stock_status = 'bogus' THEN 'invalid_stock_status'
    WHEN NOT variant_known THEN 'unknown_variant' END AS outcome FROM lookedup)""",
}

_NEEDS = {
    "chip": ["chips"], "dim": ["chip"], "products": ["chip"], "evidence": ["products"], "idx": ["products"],
    "observations": ["listings"], "prices": ["observations", "products"], "normed": ["evidence"],
    "att1": ["normed", "dim"], "att2": ["att1"], "matched": ["att2"], "classified_evidence": ["matched"],
    "known": ["classified_evidence"], "lookedup": ["listings", "idx", "known"], "classified": ["lookedup"],
}


def frames_sql(names: list[str], body: str) -> str:
    """``body`` after a WITH clause that defines the frames it uses."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in _NEEDS.get(name, []):
            visit(need)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in order) + "\n" + body
