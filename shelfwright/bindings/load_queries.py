"""Loads with rules, defaults and counters, upserts, cascades, and the load as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwright.bindings import core_queries as Q
from shelfwright.bindings import fixtures as L
from shelfwright.bindings.registry import query, table
from shelfwright.operators import contracts, counters, merge
from shelfwright.operators.references import Graph, Reference
from shelfwright.plans import enrichment, gold, silver
from shelfwright.schemas import SEED_FIELDS, architectures, memory_types, struct, vendors
from shelfwright.session import workspace, written
from shelfwright.sources import scan
from shelfwright.streaming import silver as stream_silver
from shelfwright.streaming import state

c = F.col

# --- the load as a stream, and what it could not read --------------------------


def _evidence(spark: SparkSession, root: str) -> DataFrame:
    rows = silver.coerce_evidence(scan.read_documents(spark, f"{root}/evidence", root=root))
    return rows.withColumn("path", F.regexp_replace("path", r"\.json$", ""))  # the invented evidence paths have no file ending


@query("stream_silver_load", Q._FACT_SQL)
def stream_silver_load(spark: SparkSession, sf: str) -> DataFrame:
    """The load over pages that arrive in two runs, each met by a start of its own with the same checkpoint."""
    root, base = L.bronze_files(spark, sf, pages=False), workspace(spark, "stream-silver")
    rows, early = L.listings(spark, sf), c("ref") < "5"
    for run, part in (("r1", rows.where(early)), ("r2", rows.where(~early))):
        L.write_files(spark, L.listing_pages(part, f"runs/{run}").withColumn("path", F.concat("path", F.lit(".gz"))), root)
        arrived = scan.stream_listings(spark, f"{root}/listings", root, glob="*.json")
        stream_silver.load(
            arrived, base, f"{base}/checkpoint", lambda: scan.read_index(spark, f"{root}/index", root, keep_unreadable=True), lambda: _evidence(spark, root),
            L.chip_dim(spark)).awaitTermination()
    return stream_silver.facts(spark, base, Q._FACT)


@query("load_errors", L.frames_sql(["classified"], """SELECT 'listings' AS kind, count(*) AS n_rows FROM nation UNION ALL SELECT 'index', count(*) FROM nation
UNION ALL SELECT 'evidence', count(*) FROM nation WHERE n_nationkey % 5 = 0 UNION ALL SELECT 'outcome unreadable', count(*) FROM nation
UNION ALL SELECT 'scanned', (SELECT count(*) FROM nation) + (SELECT count(*) FROM listings)
UNION ALL SELECT 'errors', (SELECT count(*) FROM nation) + count_if(outcome = 'unknown_variant') FROM classified"""))
def load_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Pages, index files and evidence that do not parse: each is an outcome or a row of ``unreadable``, none is lost."""
    root = L.bronze_files(spark, sf)
    n = c("n_nationkey").cast("string")
    nations = table(spark, sf, "nation")
    for path, value, rows in (
        (F.concat(F.lit("listings/runs/r1/page_pg=~"), n, F.lit(".products.json")), '[{"cut', nations),
        (F.concat(F.lit("index/bad"), n, F.lit(".json")), "no object", nations),
        (F.concat(F.lit("evidence/bad"), n, F.lit(".json")), "{", nations.where("n_nationkey % 5 = 0")),
    ):
        L.write_files(spark, rows.select(path.alias("path"), F.lit(value).alias("value")), root)
    listings = scan.read_listings(spark, f"{root}/listings", root, glob="*.json")
    load = silver.silver_pipeline(spark, listings, scan.read_index(spark, f"{root}/index", root, keep_unreadable=True), _evidence(spark, root), L.chip_dim(spark), schema=Q._FACT)
    found = load.counters
    sums = {"outcome unreadable": found["unreadable"], "scanned": sum(found.values()), "errors": sum(found[e] for e in silver.ERRORS)}
    return load.unreadable.groupBy("kind").agg(F.count("*").alias("n_rows")).union(
        spark.createDataFrame(list(sums.items()), "kind string, n_rows bigint"))


@query("run_counters", L.frames_sql(["classified"], f"""SELECT outcome, count(*) AS n_rows FROM (SELECT {Q._OUTCOME.format('observation_id', 'ref')} AS outcome FROM classified) GROUP BY 1"""))
def run_counters(spark: SparkSession, sf: str) -> DataFrame:
    """The funnel from the two writes of the load: the listings are read once."""
    _, products = silver.load_products(spark, silver.coerce_evidence_text(L.evidence(spark, sf)), L.chip_dim(spark))
    judged, seen = counters.counted(silver.classify_observations(L.listings(spark, sf), L.index(spark, sf), products), silver.OUTCOMES)
    classified = written(spark, judged.select("ref", "outcome", *[n for n in silver.FACT_INPUTS if n in judged.columns]), "classified", silver.CODEC)
    facts, inserted = counters.tally(silver.load_observations(classified, schema=Q._FACT, stored=True))
    written(spark, facts, "facts", silver.CODEC)
    return counters.rows(spark, silver.run_counters(seen.get, inserted.get))


_STREAM_LATEST = """SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (
    PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id) AS rn FROM events) WHERE rn = 1"""


@query("stream_state_latest", _STREAM_LATEST)
def stream_state_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Newest row per key in a state store: three files and a start for the newer half, then for the older half, whose rows are late."""
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value", "ts")
    base, newer = workspace(spark, "stream-state"), F.day("ts") > 12
    for rows in (events.where(newer), events.where(~newer)):
        rows.repartition(3).write.mode("append").parquet(f"{base}/in")
        arrived = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/in")
        state.latest(arrived, f"{base}/checkpoint", ["user_id", "event_type"], "ts", "event_id").awaitTermination()
    return state.current(spark, f"{base}/checkpoint", events.schema).select("user_id", "event_type", "event_id", "value")


@query("stream_state_new_products", """SELECT sha256(url) AS url_hash, url, page_id FROM (
    SELECT url, page_id, row_number() OVER (PARTITION BY url ORDER BY page_id % 2, page_id) AS rn FROM pages
    WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0 AND url IS NOT NULL)) WHERE rn = 1""")
def stream_state_new_products(spark: SparkSession, sf: str) -> DataFrame:
    """Pages whose url neither the index nor an earlier arrival has, kept apart by keyed state: even pages arrive first, odd ones after a new start."""
    pages = table(spark, sf, "pages").where("url is not null and page_id is not null").select(F.sha2("url", 256).alias("url_hash"), "url", "page_id")
    base, index = workspace(spark, "stream-state-new"), pages.where("page_id % 3 = 0")
    for rows in (pages.where("page_id % 2 = 0"), pages.where("page_id % 2 = 1")):
        rows.write.mode("append").parquet(f"{base}/in")
        arrived = spark.readStream.schema(pages.schema).parquet(f"{base}/in")
        state.first(arrived, f"{base}/rows", f"{base}/checkpoint", ["url_hash"], "page_id", index).awaitTermination()
    return spark.read.schema(pages.schema).parquet(f"{base}/rows")


@query("stream_dedup_within", """WITH m AS (SELECT max(ts) AS top FROM events),
again AS (SELECT event_id, ts FROM events, m WHERE event_id % 3 = 0 AND ts > top - INTERVAL 4 DAY),
late AS (SELECT event_id, ts FROM events, m WHERE event_id % 3 = 1 AND ts < top - INTERVAL 6 DAY),
old AS (SELECT event_id, top FROM events, m WHERE event_id % 3 = 2 AND ts < top - INTERVAL 11 DAY)
SELECT event_id, ts, (SELECT count(*) FROM late) AS late_rows, (SELECT count(*) FROM again) + (SELECT count(*) FROM old) AS repeated_rows
FROM (SELECT event_id, ts FROM events UNION ALL SELECT event_id, top FROM old)""")
def stream_dedup_within(spark: SparkSession, sf: str) -> DataFrame:
    """Event-time dedup over five days in two starts. The second brings repeats, late rows, and ids beyond the five days, twice each."""
    events = table(spark, sf, "events").select("event_id", "ts")
    base, top = workspace(spark, "stream-within"), events.agg(F.max("ts").alias("top"))
    third, ago = c("event_id") % 3, lambda days: c("top") - F.make_dt_interval(F.lit(days))
    joined = events.join(top, F.lit(True))  # one row
    old = joined.where((third == 2) & (c("ts") < ago(11))).select("event_id", c("top").alias("ts"))
    more = joined.where(((third == 0) & (c("ts") > ago(4))) | ((third == 1) & (c("ts") < ago(6)))).select("event_id", "ts").union(old).union(old)
    drops = {"late": 0, "repeated": 0}
    for rows in (events, more):
        rows.repartition(2).write.mode("append").parquet(f"{base}/in")
        arrived = spark.readStream.schema(events.schema).parquet(f"{base}/in")
        run = state.dedup_counted(arrived, f"{base}/rows", f"{base}/checkpoint", "event_id", "ts", "5 days")
        run.awaitTermination()
        drops = {k: n + state.dropped(run)[k] for k, n in drops.items()}
    kept = spark.read.schema("event_id bigint, ts timestamp").parquet(f"{base}/rows")
    return kept.select("event_id", c("ts").cast("timestamp_ntz").alias("ts"), F.lit(drops["late"]).cast("bigint").alias("late_rows"),
                       F.lit(drops["repeated"]).cast("bigint").alias("repeated_rows"))


# --- rules, defaults and upserts ---------------------------------------------------

def _seed_entries(spark: SparkSession, sf: str, **changes: Column) -> DataFrame:
    """Parts as seed entries ``file, pos, entry`` whose fields all fit, but for ``changes`` (``section__field``)."""
    own = {
        "chip__vendor": F.lit("NVIDIA"), "chip__architecture": F.lit("Blackwell"), "chip__brand_series": F.lit("Series"),
        "chip__model_name": F.concat_ws(" ", "p_name", c("p_partkey").cast("string")), "chip__compute_units_type": F.lit("CUDA_CORES"),
        "chip__compute_units_count": F.lit(100), "chip__tdp_watts": c("p_size") * 10, "chip__pcie_generation": F.lit("5.0"), "chip__pcie_lanes": F.lit(16),
        "memory__vram_gb": 8 + c("p_partkey") % 4, "memory__memory_type": F.lit("GDDR7"), "memory__memory_bus_bits": F.lit(128),
        "features__raytracing_hardware": F.lit(True), **changes,
    }
    sections = [
        F.struct(*[own.get(f"{s}__{n}", F.lit(None).cast("string")).alias(n) for n in names]).alias(s) for s, names in SEED_FIELDS.items()]
    entry = F.to_json(F.struct(*sections), {"ignoreNullFields": "false"})
    return table(spark, sf, "part").select(F.lit("parts").alias("file"), c("p_partkey").alias("pos"), entry.alias("entry"))


def _seed_parts(spark: SparkSession, entries: DataFrame) -> dict[str, DataFrame]:
    return scan.seed_relations(entries, vendors(spark), architectures(spark), memory_types(spark))


_MODEL = "p_name || ' ' || p_partkey"


@query("seed_refused", f"""SELECT relation, model_name, broken FROM (
    SELECT 'chip' AS relation, {_MODEL} AS model_name, concat_ws('; ', CASE WHEN p_partkey % 13 = 0 THEN 'compute_units_type known' END,
        CASE WHEN p_partkey % 7 = 0 THEN 'tdp_watts > 0' END) AS broken FROM part
    UNION ALL SELECT 'memory', {_MODEL}, concat_ws('; ', CASE WHEN p_partkey % 17 = 0 THEN 'vram_gb not null' END, CASE WHEN p_partkey % 11 = 0 THEN 'memory_bus_bits known' END) FROM part
    UNION ALL SELECT 'seed', {_MODEL}, CASE WHEN p_partkey % 19 = 0 THEN 'wrong type: chip.process_node_nm' ELSE '' END FROM part) WHERE broken <> ''""")
def seed_refused(spark: SparkSession, sf: str) -> DataFrame:
    """Seed entries that break the rules of their tables, with all rules that they break; nothing becomes visible."""
    key = c("p_partkey")
    entries = _seed_entries(
        spark, sf, chip__tdp_watts=F.when(key % 7 == 0, -5).otherwise(c("p_size") * 10),
        chip__compute_units_type=F.when(key % 13 == 0, F.lit("OTHER")).otherwise(F.lit("CUDA_CORES")),
        chip__process_node_nm=F.when(key % 19 == 0, F.lit("five")), memory__vram_gb=F.when(key % 17 != 0, 8 + key % 4),
        memory__memory_bus_bits=F.when(key % 11 == 0, 100).otherwise(128))
    parts = _seed_parts(spark, entries)
    refused = contracts.problems({"chip": (parts["chip"], contracts.CHIP), "memory": (parts["memory"], contracts.MEMORY)})
    base = workspace(spark, "refused-seed")
    try:
        merge.load_all(spark, base, {n: parts[n] for n in ("chip", "memory", "features")}, {"seed": parts["problems"], **refused})
        raise AssertionError("a seed with broken rules was loaded")
    except merge.RejectedLoad:
        pass
    names = parts["chip"].select("chip_id", "model_name")
    listed = F.array_join("broken_rules", "; ").alias("broken")
    chip = refused["rules of chip"].select(F.lit("chip").alias("relation"), "model_name", listed)
    memory = refused["rules of memory"].join(names, "chip_id").select(F.lit("memory"), "model_name", listed)
    model = entries.select("file", "pos", F.get_json_object("entry", "$.chip.model_name").alias("model_name"))
    seed = parts["problems"].join(model, ["file", "pos"]).select(F.lit("seed"), "model_name", "problem")
    return chip.union(memory).union(seed)


@query("default_columns", """SELECT CAST(p_partkey AS VARCHAR) AS chip_id, p_size * 10 AS tdp_watts, CASE WHEN p_partkey % 2 = 0 THEN 0 END AS rt_cores,
    CASE WHEN p_partkey % 2 = 0 THEN 16 WHEN p_partkey % 3 = 0 THEN 8 END AS pcie_lanes, CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE p_size END AS tensor_cores FROM part""")
def default_columns(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog table whose columns have defaults: omitted columns take them, given NULLs stay."""
    part = table(spark, sf, "part").select(c("p_partkey").cast("string").alias("chip_id"), (c("p_size") * 10).cast("int").alias("tdp_watts"), "p_partkey", "p_size")
    path = workspace(spark, "defaults")
    name = f"chips_{path[-32:]}"
    contracts.create_table(spark, name, contracts.CHIP, path)
    contracts.insert(spark, name, part.where("p_partkey % 2 = 0").select("chip_id", "tdp_watts"))
    contracts.insert(spark, name, part.where("p_partkey % 2 <> 0").select(
        "chip_id", "tdp_watts", F.lit(None).cast("int").alias("rt_cores"), F.when(c("p_partkey") % 3 == 0, 8).alias("pcie_lanes"),
        c("p_size").cast("int").alias("tensor_cores")))
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return spark.read.schema(contracts.CHIP).parquet(path).select("chip_id", "tdp_watts", "rt_cores", "pcie_lanes", "tensor_cores")


@query("upsert_seed", f"""SELECT {_MODEL} AS model_name, CAST(8 + p_partkey % 4 AS INTEGER) AS vram_gb, CASE WHEN p_partkey * 4 > m THEN '4.5' ELSE '4.0' END AS dlss_version,
    CASE WHEN p_partkey * 2 < m THEN 'old' ELSE 'new' END AS created_at, CASE WHEN p_partkey * 4 > m THEN 'new' ELSE 'old' END AS updated_at
FROM part, (SELECT max(p_partkey) AS m FROM part) WHERE p_partkey * 2 < m OR p_partkey * 4 > m""")
def upsert_seed(spark: SparkSession, sf: str) -> DataFrame:
    """Chips, memory and features change together: half of them exist, the upper three quarters arrive with another feature."""
    top, path = table(spark, sf, "part").agg(F.max("p_partkey")).scalar(), workspace(spark, "seed-units")
    for now, version, wanted in (("old", "4.0", c("pos") * 2 < c("top")), ("new", "4.5", c("pos") * 4 > c("top"))):
        entries = _seed_entries(spark, sf, features__dlss_version=F.lit(version)).withColumn("top", top).where(wanted).drop("top")
        merge.upsert_parts(spark, path, scan.seed_units(_seed_parts(spark, entries)), "chip_id", F.lit(now), ["chip_id"], digits=1)
    return spark.read.parquet(path).select("chip.model_name", "memory.vram_gb", "features.dlss_version", "created_at", "updated_at")


# --- histories, limits, references, views -----------------------------------------------

_HISTORY = L.frames_sql(["observations"], """SELECT variant_id, date_trunc('month', observed_at) AS period, count(*) AS n_observations,
    min(price_eur) AS min_price, CAST(sum(CAST(price_eur AS DECIMAL(28, 8))) AS DOUBLE) / count(*) AS avg_price, max(price_eur) AS max_price,
    arg_min(price_eur, strftime(observed_at, '%Y%m%d%H%M%S') || ref) AS first_price, arg_max(price_eur, strftime(observed_at, '%Y%m%d%H%M%S') || ref) AS last_price
FROM observations GROUP BY 1, 2""")


@query("price_history_incremental", _HISTORY)
def price_history_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The price history kept up to date by three slices, whose periods overlap."""
    rows, path = L.observations(spark, sf).select("variant_id", "observed_at", "price_eur", "ref"), workspace(spark, "history")
    for i in range(3):
        gold.update_history(spark, path, rows.where(F.crc32(c("ref").cast("binary")) % 3 == i), tie=("ref",))
    history = gold.history_of(spark.read.parquet(path))
    return history.withColumn("period", c("period").cast("timestamp_ntz"))


@query("limit_prefix_files", """SELECT key, true AS readable FROM (SELECT conv_id * 1000 + turn AS key FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
    ORDER BY key LIMIT (SELECT count(*) // 3 FROM conversations)) UNION ALL SELECT NULL, false""")
def limit_prefix_files(spark: SparkSession, sf: str) -> DataFrame:
    """The first third of all records by prefix sums over files; the unreadable file before them is reported, the one behind is not read."""
    turns = table(spark, sf, "conversations").where("conv_id is not null and turn is not null")
    keys = turns.select((c("conv_id") * 1000 + c("turn")).alias("key")).repartitionByRange("key").sortWithinPartitions("key")
    path = workspace(spark, "limited-pages")
    L.write_files(spark, L.array_pages(keys, ["key"]), path)
    bad = spark.createDataFrame([("page_pg=!.products.json", "{"), ("page_pg=~.products.json", "[")], "path string, value string")
    L.write_files(spark, bad, path)
    n = table(spark, sf, "conversations").count() // 3
    rows = scan.read_array_files(spark, path, struct("key bigint"), root=path, limit=n)
    return rows.select("record.key", "readable")


_TREE = Graph([
    Reference("nation", "n_regionkey", "region", "r_regionkey"), Reference("supplier", "s_nationkey", "nation", "n_nationkey"),
    Reference("customer", "c_nationkey", "nation", "n_nationkey"), Reference("orders", "o_custkey", "customer", "c_custkey"),
    Reference("lineitem", "l_orderkey", "orders", "o_orderkey"), Reference("lineitem", "l_suppkey", "supplier", "s_suppkey", cascade=False),
    Reference("lineitem", "l_partkey", "part", "p_partkey"),
])


@query("purge_cascade", """WITH gone_nation AS (SELECT n_nationkey FROM nation WHERE n_regionkey = 0), gone_customer AS (SELECT c_custkey FROM customer WHERE c_nationkey IN (FROM gone_nation)),
gone_orders AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (FROM gone_customer))
SELECT 'region' AS relation, CAST(r_regionkey AS VARCHAR) AS key FROM region WHERE r_regionkey <> 0
UNION ALL SELECT 'nation', CAST(n_nationkey AS VARCHAR) FROM nation WHERE n_nationkey NOT IN (FROM gone_nation)
UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_nationkey NOT IN (FROM gone_nation)
UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey NOT IN (FROM gone_customer)
UNION ALL SELECT 'orders', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey NOT IN (FROM gone_orders)
UNION ALL SELECT 'part', CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 10 <> 0
UNION ALL SELECT 'lineitem', l_orderkey || '-' || l_linenumber FROM lineitem WHERE l_orderkey NOT IN (FROM gone_orders) AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 10 = 0)""")
def purge_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """A region and some parts go, and with them all that hangs below, over five levels; suppliers' lines stay, their reference does not cascade."""
    keys = {"region": "r_regionkey", "nation": "n_nationkey", "supplier": "s_suppkey", "customer": "c_custkey", "orders": "o_orderkey", "part": "p_partkey"}
    tables = {n: table(spark, sf, n) for n in (*keys, "lineitem")}
    removed = {"region": tables["region"].where("r_regionkey = 0").select("r_regionkey"), "part": tables["part"].where("p_partkey % 10 = 0").select("p_partkey")}
    kept = _TREE.purge(tables, removed)
    rows = [kept[n].select(F.lit(n).alias("relation"), c(k).cast("string").alias("key")) for n, k in keys.items()]
    lines = kept["lineitem"].select(F.lit("lineitem"), F.concat_ws("-", "l_orderkey", "l_linenumber"))
    for more in rows[1:]:
        lines = lines.union(more)
    return rows[0].union(lines)


@query("enrichment_pass", L.frames_sql(["listings"], """SELECT outcome, count(*) AS n_rows FROM (SELECT CASE WHEN l_orderkey % 107 = 0 OR l_orderkey % 109 = 0 THEN 'error'
    WHEN l_partkey % 3 = 0 THEN 'skipped' WHEN row_number() OVER (PARTITION BY l_partkey, l_orderkey % 107 = 0 OR l_orderkey % 109 = 0) = 1 THEN 'created' ELSE 'skipped' END AS outcome FROM lineitem) GROUP BY 1
UNION ALL SELECT 'processed', count(*) FROM lineitem"""))
def enrichment_pass(spark: SparkSession, sf: str) -> DataFrame:
    """Counters of the enrichment: no url or no name is an error, a known or repeated url is skipped; blanks are a name."""
    order = F.split("ref", r"\|")[0].cast("bigint")
    rows = L.listings(spark, sf).select(
        F.when(order % 107 == 0, F.lit("")).otherwise(c("product_url")).alias("product_url"),
        F.when(order % 109 != 0, F.lit("  ")).alias("product_name_raw"))
    known = L.products(spark, sf).where("product_id % 3 = 0").select(F.sha2("product_url", 256).alias("url_hash"))
    return enrichment.counts(rows, known)


@query("view_catalogue", L.frames_sql(["prices"], """SELECT c.brand_series || ' ' || c.model_name AS full_model_name,
    CASE c.vendor_id WHEN 'NVIDIA' THEN 'CUDA Cores' WHEN 'AMD' THEN 'Stream Processors' ELSE 'Xe Cores' END AS core_type_label, count(*) AS n_offers, min(price_eur) AS min_price, max(last_seen_at) AS last_seen
FROM prices p JOIN chip c ON p.chip_id = c.chip_id GROUP BY c.chip_id, 1, 2"""))
def view_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """The registered views, asked through SQL."""
    chip = L.silver_chip(spark)
    arch = F.when(c("vendor_id") == "NVIDIA", F.lit("Blackwell")).when(c("vendor_id") == "AMD", F.lit("RDNA4")).otherwise(F.lit("Xe2-HPG"))
    none = F.lit(None).cast("int")
    chip = chip.withColumns({"architecture_id": arch, "compute_units_type": F.lit("OTHER"), "typical_clock_mhz": none, "recommended_psu_watts": none, "process_node_nm": none})
    memory = L.silver_memory(spark).withColumns({"memory_type_id": F.lit("GDDR7"), "memory_bus_bits": none})
    features = L.silver_features(spark).withColumns({n: F.lit(None).cast("string") for n in ("dlss_version",)} | {n: F.lit(False) for n in ("raytracing_hardware", "fsr_support", "av1_encode")})
    gold.register_views(spark, {
        "chip": chip, "vendor": vendors(spark), "architecture": architectures(spark), "memory": memory, "memory_type": memory_types(spark), "features": features,
        "variant": L.variants(spark, sf), "observation": L.observations(spark, sf).withColumn("observation_id", c("ref"))})
    return spark.sql("""SELECT full_model_name, core_type_label, count(*) AS n_offers, min(price_eur) AS min_price, max(last_seen_at) AS last_seen
        FROM current_gpu_prices JOIN gpu_technical_sheet USING (chip_id) GROUP BY chip_id, full_model_name, core_type_label""")
