"""Streams against batches, and invariants of the silver load."""

from pyspark.sql import functions as F

from shelfwright.bindings import core_queries as Q
from shelfwright.bindings import fixtures as L
from shelfwright.operators.latest import latest_by_key
from shelfwright.plans import gold, silver
from shelfwright.streaming import jobs

SF = "/root/testdata/sf0.001"


def source(spark, tmp_path, name, df, files):
    df.repartition(files).write.parquet(str(tmp_path / name))
    return lambda: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").select("user_id", "event_type", "event_id", "ts")
    keys, order = ["user_id", "event_type"], ["event_id"]
    want = sorted(map(tuple, latest_by_key(events, keys, "ts", order).collect()))
    for files in (1, 4):
        stream = source(spark, tmp_path, f"events{files}", events, files)
        base = str(tmp_path / f"latest{files}")
        jobs.latest(stream(), f"{base}/rows", f"{base}/cp", keys, "ts", order).awaitTermination()
        state = jobs.current_state(spark, f"{base}/rows", events.schema, keys, "ts", order)
        assert sorted(map(tuple, state.collect())) == want
        jobs.compact_state(spark, f"{base}/rows", f"{base}/compact", events.schema, keys, "ts", order)
        assert jobs.current_state(spark, f"{base}/compact", events.schema, keys, "ts", order).count() == len(want)


def test_stream_ingest_once(spark, tmp_path):
    rows = spark.createDataFrame([(i % 7, i) for i in range(60)], "k int, v int")
    stream = source(spark, tmp_path, "in", rows, 3)
    base = str(tmp_path / "out")
    for _ in range(2):  # the second start finds nothing new
        jobs.ingest(stream(), f"{base}/rows", f"{base}/cp", "k", ["v"]).awaitTermination()
    got = jobs.read_batches(spark, f"{base}/rows", rows.schema)
    assert sorted(r.k for r in got.collect()) == list(range(7))
    # A restart without the checkpoint replays everything and still adds nothing.
    jobs.ingest(stream(), f"{base}/rows", f"{base}/cp2", "k", ["v"]).awaitTermination()
    assert sorted(r.k for r in jobs.read_batches(spark, f"{base}/rows", rows.schema).collect()) == list(range(7))


def test_stream_restarts(spark, tmp_path):
    """New checkpoints, other batch sizes and compaction give the rows of the batch twin."""
    parts = [spark.createDataFrame([(i, v) for i in keys], "k int, v int") for v, keys in enumerate((range(0, 4), range(2, 6), range(5, 9)))]
    base = str(tmp_path / "restarts")

    starts = iter(range(99))

    def stream(*which):
        folder = f"{base}/in-{next(starts)}"
        for i in which:
            parts[i].coalesce(1).write.parquet(f"{folder}/{i}")
        return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder)

    def rows():
        return sorted((r.k, r.v) for r in jobs.read_batches(spark, f"{base}/rows", parts[0].schema).collect())

    jobs.ingest(stream(0, 1), f"{base}/rows", f"{base}/cp1", "k", ["v"]).awaitTermination()
    first = rows()
    assert [k for k, _ in first] == list(range(6))
    jobs.ingest(stream(0, 1), f"{base}/rows", f"{base}/cp2", "k", ["v"]).awaitTermination()
    assert rows() == first
    jobs.ingest(stream(2), f"{base}/rows", f"{base}/cp3", "k", ["v"]).awaitTermination()
    assert rows() == first + [(6, 2), (7, 2), (8, 2)]

    keys, order = ["k"], ["v"]
    state = lambda path: sorted(map(tuple, jobs.current_state(spark, path, parts[0].schema, keys, "v", order).collect()))
    jobs.latest(stream(0, 1), f"{base}/state", f"{base}/cp4", keys, "v", order).awaitTermination()
    jobs.compact_state(spark, f"{base}/state", f"{base}/compact", parts[0].schema, keys, "v", order)
    jobs.latest(stream(2), f"{base}/compact", f"{base}/cp5", keys, "v", order).awaitTermination()
    both = parts[0].union(parts[1]).union(parts[2])
    assert state(f"{base}/compact") == sorted(map(tuple, latest_by_key(both, keys, "v", order).collect()))


def test_stream_new_products(spark, tmp_path):
    rows = spark.createDataFrame([(f"u{i % 9}",) for i in range(40)], "product_url string")
    known = spark.createDataFrame([("u1",), ("u2",)], "u string").select(F.sha2("u", 256).alias("url_hash"))
    stream = source(spark, tmp_path, "urls", rows, 3)
    base = str(tmp_path / "new")
    jobs.new_products(stream(), f"{base}/rows", f"{base}/cp", ["product_url"], known).awaitTermination()
    found = spark.read.parquet(f"{base}/rows")
    assert sorted(r.product_url for r in found.collect()) == ["u0", "u3", "u4", "u5", "u6", "u7", "u8"]


def test_dedup_within_watermark(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:01:00"), ("b", "2024-01-01 00:02:00")], "k string, ts string")
    stream = source(spark, tmp_path, "dd", rows, 1)
    out = str(tmp_path / "dd-out")
    jobs.dedup_within(stream(), "k", "ts", "1 hour").writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", str(tmp_path / "dd-cp")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_silver_invariants(spark):
    classified = Q.classified(spark, SF).persist()
    total = classified.count()
    assert total == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    counts = {r.outcome: r.n_rows for r in silver.outcome_counts(classified, "observation_id").collect()}
    assert sum(counts.values()) == total
    facts = silver.load_observations(classified, schema=Q._FACT).persist()
    assert facts.count() == counts["inserted"]
    rejected = silver.reject_table(classified)
    assert rejected.agg(F.sum("n_copies")).first()[0] == total - counts["inserted"]
    # A second run inserts nothing: every acceptable row is a duplicate.
    again = {r.outcome: r.n_rows for r in silver.outcome_counts(classified, "observation_id", facts).collect()}
    assert "inserted" not in again and sum(again.values()) == total
    assert silver.load_observations(classified, target=facts).count() == 0
    errors_only = silver.reject_table(classified, duplicates=False)
    assert errors_only.where("outcome = 'duplicate'").count() == 0
    for frame in (classified, facts):
        frame.unpersist()


def test_currency_is_required_when_asked(spark):
    found = Q.matched(spark, SF)
    strict = silver.classify_observations(
        L.listings(spark, SF), L.index(spark, SF), found, Q.loaded_variants(found), require_currency=True)
    assert strict.where("outcome = 'missing_currency' and currency is not null").count() == 0
    assert strict.where("outcome = 'missing_currency'").count() > 0


def test_views(spark):
    one = lambda ddl, *row: spark.createDataFrame([row], ddl)
    tables = {
        "chip": one("chip_id string, vendor_id string, architecture_id string, brand_series string, model_name string, compute_units_type string, compute_units_count int, tensor_cores int, typical_clock_mhz int, boost_clock_mhz int, tdp_watts int, recommended_psu_watts int, process_node_nm int",
                    "c", "NVIDIA", "Blackwell", "GeForce RTX 50", "GeForce RTX 5060", "CUDA_CORES", 3840, 120, 2280, 2500, 145, 550, 5),
        "vendor": one("vendor_id string, full_name string", "NVIDIA", "NVIDIA Corporation"),
        "architecture": one("architecture_id string, generation string", "Blackwell", "5th Gen RTX"),
        "memory": one("chip_id string, vram_gb int, memory_type_id string, memory_bus_bits int, memory_bandwidth_gbs double", "c", 16, "GDDR7", 128, 448.0),
        "memory_type": one("memory_type_id string, standard_name string", "GDDR7", "GDDR7 SGRAM"),
        "features": one("chip_id string, cuda_compute_capability string, dlss_version string, raytracing_hardware boolean, fsr_support boolean, av1_encode boolean", "c", "12.0", "4", True, False, True),
        "variant": one("variant_id string, chip_id string, aib_manufacturer string, model_suffix string", "v", "c", "ASUS", "Dual"),
        "observation": one("observation_id string, variant_id string, retailer string, price_eur double, stock_status string, product_url string, observed_at string", "o", "v", "shop", 277.38, None, "u", "2025-12-23T00:00:00Z"),
    }
    assert gold.register_views(spark, tables) == list(gold.VIEWS)
    score = spark.sql("select performance_per_euro_score s, model from gold_gpu_price_performance").first()
    assert (score.s, score.model) == (346.1, "GeForce RTX 50 GeForce RTX 5060")
    assert spark.sql("select price_per_vram_gb from gpu_value_analysis").first()[0] == 17.34
    assert spark.sql("select core_type_label, dlss_version from gpu_technical_sheet").first()[:] == ("CUDA Cores", "4")
    suitability = gold.ai_suitability(tables["chip"], tables["memory"], tables["features"], spark.table("current_gpu_prices"))
    watt = gold.capacity_per_watt(suitability, tables["chip"], limit=5).first()
    assert watt.vram_mb_per_watt == 112.99
    assert gold.register_views(spark, tables, replace=False) == []
