"""Rules, defaults, counters, upserts, cascades, limits and the load as a stream, case by case."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwright import session
from shelfwright.bindings import fixtures as L
from shelfwright.operators import contracts, counters, merge
from shelfwright.operators.references import CATALOG, Graph, Reference
from shelfwright.plans import enrichment, gold, silver
from shelfwright.schemas import LISTING, struct
from shelfwright.sources import scan
from shelfwright.streaming import jobs, state
from shelfwright.streaming import silver as stream_silver


def test_contract_survives_as_json_and_lists_all_broken_rules(spark):
    stored = T.StructType.fromJson(json.loads(contracts.MEMORY.json()))
    rows = [("c", 8, "GDDR7", 128, 1.0, 2.0), ("d", None, "GDDR7", 100, -1.0, None), ("e", 0, None, 64, None, None)]
    df = spark.createDataFrame(rows, "chip_id string, vram_gb int, memory_type_id string, memory_bus_bits int, memory_speed_gbps double, memory_bandwidth_gbs double")
    good, bad = contracts.split(df, stored)
    assert [r.chip_id for r in good.collect()] == ["c"]
    assert {r.chip_id: r.broken_rules for r in bad.collect()} == {
        "d": ["vram_gb not null", "memory_bus_bits known", "memory_speed_gbps > 0"], "e": ["memory_type_id not null", "vram_gb > 0"]}


def test_defaults_fill_omitted_columns_only(spark):
    df = spark.createDataFrame([("c", None)], "chip_id string, rt_cores int")
    row = contracts.with_defaults(df, contracts.CHIP).first()
    assert (row.rt_cores, row.tensor_cores, row.pcie_lanes, row.vendor_id) == (None, 0, 16, None)


def test_load_is_refused_by_rules(spark, tmp_path):
    bad = spark.createDataFrame([("o", "v", "shop", "u", -1.0, "odd", None, "r")], "observation_id string, variant_id string, retailer string, product_url string, price_eur double, stock_status string, observed_at timestamp, scrape_run_id string")
    with pytest.raises(merge.RejectedLoad, match="price_eur > 0"):
        merge.load_all(spark, str(tmp_path / "t"), {"o": bad}, contracts.problems({"observation": (bad, contracts.OBSERVATION)}))
    assert not (tmp_path / "t").exists()


def test_ill_typed_seed_fields_are_problems(spark):
    from shelfwright.bindings.load_queries import _seed_entries, _seed_parts

    entries = _seed_entries(spark, "/root/testdata/sf0.001", chip__launch_date=F.when(F.col("p_partkey") == 3, F.lit("soon")),
                            features__av1_encode=F.when(F.col("p_partkey") == 4, F.lit("perhaps")))
    found = {r.pos: r.problem for r in _seed_parts(spark, entries)["problems"].collect()}
    assert found == {3: "wrong type: chip.launch_date", 4: "wrong type: features.av1_encode"}


def test_upsert_touches_its_key_ranges_only(spark, tmp_path):
    path, ddl = str(tmp_path / "units"), "id string, v struct<a: int>"
    merge.upsert_parts(spark, path, spark.createDataFrame([("x_0a", (1,)), ("x_0b", (2,)), ("x_9c", (3,))], ddl), "id", F.lit("one"), ["id"], 1)
    before = {f: os.stat(f).st_mtime_ns for f in map(str, (tmp_path / "units").rglob("*.parquet"))}
    touched = merge.upsert_parts(spark, path, spark.createDataFrame([("x_0b", (5,)), ("x_0d", (6,))], ddl), "id", F.lit("two"), ["id"], 1)
    assert touched == ["0"]
    rows = {r.id: (r.v.a, r.created_at, r.updated_at) for r in spark.read.parquet(path).collect()}
    assert rows == {"x_0a": (1, "one", "one"), "x_0b": (5, "one", "two"), "x_9c": (3, "one", "one"), "x_0d": (6, "two", "two")}
    kept = {f: t for f, t in before.items() if "key_range=9" in f}
    assert kept and all(os.stat(f).st_mtime_ns == t for f, t in kept.items())
    assert not any(os.path.exists(f) for f in before if "key_range=0" in f)


def test_history_reads_touched_periods_only(spark, tmp_path):
    path, ddl = str(tmp_path / "history"), "variant_id string, observed_at timestamp, price_eur double, observation_id string"
    rows = [("v", "2024-01-05", 10.0, "a"), ("v", "2024-01-06", 20.0, "b"), ("v", "2024-02-01", 5.0, "c"), ("w", None, 1.0, "d"), ("w", "2024-01-01", None, "e")]
    df = spark.createDataFrame(rows, "variant_id string, at string, price_eur double, observation_id string").selectExpr("variant_id", "timestamp(at) observed_at", "price_eur", "observation_id")
    assert gold.update_history(spark, path, df.where("observation_id in ('a', 'c', 'd')")) and df.schema.simpleString()
    assert gold.update_history(spark, path, df.where("observation_id in ('b', 'e')")) == ["2024-01-01"]
    got = sorted(map(tuple, gold.history_of(spark.read.parquet(path)).collect()))
    assert got == sorted(map(tuple, gold.price_history(df, period="month").collect())) and ddl


def test_reference_graph(spark):
    order = CATALOG.load_order()
    assert all(order.index(r.parent) < order.index(r.child) for r in CATALOG.references)
    graph = Graph([Reference("b", "a_id", "a", "id"), Reference("c", "b_id", "b", "id"), Reference("c", "other", "a", "id", cascade=False)])
    a = spark.createDataFrame([(1,), (2,)], "id int")
    b = spark.createDataFrame([(10, 1), (20, 2), (30, None), (40, 99)], "id int, a_id int")
    c = spark.createDataFrame([(100, 10, 2), (200, 20, 1), (300, 40, None), (400, None, 7)], "id int, b_id int, other int")
    kept = graph.purge({"a": a, "b": b, "c": c}, {"a": a.where("id = 1")})
    assert [sorted(r.id for r in kept[n].collect()) for n in "abc"] == [[2], [20, 30, 40], [200, 300, 400]]
    assert sorted(map(tuple, graph.violations({"a": a, "b": b, "c": c}).collect())) == [("b.a_id", "99", 1), ("c.other", "7", 1)]


def write_page(folder, name, value):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value)


def test_limit_reads_no_file_beyond_the_cut(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scan, "FIRST_FILES", 1)
    write_page(tmp_path, "page_pg=1.products.json", '[{"key": 1}, 5, {"key": 2}]')
    write_page(tmp_path, "page_pg=2.products.json", "[broken")
    write_page(tmp_path, "page_pg=3.products.json", '[{"key": 3}, {"key": 4}]')
    write_page(tmp_path, "page_pg=4.products.json", "[broken too")
    for limit, keys, bad in ((1, [1], 0), (2, [1, 2], 0), (3, [1, 2, 3], 1), (4, [1, 2, 3, 4], 1), (9, [1, 2, 3, 4], 2)):
        rows = scan.read_array_files(spark, str(tmp_path), struct("key bigint"), root=str(tmp_path), limit=limit).collect()
        assert sorted(r.record.key for r in rows if r.readable) == keys and sum(not r.readable for r in rows) == bad
    assert scan.read_array_files(spark, str(tmp_path), struct("key bigint"), "*.none", str(tmp_path), limit=3).count() == 0


def test_index_keeps_unreadable_files_and_references(spark, tmp_path):
    write_page(tmp_path, "a.json", '{"product_url": "u", "hypotheses": ["h"], "marketplace_observations": ["p#1", " ", 3]}')
    write_page(tmp_path, "b.json", "nothing")
    rows = {r.url_hash: r for r in scan.read_index(spark, str(tmp_path), str(tmp_path), keep_unreadable=True).collect()}
    assert (rows["a"].readable, rows["a"].observation_refs[0], rows["b"].readable) == (True, "p#1", False)


def test_counters_come_from_the_write(spark, tmp_path):
    df = spark.createDataFrame([("x",), (None,), ("x",), ("y",)], "outcome string")
    watched, seen = counters.counted(df, ["x", "y", "z"])
    watched.write.parquet(str(tmp_path / "w"))
    assert seen.get == {"x": 2, "y": 1, "z": 0, "accepted": 1, "total": 4}
    assert sorted(map(tuple, counters.rows(spark, {"a": 1, "b": 0}).collect())) == [("a", 1)]


def test_enrichment_work_list(spark):
    rows = spark.createDataFrame([(1, "u1", "n"), (2, "u1", "m"), (3, "", "n"), (4, "u2", None), (5, "u3", " "), (6, "u4", "n")], "id int, product_url string, product_name_raw string")
    index = spark.createDataFrame([("u4",)], "u string").select(F.sha2("u", 256).alias("url_hash"))
    assert sorted(r.id for r in enrichment.work_list(rows, index, ["id"]).collect()) == [1, 5]
    assert {r.outcome: r.n_rows for r in enrichment.counts(rows, index).collect()} == {"created": 2, "skipped": 2, "error": 2, "processed": 6}


def test_state_survives_restarts_and_late_rows_lose(spark, tmp_path):
    ddl, folder, cp = "k string, t timestamp, id int, v double", str(tmp_path / "in"), str(tmp_path / "cp")
    batches = [[("a", "2024-01-05", 2, 1.5), ("b", None, 9, None)], [("a", "2024-01-01", 1, 9.0), ("c", "2024-01-02", 3, 0.1)], [("a", "2024-01-05", 1, 7.0), ("b", "2020-01-01", 4, 2.0)]]
    for rows in batches:
        spark.createDataFrame(rows, "k string, t string, id int, v double").selectExpr("k", "timestamp(t) t", "id", "v").write.mode("append").parquet(folder)
        state.latest(spark.readStream.schema(ddl).parquet(folder), cp, ["k"], "t", "id").awaitTermination()
    got = {r.k: (str(r.t), r.id, r.v) for r in state.current(spark, cp, T.StructType.fromDDL(ddl)).collect()}
    assert got == {"a": ("2024-01-05 00:00:00", 1, 7.0), "b": ("2020-01-01 00:00:00", 4, 2.0), "c": ("2024-01-02 00:00:00", 3, 0.1)}


def test_stream_load_reads_evidence_again(spark, tmp_path):
    """Evidence that arrives between two starts counts for the pages of the second; a replay adds nothing; a bad page is an outcome."""
    root, base = tmp_path / "bronze", str(tmp_path / "stores")
    url = "https://shop.example/p/7"
    digest = __import__("hashlib").sha256(url.encode()).hexdigest()
    listing = {"retailer": "s", "product_url": url, "price_eur": 10.5, "observed_at_utc": "2024-01-01T00:00:00Z", "scrape_run_id": "r", "stock_status": "in_stock"}
    write_page(root, "listings/runs/1/page_pg=1.products.json", json.dumps([listing]))
    write_page(root, f"index/{digest}.json", json.dumps({"product_url": url, "hypotheses": ["evidence/7.json"]}))
    write_page(root, "evidence/none.json", "{")

    def start(checkpoint):
        stream = scan.stream_listings(spark, f"{root}/listings", str(root))
        stream_silver.load(stream, base, checkpoint, lambda: scan.read_index(spark, f"{root}/index", str(root), keep_unreadable=True),
                           lambda: silver.coerce_evidence(scan.read_documents(spark, f"{root}/evidence", root=str(root))), L.chip_dim(spark)).awaitTermination()
        return {r.outcome: r.n_rows for r in stream_silver.outcomes(spark, base).collect()}

    assert start(f"{base}/cp") == {"missing_hypothesis_file": 1}
    document = {"hypothesis_type": "gpu_variant", "input": {"model_name": "Asus GeForce RTX 6010 8GB"}, "extraction": {
        "aib_manufacturer": "Asus", "chipset_manufacturer": "NVIDIA", "chipset_model": "GeForce RTX 6010", "vram_gb": 8}}
    write_page(root, "evidence/7.json", json.dumps(document))
    write_page(root, "listings/runs/2/page_pg=1.products.json", json.dumps([listing, listing]))
    write_page(root, "listings/runs/2/page_pg=2.products.json", "[broken")
    assert start(f"{base}/cp") == {"missing_hypothesis_file": 1, "inserted": 1, "duplicate": 1, "unreadable": 1}
    facts = struct("observation_id string, price_eur double, observed_at timestamp")
    assert [r.price_eur for r in stream_silver.facts(spark, base, facts).collect()] == [10.5]
    start(f"{base}/cp2")  # everything again with a new checkpoint
    assert stream_silver.facts(spark, base, facts).count() == 1
    assert jobs.read_batches(spark, f"{base}/variants", struct("variant_id string"), sharded=False).count() == 1
    assert "product_url" in LISTING.names


def test_first_row_per_key_over_batches_and_starts(spark, tmp_path):
    ddl, folder, out, cp = "k string, id int, at timestamp, v double", str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    known = spark.createDataFrame([("z",), ("z",)], "k string")
    batches = [[("a", 5, 1.5)] * 300 + [("a", 3, 2.5), (None, 7, None), ("z", 1, 0.0)], [("a", 1, 9.0), ("b", 2, 0.1), ("b", 4, 0.2), (None, 1, 1.0)], [("b", 0, 7.0), ("z", 0, 0.0)]]
    for rows in batches:
        spark.createDataFrame(rows, "k string, id int, v double").selectExpr("k", "id", "timestamp_seconds(id + 0.25) at", "v").repartition(3).write.mode("append").parquet(folder)
        state.first(spark.readStream.schema(ddl).parquet(folder), out, cp, ["k"], "id", known).awaitTermination()
    got = sorted(((r.k, r.id, r.v) for r in spark.read.schema(ddl).parquet(out).where("at = timestamp_seconds(id + 0.25)").collect()), key=str)
    assert got == sorted([("a", 3, 2.5), (None, 7, None), ("b", 2, 0.1)], key=str)


def test_two_loads_at_once(spark, tmp_path, monkeypatch):
    base, one = str(tmp_path / "tables"), spark.range(3)
    assert merge.current_version(spark, base) is None
    first = merge.load_all(spark, base, {"t": one}, {})
    seen = iter([first, "another"])
    with monkeypatch.context() as m:
        m.setattr(merge, "current_version", lambda *_: next(seen))
        with pytest.raises(merge.RejectedLoad, match="again"):
            merge.load_all(spark, base, {"t": spark.range(9)}, {})
    assert merge.current_version(spark, base) == first and merge.read_current(spark, base, "t").count() == 3


def test_seed_in_one_partition_is_parsed_by_many_tasks_and_once(spark):
    from shelfwright.schemas import SEED_FIELDS, architectures, memory_types, vendors

    whole = {s: {n: None for n in names} for s, names in SEED_FIELDS.items()}
    rows = [("f", i, json.dumps(whole | {"chip": whole["chip"] | {"model_name": f"m{i}"}} if i else {"chip": {}})) for i in range(40)]
    entries = spark.createDataFrame(rows, "file string, pos int, entry string").coalesce(1)
    parts = scan.seed_relations(entries, vendors(spark), architectures(spark), memory_types(spark))
    assert len(parts["chip"].inputFiles()) > 1
    assert "get_json_object" not in parts["problems"]._jdf.queryExecution().toString()
    lacking = [r.problem for r in parts["problems"].where("pos = 0").collect() if "section" in r.problem]
    assert len(lacking) == 1 and "section memory" in lacking[0] and "section features" in lacking[0]


def test_only_repeats_are_counted_as_whole_rows(spark):
    """Lone rejected rows are joined with the short hashes of repeated ones; copies, repeated and known ids count as before."""
    rows = [("r1", "no_index_entry", None), ("r2", "no_index_entry", None), ("r2", "no_index_entry", None),
            ("r3", None, "a"), ("r4", None, "b"), ("r5", None, "b"), ("r6", None, "c"), ("r6", None, "c"), ("r7", None, "known")]
    others = [F.lit(None).cast("string").alias(n) for n in silver.REJECT_COLUMNS if n != "outcome"]
    judged = spark.createDataFrame(rows, "ref string, outcome string, observation_id string").select("*", *others)
    found = silver.reject_table(judged, target=spark.createDataFrame([("known",)], "observation_id string"))
    assert "LeftAnti" in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.ref, r.outcome, r.n_copies) for r in found.collect()) == [
        ("r1", "no_index_entry", 1), ("r2", "no_index_entry", 2), ("r5", "duplicate", 1), ("r6", "duplicate", 1), ("r7", "duplicate", 1)]


def test_evidence_of_one_partition_is_matched_by_many_tasks(spark):
    names = ("path", "name", *silver._EVIDENCE_TEXT)
    evidence = spark.createDataFrame([(f"e{i}",) for i in range(40)], "path string").coalesce(1).select(
        "path", *[F.lit(None).cast("string").alias(n) for n in names if n != "path"], *[F.lit(None).cast("int").alias(n) for n in silver._EVIDENCE_INT])
    assert silver.match_evidence(evidence, L.chip_dim(spark)).select(F.spark_partition_id()).distinct().count() > 1


def test_newest_rows_with_null_keys_are_kept(spark, tmp_path):
    """The state is native: its plan has no Python, and a null among whole-number keys loses no other key."""
    ddl, folder, cp = "k bigint, e string, t timestamp, id bigint", str(tmp_path / "in"), str(tmp_path / "cp")
    rows = [(3, "view", "2024-01-01", 1), (None, "view", "2024-01-02", 2), (3, None, "2024-01-03", 3), (3, "view", "2024-01-04", 4)]
    spark.createDataFrame(rows, "k bigint, e string, t string, id bigint").selectExpr("k", "e", "timestamp(t) t", "id").coalesce(1).write.parquet(folder)
    query = state.latest(spark.readStream.schema(ddl).parquet(folder), cp, ["k", "e"], "t", "id")
    query.awaitTermination()
    assert "InPandas" not in query._jsq.explainInternal(False)
    got = {(r.k, r.e): r.id for r in state.current(spark, cp, T.StructType.fromDDL(ddl)).collect()}
    assert got == {(3, "view"): 4, (None, "view"): 2, (3, None): 3}


def test_history_exchanges_a_slice_once(spark, tmp_path, monkeypatch):
    """Old states and new rows meet in one exchange, which combines before it; equal times and lone rows keep first and last."""
    path = str(tmp_path / "history")
    rows = [("v", "2024-01-05", 10.0, "a"), ("v", "2024-01-05", 20.0, "b"), ("v", "2024-02-01", 5.0, "c"), ("w", "2024-01-09", 7.0, None), (None, "2024-01-09", 3.0, "x")]
    df = spark.createDataFrame(rows, "variant_id string, at string, price_eur double, observation_id string").selectExpr("variant_id", "timestamp(at) observed_at", "price_eur", "observation_id")
    plans, staged, merged = [], [], gold.merge_states

    def seen(states, keys):
        plans.append(merged(states, keys))
        return plans[-1]

    monkeypatch.setattr(gold, "merge_states", seen)
    monkeypatch.setattr(merge, "written", lambda *a: staged.append(a))
    for i in ("b", "a"):
        gold.update_history(spark, path, df.where(F.coalesce("observation_id", F.lit("b")).isin(i, {"b": "c", "a": "x"}[i])))
    assert not staged
    text = plans[1]._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and text.index("Exchange") < text.index("partial_min")
    got = sorted(map(str, gold.history_of(spark.read.parquet(path)).collect()))
    assert got == sorted(map(str, gold.price_history(df, period="month").collect()))
    assert sorted((r.variant_id or "", r.n) for r in spark.read.parquet(path).where("last is null").collect()) == [("", 1), ("v", 1), ("w", 1)]


def test_shuffle_files_go_with_the_write(spark):
    """What a written table exchanged is not kept on disk until the driver collects its garbage; the setting is as before."""
    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    before, setting = files(), spark.conf.get(session._CLEANUP, None)
    df = spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").agg(F.count("*").alias("n"))
    table = session.written(spark, df, "freed")
    end = time.time() + 20
    while files() - before and time.time() < end:
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(session._CLEANUP, None) == setting
    assert table.count() == 7  # exchanges its own


def test_only_repeats_of_a_stored_batch_are_exchanged(spark, tmp_path, monkeypatch):
    rows = [("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z"), ("c", 4, None), (None, 5, "n"), (None, 6, "m"), ("d", 7, "t"), ("d", 7, "t")]
    spark.createDataFrame(rows, "k string, n int, v string").write.parquet(str(tmp_path / "batch"))
    batch = spark.read.parquet(str(tmp_path / "batch"))
    target = spark.createDataFrame([("c",), ("e",), (None,)], "k string")
    for known in (None, target):
        whole = sorted(map(str, merge.append_new(known, batch, "k", ["n"]).collect()))
        few = merge.append_stored(known, batch, "k", ["n"])
        assert sorted(map(str, few.collect())) == whole
        branch = few._jdf.queryExecution().optimizedPlan().children().head().toString()
        assert "LeftAnti" in branch and "Window" not in branch
        monkeypatch.setattr(merge, "REPEATS", 0)
        assert sorted(map(str, merge.append_stored(known, batch, "k", ["n"]).collect())) == whole
        monkeypatch.undo()


def test_listings_are_exchanged_without_their_url_hash(spark, monkeypatch):
    from shelfwright.operators import lookup

    digest = lambda u: __import__("hashlib").sha256(u.encode()).hexdigest()
    events = spark.createDataFrame([("u1", 1), (" u1 ", 2), (None, 3), ("  ", 4), ("u2", 5), ("u3", 6), ("u9", 7)], "product_url string, n int")
    entries = [(digest("u1"), ["p"]), (digest("u2"), ["q"]), (digest("u2"), ["r"]), (digest("u3"), []), ("zz", ["p"]), (None, ["p"]), (digest(""), ["p"])]
    index, evidence = spark.createDataFrame(entries, "url_hash string, hypotheses array<string>"), spark.createDataFrame([("p", 1.5)], "path string, v double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = lookup.lookup_chain(events, index, evidence)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(_key" in plan and "hashpartitioning(url_hash" not in plan.split("_entry")[0]
        got = {r.n: (r.url_hash, r.n_entries, r.n_hypotheses, r.path, r.v) for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    none = (None,) * 4
    assert got == {
        1: (digest("u1"), 1, 1, "p", 1.5), 2: (digest("u1"), 1, 1, "p", 1.5), 3: (None, *none), 4: (None, *none),
        5: (digest("u2"), 2, None, None, None), 6: (digest("u3"), 1, 0, None, None), 7: (digest("u9"), *none)}
