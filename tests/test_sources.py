import json

import pytest
from pyspark.sql import functions as F

from shelfwright import schemas
from shelfwright.bindings import fixtures
from shelfwright.operators.merge import RejectedLoad, load_all, read_current
from shelfwright.plans import silver
from shelfwright.sources import conform, pages, scan
from shelfwright.sources.markup import ItemRules


def write(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(data if isinstance(data, str) else json.dumps(data))


def test_array_files(spark, tmp_path):
    runs = tmp_path / "shop" / "runs"
    write(runs / "r1" / "page_pg=2.products.json", [{"product_url": "b"}, 7, {"product_url": "c", "price_eur": 1.5}])
    write(runs / "r1" / "page_pg=10.products.json", [{"product_url": "a"}])
    write(runs / "r1" / "page_pg=3.products.json", {"not": "a list"})
    write(runs / "r1" / "page_pg=4.products.json", "[{]")
    write(runs / "r1" / "page_pg=5.products.json", [])
    write(runs / "r1" / "page_pg=2.meta.json", [{"product_url": "z"}])
    rows = scan.read_array_files(spark, str(tmp_path), root=str(tmp_path))
    got = sorted((r.ref, r.record.product_url) for r in rows.where("readable").collect())
    base = "shop/runs/r1/page_pg="
    assert got == [(f"{base}10.products.json#0", "a"), (f"{base}2.products.json#0", "b"), (f"{base}2.products.json#1", "c")]
    assert rows.where("not readable").count() == 2
    first = scan.read_array_files(spark, str(tmp_path), root=str(tmp_path), limit=2)
    assert sorted(r.ref for r in first.collect()) == [g[0] for g in got[:2]]


def test_awkward_pages(spark, tmp_path):
    """Folder names with blanks and signs, values of the wrong type, more than ten records, errors under a limit."""
    base = tmp_path / "a b+c(d)"
    many = [{"product_url": f"u{i}", "price_eur": i + 0.5} for i in range(12)]
    write(base / "runs" / "r 1" / "page_pg=1.products.json", many)
    write(base / "runs" / "r 1" / "page_pg=0.products.json", "{}")
    odd = [{"price_eur": True}, {"price_eur": "5d"}, {"price_eur": "7.25"}, {"price_eur": 3, "page_number": "2"}]
    write(base / "runs" / "r+2" / "page_pg=1.products.json", odd)
    write(base / "other" / "page_pg=9.products.json", many)
    rows = scan.read_listings(spark, str(tmp_path), root=str(base))
    assert rows.where("readable").count() == 16 and rows.where("readable").select("ref").distinct().count() == 16
    assert {r.file for r in rows.collect()} == {"runs/r 1/page_pg=1.products.json", "runs/r 1/page_pg=0.products.json", "runs/r+2/page_pg=1.products.json"}
    assert [r.price_eur for r in rows.where("file like 'runs/r+2%'").orderBy("pos").collect()] == [None, None, 7.25, 3.0]
    cut = scan.read_listings(spark, str(tmp_path), root=str(base), limit=11)
    assert cut.where("not readable").count() == 1 and sorted(r.pos for r in cut.where("readable").collect()) == list(range(11))


def test_index_files(spark, tmp_path):
    write(tmp_path / "ab" / "abc.json", {"product_url": "u", "hypotheses": ["x", " \t", None, 7]})
    write(tmp_path / "cd.json", {"hypotheses": "none"})
    write(tmp_path / "bad.json", [1])
    got = sorted((r.url_hash, r.product_url, r.hypotheses) for r in scan.read_index(spark, str(tmp_path), str(tmp_path)).collect())
    assert got == [("abc", "u", ["x", "7"]), ("cd", None, [])]


def test_conform_nested_payload(spark):
    inner = "cooling_type string, hdmi_count string, vram_gb string, chipset string, model_suffix string"
    df = spark.createDataFrame([(1, ("Liquid", "2", "sixteen", "AMD Radeon RX", "Nitro"))], f"id int, extraction struct<{inner.replace(' string', ': string')}>")
    row = conform.conform(df, "nested", ["id"]).first()
    assert (row.cooling_type, row.hdmi_count, row.vram_gb, row.chipset_manufacturer, row.aib_model_suffix) == ("Liquid", 2, None, "AMD", "Nitro")


def test_blank_first_suffix_counts(spark, tmp_path):
    write(tmp_path / "1.json", {"input": {"model_name": "n"}, "extraction": {"aib_model_suffix": "  ", "model_suffix": "X"}})
    write(tmp_path / "2.json", {"input": {"model_name": "n"}, "extraction": {"aib_model_suffix": "", "model_suffix": "X"}})
    rows = silver.coerce_evidence(scan.read_documents(spark, str(tmp_path))).orderBy("path").collect()
    assert [r.aib_model_suffix for r in rows] == [None, "X"]


def test_documents(spark, tmp_path):
    doc = {"hypothesis_type": "gpu_variant", "input": {"model_name": "n"},
           "extraction": {"vram_gb": 16, "length_mm": 303.5, "width_slots": "2.5", "is_oc": True, "model_suffix": " X "}}
    write(tmp_path / "a" / "1.json", doc)
    write(tmp_path / "a" / "2.json", "{broken")
    write(tmp_path / "b" / "3.json", doc)
    docs = scan.read_documents(spark, str(tmp_path))
    assert docs.count() == 3 and docs.where("not readable").count() == 1
    only = scan.read_documents(spark, str(tmp_path), prefer="b")
    row = silver.coerce_evidence(only).first()
    assert (row.vram_gb, row.length_mm, row.width_slots, row.aib_model_suffix) == (16, 304, 2.5, "X")
    assert scan.read_documents(spark, str(tmp_path), limit=1).count() == 1


def test_index_refs(spark):
    df = spark.createDataFrame([("a", ["x", " ", None]), ("b", None)], "id string, refs array<string>")
    assert [tuple(r) for r in scan.explode_index(df, "refs").collect()] == [("a", "x")]


def seed(**changes):
    chip = dict.fromkeys(schemas.SEED_FIELDS["chip"]) | {
        "vendor": "nvidia", "architecture": "ada-lovelace", "brand_series": "GeForce RTX 40", "model_name": "GeForce RTX 4070", "tdp_watts": 200}
    memory = dict.fromkeys(schemas.SEED_FIELDS["memory"]) | {"memory_type": "gddr6x", "vram_gb": 12, "memory_bandwidth_gbs": 504.0}
    features = dict.fromkeys(schemas.SEED_FIELDS["features"]) | {"dlss_version": "3"}
    return {"chip": chip, "memory": memory, "features": features} | changes


def relations(spark, path):
    return scan.seed_relations(
        scan.read_seed(spark, str(path)), schemas.vendors(spark), schemas.architectures(spark), schemas.memory_types(spark)
    )


def test_seed(spark, tmp_path):
    good = tmp_path / "good"
    write(good / "1.json", [seed(), seed()])
    parts = relations(spark, good)
    assert parts["problems"].count() == 0
    chip = parts["chip"].collect()
    assert [(c.vendor_id, c.architecture_id, c.tdp_watts) for c in chip] == [("NVIDIA", "Ada Lovelace", 200)]
    base = str(tmp_path / "silver")
    tables = {n: parts[n] for n in ("chip", "memory", "features")}
    load_all(spark, base, tables, {"seed": parts["problems"]})
    assert read_current(spark, base, "memory").first().vram_gb == 12

    bad = tmp_path / "bad"
    other = seed()
    other["features"] = other["features"] | {"dlss_version": "4"}
    unknown = seed()
    unknown["chip"] = unknown["chip"] | {"vendor": "Matrox"}
    lacking = seed()
    del lacking["memory"]["vram_gb"]
    write(bad / "1.json", [seed(), other, unknown, lacking, {"chip": {}}])
    parts = relations(spark, bad)
    problems = {r.problem for r in parts["problems"].collect()}
    assert {"conflicting payload", "unknown reference", "vram_gb"} <= problems
    assert any("section memory" in p for p in problems)
    with pytest.raises(RejectedLoad):
        load_all(spark, base, tables, {"seed": parts["problems"]})
    assert read_current(spark, base, "chip").count() == 1


def test_seed_hard_errors(spark, tmp_path):
    write(tmp_path / "x" / "1.json", {"chip": {}})
    with pytest.raises(RejectedLoad):
        scan.read_seed(spark, str(tmp_path / "x"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        scan.read_seed(spark, str(tmp_path / "empty"))


def test_conform(spark):
    flat = spark.createDataFrame([("m", None)], "chipset_model string, cooling_type string")
    nested = spark.createDataFrame([("NVIDIA GeForce RTX 5070", "Dual")], "chipset string, model_suffix string")
    rows = {r.source: r for r in conform.conform_union({"flat": flat, "nested": nested, "search": flat}).collect()}
    assert (rows["flat"].cooling_type, rows["flat"].hdmi_count, rows["flat"].is_oc) == ("Air", 0, False)
    assert (rows["nested"].chipset_manufacturer, rows["nested"].aib_model_suffix) == ("NVIDIA", "Dual")
    assert rows["search"].cooling_type is None


PAGE = """<html><body><ul><li class="productlist__product"><div class="productlist__name"><a href="/a-1.html"> Card
 A &amp; B</a></div><span class="price">ab</span><span class="gh_price">€ 1.234,50</span></li>
<li class="productlist__product"><h3><a href="x">No price</a></h3></li>
<li class="productlist__product"><h3><a>No link</a></h3><span class="price">5</span></li>
<li class="productlist__product"><h3><a href="//cdn.example/y?q">Far</a></h3><span class="price">€ 99.999,00</span></li>
<li class="productlist__product"><h3><a href="z">Last</a></h3><b class="price big">7</b></ul></body></html>"""


def test_page_items(spark):
    df = spark.createDataFrame([(1, PAGE, "https://shop.example/list/p1"), (2, None, "u"), (3, "<p>", "u")], "id int, html string, base string")
    rows = [tuple(r) for r in pages.extract_items(df, "html", "base", keep=["id"]).orderBy("position").collect()]
    assert rows == [(1, 1, "Card A & B", "https://shop.example/a-1.html", 1234.5), (1, 5, "Last", "https://shop.example/list/z", 7.0)]
    loose = pages.extract_items(df, "html", "base", ItemRules(need_price=False), keep=["id"])
    assert [(r.position, r.url) for r in loose.orderBy("position").collect()][1:3] == [(2, "https://shop.example/list/x"), (4, "https://cdn.example/y?q")]


def test_block_pages(values):
    pad = "x" * 20
    assert values(lambda c: pages.block_class(c, 100), [
        "<title a>\nAre you HUMAN</title>galleryview__item", "<title>ok</title> productlist__product captcha",
        "Just a moment", "captcha" + "x" * 300, pad, None,
    ]) == ["blocked_title", "items", "blocked_body", "clear", "clear", "clear"]
    assert values(lambda c: pages.sane(c, 20), [pad, "x", None]) == [True, False, False]


def test_page_metadata(spark):
    seen = spark.createDataFrame([("r", 1, "u", "t1", 200), ("r", 2, "u", "t2", 200), ("r", 3, "u", "t3", 503)],
                                 "run_id string, page_number int, url string, fetched_at string, http_status int")
    products = spark.createDataFrame([("r", 1)] * 3, "run_id string, page_number int")
    meta = pages.page_metadata(seen, products, F.col("page_number") != 2).orderBy("page_number").collect()
    assert [(m.http_status, m.product_count) for m in meta] == [(200, 3), (0, 0), (503, 0)]
    run = pages.run_metadata(seen, "shop", "gpu", "c").first()
    assert (run.started_at, run.finished_at) == ("t1", "t3")


def test_archives_hold_small_files(spark, tmp_path, monkeypatch):
    """Packed files are read as the loose ones of the same folder, by tasks and by Spark's readers, with and without a limit; a damaged archive is no silence."""
    loose, packed = tmp_path / "loose", tmp_path / "packed"
    rows = [(f"index/{'ab' * 32}{i}.json", f'{{"product_url": "u{i}"}}') for i in range(9)] + [("index/bad ä.json", "{"), ("index/_no.json", "{}"), ("index/no.txt", "{}")]
    rows += [(f"s/runs/r/page_pg={i}.products.json", f'[{{"product_url": "u{i}"}}, {{"product_url": "v{i}"}}]') for i in range(4)] + [("s/other/page_pg=9.products.json", "[{}]")]
    files = spark.createDataFrame(rows, "path string, value string").coalesce(2)
    fixtures.write_files(spark, files, str(loose))
    monkeypatch.setattr(fixtures, "ARCHIVE_BYTES", 60)
    fixtures.write_files(spark, files, str(packed), packed=True)
    for i, value in enumerate(("{}", "[{}]")):  # loose files beside archives count
        for base in (loose, packed):
            write(base / ("index/more.json", "s/runs/r/page_pg=8.products.json")[i], value)
    names = [p.name for p in packed.rglob("*") if p.is_file()]
    assert len(names) < len(rows) and sum(n.endswith(".zip") for n in names) == len(names) - 2
    frames = lambda base: [
        scan.read_index(spark, f"{base}/index", base, keep_unreadable=True), scan.read_documents(spark, f"{base}/index", root=base),
        scan.read_documents(spark, f"{base}/index", root=base, limit=3), scan.read_listings(spark, f"{base}/s", base), scan.read_listings(spark, f"{base}/s", base, limit=3)]
    texts = lambda base: [sorted(str(r) for r in f.selectExpr("to_json(struct(*))").collect()) for f in frames(str(base))]
    by_tasks = texts(loose)
    assert [len(r) for r in by_tasks] == [11, 11, 3, 9, 3] and texts(packed) == by_tasks
    monkeypatch.setattr(scan.files_, "folder", lambda *a: None)
    assert texts(packed) == by_tasks
    monkeypatch.undo()
    archive = next((packed / "index").glob("*.zip"))
    archive.write_bytes(archive.read_bytes()[:-30])
    with pytest.raises(Exception, match="zip"):
        scan.read_index(spark, str(packed / "index")).count()


def test_a_path_is_packed_once(spark, tmp_path):
    parts = [(k, k % 7) for k in range(30)]
    spark.createDataFrame(parts + parts[:9] + [(3, 50)], "p_partkey long, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    root = fixtures.bronze_files(spark, str(tmp_path), pages=False)
    for rows, name in ((scan.read_index(spark, f"{root}/index", root), "index_path"), (scan.read_documents(spark, f"{root}/evidence", root=root), "path")):
        paths = [r[0] for r in rows.select(name).collect()]
        assert len(paths) == len(set(paths)) >= 29


def test_compressed_pages(spark, tmp_path, monkeypatch):
    """``x.json.gz`` is read as ``x.json``: by tasks, by Spark's readers, with a limit and as a stream."""
    rows = [(f"s/runs/r/page_pg={i}.products.json{'.gz' if i % 2 else ''}", f'[{{"product_url": "u{i}"}}, {{"product_url": "v{i}"}}]') for i in range(4)]
    fixtures.write_files(spark, spark.createDataFrame(rows + [("index/a.json.gz", '{"product_url": "u"}'), ("index/b.json", "{}")], "path string, value string"), str(tmp_path))
    assert (tmp_path / "s/runs/r/page_pg=1.products.json.gz").read_bytes()[:2] == b"\x1f\x8b"
    root = str(tmp_path)
    refs = [f"s/runs/r/page_pg={i}.products.json#{j}" for i in range(4) for j in range(2)]
    read = lambda: (
        sorted((r.ref, r.product_url) for r in scan.read_listings(spark, f"{root}/s", root).collect()), sorted(r.ref for r in scan.read_listings(spark, f"{root}/s", root, limit=3).collect()),
        sorted((r.url_hash, r.index_path, r.product_url) for r in scan.read_index(spark, f"{root}/index", root).select("url_hash", "index_path", F.coalesce("product_url", F.lit("")).alias("product_url")).collect()),
        [r.path for r in scan.read_documents(spark, f"{root}/index", root=root, limit=1).collect()])
    by_tasks = read()
    assert by_tasks == ([(ref, f"{'uv'[k % 2]}{k // 2}") for k, ref in enumerate(refs)], refs[:3], [("a", "index/a.json", "u"), ("b", "index/b.json", "")], ["index/a.json"])
    monkeypatch.setattr(scan.files_, "folder", lambda *a: None)
    assert read() == by_tasks
    got = []
    scan.stream_listings(spark, f"{root}/s", root).writeStream.foreachBatch(lambda batch, _: got.extend(batch.collect())).option(
        "checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert sorted((r.ref, r.product_url) for r in got) == by_tasks[0]


def test_pages_are_made_without_an_exchange(spark):
    rows = spark.range(1203).coalesce(1).select(F.col("id").alias("a"), F.when(F.col("id") % 2 == 0, F.lit('x"y')).alias("b"))
    pages = fixtures.array_pages(rows, ["a", "b"])
    assert "Exchange" not in pages._jdf.queryExecution().executedPlan().toString()
    got = [json.loads(r.value) for r in pages.orderBy("path").collect()]
    assert [len(p) for p in got] == [500, 500, 203] and [r for p in got for r in p] == [{"a": i, **({} if i % 2 else {"b": 'x"y'})} for i in range(1203)]


def test_small_files_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    """Index, evidence and listings come without a file list in the driver, and as Spark's readers give them: nested, hidden, odd names and bytes."""
    base = tmp_path / "a b+c%d"
    for name, value in {"index/é/1 #.json": {"product_url": "u"}, "index/2.json": [1], "index/_no.json": {}, "index/.no/3.json": {}, "index/_x=1/4.json": {},
                        "index/no.JSON": {}, "index/5.txt": {}, "s/runs/r[1]/page_pg=1.products.json": [{"product_url": "u"}]}.items():
        write(base / name, value)
    (base / "index" / "6.json").write_bytes(b'{"product_url": "\xff\xfe"}')
    root = str(base)
    frames = lambda: [
        scan.read_index(spark, f"{root}/index", root, keep_unreadable=True), scan.read_documents(spark, f"{root}/index", root=root).select("path", "readable"),
        scan.read_documents(spark, f"{root}/index").select("path", "readable"), scan.read_documents(spark, f"file:{root}/index", limit=2).select("path", "readable"),
        scan.read_listings(spark, root, root), scan.read_listings(spark, root, "/elsewhere")]
    found = frames()
    assert all("FileScan text" not in f._jdf.queryExecution().toString() for f in found)
    rows = [sorted(str(r) for r in f.selectExpr("to_json(struct(*))").collect()) for f in found]
    monkeypatch.setattr(scan.files_, "folder", lambda *a: None)
    assert rows == [sorted(str(r) for r in f.selectExpr("to_json(struct(*))").collect()) for f in frames()]
    assert [len(r) for r in rows] == [4, 4, 4, 2, 1, 1]
