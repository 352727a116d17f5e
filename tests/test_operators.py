from pyspark.sql import functions as F

from shelfwright.operators import joins, latest, lookup, matching, merge, quality

c = F.col


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def dim(spark):
    return spark.createDataFrame([
        ("c1", "NVIDIA", "GeForce RTX 5060", 8), ("c2", "NVIDIA", "GeForce RTX 5060 Ti", 8), ("c3", "NVIDIA", "GeForce RTX 5060 Ti", 16),
        ("c4", "AMD", "Radeon RX 9070", 16), ("c5", "AMD", "RX 9070", 16), ("c6", "NVIDIA", "RTX 5080 16GB", 16), ("c7", "AMD", "RX 7600", None),
    ], "chip_id string, vendor_id string, model_name string, vram_gb int")


def test_match_states(spark):
    cases = [
        ("NVIDIA", "RTX 5060", 8, "c1", None), ("NVIDIA", "RTX 5060", None, None, "no_match"),
        ("amd", "RX 9070", 16, None, "ambiguous"), ("AMD", "RX 7600", None, "c7", None),
        ("AMD", "RX 7600", 8, None, "no_match"), ("NVIDIA", "5080 16GB", None, "c6", None),
        ("NVIDIA", "5080 16GB", 12, None, "no_match"), ("INTEL", "B580", 12, None, "missing"),
        ("NVIDIA", None, 8, None, "missing"), ("NVIDIA", "RTX", 16, None, "no_match"), ("NVIDIA", "RTX", None, None, "missing"),
    ]
    df = spark.createDataFrame([(i, *x[:3]) for i, x in enumerate(cases)], "i int, v string, m string, gb int")
    got = matching.match_entities(df, matching.candidate_index(dim(spark)), c("v"), c("m"), c("gb"), F.lit("B"))
    out = got.orderBy("i").select("match.*").collect()
    assert [(r.chip_id, r.state) for r in out] == [x[3:] for x in cases]
    # The brand is lost when an attempt is missing its fields.
    assert [r.brand for r in out] == [None if x[4] == "missing" else "B" for x in cases]


def test_two_attempts(spark):
    df = spark.createDataFrame([
        (1, "NVIDIA", "RTX 5060", 8, "A", "AMD", "RX 7600", None, "B"),
        (2, "NVIDIA", "RTX 9", 8, None, "AMD", "RX 7600", None, "B"),
        (3, "NVIDIA", "RTX 9", 8, "A", "AMD", "RX 9070", 16, "B"),
    ], "i int, v1 string, m1 string, g1 int, b1 string, v2 string, m2 string, g2 int, b2 string")
    pick = lambda n: tuple(c(f"{x}{n}") for x in "vmgb")
    got = matching.match_two_attempts(df, matching.candidate_index(dim(spark)), pick(1), pick(2))
    assert rows(got.select("i", "chip_id", "state", "vendor_id", "brand", "match_source"), "i") == [
        (1, "c1", None, "NVIDIA", "A", "normalize"), (2, "c7", None, "AMD", "B", "extraction"),
        (3, None, "ambiguous", "AMD", "A", "extraction"),
    ]


def test_resolve_reference(spark):
    ids = spark.createDataFrame([("RDNA 3",), ("Xe2-HPG",), ("a b",), ("ab",)], "id string")
    df = spark.createDataFrame([(1, "rdna3"), (2, None), (3, "x"), (4, "AB")], "i int, said string")
    assert rows(matching.resolve_reference(df, "said", ids, "id").select("i", "resolved", "resolved_error"), "i") == [
        (1, "RDNA 3", None), (2, None, "missing"), (3, None, "unknown"), (4, None, "ambiguous")]


def test_prefix_join(spark):
    left = spark.createDataFrame([(1, "Card 60 Ti"), (2, "card 60"), (3, "Other"), (4, None), (5, "C%x")], "i int, t string")
    right = spark.createDataFrame([("a", "Card 60"), ("b", "Card 60 TI"), ("c", "C%"), ("d", "ard"), ("e", "Card 60")], "k string, p string")
    assert sorted(rows(joins.prefix_join(left, right, "t", "p").select("i", "k"))) == [
        (1, "a"), (1, "b"), (1, "e"), (2, "a"), (2, "e"), (5, "c")]
    assert sorted(rows(joins.prefix_join(left, right, "t", "p", "longest").select("i", "k"))) == [(1, "b"), (2, "a"), (2, "e"), (5, "c")]
    anything = spark.createDataFrame([("z", "")], "k string, p string")
    assert joins.prefix_join(left, anything, "t", "p").count() == 4


def test_latest_and_topk(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", None, 4)], "k string, t int, id int")
    assert rows(latest.latest_by_key(df, ["k"], "t", ["id"]).select("k", "id"), "k") == [("a", 2), ("b", 4)]
    assert rows(latest.top_k(df, ["k"], [F.desc("t")], 1).select("id"), "id") == [(2,), (3,), (4,)]
    assert latest.top_k(df, ["k"], [F.desc("t"), "id"], 1, ties=False).count() == 2


def test_lookup_and_hints(spark):
    index = spark.createDataFrame([("u1", "n", "i1", ["p1"]), ("u2", "n", "i2", []), ("u3", "n", "i3", ["p1", "p2"]), ("u4", "m", "i4", ["gone"]), ("u5", "m", "i5", ["p1"]), ("u5", "m", "i6", ["p1"])],
                                  "product_url string, normalized_name string, index_path string, hypotheses array<string>")
    index = index.withColumn("url_hash", F.sha2("product_url", 256))
    evidence = spark.createDataFrame([("p1", 9)], "path string, x int")
    events = spark.createDataFrame([(" u1 ",), ("u2",), ("u3",), ("u4",), ("u5",), ("u6",), (None,)], "product_url string")
    got = lookup.lookup_chain(events, index, evidence)
    assert sorted(rows(got.select("product_url", "n_entries", "n_hypotheses", "evidence_found", "x")), key=str) == sorted([
        (" u1 ", 1, 1, True, 9), ("u2", 1, 0, False, None), ("u3", 1, 2, False, None), ("u4", 1, 1, False, None),
        ("u5", 2, None, False, None), ("u6", None, None, None, None), (None, None, None, None, None)], key=str)
    asked = spark.createDataFrame([("u1", "m"), ("q", None)], "product_url string, normalized_name string")
    hints = lookup.index_hints(asked, index, n=2)
    assert rows(hints.select("product_url", "url_hints", "name_hints"), "product_url") == [("q", [], []), ("u1", ["i1"], ["i4", "i5"])]
    assert rows(lookup.new_products(asked, index).select("product_url")) == [("q",)]


def test_quality(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1), (3, -1), (3, 2)], "k int, v int")
    rules = [("positive", c("v") > 0), *quality.not_null("v")]
    assert rows(quality.check(df, rules), "rule") == [("positive", 5, 2), ("v not null", 5, 1)]
    assert quality.violations(df, rules).count() == 3
    assert rows(quality.duplicate_keys(df, ["k"])) == [(3, 3)]
    assert rows(quality.conflicting(df, ["k"], ["v"])) == [(3, 2)]
    assert rows(quality.ambiguous(df, c("k"), "v")) == [(3, 2, -1, 2)]
    docs = spark.createDataFrame([('{"a":null}',), ("x",)], "j string")
    assert [r.missing for r in quality.required_fields(docs, "j", ["a", "b"]).collect()] == [["b"], ["a", "b"]]
    judged = quality.reject_cascade(df, [("null", c("v").isNull()), ("neg", c("v") < 0), ("three", c("k") == 3)])
    assert dict(rows(quality.funnel(judged))) == {"null": 1, "neg": 2, "three": 1, None: 1}
    assert tuple(quality.run_failed(quality.funnel(judged), ["neg"]).first()) == (2, True)
    assert tuple(quality.run_failed(quality.funnel(judged), ["other"]).first()) == (0, False)
    filled = quality.fill_defaults(df, {"v": 0, "lanes": 16})
    assert filled.where("v is null").count() == 1 and filled.where("lanes = 16").count() == 5


def test_foreign_keys(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(2,)], "id int")
    assert rows(joins.foreign_keys(child, [("r", "fk", parent, "id")])) == [("r", "1", 2)]
    good, bad = joins.semi_split(child, parent.withColumnRenamed("id", "fk"), ["fk"])
    assert (good.count(), bad.count()) == (1, 3)
    assert rows(joins.purge_orphans(parent, child, "fk", "id")) == [(2,)]


def test_append(spark):
    target = spark.createDataFrame([("a", 0)], "id string, v int")
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("b", 1), ("c", 3)], "id string, v int")
    new = merge.append_new(target, batch, "id", ["v"])
    assert rows(new.select("id", "v"), "id") == [("b", 1), ("c", 3)]
    after = target.unionByName(new)
    assert merge.append_new(after, batch, "id", ["v"]).count() == 0
    preview = merge.append_preview(target, batch, "id")
    assert rows(preview, "id") == [("a", 1, 0, 1), ("b", 2, 1, 1), ("c", 1, 1, 0)]
    assert preview.agg(F.sum("inserted")).first()[0] == new.count()
    assert merge.append_new(target, batch, "id", ["v"], prune="v").count() == 3
    # A known key whose prune column is NULL is not added again.
    old = spark.createDataFrame([("x", None)], "id string, v int")
    new = spark.createDataFrame([("x", None), ("y", 4)], "id string, v int")
    assert [r.id for r in merge.append_new(old, new, "id", ["v"], prune="v").collect()] == ["y"]


def test_upsert(spark):
    target = spark.createDataFrame([("a", 1, "old", "old"), ("b", 2, "old", "old")], "id string, v int, created_at string, updated_at string")
    batch = spark.createDataFrame([("b", 5), ("b", 4), ("c", None)], "id string, v int")
    got = merge.upsert(target, batch, "id", F.lit("now"), [F.desc("v")])
    assert rows(got.select("id", "v", "created_at", "updated_at"), "id") == [
        ("a", 1, "old", "old"), ("b", 5, "old", "now"), ("c", None, "now", "now")]


def test_documents(spark, tmp_path):
    df = spark.createDataFrame([("ab", 1), ("cd", 2)], "id string, v int")
    merge.write_documents(df, str(tmp_path / "d"), "id", F.to_json(F.struct("v")))
    back = spark.read.parquet(str(tmp_path / "d"))
    assert rows(back.select("id", "document", "shard"), "id") == [("ab", '{"v":1}', "a"), ("cd", '{"v":2}', "c")]
