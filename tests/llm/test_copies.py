"""Exact dedup and the n-gram join against brute force."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shelfwright.llm import extendible_dedup as X
from shelfwright.llm import ngram_join as J

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def norm(text):
    return (text or "").translate(ASCII)


def copies_by_hand(corpus):
    groups = defaultdict(list)
    for doc, text in corpus:
        groups[norm(text)].append(doc)
    rows = []
    for doc, text in corpus:
        group = groups[norm(text)]
        keep = max((d for d in group if d is not None), default=None)
        rows.append((doc, keep, len(group), doc == keep, hashlib.sha256(norm(text).encode()).hexdigest()))
    return sorted(rows, key=str)


@pytest.mark.parametrize("key, capacity", [(X.text_key, 100_000), (lambda c: F.xxhash64(c).bitwiseAND(F.lit(-(1 << 61))), 3)], ids=["plain", "collisions"])
def test_exact_copies(spark, corpus, documents, key, capacity):
    got = X.mark_copies(spark, documents, capacity, 6, key)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == copies_by_hand(corpus)


def test_exact_copies_of_nothing(spark, nothing):
    assert X.mark_copies(spark, nothing).count() == 0


def test_directory():
    flat = X.plan_directory({0: 5}, 10, 4)
    assert (flat.depth, flat.buckets) == (0, [0])
    cells = {i: 1 for i in range(16)} | {0: 9}
    grown = X.plan_directory(cells, 4, 4)
    assert grown.depth == 4 and len(grown.buckets) == 16
    size = defaultdict(int)
    for cell, bucket in enumerate(grown.buckets):
        size[bucket] += cells[cell]
    assert sum(size.values()) == 24 and max(size.values()) == 9  # one cell can't be split any more
    assert grown.buckets == sorted(grown.buckets)  # buckets are key ranges
    assert grown.buckets[8] == grown.buckets[11]  # a bucket that was not full has several entries


def test_directory_table_doubles_and_owns(spark):
    """Several doublings at a small capacity: the same buckets as by hand, none overfull, and rows find their chains only through them."""
    keys = spark.range(3000).select(F.xxhash64("id").alias("key"))
    capacity = 7
    table, depth = X.plan(spark, keys, capacity, 2)  # too few bits at first: counted again with more
    entries = {r.entry: r.bucket for r in table.collect()}
    assert depth >= 9
    cells = {r[0]: r[1] for r in keys.groupBy(X.cell_of(F.col("key"), 18)).count().collect()}
    hand = X.plan_directory({c: cells.get(c, 0) for c in range(1 << 18)}, capacity, 18)
    assert hand.depth == depth
    same = {}
    # Entries of cells without keys need no row.
    assert all(same.setdefault(entries[i], b) == b for i, b in enumerate(hand.buckets) if i in entries) and len(set(same.values())) == len(same)
    assert {c >> 18 - depth for c in cells} == set(entries)
    rows = X.place(keys.withColumns({"doc_id": F.col("key"), "norm": F.col("key").cast("string")}), table, depth)
    assert max(r["count"] for r in rows.groupBy("bucket").count().collect()) <= capacity
    index = X.build_index(spark, rows)
    assert X.lookup(rows, index).where("kept").count() == 3000
    astray = rows.withColumn("bucket", F.lit("0-0"))
    assert X.lookup(astray, index).count() == 0


def test_keys_that_share_all_bits_but_one(spark):
    keys = spark.createDataFrame([(0,), (1,), (-1,), (1 << 40,)], "key long")
    table, depth = X.plan(spark, keys, 1)
    assert depth == 64
    owners = {r.key: r.bucket for r in X.place(keys, table, depth).collect()}
    assert len(set(owners.values())) == 4 and owners[0] == "64-0" and owners[-1] == "1-1"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", norm(text))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def components_by_hand(corpus, percent):
    sets = [(doc, shingles(text)) for doc, text in corpus]
    parent = {doc: doc for doc, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, one) in enumerate(sets):
        for b, two in sets[:i]:
            if one and two and None not in (a, b):
                both = len(one & two)
                if 100 * both >= percent * (len(one) + len(two) - both):
                    parent[max(root(a), root(b))] = min(root(a), root(b))
    rows = [(d, len(s), None if d is None else root(d) if s else d) for d, s in sets]
    return sorted(rows, key=str)


@pytest.mark.parametrize("percent", [80, 60])
def test_near_copies(spark, corpus, documents, percent):
    got = J.link_components(spark, documents, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == components_by_hand(corpus, percent)


def test_near_copies_of_nothing(spark, nothing):
    assert J.link_components(spark, nothing).count() == 0


def test_sizes():
    for n in range(1, 60):
        for m in range(1, n + 1):
            least = next((k for k in range(1, m + 1) if 100 * k >= 80 * (n + m - k)), None)
            if least is not None:
                assert J.needed(n, m) == least and J.prefix(n) >= n - least + 1
            else:
                assert J.needed(n, m) > m
    assert J.choose_boundary({5: 10, 15: 10}, 1000.0) == 15
    assert J.choose_boundary({5: 10, 15: 10}, 1.5) < 15


def test_chains_of_links_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (7, 7)], "a long, b long")
    found = {r.node: r.root for r in J.components(spark, edges).collect()}
    assert found == {i: 1 for i in range(1, 41)} | {100: 100, 101: 100}
