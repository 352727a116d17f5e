"""Importance resampling against plain loops."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from shelfwright.llm import importance as I

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def buckets(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return Counter(zlib.crc32(w.encode()) % I.BUCKETS for w in WORD.findall(low))


def brute(rows, target, percent, least):
    source, aim = Counter(), Counter()
    for _, text in rows:
        source += buckets(text)
    for text in target:
        aim += buckets(text)
    s, t = sum(source.values()) + I.BUCKETS, sum(aim.values()) + I.BUCKETS
    out = []
    for doc, text in rows:
        own = buckets(text)
        n = sum(own.values())
        total = sum(c * math.floor(1000 * math.log((aim[b] + 1) * s / ((source[b] + 1) * t))) for b, c in own.items())
        weight = total // n if n else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, n, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for place, row in enumerate(able[:len(able) * percent // 100], 1):
        row[4] = place
    return sorted(map(tuple, out), key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.mark.parametrize(("percent", "least"), [(10, 20), (60, 1), (100, 0), (0, 0)])
def test_equals_plain_loops(spark, documents, corpus, percent, least):
    target = ["w1 w2 the same text p1 p2 p3", "É漢 long7 long8 long9", None, ""]
    aim = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    assert got(I.resample(spark, documents, aim, percent, least)) == brute(corpus, target, percent, least)


def test_repeated_rows_each_have_a_rank(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(7, text)] * 50 + [(7, f"{text} more")] * 3 + [(i, f"{text} {i}") for i in range(40)] + [(None, text)] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string")
    aim = df.limit(0).select("text")
    out = got(I.resample(spark, df, aim, 50, 20))
    assert out == brute(rows, [], 50, 20)
    assert sorted(r[4] for r in out if r[4]) == list(range(1, 50))


def test_empty_tables(spark, nothing, documents):
    assert got(I.resample(spark, nothing, documents)) == []
    assert len(got(I.resample(spark, documents, nothing))) == documents.count()


def test_blocks_of_a_long_text():
    rng = random.Random(3)
    text = "".join(rng.choice("abcXYZ019é漢 .,\n") for _ in range(3000)) + "y" * 4000 + " end"
    before = I.BLOCK, I.GROUP
    I.BLOCK, I.GROUP = 100, 2
    try:
        counts = {}
        for a, rows in I.row_counts(pa.array(["one two", text, None, "x", text + "!"])):
            counts.update({a + i: row.copy() for i, row in enumerate(rows)})
    finally:
        I.BLOCK, I.GROUP = before
    for i, whole in enumerate(["one two", text, None, "x", text + "!"]):
        assert {b: c for b, c in enumerate(counts[i].tolist()) if c} == dict(buckets(whole))


def test_planes_give_exact_sums():
    rng = np.random.default_rng(1)
    gain = rng.integers(-20000, 20000, I.BUCKETS)
    counts = rng.integers(0, 5, (7, I.BUCKETS)) * rng.integers(0, 2, (7, I.BUCKETS))
    counts[3, 17] = 10**9
    assert (I.Gains(gain).sums(counts) == counts @ gain).all()
    assert (I.Gains(np.zeros(I.BUCKETS, np.int64)).sums(counts) == 0).all()


def test_query_equals_its_sql(spark):
    folder, name = "/root/testdata/sf0.001", "op11_importance_resampling"
    con = duckdb.connect()
    for file in os.listdir(folder):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{folder}/{file}'")
    relation = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in relation.description]
    assert sorted(map(tuple, entry.queries()[name](spark, folder).select(*columns).collect()), key=str) == sorted(relation.fetchall(), key=str)
