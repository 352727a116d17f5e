"""Every registered query against its SQL, also on tables with a hot key."""

import decimal
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
# The corpus queries have tests of their own.
QUERIES = {k: f for k, f in entry.queries().items() if f.__module__.startswith("shelfwright.bindings")}
ORACLES = {k: sql for k, sql in entry.oracle_sql().items() if k in QUERIES}


def connect(folder):
    con = duckdb.connect()
    for name in os.listdir(folder):
        path = os.path.join(folder, name)
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{source}'")
    return con


def plain(row):
    return tuple(float(v) if isinstance(v, decimal.Decimal) else v for v in row)


def compare(spark, con, name, folder):
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    got = sorted((plain(r) for r in df.select(*columns).collect()), key=str)
    relation = con.execute(ORACLES[name])
    names = [d[0] for d in relation.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted((plain([r[i] for i in order]) for r in relation.fetchall()), key=str)
    assert got == want


@pytest.fixture(scope="module")
def small():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, name):
    compare(spark, small, name, SF)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A third of the lines are one part and shop, many of them exact copies."""
    folder = tmp_path_factory.mktemp("skewed")
    for file in os.listdir(SF):
        df = spark.read.parquet(f"{SF}/{file}")
        if file == "lineitem.parquet":
            hot = df.where("l_orderkey % 3 = 0").withColumns({
                "l_partkey": F.lit(7).cast("bigint"), "l_suppkey": F.lit(3).cast("bigint"),
            })
            copies = hot.limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("n")
            df = df.where("l_orderkey % 3 <> 0").unionByName(hot).unionByName(copies.select(*df.columns))
        if file == "events.parquet":
            df = df.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(5).cast("bigint")).otherwise(F.col("user_id")))
        df.coalesce(3).write.parquet(f"{folder}/{file}")
    return str(folder), connect(str(folder))


@pytest.mark.parametrize("name", [
    "current_prices", "latest_by_key", "first_seen_index", "value_analysis", "price_history", "lookup_chain", "funnel_events",
    "reject_table", "silver_load", "idempotent_append", "append_preview", "schema_adaptive_append", "enrichment_funnel",
    "new_products", "duplicate_keys", "conflicting_duplicates", "fk_violations", "fk_semi_split", "stream_latest",
    "stream_dedup", "index_hints", "segment_topk", "prefix_join_longest",
])
def test_query_with_hot_key(spark, skewed, name):
    folder, con = skewed
    compare(spark, con, name, folder)
