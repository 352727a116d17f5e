"""Small DataFrame helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwright.session import workspace

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Text with A-Z lower-cased and nothing else; a null is an empty text.

    An all-ASCII text takes the fast ``lower``; only the others pay for ``translate``.
    """
    whole = F.coalesce(text.cast("string"), F.lit(""))
    plain = F.octet_length(whole) == F.char_length(whole)
    return F.when(plain, F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))


def written(spark: SparkSession, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: its lineage ends there.

    The folder lies below ``spark.checkpoint.dir``; who owns that folder clears it.
    """
    path = workspace(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand Python workers at most ``rows`` rows at once, for the rest of the session: long texts then take little memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def checked_broadcast(df: DataFrame, n_bytes: int, limit: int) -> DataFrame:
    """``df`` with a broadcast hint if its measured size is within ``limit``, else as it is (both sides shuffle)."""
    return F.broadcast(df) if n_bytes <= limit else df


def without(spark: SparkSession, rows: DataFrame, gone: DataFrame, limit: int = 64 << 20) -> DataFrame:
    """``rows`` whose ``doc_id`` is not in ``gone``, all columns. A row without a ``doc_id`` stays: ``dropping`` names such rows first.

    The ids are broadcast, so that the rows do not move, only while their measured number keeps within ``limit`` bytes.
    """
    ids = written(spark, gone.select(F.col("doc_id").cast("long").alias("_gone")).where("_gone is not null").distinct(), "gone")
    side = checked_broadcast(ids, 32 * ids.count(), limit)
    return rows.join(side, rows["doc_id"].cast("long") == side["_gone"], "left_anti")


def dropping(spark: SparkSession, rows: DataFrame, decide: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rows`` without those whose ``doc_id`` ``decide`` returns, decided and dropped row by row.

    Where ids are missing or repeat, ``decide`` gets a written copy of the rows with new ids, one for each row: in the order of the old
    ids, rows without one first, rows of one id in the order of their texts' hashes. So "largest" and "smallest" mean the same, and
    what is decided on one row is not done to another. The rows returned have their old ids.
    """
    own = F.col("doc_id").cast("long").alias("id")
    if rows.select(own).groupBy("id").agg(F.count("*").alias("n")).where("id is null or n > 1").isEmpty():
        return without(spark, rows, decide(rows))
    kept = f"own_{uuid.uuid4().hex}"
    # The row's place comes last in the order, so that very many equal rows are dealt to many partitions, too.
    order = [F.col("doc_id").cast("long").asc_nulls_first(), F.xxhash64(F.col("text").cast("string")), F.col(f"{kept}_at")]
    placed = rows.withColumn(f"{kept}_at", F.monotonically_increasing_id())
    named = written(spark, placed.orderBy(*order).drop(f"{kept}_at").withColumn(kept, F.col("doc_id")).withColumn(
        "doc_id", F.monotonically_increasing_id()), "named")
    return without(spark, named, decide(named)).withColumn("doc_id", F.col(kept)).select(*rows.columns)


def fingerprint(df: DataFrame) -> tuple[int, int]:
    """Row count and an order-free hash of all rows."""
    row = df.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(*df.columns)).alias("h")).first()
    return row["n"], row["h"] or 0


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node, root`` of every node with an edge; the root is the smallest node that links reach.

    ``edges`` has two long columns ``a`` and ``b``. Each round is a large-star and a small-star step: every node hands its
    neighbours to its smallest one, which halves the distances. A round's edges are a written table, so a lost executor costs
    that round only. Minima combine before each exchange, and the joins that follow may split hot nodes.
    """
    a, b = F.col("a"), F.col("b")
    table = written(spark, edges.where(a != b).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    state = fingerprint(table)
    while state[0]:
        both = table.union(table.select("v", "u")).toDF("x", "y")
        low = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.where("y > x").join(low, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = large.join(low, "u")
        small = pairs.select("u", F.col("m").alias("v")).union(
            pairs.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        table = written(spark, small.distinct(), "edges")
        before, state = state, fingerprint(table)
        if state == before:
            break
    roots = table.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select("root", "root").distinct())
