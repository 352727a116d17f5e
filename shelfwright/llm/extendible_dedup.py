"""Exact dedup through an extendible-hash index on shared files, in DataFrame operations only.

A text's key is the 64-bit hash of its normalised form (A-Z lower-cased, a null is empty). The index is a directory over the
top bits of the key and bucket files that it points to. The directory is a written table, an entry for each value of its top bits with the
bucket that owns it. A bucket that would hold more than ``capacity`` chains is split by its next bit, and the directory doubles
where that bit is beyond its depth; nothing bounds the depth but the 64 bits, and different keys always part there. The table is made
from counts of different keys by cell, summed up for all shorter prefixes: a bucket is the shortest prefix that fits.

Each row finds its owner by the directory. A chain is what one key of a bucket holds. Its rows are compared byte by byte: the
smallest and the largest text of a key are found with combination before the exchange, and if they are the same bytes, so is everything
between them. A key that holds different texts (a collision) is chained once more, by text. A group with a third of all rows leaves
each task as one row.

Owner tasks take whole buckets, that is key ranges, and write their chains sorted as ``bucket=<bits>-<prefix>`` files; ``lookup`` finds the
chain of each row in its owner's file, by bucket and key. Rows: one per input row. Of equal texts the largest ``doc_id`` stays (nulls last);
if all are null, ``keep_id`` is null and all stay. Rows that repeat both text and ``doc_id`` are kept or dropped together. Other
columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwright.llm.frames import ascii_lower, written

#: Chains in a bucket before it splits, and bits that are counted beyond those that even buckets would need.
CAPACITY, MORE_BITS = 100_000, 3


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def cell_of(key: Column, depth: int) -> Column:
    """The top ``depth`` bits of a key."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


@dataclass(frozen=True)
class Directory:
    """``buckets[i]`` is the bucket of keys whose top ``depth`` bits are i; a bucket is named by its bits and their number."""

    depth: int
    buckets: list[int]

    def bucket(self, key: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, self.buckets)), (cell_of(key, self.depth) + 1).cast("int"))


def plan_directory(cells: dict[int, int], capacity: int, max_depth: int) -> Directory:
    """The same directory from a few counts on one machine, bucket by bucket as rows would fill it; ``plan`` is held against it.

    ``cells`` counts chains by their top ``max_depth`` bits.
    """
    depth, local = 0, {(0, 0): sum(cells.values())}  # (bits, number of bits) -> chains
    while True:
        full = [b for b, n in local.items() if n > capacity and b[1] < max_depth]
        if not full:
            break
        for bits, own in full:
            del local[bits, own]
            depth = max(depth, own + 1)
            for half in (2 * bits, 2 * bits + 1):
                low = half << (max_depth - own - 1)
                local[half, own + 1] = sum(n for c, n in cells.items() if low <= c < low + (1 << (max_depth - own - 1)))
    buckets = [0] * (1 << depth)
    for i, (bits, own) in enumerate(sorted(local, key=lambda b: b[0] / (1 << b[1]))):
        for entry in range(bits << (depth - own), (bits + 1) << (depth - own)):
            buckets[entry] = i
    return Directory(depth, buckets)


def plan(spark: SparkSession, keys: DataFrame, capacity: int = CAPACITY, depth: int | None = None) -> tuple[DataFrame, int]:
    """The directory as a table ``entry, bucket``, and its depth. ``keys`` has each key once; ``depth`` bits are counted first."""
    if depth is None:
        depth = max(1, math.ceil(math.log2(max(keys.count() / capacity, 1))) + MORE_BITS)
    while True:
        cells = written(spark, keys.groupBy(cell_of(F.col("key"), depth).alias("cell")).agg(F.count("*").alias("n")), "cells")
        if depth == 64 or cells.where(F.col("n") > capacity).isEmpty():
            break
        depth = min(depth + 8, 64)

    def prefix(own: Column) -> Column:
        return F.when(own == 0, F.lit(0).cast("long")).otherwise(F.expr(f"shiftrightunsigned(cell, {depth} - own)"))

    levels = cells.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("own")).withColumn("bits", prefix(F.col("own")))
    sums = levels.groupBy("own", "bits").agg(F.sum("n").alias("chains"))
    fits = levels.select("cell", "own", "bits").join(sums, ["own", "bits"]).where((F.col("chains") <= capacity) | (F.col("own") == depth))
    owners = written(spark, fits.groupBy("cell").agg(F.min(F.struct("own", "bits")).alias("b")).select("cell", "b.own", "b.bits"), "owners")
    used = owners.agg(F.max("own")).first()[0] or 0
    entry = F.lit(0).cast("long") if used == 0 else F.expr(f"shiftrightunsigned(cell, {depth - used})")
    entries = owners.select(entry.alias("entry"), F.concat_ws("-", "own", "bits").alias("bucket")).distinct()
    return written(spark, entries, "directory"), used


def place(rows: DataFrame, directory: DataFrame, depth: int) -> DataFrame:
    """``rows`` with the bucket that owns their key."""
    return rows.withColumn("entry", cell_of(F.col("key"), depth)).join(directory, "entry").drop("entry")


def _chains(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``bucket, key, text_sha256, keep_id, group_size``: one row for each different text."""
    sizes = [F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")]
    found = written(spark, rows.groupBy("bucket", "key").agg(
        *sizes, F.min("norm").alias("lo"), F.max("norm").alias("hi")).select(
        "bucket", "key", "keep_id", "group_size", F.sha2("lo", 256).alias("text_sha256"), (F.col("lo") != F.col("hi")).alias("mixed")), "chains")
    columns = ["bucket", "key", "text_sha256", "keep_id", "group_size"]
    mixed = found.where("mixed").select("bucket", "key")
    if mixed.isEmpty():
        return found.select(*columns, F.lit(False).alias("mixed"))
    again = rows.join(mixed, ["bucket", "key"]).groupBy("bucket", "key", "norm").agg(*sizes).withColumn("text_sha256", F.sha2("norm", 256))
    return found.where("not mixed").select(*columns, "mixed").union(again.select(*columns, F.lit(True)))


def build_index(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The bucket files as a table. ``rows``: ``doc_id, norm, key, bucket``."""
    owned = _chains(spark, rows).repartition("bucket").sortWithinPartitions("bucket", "key")
    return written(spark, owned.select("key", "text_sha256", "keep_id", "group_size", "mixed", "bucket"), "index", "bucket")


def lookup(rows: DataFrame, index: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of each row from its owner's file, by key and, where a key holds several texts, text."""
    own = ["bucket", "key"]
    found = rows.select("doc_id", *own).join(index.where("not mixed").select(*own, "keep_id", "group_size", "text_sha256"), own)
    mixed = index.where("mixed").select(*own, "keep_id", "group_size", "text_sha256")
    if not mixed.isEmpty():
        texts = rows.join(mixed.select(*own).distinct(), own, "left_semi").select("doc_id", *own, F.sha2("norm", 256).alias("text_sha256"))
        found = found.unionByName(texts.join(mixed, [*own, "text_sha256"]))
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def mark_copies(
    spark: SparkSession, documents: DataFrame, capacity: int = CAPACITY, depth: int | None = None, key=text_key
) -> DataFrame:
    """Every document with the row that stays for its text."""
    norm = documents.select(F.col("doc_id").cast("long"), ascii_lower(F.col("text")).alias("norm"))
    rows = norm.withColumn("key", key(F.col("norm")))
    keys = written(spark, rows.select("key").distinct(), "keys")
    placed = place(rows, *plan(spark, keys, capacity, depth))
    return lookup(placed, build_index(spark, placed))
