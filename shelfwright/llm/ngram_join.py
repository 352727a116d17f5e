"""Size-aware heavy-light Jaccard join of word shingles.

Two documents link when their sets of five-word shingles have a Jaccard similarity of ``percent`` / 100 or more. Equal sets
are one representative from the start, so copies never meet as pairs. Then:

* **Light sets** (up to ``boundary`` shingles) enumerate the subsets of the size that a link needs. For sizes s >= r a link is
  a common subset of c(s, r) shingles, so equal keys (s, r, subset) *are* links; a key's members are joined to its smallest
  one, not to each other.
* **Heavy sets** scan inverted lists. A set's shingles are ordered by how many sets have them (rarest first); only the first
  n - ceil(t n) + 1 go into the lists, with their place, which bounds the overlap that can still follow. Passages that many
  documents share come last in that order and hardly reach the lists.
* ``boundary`` is where the subsets of one set begin to cost more than the lists it would scan (``choose_boundary``).

A set with more than n - ceil(t n) shingles that no other document has cannot link. Two counts find these sets: first, over all
documents, of the shingles whose hash is below ``UNIVERSE`` (about a third, which is enough to prove it for most); then, over
the sets that are left, of all shingles, which also gives the order. A bit table of fixed size tells a pass over the sets
which shingles are shared; a wrong bit only lets a set through. Counts decide order and work, never the result.

Lists are first compared with one leader each (the member with the fewest shingles of its own, usually the original of a
family); what that links is one component. Only then do pairs across components meet, so a family of thousands of near
copies costs a row per member. Every candidate is verified on the whole sets.

Rows: one per input row. A null or blank text has an empty set and its own ``doc_id`` as component. A null ``doc_id`` keeps
its row with a null component and links nothing. Rows that repeat a ``doc_id`` are one node. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwright.llm.frames import components, small_batches, written
from shelfwright.llm.memory import release
from shelfwright.llm.shingles import shingle_sets, signature

PERCENT = 80
#: Sizes for which subsets may be enumerated at all.
LIGHT_LIMIT = 15
#: Shingles with a hash below it are counted.
UNIVERSE = np.uint64(int(0.35 * 2**64))
#: Bits of the table of shared shingles: at least, at most, and for each shared shingle.
BITS_MIN, BITS_MAX, BITS_EACH = 1 << 16, 1 << 28, 16
_SLOT = 1 << 16


def needed(n: int, m: int, percent: int = PERCENT) -> int:
    """Smallest overlap with which sets of n and m shingles link."""
    return -(-percent * (n + m) // (100 + percent))


def prefix(n: int, percent: int = PERCENT) -> int:
    """How many of n ordered shingles hold one of every possible partner."""
    return n + (-percent * n // 100) + 1


def choose_boundary(sizes: dict[int, int], list_length: float, percent: int = PERCENT) -> int:
    """Largest size of light sets at the least total cost.

    ``sizes`` counts the sets of each size up to ``LIGHT_LIMIT``; ``list_length`` is how many sets an entry's list holds on average.
    """
    def cost(boundary: int) -> float:
        subsets = sum(k * sum(math.comb(n, c) for _, _, c, _ in roles(n, boundary, percent))
                      for n, k in sizes.items() if n <= boundary)
        return subsets + sum(k * prefix(n, percent) * list_length for n, k in sizes.items() if n > boundary)

    return min(range(1, LIGHT_LIMIT + 1), key=lambda b: (cost(b), b))


def roles(n: int, boundary: int, percent: int = PERCENT) -> list[tuple[int, int, int, int]]:
    """Larger size, smaller size, subset size and side of a set of n shingles for each size that it can link with."""
    found = []
    for m in range(1, boundary + 1):
        if 100 * min(n, m) >= percent * max(n, m):
            found.append((max(n, m), min(n, m), needed(n, m, percent), (n > m) - (n < m)))
    return found


def _shared_counts(texts: DataFrame) -> DataFrame:
    """``shingle, df`` of counted shingles that two documents or more have."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets in shingle_sets(batch.column(0)):
                flat = np.concatenate([s[:np.searchsorted(s, UNIVERSE)] for s in sets])
                yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64))], ["shingle"])
        release()

    found = texts.select("text").mapInArrow(emit, "shingle long")
    return found.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")


def _bit_table(shared: DataFrame, n_shared: int) -> np.ndarray:
    """Bit for each shared shingle, by the low bits of its hash; at most ``BITS_MAX`` bits reach the driver."""
    bits = min(BITS_MAX, max(BITS_MIN, 1 << (BITS_EACH * max(1, n_shared) - 1).bit_length()))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False)
            for slot in np.unique(at // _SLOT):
                own = seen.setdefault(int(slot), np.zeros(_SLOT, bool))
                own[at[at // _SLOT == slot] % _SLOT] = True
        for slot, own in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array([slot]), pa.array([np.packbits(own).tobytes()])], ["slot", "bits"])

    at = F.col("shingle").bitwiseAND(F.lit(bits - 1))
    dealt = shared.select(at.alias("at")).repartition(F.expr(f"at div {_SLOT}"))
    table = np.zeros(bits // 8, np.uint8)
    for row in dealt.mapInArrow(pack, "slot long, bits binary").collect():
        table[row["slot"] * (_SLOT // 8):(row["slot"] + 1) * (_SLOT // 8)] = np.frombuffer(row["bits"], np.uint8)
    return table


def _is_set(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(len(table) * 8 - 1)
    return (table[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & np.uint8(1) == 1


def _sets(spark: SparkSession, texts: DataFrame, table: np.ndarray, percent: int) -> DataFrame:
    """``doc_id, n, sig1, sig2, whole`` per document; ``whole`` is the set where it is light or may have a partner, else null."""
    held = spark.sparkContext.broadcast(table)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in shingle_sets(batch.column(1)):
                rows: list[tuple] = []
                for own in sets:
                    counted = own[:np.searchsorted(own, UNIVERSE)]
                    alone = len(counted) - int(_is_set(held.value, counted).sum())
                    keep = len(own) <= LIGHT_LIMIT or alone < prefix(len(own), percent)
                    rows.append((len(own), *signature(own), own.view(np.int64) if keep else None))
                n, one, two, whole = zip(*rows, strict=True)
                long = pa.int64()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(sets)), *(pa.array(c, long) for c in (n, one, two)), pa.array(whole, pa.list_(long))],
                    ["doc_id", "n", "sig1", "sig2", "whole"])
        release()

    return texts.select("doc_id", "text").mapInArrow(emit, "doc_id long, n long, sig1 long, sig2 long, whole array<long>")


def _open_sets(spark: SparkSession, reps: DataFrame, table: np.ndarray, percent: int) -> DataFrame:
    """``doc, n, shared`` of the sets that may have a partner: ``shared`` has the shingles that another set may have."""
    held = spark.sparkContext.broadcast(table)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, whole in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = whole.values.to_numpy(zero_copy_only=False)
                shared = own[_is_set(held.value, own.view(np.uint64))]
                if len(own) - len(shared) < prefix(len(own), percent):
                    rows.append((doc, len(own), shared))
            doc, n, shared = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(shared, pa.list_(pa.int64()))], ["doc", "n", "shared"])
        release()

    return reps.select("rep", "whole").mapInArrow(emit, "doc long, n long, shared array<long>")


def _subset_links(light: DataFrame, boundary: int, percent: int) -> DataFrame:
    """Links among light sets: members of a subset's key to the smallest member of the other size."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys, sides = [], []
                for large, small, c, side in roles(len(whole), boundary, percent):
                    for subset in itertools.combinations(whole, c):
                        keys.append(blake2b(np.array([large, small, *subset], np.int64).tobytes(), digest_size=16).digest())
                        sides.append(side)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(sides, pa.int64()), pa.array([doc] * len(keys), pa.int64())],
                    ["key", "side", "doc"])

    entries = light.select("rep", "whole").mapInArrow(emit, "key binary, side long, doc long")
    at = F.col("side")
    lows = entries.groupBy("key").agg(
        F.count("*").alias("k"), F.min(F.when(at >= 0, F.col("doc"))).alias("of_large"),
        F.min(F.when(at <= 0, F.col("doc"))).alias("of_small")).where("k > 1 and of_large is not null and of_small is not null")
    other = F.when(at > 0, F.col("of_small")).otherwise(F.col("of_large"))
    return entries.join(lows, "key").select(F.col("doc").alias("a"), other.alias("b")).where("a <> b").distinct()


def _entries(spark: SparkSession, reps: DataFrame, percent: int) -> tuple[DataFrame, float]:
    """Inverted lists ``shingle, doc, n, place, own`` of each prefix, and the length of the list that an entry has on average.

    ``own`` is the share of shingles that no other set has.
    """
    counts = reps.select(F.explode("whole").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    shared = written(spark, counts, "shared")
    total = shared.agg(F.count("*").alias("n"), F.sum("df").alias("s"), F.sum(F.col("df").cast("double") ** 2).alias("q")).first()
    open_ = _open_sets(spark, reps, _bit_table(shared, total["n"]), percent)
    listed = open_.select("doc", "n", F.explode("shared").alias("shingle")).join(shared, "shingle")
    alone = F.col("n") - F.expr("count(*) over (partition by doc)")
    order = F.expr("row_number() over (partition by doc order by df, shingle)")
    ranked = listed.select("shingle", "doc", "n", (alone + order - 1).alias("place"), (alone / F.col("n")).alias("own"))
    cut = F.expr(f"place < n - cast(ceil({percent} * n / 100.0) as bigint) + 1")
    return ranked.where(cut), (total["q"] or 0) / (total["s"] or 1)


def _possible(left: str, right: str, boundary: int, percent: int) -> Column:
    """Whether sizes and places of one common entry allow a link with one heavy set at least."""
    return F.expr(
        f"100 * least({left}.n, {right}.n) >= {percent} * greatest({left}.n, {right}.n)"
        f" and greatest({left}.n, {right}.n) > {boundary}"
        f" and (100 + {percent}) * least({left}.n - {left}.place, {right}.n - {right}.place) >= {percent} * ({left}.n + {right}.n)")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose whole sets overlap enough."""
    one = sets.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("whole").alias("of_a"))
    two = sets.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("whole").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    return pairs.join(one, "a").join(two, "b").where(
        (100 + percent) * both >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def link_components(spark: SparkSession, documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    small_batches(spark)
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    shared = written(spark, _shared_counts(texts), "counted")
    sets = written(spark, _sets(spark, texts, _bit_table(shared, shared.count()), percent), "sets")

    usable = sets.where("n > 0 and doc_id is not null")
    # Written, so that the joins with it may split the rows of a large group of copies.
    members = written(spark, usable.groupBy("n", "sig1", "sig2").agg(F.min("doc_id").alias("rep")), "members")
    open_ = usable.where("whole is not null").select("doc_id", "n", "sig1", "sig2", "whole")
    reps = written(spark, open_.join(members, ["n", "sig1", "sig2"]).where("doc_id = rep").select("rep", "n", "whole"), "reps")

    entries, list_length = _entries(spark, reps, percent)
    sizes = {r["n"]: r["k"] for r in reps.where(F.col("n") <= LIGHT_LIMIT).groupBy("n").agg(F.count("*").alias("k")).collect()}
    boundary = choose_boundary(sizes, list_length, percent)
    links = _subset_links(reps.where(F.col("n") <= boundary), boundary, percent)

    smallest = -(-percent * (boundary + 1) // 100)
    entries = written(spark, entries.where(F.col("n") >= smallest), "entries")
    leads = entries.groupBy("shingle").agg(
        F.count("*").alias("k"), F.min(F.struct("own", "doc", "n", "place")).alias("r")).where("k > 1")
    starred = entries.alias("l").join(leads, "shingle").where(_possible("l", "r", boundary, percent)).selectExpr(
        "l.doc a", "r.doc b").where("a <> b").distinct()
    starred = written(spark, starred, "starred")
    links = written(spark, links.union(_verified(starred, reps, percent)), "links")

    roots = components(spark, links)
    labelled = entries.join(roots.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
        "root", F.coalesce("root", "doc"))
    mixed = labelled.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("shingle")
    across = written(spark, labelled.join(mixed, "shingle"), "across")
    pairs = across.alias("l").join(across.alias("r"), "shingle").where(
        F.expr("l.doc < r.doc and l.root <> r.root") & _possible("l", "r", boundary, percent)).selectExpr(
        "l.doc a", "r.doc b").distinct()
    tried = starred.selectExpr("least(a, b) a", "greatest(a, b) b").distinct()
    late = _verified(pairs.join(tried, ["a", "b"], "left_anti"), reps, percent)
    roots = components(spark, roots.selectExpr("node a", "root b").union(late))

    named = usable.select("doc_id", "n", "sig1", "sig2").join(members, ["n", "sig1", "sig2"]).join(
        roots.withColumnRenamed("node", "rep"), "rep", "left")
    linked = named.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "rep").alias("component_id"))
    return linked.union(sets.where("n = 0 or doc_id is null").select("doc_id", "n", F.when(F.col("n") == 0, F.col("doc_id"))))
