"""Join building blocks.

No function here hints a broadcast. Catalyst broadcasts a side only when its
size, known from statistics or measured by adaptive execution, is under
``spark.sql.autoBroadcastJoinThreshold``; otherwise the join shuffles both
sides and adaptive execution splits the partitions of hot keys. The lookup
side is always unique per key, so a hot key never multiplies rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def semi_split(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose key exists in ``keys``, and the others."""
    known = keys.select(*on)
    return df.join(known, list(on), "left_semi"), df.join(known, list(on), "left_anti")


def mark_known(df: DataFrame, keys: DataFrame, on: Sequence[str], out: str) -> DataFrame:
    """Add whether the key exists in ``keys``: both sides of the split in one pass."""
    known = keys.select(*on).distinct().withColumn(out, F.lit(True))
    return df.join(known, list(on), "left").withColumn(out, F.coalesce(out, F.lit(False)))


def foreign_keys(child: DataFrame, relations: Sequence[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """Missing parents: one row per relation and unknown key with its row count.

    ``relations`` holds ``(name, child_column, parent, parent_column)``. The child
    is read once: each row gives its key of every relation, and these are counted
    before the join, so a hot key shuffles as one row per task. Keys meet as text;
    NULL keys reference nothing and pass.
    """
    references = F.array(*[
        F.struct(F.lit(name).alias("relation"), F.col(child_col).cast("string").alias("key"))
        for name, child_col, _, _ in relations
    ])
    counts = (
        child.select(F.inline(references)).where("key is not null")
        .groupBy("relation", "key").agg(F.count("*").alias("n_rows"))
    )
    known = [
        parent.select(F.lit(name).alias("relation"), F.col(parent_col).cast("string").alias("key"))
        for name, _, parent, parent_col in relations
    ]
    return counts.join(reduce(DataFrame.unionByName, known), ["relation", "key"], "left_anti")


def purge_orphans(parent: DataFrame, child: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose parent survives. Chain it along a hierarchy."""
    known = parent.select(F.col(parent_key or key).alias(key))
    return child.join(known, key, "left_semi")


def prefix_join(
    left: DataFrame, right: DataFrame, text: str, prefix: str, mode: str = "all", texts: DataFrame | None = None,
    empty: bool = True,
) -> DataFrame:
    """Pairs where ``text`` starts with ``prefix``, ignoring ASCII case.

    A prefix of length ``n`` can only match the first ``n`` characters of a
    text. The distinct texts are expanded to their heads of the lengths that
    occur among the prefixes and joined by equality, so there is no nested loop
    and a text that fills a third of the table is expanded once. ``%`` and ``_``
    are plain characters; an empty prefix matches every text unless ``empty`` is false.

    ``mode='longest'`` keeps only the longest matching prefix of each text.
    ``texts`` may hold the texts of ``left`` in its only column (more do no harm),
    for instance those of a dimension: then ``left`` is evaluated once.
    The two sides must not share column names.
    """
    if mode not in ("all", "longest"):
        raise ValueError(f"unknown prefix join mode: {mode}")
    keyed = right.withColumn("_head", _fold(F.col(prefix))).where(F.col("_head").isNotNull() if empty else F.col("_head") != "")
    known = keyed.select("_head").distinct()
    # One number per prefix length: never more than the longest prefix is long.
    lengths = known.agg(F.sort_array(F.collect_set(F.length("_head")))).scalar()
    named = left.select(F.col(text).alias("_text")) if texts is None else texts.toDF("_text")
    texts = named.distinct().withColumn("_lengths", lengths)
    low = _fold(F.col("_text"))
    fitting = F.filter(F.col("_lengths"), lambda n: n <= F.length("_text"))
    heads = texts.select(
        "_text", F.explode(F.transform(fitting, lambda n: F.substring(low, F.lit(1), n))).alias("_head")
    )
    pairs = heads.join(known, "_head")
    if mode == "longest":
        pairs = pairs.groupBy("_text").agg(F.max_by("_head", F.length("_head")).alias("_head"))
    matched = left.join(pairs, left[text] == pairs["_text"]).drop("_text")
    return matched.join(keyed, "_head").drop("_head")


def _fold(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()

