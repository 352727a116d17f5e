"""Idempotent writes: append by key, upsert, and snapshots that switch at once."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwright.operators.latest import first_by_key
from shelfwright.session import written

#: Repeated hashes, of 8 bytes each, whose table is below Catalyst's limit for broadcasts.
REPEATS = 500_000


def append_new(
    target: DataFrame | None, batch: DataFrame, key: str, order: Sequence[str | Column],
    prune: str | None = None,
) -> DataFrame:
    """Rows of ``batch`` to add: the first per key, unless the target has the key.

    The batch is exchanged once on ``key``; the ranking and the anti join share
    that partitioning. ``prune`` names a column the key determines (for instance
    the observation date): only target rows inside the batch's range of it are
    read, and those without a value if the batch has such rows.
    """
    first = first_by_key(batch, [key], order)
    if target is None:
        return first
    if prune:
        lo, hi = batch.agg(F.min(prune)).scalar(), batch.agg(F.max(prune)).scalar()
        blank = batch.agg(F.coalesce(F.bool_or(F.col(prune).isNull()), F.lit(False))).scalar()
        target = target.where(F.col(prune).between(lo, hi) | (F.col(prune).isNull() & blank))
    return first.join(target.select(key), key, "left_anti")


def append_stored(target: DataFrame | None, batch: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """``append_new`` for a written table: only rows whose key may occur again are exchanged.

    A short hash of every key is exchanged, the target's too. A row whose hash occurs once is added as it is; the others are ranked
    and looked up as whole rows. A table of the repeated hashes, small enough for Catalyst to broadcast, tells them apart; with more
    than ``REPEATS`` of them all rows are exchanged. ``batch`` is read three times.
    """
    keyed = batch.withColumn("_key", F.xxhash64(key))
    keys = keyed.select("_key")
    if target is not None:
        keys = keys.union(target.select(F.xxhash64(key)))
    spark = batch.sparkSession
    again = written(spark, keys.groupBy("_key").agg(F.count("*").alias("n")).where("n > 1").select("_key"), "again")
    if again.count() > REPEATS:
        return append_new(target, batch, key, order).select(*batch.columns)
    lone = keyed.join(again, "_key", "left_anti").drop("_key")
    repeats = append_new(target, keyed.join(again, "_key", "left_semi").drop("_key"), key, order)
    return lone.select(*batch.columns).union(written(spark, repeats.select(*batch.columns), "repeats"))


def append_preview(target: DataFrame | None, batch: DataFrame, key: str) -> DataFrame:
    """What ``append_new`` would do per key: rows, inserts and duplicates."""
    per_key = batch.groupBy(key).agg(F.count("*").alias("n_rows"))
    if target is None:
        marked = per_key.withColumn("_known", F.lit(False))
    else:
        known = target.select(key).distinct().withColumn("_hit", F.lit(True))
        marked = per_key.join(known, key, "left").select(
            *per_key.columns, F.col("_hit").isNotNull().alias("_known")
        )
    inserts = F.when(F.col("_known"), 0).otherwise(1).cast("bigint")
    return marked.withColumn("inserted", inserts).withColumn(
        "duplicates", F.col("n_rows") - F.col("inserted")
    ).drop("_known")


def conform_to_target(batch: DataFrame, target: T.StructType) -> DataFrame:
    """Columns and types of the target; what it lacks is left out.

    Optional target columns that the batch lacks become NULL. A value that does
    not fit the target's type is an error, as in a table's own insert.
    """
    return batch.select(*[
        (F.col(f.name) if f.name in batch.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields
    ])


def upsert(
    target: DataFrame, batch: DataFrame, key: str, now: Column, order: Sequence[str | Column]
) -> DataFrame:
    """New state of ``target``: batch rows replace all non-key columns.

    ``created_at`` survives an update, ``updated_at`` becomes ``now`` on every
    row the batch touches. With repeats of a key in the batch the first in
    ``order``, which must tell them apart, wins.
    """
    source = first_by_key(batch, [key], order)
    payload = [c for c in source.columns if c != key]
    renamed = source.select(key, *[F.col(c).alias(f"_new_{c}") for c in payload], F.lit(True).alias("_hit"))
    merged = target.join(renamed, key, "full_outer")
    hit = F.col("_hit").isNotNull()
    columns = []
    for c in target.columns:
        if c == key:
            columns.append(F.col(key))
        elif c == "created_at":
            columns.append(F.coalesce(F.col(c), now).alias(c))
        elif c == "updated_at":
            columns.append(F.when(hit, now).otherwise(F.col(c)).alias(c))
        elif c in payload:
            columns.append(F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(c))
    return merged.select(*columns)


def key_range(key: str, digits: int = 2) -> Column:
    """Range of content ids that a row belongs to: the first digits of the hash, so ranges are even; 256 of them for two."""
    return F.substring(F.substring_index(key, "_", -1), 1, digits)


def rewrite_parts(
    spark: SparkSession, path: str, new: DataFrame, part: str, merge: Callable[[DataFrame, DataFrame], DataFrame], staged: bool = True,
) -> list:
    """Merge ``new`` into a table partitioned by ``part``, reading and writing only the parts that ``new`` has rows of.

    ``merge`` gets the stored rows of those parts and the new rows. The result replaces the parts when the whole job has ended
    (dynamic partition overwrite), so a failed write leaves the table as it was. Returns the parts.

    Without ``staged`` the new rows are not written first but read twice, and the merged rows are written by the tasks that merged
    them: nothing is exchanged for the write. New rows that have other parts at the second reading end the job.
    """
    new = written(spark, new, "new-rows") if staged else new
    touched = [r[0] for r in new.select(part).distinct().collect()]  # as many as the table has parts
    schema = T.StructType([*[f for f in new.schema.fields if f.name != part], new.schema[part]])
    try:
        old = spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        old = spark.createDataFrame([], schema)
    if not staged:
        changed = F.raise_error(F.lit("the new rows changed while they were merged")).cast("boolean")
        new = new.where(F.when(F.col(part).isin(touched), F.lit(True)).otherwise(changed))
    rows = merge(old.where(F.col(part).isin(touched)), new.select(*schema.names)).select(*schema.names)
    rows = rows.repartition(part) if staged else rows
    rows.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(part).parquet(path)
    return touched


def upsert_parts(
    spark: SparkSession, path: str, batch: DataFrame, key: str, now: Column, order: Sequence[str | Column], digits: int = 2,
) -> list:
    """Upsert by key into a table in key ranges; ranges without a batch row are neither read nor written.

    Several related relations can be one table with a struct for each: then they change together. ``created_at`` and
    ``updated_at`` are added.
    """
    stamped = first_by_key(batch, [key], order).withColumns({"created_at": now, "updated_at": now, "key_range": key_range(key, digits)})

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        rows = upsert(old.drop("key_range"), new.drop("key_range", "created_at", "updated_at"), key, now, [F.lit(1)])
        return rows.withColumn("key_range", key_range(key, digits))

    return rewrite_parts(spark, path, stamped, "key_range", merge)


class RejectedLoad(ValueError):
    """A load was refused before anything became visible."""


def load_all(
    spark: SparkSession, base: str, tables: dict[str, DataFrame], problems: dict[str, DataFrame]
) -> str:
    """Write related tables as one new version of ``base``, all or nothing.

    Every frame in ``problems`` must be empty. Tables go to a new version folder
    and become current by one small pointer write at the end, so a failed write
    leaves the previous version in place. A load that finds at its end that another
    one became current meanwhile is refused: it has not seen that one's rows.
    """
    before = current_version(spark, base)
    for name, frame in problems.items():
        bad = frame.limit(5).collect()
        if bad:
            raise RejectedLoad(f"{name}: {[r.asDict() for r in bad]}")
    version = f"version-{uuid.uuid4().hex}"
    for name, frame in tables.items():
        frame.write.parquet(f"{base}/{version}/{name}")
    if current_version(spark, base) != before:
        raise RejectedLoad(f"{base}: another load became current, run this one again")
    pointer = spark.createDataFrame([(version,)], "version string").coalesce(1)
    pointer.withColumn("seq", F.current_timestamp()).write.mode("append").json(f"{base}/current")
    return version


def current_version(spark: SparkSession, base: str) -> str | None:
    """The version that the newest pointer names; None before the first load."""
    try:
        pointers = spark.read.schema("version string, seq timestamp").json(f"{base}/current")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    newest = pointers.orderBy(F.desc("seq"), "version").first()
    return newest["version"] if newest else None


def read_current(spark: SparkSession, base: str, table: str) -> DataFrame:
    """The table in the version that the newest pointer names."""
    return spark.read.parquet(f"{base}/{current_version(spark, base)}/{table}")


def documents(df: DataFrame, id_col: str, document: Column) -> DataFrame:
    """``id, document, shard`` of JSON documents; the first id character is the shard."""
    return df.select(
        F.col(id_col).alias("id"), document.alias("document"), F.substring(id_col, 1, 1).alias("shard")
    )


def write_documents(df: DataFrame, path: str, id_col: str, document: Column) -> None:
    """One JSON document per row, in folders by shard."""
    documents(df, id_col, document).write.partitionBy("shard").parquet(path)
