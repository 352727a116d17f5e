"""Structured Streaming twins of the batch jobs.

A micro-batch writes its own folder ``run=<id>/batch_id=<n>`` in overwrite mode. The run id is the streaming query's, which lives in
its checkpoint: a batch that is replayed after a failure replaces its first attempt, and a start with a new checkpoint, whose
batch numbers begin at 0 again, never touches what earlier runs wrote. What all other folders hold is the state; nothing grows
in memory.

Stores of keyed rows are also split into ``SHARDS`` folders by a hash of the key, and a batch reads only the shards that it has
keys of.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfwright.functions.ids import url_hash
from shelfwright.operators.latest import latest_by_key
from shelfwright.operators.merge import append_new, append_stored
from shelfwright.session import shuffles_freed

Order = Sequence[str | Column]
SHARDS = 16
#: Of a store's own columns.
_RUN, _BATCH, _SHARD = "run", "batch_id", "shard"


def _store_schema(schema: T.StructType, sharded: bool) -> T.StructType:
    own = [T.StructField(_RUN, T.StringType()), T.StructField(_BATCH, T.LongType())]
    return T.StructType([*schema.fields, *own, *([T.StructField(_SHARD, T.IntegerType())] if sharded else [])])


def _open(spark: SparkSession, path: str, schema: T.StructType, sharded: bool) -> DataFrame | None:
    try:
        return spark.read.schema(_store_schema(schema, sharded)).option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType, besides: tuple[str, int] | None = None, sharded: bool = True,
) -> DataFrame | None:
    """Rows written so far, without those of the folder ``besides`` (run, batch); NULL when there is no store yet."""
    rows = _open(spark, path, schema, sharded)
    if rows is None or besides is None:
        return rows
    return rows.where(~((F.col(_RUN) == besides[0]) & (F.col(_BATCH) == besides[1])))


def _run_of(batch: DataFrame, checkpoint: str) -> str:
    """The streaming query's id; where the session does not tell it, one made of the checkpoint's path."""
    try:
        found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    except Exception:  # no Spark context in a remote session
        found = None
    return found or hashlib.sha256(checkpoint.encode()).hexdigest()[:32]


def each_batch(stream: DataFrame, step: Callable[[DataFrame, str, int], None], checkpoint: str, trigger: dict | None) -> StreamingQuery:
    """Give ``step`` each batch with the run's id and the batch's number."""
    def each(batch: DataFrame, batch_id: int) -> None:
        step(batch, _run_of(batch, checkpoint), batch_id)

    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def _shard(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SHARDS)).cast("int")


def append_batch(
    batch: DataFrame, path: str, schema: T.StructType, key: str, order: Order, run: str, batch_id: int, codec: str | None = None, stored: bool = False,
) -> None:
    """Write the batch's keys that no other folder of the store has. ``stored`` says that the batch is a written table: then only repeats are exchanged as rows."""
    spark = batch.sparkSession
    seen = read_batches(spark, path, schema, besides=(run, batch_id))
    if seen is not None:
        touched = [r[0] for r in batch.select(_shard(key)).distinct().collect()]  # at most SHARDS
        seen = seen.where(F.col(_SHARD).isin(touched)) if len(touched) < SHARDS else seen
    rows = (append_stored if stored else append_new)(seen, batch, key, order).withColumn(_SHARD, _shard(key))
    with shuffles_freed(spark):
        (rows.write if codec is None else rows.write.option("compression", codec)).mode("overwrite").partitionBy(_SHARD).parquet(
            f"{path}/{_RUN}={run}/{_BATCH}={batch_id}")


def ingest(
    stream: DataFrame, path: str, checkpoint: str, key: str, order: Order, trigger: dict | None = None
) -> StreamingQuery:
    """Append each key once: the first arrival wins, as in the batch load.

    ``trigger`` holds the arguments of ``DataStreamWriter.trigger``; the default takes what is there and ends.
    """
    schema = stream.schema

    def step(batch: DataFrame, run: str, batch_id: int) -> None:
        append_batch(batch, path, schema, key, order, run, batch_id)

    return each_batch(stream, step, checkpoint, trigger)


def dedup_within(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """Drop repeats of ``key`` that arrive within ``delay``; state is bounded by it."""
    moment = F.col(time).cast("timestamp")
    return stream.withColumn(time, moment).withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def latest(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], time: str, tie: Order, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the newest row per key; rows that arrive late lose by their time.

    A batch writes only its own newest rows; ``current_state`` settles them and ``compact_state`` shortens what it reads.
    """
    def step(batch: DataFrame, run: str, batch_id: int) -> None:
        rows = latest_by_key(batch, keys, time, tie)
        rows.write.mode("overwrite").parquet(f"{path}/{_RUN}={run}/{_BATCH}={batch_id}")

    return each_batch(stream, step, checkpoint, trigger)


def current_state(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], time: str, tie: Order
) -> DataFrame:
    """Newest row per key over all batches of all runs."""
    rows = read_batches(spark, path, schema, sharded=False)
    if rows is None:
        return spark.createDataFrame([], schema)
    return latest_by_key(rows.drop(_RUN, _BATCH), keys, time, tie)


def compact_state(
    spark: SparkSession, path: str, out: str, schema: T.StructType, keys: Sequence[str], time: str, tie: Order
) -> None:
    """Write the settled state to a new folder, as a run of its own: streams may go on there with any checkpoint."""
    state = current_state(spark, path, schema, keys, time, tie)
    state.write.parquet(f"{out}/{_RUN}=compacted-{uuid.uuid4().hex}/{_BATCH}=0")


def new_products(
    stream: DataFrame, path: str, checkpoint: str, order: Order, index: DataFrame | None = None, url: str = "product_url",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Emit every url once that neither the index nor another batch has."""
    hashed = stream.withColumn("url_hash", url_hash(F.col(url)))
    schema = hashed.schema

    def step(batch: DataFrame, run: str, batch_id: int) -> None:
        fresh = batch
        if index is not None:
            fresh = fresh.join(index.select("url_hash").distinct(), "url_hash", "left_anti").select(*batch.columns)
        append_batch(fresh, path, schema, "url_hash", order, run, batch_id)

    return each_batch(hashed, step, checkpoint, trigger)
