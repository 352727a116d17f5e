"""Streams with keyed state: a batch costs its own keys, not the history."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from shelfwright.streaming.jobs import dedup_within

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SEEN, _NEVER = "seen", -(1 << 63)


class _First(StatefulProcessor):
    """Per key the row that came first, once; of one batch the row with the smallest tie. The state is a mark."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState(_SEEN, "yes boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        if self.seen.exists():
            for _ in rows:
                pass
            return
        found = min(row for frame in rows for row in frame[["tie_key", "packed"]].itertuples(index=False, name=None))
        self.seen.update((True,))
        yield pd.DataFrame({"packed": [found[1]]})

    def close(self) -> None:
        pass


@contextmanager
def _state_store(spark: SparkSession) -> Iterator[None]:
    """A query takes the provider that is set when it starts."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def _micros(time: Column, kind: T.DataType) -> Column:
    moment = F.unix_micros(time.cast("timestamp")) if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)) else time.cast("bigint")
    return F.coalesce(moment, F.lit(_NEVER))


def _packed(schema: T.StructType) -> Column:
    """A row as JSON without loss: moments as microseconds."""
    moments = (T.TimestampType, T.TimestampNTZType)
    return F.to_json(F.struct(*[
        F.unix_micros(F.col(f.name).cast("timestamp")).alias(f.name) if isinstance(f.dataType, moments) else F.col(f.name) for f in schema.fields]))


def _unpacked(row: Column, schema: T.StructType) -> list[Column]:
    moments = (T.TimestampType, T.TimestampNTZType)
    stored = T.StructType([T.StructField(f.name, T.LongType() if isinstance(f.dataType, moments) else f.dataType) for f in schema.fields])
    value = F.from_json(row, stored)
    return [
        (F.timestamp_micros(value[f.name]).cast(f.dataType) if isinstance(f.dataType, moments) else value[f.name]).alias(f.name)
        for f in schema.fields]


def latest(
    stream: DataFrame, checkpoint: str, keys: Sequence[str], time: str, tie: str, trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the newest row per key in the state store; rows that arrive late lose by their time, rows without a time to all others.

    ``tie`` is a whole-number or text column without NULLs; the smallest wins among equal times. The state is a native minimum, which combines
    inside each task before the exchange. Emits the rows of a batch's keys in update mode (here to nowhere; ``current`` reads the state).
    """
    schema = stream.schema
    kind = "string" if isinstance(schema[tie].dataType, T.StringType) else "long"
    # All bits of the time are turned over, so the newest is the smallest, as the tie is.
    age = F.bitwise_not(_micros(F.col(time), schema[time].dataType)).alias("age")
    packed = stream.select(*keys, F.struct(age, F.col(tie).cast(kind).alias("tie"), _packed(schema).alias("row")).alias("packed"))
    with _state_store(stream.sparkSession):
        changed = packed.groupBy(*keys).agg(F.min("packed").alias("newest"))
        return (changed.select(*_unpacked(F.col("newest.row"), schema)).writeStream.format("noop").outputMode("update")
                .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def current(spark: SparkSession, checkpoint: str, schema: T.StructType) -> DataFrame:
    """Newest row per key, from the state store: as many rows as there are keys."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(*_unpacked(F.col("value.min.row"), schema))


def _least(keys: Sequence[str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.sort_values(["tie_key", "packed"]).drop_duplicates(list(keys))

    return run


def first(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], tie: str, known: DataFrame | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """Append each key's first row to ``path``, once over all batches and starts; keys of ``known`` never.

    The state store answers whether a key was there, so a batch costs its own keys and reads nothing that earlier ones wrote. Of one batch
    the row with the smallest ``tie`` (a whole-number or text column without NULLs) counts. Repeats are dropped inside each task before
    the exchange, so that a key with very many rows crosses it as a few. ``known`` has the ``keys`` and is joined with each batch.
    """
    schema = stream.schema
    kind = "string" if isinstance(schema[tie].dataType, T.StringType) else "long"
    rows = stream if known is None else stream.join(known.select(*keys).distinct(), list(keys), "left_anti")
    packed = rows.select(*keys, F.col(tie).cast(kind).alias("tie_key"), _packed(schema).alias("packed"))
    packed = packed.mapInPandas(_least(keys), packed.schema)
    with _state_store(stream.sparkSession):
        new = packed.groupBy(*keys).transformWithStateInPandas(_First(), "packed string", "Append", "None")
        return (new.select(*_unpacked(F.col("packed"), schema)).writeStream.format("parquet").outputMode("append").option("path", path)
                .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def dedup_counted(
    stream: DataFrame, path: str, checkpoint: str, key: str, time: str, delay: str, trigger: dict | None = None,
) -> StreamingQuery:
    """Append rows to ``path`` without repeats of ``key`` within ``delay`` and without late rows; ``dropped`` counts both."""
    return (dedup_within(stream, key, time, delay).writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def dropped(query: StreamingQuery) -> dict[str, int]:
    """Late and repeated rows that the query's stateful operators dropped, from its progress reports."""
    operators = [o for progress in query.recentProgress for o in progress.stateOperators]
    return {
        "late": sum(o.numRowsDroppedByWatermark for o in operators),
        "repeated": sum(int((o.customMetrics or {}).get("numDroppedDuplicateRows", 0)) for o in operators),
    }
