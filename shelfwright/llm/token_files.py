"""Token ids in flat binary files with 64-bit document offsets.

A folder holds shards in ascending ``doc_id`` order. Shard ``<name>`` is three flat little-endian files: ``.tok`` (the ids, unsigned
16 bits if the vocabulary allows it, else 32), ``.off`` (unsigned 64 bits: where each document starts within the shard, and the
end) and ``.ids`` (signed 64 bits: each ``doc_id``). The ``manifest`` table has a row per shard with the number of ids before it:
prefix sums over the shards' totals, so a document starts at its shard's base plus its offset. The shards are read by memory map.

Documents are exchanged once, by ranges of ``doc_id``; each task encodes its range and writes its shard in a stream. A shard's name
holds a random part and the manifest names the shards of the attempts that ended, so a repeated task harms nothing; what a
failed attempt wrote is not named. The driver sees one row per shard.

Texts are encoded by the ``tokenizers`` library, cut where byte-level models with the usual pattern never join (see ``parts``): the
library sees each different part once.

Rows: one document per input row. A null or empty text has the end id only. Rows with one ``doc_id`` are ordered by text. A null
``doc_id`` comes first and is stored as the smallest 64-bit integer. Other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfwright.llm.parts import Parts
from shelfwright.llm.shingles import utf8

ROWS = 512
NO_ID = -(1 << 63)


class Encoder:
    """Ids of texts in ``dtype``, each with the end id."""

    def __init__(self, serialized: str, end_id: int, dtype: str):
        self.parts, self.end = Parts(serialized, dtype), end_id

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has."""
        ids, starts = self.parts.encode(*utf8(texts))
        counts = np.diff(starts)
        out = np.full(len(ids) + len(counts), self.end, self.parts.dtype)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
        return out, counts + 1

    def encode_all(self, texts: list[str]) -> list[bytes]:
        ids, counts = self.encode_column(pa.array(texts, pa.string()))
        return [part.tobytes() for part in np.split(ids, np.cumsum(counts)[:-1])]


_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(serialized: str, end_id: int, dtype: str) -> Encoder:
    """One for each worker process and model."""
    key = (zlib.crc32(serialized.encode()), end_id, dtype)
    if key not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives the task its core
        _ENCODERS[key] = Encoder(serialized, end_id, dtype)
    return _ENCODERS[key]


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _view(path: str, dtype: str) -> np.ndarray:
    """A flat file as an array: memory-mapped where the folder is mounted, else read."""
    store, at = _store(path)
    if not store.get_file_info(at).size:
        return np.zeros(0, dtype)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(at, dtype, "r")
    with store.open_input_file(at) as file:
        return np.frombuffer(file.read(), dtype)


def write(spark: SparkSession, documents: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode all texts into ``path``, a new folder that all executors share. ``tokenizer`` is the path of the model file."""
    with open(tokenizer, encoding="utf-8") as file:
        serialized = file.read()
    size = max(Tokenizer.from_str(serialized).get_vocab_size(), end_id + 1)
    dtype = "<u2" if size <= 1 << 16 else "<u4"
    held = spark.sparkContext.broadcast(serialized)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(held.value, end_id, dtype)
        place, name = TaskContext.get().partitionId(), ""
        store, folder = _store(path)
        lengths: list[int] = []
        ids: list[np.ndarray] = []
        tokens = None
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                if tokens is None:
                    store.create_dir(folder, recursive=True)
                    name = f"shard-{place:06d}-{uuid.uuid4().hex}"
                    tokens = store.open_output_stream(f"{folder}/{name}.tok")
                encoded, counts = encoder.encode_column(part.column(1))
                tokens.write(encoded.tobytes())
                lengths += counts.tolist()
                ids.append(part.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False))
        if tokens is None:
            return
        tokens.close()
        for suffix, values in ((".off", np.concatenate([[0], np.cumsum(lengths)]).astype("<u8")), (".ids", np.concatenate(ids).astype("<i8"))):
            with store.open_output_stream(f"{folder}/{name}{suffix}") as file:
                file.write(values.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([place]), pa.array([name]), pa.array([len(lengths)]), pa.array([sum(lengths)])], ["place", "shard", "n_docs", "n_tokens"])

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    shards = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(
        run, "place long, shard string, n_docs long, n_tokens long").collect()
    shards.sort(key=lambda s: s["place"])
    bases = np.concatenate([[0], np.cumsum([s["n_tokens"] for s in shards], dtype=np.int64)])
    spark.createDataFrame(
        [(int(b), s["shard"], s["n_docs"], s["n_tokens"], dtype) for b, s in zip(bases, shards, strict=False)],
        "base long, shard string, n_docs long, n_tokens long, dtype string").write.parquet(f"{path}/manifest")


def _shards(spark: SparkSession, path: str) -> DataFrame:
    manifest = spark.read.parquet(f"{path}/manifest").collect()
    return spark.createDataFrame(manifest, "base long, shard string, n_docs long, n_tokens long, dtype string").repartition(max(1, len(manifest)))


def _documents(path: str, shard: dict) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Doc ids, starts within the corpus and token views of each ``ROWS`` documents of a shard."""
    tokens, offsets, ids = (_view(f"{path}/{shard['shard']}{s}", d) for s, d in ((".tok", shard["dtype"]), (".off", "<u8"), (".ids", "<i8")))
    for a in range(0, len(ids), ROWS):
        off = offsets[a:a + ROWS + 1].astype(np.int64)
        yield ids[a:a + ROWS], shard["base"] + off[:-1], [tokens[x:y] for x, y in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]


def _id_column(ids: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(ids), mask=np.asarray(ids) == NO_ID)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, tokens`` of every document in the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                for ids, starts, tokens in _documents(path, shard):
                    lists = pa.array([t.astype(np.int64) for t in tokens], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([_id_column(ids), pa.array(starts), lists], ["doc_id", "start", "tokens"])

    return _shards(spark, path).mapInArrow(run, "doc_id long, start long, tokens array<long>")


def digest(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files; the checksum is of unsigned 32-bit ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                for ids, starts, tokens in _documents(path, shard):
                    crc = [zlib.crc32(t.astype("<u4")) for t in tokens]
                    yield pa.RecordBatch.from_arrays(
                        [_id_column(ids), pa.array(starts), pa.array([len(t) for t in tokens], pa.int64()), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _shards(spark, path).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
