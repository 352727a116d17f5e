"""Importance resampling towards a target by bit-sliced bucket counts.

**Features** are the words of a text: runs of bytes that are digits, a-z (A-Z is lower-cased first) or not ASCII. A feature's bucket
is its CRC-32 modulo ``BUCKETS``.

**Gains.** The counts of all buckets over all documents and over the whole target table are two sums of ``BUCKETS`` numbers; they
combine within each task, then by bucket, so the driver sees ``BUCKETS`` rows whatever the input. A bucket's gain is
``floor(1000 * ln((t + 1) * (S + BUCKETS) / ((s + 1) * (T + BUCKETS))))``.

**Weights** are exact sums, bit-sliced. The counts of a document are planes of ``BUCKETS`` bits: bit b of plane j is bit j of the count
of bucket b. The gains are planes as well, of their magnitude's bits, apart for positive and negative ones. The sum of count times
gain is the sum over all pairs of planes of ``2^(j + k)`` times the population count of their conjunction, with the sign of the gain
plane. The weight is that sum divided by the number of features, floored.

**Draw.** The score adds Gumbel noise that depends on the id only; the highest scores of the documents with enough words are drawn.
Rows that agree in all result columns are counted before anything is ordered. Counts by score give each score the number of
better rows: scores are whole numbers within the bounds of weight and noise, so their number does not grow with the documents.
Among equal scores a window counts by ``doc_id``; the noise spreads documents over thousands of scores, so no window grows to a
fixed share of the input.

Rows: one per input row. A null or empty text has no features, weight 0. A null ``doc_id`` is hashed as an empty string and comes
first among equal scores; rows that agree in ``doc_id`` and score are ordered by ``n_features``, then arbitrarily, all of them one row
each. With no documents or no target the sums are 0 and the formula holds. Very long texts are read in blocks. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwright.llm.frames import small_batches, written
from shelfwright.llm.memory import release
from shelfwright.llm.shingles import utf8

BUCKETS = 10_000
SEED, PERCENT, LEAST_WORDS = 2024, 10, 20
#: Rows and bytes whose counts are in memory at once; the whole of a longer text passes in blocks of that many bytes.
GROUP, BLOCK = 64, 1 << 20
#: Longer words take the scalar checksum.
LONG_WORD = 48
#: Equal rows are written out in lists of at most so many.
STEP = 1 << 16

_CODES = np.arange(256)
_PART = (_CODES >= 128) | ((_CODES >= 48) & (_CODES <= 57)) | ((_CODES >= 97) & (_CODES <= 122))


def _crc_steps() -> np.ndarray:
    """Checksum of each byte: eight steps by the reversed polynomial."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1).astype(np.uint32)
    return out


_STEPS = _crc_steps()


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and the start and length of each word; a word ends with its row."""
    low = raw + ((raw - np.uint8(65) < 26).astype(np.uint8) << 5)
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = _PART[low]
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    return low, starts, ends - starts


def checksums(low: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each word, all words at once: byte i of every word that has one."""
    order = np.argsort(-lengths, kind="stable")
    at, size = starts[order], lengths[order]
    long = int(np.searchsorted(-size, -LONG_WORD, "left"))
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for i in range(min(int(size[0]) if len(size) else 0, LONG_WORD)):
        n = int(np.searchsorted(-size, -i, "left"))
        part = crc[long:n]
        crc[long:n] = _STEPS[(part ^ low[at[long:n] + i]) & np.uint32(255)] ^ (part >> np.uint32(8))
    crc = ~crc
    for k in range(long):
        crc[k] = zlib.crc32(low[at[k]:at[k] + size[k]].tobytes())
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _blocks(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows a to b with their bytes and offsets: whole rows of at most ``GROUP`` and ``BLOCK`` bytes, or a block of one longer row that
    ends where a word does."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = min(row + GROUP, rows, max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1))
        a, stop = int(offsets[row]), int(offsets[end])
        if end > row + 1 or stop - a <= BLOCK:
            yield row, end, raw[a:stop], offsets[row:end + 1] - a
        else:
            while a < stop:
                b = min(a + BLOCK, stop)
                while b < stop:  # a byte that is in no word, or the end
                    ahead = raw[b:min(b + BLOCK, stop)]
                    gaps = np.flatnonzero(~_PART[ahead + ((ahead - np.uint8(65) < 26).astype(np.uint8) << 5)])
                    if len(gaps):
                        b += int(gaps[0])
                        break
                    b += len(ahead)
                yield row, end, raw[a:b], np.array([0, b - a])
                a = b
        row = end


def row_counts(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """First row of a group, and the bucket counts of each of its rows."""
    raw, offsets = utf8(column)
    first, counts = -1, np.zeros((0, BUCKETS), np.int64)
    for a, b, data, off in _blocks(raw, offsets):
        low, starts, lengths = word_bounds(data, off)
        place = (np.searchsorted(off, starts, "right") - 1) * BUCKETS + checksums(low, starts, lengths) % np.uint32(BUCKETS)
        own = np.bincount(place.astype(np.int64), minlength=(b - a) * BUCKETS).reshape(b - a, BUCKETS)
        if a == first:
            counts += own
            continue
        if first >= 0:
            yield first, counts
        first, counts = a, own
    if first >= 0:
        yield first, counts


def planes(values: np.ndarray) -> np.ndarray:
    """Rows of non-negative numbers as planes of bits: (plane, row, 64-bit word), the lowest bits first."""
    width = -(-values.shape[1] // 64) * 8
    out = np.zeros((max(int(values.max(initial=0)).bit_length(), 1), len(values), width), np.uint8)
    for j in range(len(out)):
        bits = np.packbits((values >> j) & 1 == 1, axis=1)
        out[j, :, :bits.shape[1]] = bits
    return out.view(np.uint64)


class Gains:
    """Signed gains as bit planes."""

    def __init__(self, gains: np.ndarray):
        self.signed = [(sign, planes(np.maximum(sign * gains, 0)[None, :])[:, 0]) for sign in (1, -1)]

    def sums(self, counts: np.ndarray) -> np.ndarray:
        """Sum of count times gain of each row."""
        out = np.zeros(len(counts), np.int64)
        for j, plane in enumerate(planes(counts)):
            for sign, levels in self.signed:
                for k, level in enumerate(levels):
                    out += sign * (np.bitwise_count(plane & level).sum(axis=1, dtype=np.int64) << (j + k))
        return out


def bucket_totals(table: DataFrame, text: str = "text") -> np.ndarray:
    """Features of all rows by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, counts in row_counts(batch.column(0)):
                total += counts.sum(axis=0)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["bucket", "n"])
        release()

    small_batches(table.sparkSession)
    parts = table.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(BUCKETS, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket from its counts in the source and in the target."""
    s, t = float(source.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log((b + 1.0) * s / ((a + 1.0) * t))) for a, b in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None) -> int:
    """Floored Gumbel noise in thousandths, from the id alone."""
    h = int(hashlib.sha256(f"{SEED}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(documents: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id, n_features, weight, score`` of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sliced = Gains(gain)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            n, weight = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            for a, counts in row_counts(batch.column(1)):
                own = counts.sum(axis=1)
                n[a:a + len(own)] = own
                weight[a:a + len(own)] = sliced.sums(counts) // np.maximum(own, 1)
            score = weight + np.array([noise(i) for i in ids], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(weight), pa.array(score)], ["doc_id", "n_features", "weight", "score"])
        release()

    small_batches(documents.sparkSession)
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_features long, weight long, score long")


def _each(rows: DataFrame, columns: list[str], first: Column) -> DataFrame:
    """Each row as often as ``copies`` says, with ``place`` counting from ``first``; blocks keep the lists short."""
    blocks = rows.select(*columns, "copies", first.alias("first"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(STEP))).alias("at"))
    stop = F.least(F.col("at") + STEP, F.col("copies")) - 1
    return blocks.select(*columns, F.explode(F.sequence(F.col("first") + F.col("at"), F.col("first") + stop)).alias("place"))


def draw(spark: SparkSession, weighed: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS) -> DataFrame:
    """``weighed`` with ``rank``: 1, 2, 3... of the drawn rows, else null."""
    columns = ["doc_id", "n_features", "weight", "score"]
    rows = written(spark, weighed.select(*columns).groupBy(*columns).agg(F.count("*").alias("copies")), "weighed")
    able = F.col("n_features") >= least
    drawn = (rows.where(able).agg(F.sum("copies")).first()[0] or 0) * percent // 100
    levels = rows.where(able).groupBy("score").agg(F.sum("copies").alias("at_score"))
    # One row per score: bounded by the range of scores, not by the number of documents. So is the broadcast.
    better = levels.select("score", (F.sum("at_score").over(Window.orderBy(F.desc("score"))) - F.col("at_score")).alias("better"))
    marked = rows.join(F.broadcast(better.where(F.col("better") < drawn)), "score", "left")
    near = able & F.col("better").isNotNull()
    order = Window.partitionBy("score").orderBy(F.asc_nulls_first("doc_id"), "n_features").rowsBetween(Window.unboundedPreceding, 0)
    ordered = marked.where(near).withColumn("first", F.col("better") + F.sum("copies").over(order) - F.col("copies") + 1)
    rank = F.when(F.col("place") <= drawn, F.col("place")).alias("rank")
    picked = _each(ordered, columns, F.col("first")).select(*columns, rank)
    others = _each(marked.where(~near), columns, F.lit(1).cast("long")).select(*columns, F.lit(None).cast("long").alias("rank"))
    return picked.unionByName(others)


def resample(spark: SparkSession, documents: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS) -> DataFrame:
    """Weight, score and rank of every document for the target's distribution."""
    gain = gains(bucket_totals(documents), bucket_totals(target))
    return draw(spark, weigh(documents, gain), percent, least)
