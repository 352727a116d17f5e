"""Language identification by n-gram filters that answer with a bit mask of languages.

Every language has the set of its most frequent character n-grams. The sets lie in one bit-sliced Bloom filter: a slot is a
row of bits, one for each language, and an n-gram's ``PROBES`` slots ANDed give all languages that contain it at once. A
document's hits per language are the population counts of its n-grams' masks. A slot's bit may be set by chance, with the
measured probability fill ** PROBES, so a count is corrected to (hits - n * p) / (1 - p) before the languages are compared.

Learning reads the labelled rows that the caller passes, whole texts, of at most about ``sample`` rows for each language
(chosen by a hash of ``doc_id``; a documented bound, the rows of a language are thinned in proportion). Counting n-grams is an
aggregation; the filter is of a fixed size.

An n-gram here is 2 to 4 characters of the lower-cased text, where everything but letters is a blank; one with a blank
inside (not at its ends) does not count.

Rows: one per input row. A null text, and one without a letter, is ``und`` with score 0. Equal scores go to the language that
comes first in code-point order. Without labelled rows everything is ``und``. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwright.llm.frames import small_batches
from shelfwright.llm.memory import release
from shelfwright.llm.shingles import mix

ORDERS = (2, 3, 4)
#: Labelled rows read, and n-grams of each order kept, for each language.
SAMPLE, TOP = 3000, 3000
#: Slots of the filter and hash functions.
SLOTS, PROBES = 1 << 19, 3
UNKNOWN = "und"
#: Characters in a slice that is processed at once; one longer text is a slice of its own.
SLICE = 1 << 19
_BLANK = np.uint32(32)
_LETTER = np.frombuffer(bytes(chr(c).isalpha() for c in range(0x110000)), bool)


def _characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each between blanks, with blanks for all that is no letter; first index of each text."""
    parts = [f" {t.lower()} " if t else " " for t in texts]
    points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return np.where(_LETTER[points], points, _BLANK), first


def grams(points: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start indexes of the n-grams that count."""
    if len(points) < order:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    end = len(points) - order + 1
    blank = points == _BLANK
    good = ~(blank[:end] & blank[order - 1:])
    for j in range(1, order - 1):
        good &= ~blank[j:j + end]
    at = np.flatnonzero(good)
    key = np.full(len(at), order, np.uint64)
    for j in range(order):
        key = key * np.uint64(0x100000001B3) + points[at + j]
    return mix(key), at


def _slots(hashes: np.ndarray, slots: int, probe: int) -> np.ndarray:
    return ((hashes >> np.uint64(20 * probe)) ^ (hashes * np.uint64(2 * probe + 3) >> np.uint64(7))) & np.uint64(slots - 1)


@dataclass(frozen=True)
class Model:
    """Languages in order, and the filter: ``bits[slot]`` has a bit for each language."""

    languages: list[str]
    bits: np.ndarray

    def chance(self) -> np.ndarray:
        """Probability of a false hit for each language."""
        fill = np.unpackbits(self.bits, axis=1)[:, :len(self.languages)].mean(axis=0)
        return fill ** PROBES

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Bit of each language for each n-gram."""
        found = self.bits[_slots(hashes, len(self.bits), 0)]
        for probe in range(1, PROBES):
            found &= self.bits[_slots(hashes, len(self.bits), probe)]
        return np.unpackbits(found, axis=1)[:, :len(self.languages)]


def build(languages: list[str], ngrams: list[tuple[str, int]], slots: int = SLOTS) -> Model:
    """Filter of ``(language, signed hash)`` pairs."""
    bits = np.zeros((slots, max(1, -(-len(languages) // 8))), np.uint8)
    for i, language in enumerate(languages):
        hashes = np.array([h for of, h in ngrams if of == language], np.int64).view(np.uint64)
        for probe in range(PROBES):
            bits[_slots(hashes, slots, probe), i // 8] |= np.uint8(128 >> i % 8)
    return Model(languages, bits)


def learn(labelled: DataFrame, sample: int = SAMPLE, top: int = TOP) -> Model:
    """Model of the rows ``doc_id, text, lang``; rows without text or language do not count."""
    rows = labelled.where("text is not null and lang is not null").select("doc_id", "text", F.col("lang").cast("string"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return build([], [])
    draw = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 11) / float(1 << 53)
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, sample / n))])
    chosen = rows.where(draw < F.element_at(share, F.col("lang"))).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_pylist()
            for language in set(langs):
                points, _ = _characters([texts[i] for i in np.flatnonzero(langs == language)])
                for order in ORDERS:
                    keys, counts = np.unique(grams(points, order)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([language] * len(keys)), pa.array(np.full(len(keys), order)), pa.array(keys.view(np.int64)), pa.array(counts)],
                        ["lang", "size", "gram", "n"])

    counted = chosen.mapInArrow(count, "lang string, size long, gram long, n long").groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    ranked = counted.withColumn("r", F.expr("row_number() over (partition by lang, size order by n desc, gram)")).where(F.col("r") <= top)
    return build(sorted(sizes), [(r["lang"], r["gram"]) for r in ranked.select("lang", "gram").collect()])


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > SLICE:
            yield start, i
            start, size = i, 0
        size += len(t or "")
    if start < len(texts):
        yield start, len(texts)


def scores(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Corrected share of known n-grams for each text and language; whether a text has a letter."""
    chance, out, letters = model.chance(), [], []
    for a, b in _slices(texts):
        points, first = _characters(texts[a:b])
        letter = np.concatenate([[0], np.cumsum(points != _BLANK)])
        letters.append(np.diff(letter[first]) > 0)
        hits, total = np.zeros((b - a, len(model.languages))), np.zeros(b - a)
        for order in ORDERS:
            hashes, at = grams(points, order)
            edges = np.searchsorted(at, first)
            total += np.diff(edges)
            sums = np.zeros((len(hashes) + 1, len(model.languages)), np.int32)
            np.cumsum(model.hits(hashes), axis=0, out=sums[1:])
            hits += np.diff(sums[edges], axis=0)
        n = np.maximum(total, 1)[:, None]
        out.append(np.clip((hits / n - chance) / (1 - chance), 0, 1))
    if not out:
        return np.zeros((0, len(model.languages))), np.zeros(0, bool)
    return np.concatenate(out), np.concatenate(letters)


def decide(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    got, letters = scores(model, texts)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    best = got.argmax(axis=1)
    names = [model.languages[i] if ok else UNKNOWN for i, ok in zip(best, letters, strict=True)]
    return names, np.where(letters, got[np.arange(len(texts)), best], 0.0)


def predict(spark: SparkSession, documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` of every document."""
    small_batches(spark)
    held = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, top = decide(held.value, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(top, pa.float64())], ["doc_id", "lang_pred", "score"])
        release()

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def accepted(spark: SparkSession, documents: DataFrame, model: Model, least: float) -> DataFrame:
    """Documents that have a language with a score of ``least`` or more, all columns; rows stay where they are."""
    small_batches(spark)
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def good(text: pd.Series) -> pd.Series:
        names, top = decide(held.value, [t if isinstance(t, str) else None for t in text])
        release()
        return pd.Series([name != UNKNOWN and score >= least for name, score in zip(names, top, strict=True)])

    return documents.where(good(documents["text"].cast("string")))


def held_out(doc_id: Column) -> Column:
    """Fold that nothing is learned from. A null id is in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))
