"""Masked pseudo-likelihood: a network that sees ``REACH`` words on both sides predicts every word of every document.

**Vocabulary.** Words (runs without white space, A-Z lower-cased) are counted over all documents, and all counts are a written table.
The most frequent words have an entry of their own; the others share ``BUCKETS`` entries by their hash. The number of entries grows
with the square root of the number of different words. Counts combine per batch before the exchange; the driver sees how many words
have each count, the words with an entry and at most ``KNOWN`` further ones.

**Shared entries.** A word without an entry of its own has the probability of its bucket times its share of the bucket's words,
count / (words of the bucket + 1). The one place left is for words that were never counted, spread evenly over the bucket's hashes,
so the shares of a bucket sum to 1. Counts of the ``KNOWN`` most frequent words are with every task; the counts of the others are
joined from the table, by document and word.

**Network.** The hidden vector is tanh of the sum of one embedding for each neighbour and place; the target is masked, it is no input.
The output is factored: first one of the classes, then the entry within the class, so a word costs two short softmaxes.

**Start.** The biases of the output are the frequencies of the words, so an untrained network scores as a unigram model.

**Training** is numpy inside Spark tasks, data-parallel over all documents. In each of ``ROUNDS`` rounds every task starts from the
common weights, takes Adagrad steps over its documents and hands back its weights with their number of targets; the weighted mean
is the next common state. What is combined grows with the number of tasks, that is with the input, and is summed in two
exchanges by parts of the weights, so neither a task nor the driver ever holds more than one model. In round k every document
contributes the targets at places k mod ``STRIDE``; all words are context. ``ROUNDS`` is a multiple of ``STRIDE``, so every word is a
target equally often.

**Passes.** The texts are read twice: once to count, once to write every document's entries, which the rounds and the scores read
instead. Text and entries are worked through in the same pieces (``slices``), so a task's memory follows a piece.

**Scores** are sums of log conditional probabilities of the words themselves over the whole text.

Rows: one per input row. A null text and one without words have no words, ``log_prob`` 0 and a null mean. Places beyond a text's ends
are a padding entry. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwright.llm.frames import written
from shelfwright.llm.shingles import slices, utf8, word_hashes
from shelfwright.session import workspace

REACH, WIDTH = 2, 24
#: Of the smallest model, for up to ``DISTINCT`` different words.
CLASSES, MEMBERS, DISTINCT = 32, 32, 1 << 18
ENTRIES = CLASSES * MEMBERS
BUCKETS = 64
PAD = ENTRIES
ROUNDS, STRIDE, BATCH, RATE, FIRST_SQUARE = 4, 4, 2048, 0.05, 1e-8
#: Words whose counts every task has (4 MB); the counts of all others are joined.
KNOWN = 1 << 18
#: Log share of one hash among those of a bucket.
ONE_HASH = math.log(BUCKETS) - 64 * math.log(2)
#: Floats of the weights in one row, and groups of tasks that are summed first.
PART, GROUPS = 1 << 14, 64


def side_for(distinct: int) -> int:
    """Classes, and members of each, of a model of so many different words."""
    return max(CLASSES, 8 * math.ceil(CLASSES / 8 * (distinct / DISTINCT) ** 0.25))


def _shapes(side: int) -> dict[str, tuple[int, ...]]:
    return {"embed": (2 * REACH, side * side + 1, WIDTH), "bias": (WIDTH,), "to_class": (WIDTH, side), "class_bias": (side,),
            "to_member": (side, WIDTH, side), "member_bias": (side, side)}


def _heads(hashes: np.ndarray) -> tuple[np.ndarray, np.uint64]:
    """Where the hashes of each leading bit pattern begin among sorted hashes (with the end), and the shift to that pattern."""
    bits = max(1, (4 * len(hashes) - 1).bit_length())
    shift = np.uint64(64 - bits)
    return np.searchsorted(hashes >> shift, np.arange((1 << bits) + 1).astype(np.uint64)), shift


def _places(hashes: np.ndarray, heads: tuple[np.ndarray, np.uint64], words: np.ndarray) -> np.ndarray:
    """Place of each word among sorted hashes, -1 where it is none of them."""
    begin, shift = heads
    head = (words >> shift).view(np.int64)
    at, end, out = begin[head], begin[head + 1], np.full(len(words), -1)
    rest = np.flatnonzero(at < end)
    while len(rest):
        place = at[rest]
        hit = hashes[place] == words[rest]
        out[rest[hit]] = place[hit]
        rest = rest[~hit]
        at[rest] += 1
        rest = rest[at[rest] < end[rest]]
    return out


def _bucket(words: np.ndarray) -> np.ndarray:
    return ((words >> np.uint64(58)) % np.uint64(BUCKETS)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Hashes of the words with an entry, sorted, with their entries; all weights in one vector; and what is known of the other words.

    ``known`` are sorted hashes with their ``times``, ``totals`` the words of each bucket, ``table`` the path of the counts of all
    words, empty if ``known`` has all of them.
    """

    hashes: np.ndarray
    entries: np.ndarray
    weights: np.ndarray
    side: int = CLASSES
    known: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    times: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    totals: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.int64))
    table: str = ""

    @property
    def pad(self) -> int:
        return self.side * self.side

    def views(self) -> dict[str, np.ndarray]:
        """The weights by name, sharing memory with the vector."""
        out, at = {}, 0
        for name, shape in _shapes(self.side).items():
            size = math.prod(shape)
            out[name] = self.weights[at:at + size].reshape(shape)
            at += size
        return out

    @cached_property
    def _entry_heads(self) -> tuple[np.ndarray, np.uint64]:
        return _heads(self.hashes)

    @cached_property
    def _known_heads(self) -> tuple[np.ndarray, np.uint64]:
        return _heads(self.known)

    def network(self) -> Model:
        """Without its words: enough for entries."""
        none = np.zeros(0, np.uint64)
        return Model(none, none.view(np.int64), self.weights, self.side)

    def tokens(self, words: np.ndarray) -> np.ndarray:
        """Entry of each word hash."""
        out = self.pad - BUCKETS + _bucket(words)
        if len(self.hashes):
            place = _places(self.hashes, self._entry_heads, words)
            own = np.flatnonzero(place >= 0)
            out[own] = self.entries[place[own]]
        return out

    def shares(self, words: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log share of each word in its entry, and the places of words whose count is not known here: theirs lacks the count."""
        out, at = np.zeros(len(words)), np.flatnonzero(tokens >= self.pad - BUCKETS)
        own = words[at]
        out[at] = -np.log(self.totals[_bucket(own)] + 1.0)
        if len(self.known):
            place = _places(self.known, self._known_heads, own)
            found = place >= 0
            out[at[found]] += np.log(self.times[place[found]])
            at = at[~found]
        return out, at


def start(hashes: np.ndarray, seed: int = 7, side: int = CLASSES) -> Model:
    """Untrained model of words in order of frequency; frequent words share classes. It has counted no words."""
    order = np.argsort(hashes)
    rng = np.random.default_rng(seed)
    parts = [rng.normal(0, 0.1, shape) if len(shape) > 1 and "bias" not in name else np.zeros(shape) for name, shape in _shapes(side).items()]
    return Model(hashes[order], order.astype(np.int64), np.concatenate([p.ravel() for p in parts]).astype(np.float32), side)


def _texts(model: Model, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """First row, words, entries and first word of each row, slice by slice."""
    raw, offsets = utf8(column)
    for a, b in slices(offsets):
        off = offsets[a:b + 1]
        words, first = word_hashes(raw[off[0]:off[-1]], off - off[0])
        yield a, words, model.tokens(words), first


def _spaced(tokens: np.ndarray, first: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """The entries with ``REACH`` paddings before, between and behind the documents, and the place of each word there."""
    place = np.arange(len(tokens)) + REACH * np.repeat(np.arange(1, len(first)), np.diff(first))
    spaced = np.full(len(tokens) + REACH * len(first), pad)
    spaced[place] = tokens
    return spaced, place


def _around(spaced: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Entries of the neighbours of each place, a column for each neighbour."""
    out = np.empty((2 * REACH, len(place)), np.int64)
    for j, step in enumerate([*range(-REACH, 0), *range(1, REACH + 1)]):
        out[j] = np.take(spaced, place + step)
    return out.T


def contexts(tokens: np.ndarray, first: np.ndarray, at: np.ndarray, pad: int = PAD) -> np.ndarray:
    """Entries of the neighbours of the words at ``at``, without crossing a document's ends."""
    spaced, place = _spaced(tokens, first, pad)
    return _around(spaced, place[at])


def _hidden(w: dict[str, np.ndarray], context: np.ndarray) -> np.ndarray:
    total = w["bias"] + np.take(w["embed"][0], context[:, 0], axis=0)
    for j in range(1, context.shape[1]):
        total += np.take(w["embed"][j], context[:, j], axis=0)
    return np.tanh(total, out=total)


# Logits and shares have a column for each word: numpy is slow where many short rows are reduced.

def _lowered(logits: np.ndarray) -> np.ndarray:
    """Less the largest of each column, in place."""
    logits -= logits.max(axis=0)
    return logits


def _total(columns: np.ndarray) -> np.ndarray:
    """Sum of each column, a multiple of eight long, in the order in which numpy adds a row of up to 128."""
    lanes = columns[:8] + columns[8:16]
    for a in range(16, len(columns), 8):
        lanes += columns[a:a + 8]
    while len(lanes) > 1:
        lanes = lanes[0::2] + lanes[1::2]
    return lanes[0]


def _log_share(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log-probability of one place in each column; the logits are lost."""
    got = _lowered(logits)[at, np.arange(len(at))]
    return got - np.log(_total(np.exp(logits, out=logits)))


def _errors(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row for each column: its probabilities, less 1 at one place."""
    np.exp(_lowered(logits), out=logits)
    logits /= _total(logits)
    logits[at, np.arange(len(at))] -= 1
    return np.ascontiguousarray(logits.T)


def _by_class(targets: np.ndarray, side: int) -> tuple[np.ndarray, list[int]]:
    kind = (targets // side).astype(np.uint16)  # numpy sorts 16 bits by radix
    return np.argsort(kind, kind="stable"), [0, *np.cumsum(np.bincount(kind, minlength=side)).tolist()]


def _columns(side: int, n: int, dtype: np.dtype) -> np.ndarray:
    """Empty columns; rows lie no power of two apart, which caches are bad at."""
    return np.empty((side, n + 16), dtype)[:, :n]


def _class_logits(w: dict[str, np.ndarray], hidden: np.ndarray) -> np.ndarray:
    out = _columns(len(w["class_bias"]), len(hidden), hidden.dtype)
    np.matmul(w["to_class"].T, hidden.T, out=out)
    out += w["class_bias"][:, None]
    return out


def _member_logits(w: dict[str, np.ndarray], near: np.ndarray, edges: list[int]) -> np.ndarray:
    """Of words in order of their classes, each within its own class."""
    out = _columns(len(edges) - 1, len(near), near.dtype)
    for c, (a, b) in enumerate(zip(edges, edges[1:])):
        if a < b:
            own = out[:, a:b]
            np.matmul(w["to_member"][c].T, near[a:b].T, out=own)
            own += w["member_bias"][c][:, None]
    return out


def log_probs(model: Model, tokens: np.ndarray, first: np.ndarray, block: int = 1 << 12) -> np.ndarray:
    """Log conditional probability of each word's entry given its neighbours."""
    return _log_probs(model, *_spaced(tokens, first, model.pad), block)


def _log_probs(model: Model, spaced: np.ndarray, place: np.ndarray, block: int = 1 << 12) -> np.ndarray:
    w, out = model.views(), np.zeros(len(place))
    for a in range(0, len(place), block):
        at = place[a:a + block]
        targets, hidden = np.take(spaced, at).astype(np.int64), _hidden(w, _around(spaced, at))
        got = _log_share(_class_logits(w, hidden), targets // model.side)
        order, edges = _by_class(targets, model.side)
        got[order] += _log_share(_member_logits(w, np.take(hidden, order, axis=0), edges), targets[order] % model.side)
        out[a:a + block] = got
    return out


def _run_sums(values: np.ndarray, rows: np.ndarray, first: np.ndarray, short: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Order of the runs of ``rows`` that begin at ``first``, longest first, and the sums of ``values`` at each run's rows.

    Every sum is what ``np.add.reduceat`` gives; but that takes a call for each run and column, and most runs are short.
    """
    lengths = np.diff(first, append=len(rows))
    kept = np.minimum(lengths, short + 1)
    order = np.argsort((short + 1 - kept).astype(np.uint8), kind="stable")
    longer = np.cumsum(np.bincount(kept, minlength=short + 2)[::-1])[::-1]  # runs of so many rows or more
    n_long = int(longer[short + 1])
    begin = first[order[n_long:]]
    out = np.empty((len(first), values.shape[1]), values.dtype)
    np.take(values, rows[begin], axis=0, out=out[n_long:], mode="clip")
    if longer[2] > n_long:
        rest = np.take(values, rows[begin[:longer[2] - n_long] + 1], axis=0)
        for k in range(2, short):
            n = longer[k + 1] - n_long
            rest[:n] += np.take(values, rows[begin[:n] + k], axis=0)
        out[n_long:longer[2]] += rest
    if n_long:
        of = lengths[order[:n_long]]
        own = np.take(values, rows[np.repeat(lengths > short, lengths)], axis=0)
        np.add.reduceat(own, np.cumsum(of) - of, axis=0, out=out[:n_long])
    return order, out


def _adagrad(weights: np.ndarray, squares: np.ndarray, at: np.ndarray | slice, change: np.ndarray, rate: float) -> None:
    """One update of the weights at ``at``."""
    whole = isinstance(at, slice)
    own = change * change
    own += squares[at] if whole else np.take(squares, at, axis=0)
    squares[at] = own
    own += 1e-8
    change = rate * change
    change /= np.sqrt(own, out=own)
    weights[at] = np.subtract(weights[at] if whole else np.take(weights, at, axis=0), change, out=change)


def step(model: Model, squares: np.ndarray, context: np.ndarray, targets: np.ndarray, rate: float = RATE) -> None:
    """One Adagrad step on a batch, in place: only the classes and the embeddings that the batch has are touched."""
    w, q, n = model.views(), replace(model, weights=squares).views(), len(targets)
    hidden, every = _hidden(w, context), slice(None)
    grad = _errors(_class_logits(w, hidden), targets // model.side)
    back = grad @ w["to_class"].T
    updates = [("to_class", every, hidden.T @ grad), ("class_bias", every, grad.sum(axis=0))]
    order, edges = _by_class(targets, model.side)
    near = np.take(hidden, order, axis=0)
    grad = _errors(_member_logits(w, near, edges), targets[order] % model.side)
    had = np.flatnonzero(np.diff(edges))
    to_member, member_bias = np.empty((len(had), WIDTH, model.side), grad.dtype), np.empty((len(had), model.side), grad.dtype)
    far = np.empty_like(near)
    for i, c in enumerate(had.tolist()):
        a, b = edges[c], edges[c + 1]
        own = grad[a:b]
        np.matmul(near[a:b].T, own, out=to_member[i])
        np.add.reduce(own, axis=0, out=member_bias[i])
        np.matmul(own, w["to_member"][c].T, out=far[a:b])
    touched = every if len(had) == model.side else had
    updates += [("to_member", touched, to_member), ("member_bias", touched, member_bias)]
    place = np.empty_like(order)
    place[order] = np.arange(n)
    back += np.take(far, place, axis=0)
    np.square(hidden, out=hidden)
    back *= np.subtract(1, hidden, out=hidden)
    updates.append(("bias", every, back.sum(axis=0)))
    rows = (context + np.arange(context.shape[1]) * (model.pad + 1)).T.ravel()  # of all embeddings below each other
    order = np.argsort(rows.astype(np.uint16) if w["embed"].size // WIDTH <= 1 << 16 else rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    runs, change = _run_sums(back, order % n, first)
    updates.append(("embed", rows[first[runs]], change))
    w["embed"], q["embed"] = w["embed"].reshape(-1, WIDTH), q["embed"].reshape(-1, WIDTH)
    for name, at, change in updates:
        change /= n
        _adagrad(w[name], q[name], at, change, rate)


def word_counts(documents: DataFrame) -> DataFrame:
    """``word, n``: hash and count of every word of all documents."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8(batch.column(0))
            found = [word_hashes(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])[0] for a, b in slices(offsets)]
            if found:
                hashes, counts = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], ["word", "n"])

    return documents.select(F.col("text").cast("string")).mapInArrow(emit, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _most_frequent(counted: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the most frequent words."""
    rows = counted.orderBy(F.desc("n"), "word").limit(most).collect()
    return np.array([r["word"] for r in rows], np.int64).view(np.uint64), np.array([r["n"] for r in rows], np.int64)


def count_words(documents: DataFrame, most: int = ENTRIES - BUCKETS) -> np.ndarray:
    """Hashes of the most frequent words of all documents, in order; equal counts by hash."""
    return _most_frequent(word_counts(documents), most)[0]


def _know_unigrams(model: Model, often: np.ndarray, totals: np.ndarray) -> None:
    """Set the output's biases to the words' own frequencies, in place: training starts there and learns what neighbours tell."""
    counts = np.ones(model.pad)
    counts[:len(often)] += often
    counts[model.pad - BUCKETS:] += totals
    square, w = counts.reshape(model.side, model.side), model.views()
    w["class_bias"][:] = np.log(square.sum(axis=1) / square.sum())
    w["member_bias"][:] = np.log(square / square.sum(axis=1, keepdims=True))


def start_counted(spark: SparkSession, documents: DataFrame) -> Model:
    """Untrained model of the words of all documents, with their counts."""
    path = workspace(spark, "words")
    word_counts(documents).write.parquet(path)
    counted = spark.read.schema("word long, n long").parquet(path)
    levels = sorted(((r["n"], r["words"]) for r in counted.groupBy("n").agg(F.count("*").alias("words")).collect()), reverse=True)
    distinct, least, size = sum(words for _, words in levels), math.inf, 0
    for n, words in levels:
        if size + words > KNOWN:
            break
        least, size = n, size + words
    side = side_for(distinct)
    frequent, often = _most_frequent(counted, side * side - BUCKETS)
    model = start(frequent, side=side)
    totals = np.zeros(BUCKETS, np.int64)
    entered = spark.createDataFrame(pa.table({"word": pa.array(model.hashes.view(np.int64))}))  # as many as the model has entries
    own = counted.join(entered, "word", "left_anti")
    for r in own.groupBy(F.shiftrightunsigned("word", 58).alias("bucket")).agg(F.sum("n").alias("n")).collect():
        totals[r["bucket"]] = r["n"]
    if distinct:
        _know_unigrams(model, often, totals)
    known = own.where(F.col("n") >= least).toArrow() if size else None
    words, times = (known[c].to_numpy() for c in ("word", "n")) if known is not None else (np.zeros(0, np.int64),) * 2
    order = np.argsort(words.view(np.uint64))
    return replace(model, known=words.view(np.uint64)[order], times=times[order], totals=totals, table=path if size < distinct else "")


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` (part, salt, n, weights) added up by ``keys``, a running sum per key and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, list] = {}
        for batch in batches:
            for part, salt, n, weights in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = sums.setdefault((part, salt if "salt" in keys else 0), [0.0, 0.0])
                own[0] += n
                own[1] = own[1] + np.frombuffer(weights, np.float32).astype(np.float64)
        for (part, salt), (n, weights) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([salt]), pa.array([n]), pa.array([weights.astype(np.float32).tobytes()])], ["part", "salt", "n", "weights"])

    return rows.repartition(*keys).mapInArrow(run, "part long, salt long, n double, weights binary")


def encode(spark: SparkSession, documents: DataFrame, model: Model) -> DataFrame:
    """A row for each document, with what rounds and scores need of its text; ``model`` may be trained or not.

    ``tokens`` are the entries of its words and ``REACH`` paddings, ``share`` is the sum of the words' log shares in their entries, ``words`` and ``times``
    are those whose counts are to be joined. Rows of one ``piece`` are worked on together.
    """
    held, kind = spark.sparkContext.broadcast(model), _kind(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, row, piece = held.value, TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            for start_, words, tokens, first in _texts(own, batch.column(1)):
                shares, open_ = own.shares(words, tokens)
                if not own.table:
                    shares[open_] += ONE_HASH
                    open_ = open_[:0]
                n, share = np.diff(first), np.diff(np.concatenate([[0.0], np.cumsum(shares)])[first])
                # Words whose counts are to be joined, once for each document.
                of = np.searchsorted(first, open_, "right") - 1
                order = np.lexsort((words[open_], of))
                of, rest = of[order], words[open_][order]
                new = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (rest[1:] != rest[:-1])])) if len(of) else np.zeros(0, np.int64)
                offsets = pa.array(np.searchsorted(of[new], np.arange(len(n) + 1)).astype(np.int32))
                spaced = _spaced(tokens, first, own.pad)[0][REACH:].astype(kind)
                ends = pa.py_buffer(((first + REACH * np.arange(len(first))) * kind.itemsize).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(len(n))), batch.column(0).slice(start_, len(n)), pa.array(np.full(len(n), piece)), pa.array(n),
                     pa.array(share), pa.Array.from_buffers(pa.binary(), len(n), [None, ends, pa.py_buffer(spaced)]),
                     pa.ListArray.from_arrays(offsets, pa.array(rest[new].view(np.int64))),
                     pa.ListArray.from_arrays(offsets, pa.array(np.diff(np.append(new, len(of)))))],
                    ["row", "doc_id", "piece", "n_words", "share", "tokens", "words", "times"])
                row += len(n)
                piece += 1

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "row long, doc_id long, piece long, n_words long, share double, tokens binary, words array<long>, times array<long>")


def _kind(model: Model) -> np.dtype:
    """Of entries in a file."""
    return np.dtype(np.uint16 if model.pad < 1 << 16 else np.uint32)


def _pieces(piece: pa.Array, tokens: pa.Array, model: Model) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """First row, entries as ``_spaced`` has them, where each row begins there, and its number of words, piece by piece."""
    wide, kind = np.int64 if pa.types.is_large_binary(tokens.type) else np.int32, _kind(model)
    _, offsets, data = tokens.buffers()
    rows = len(tokens)
    if not rows:
        return
    off = np.frombuffer(offsets, wide)[tokens.offset:tokens.offset + rows + 1].astype(np.int64)
    raw, of, ahead = np.frombuffer(data, np.uint8), piece.to_numpy(), np.full(REACH, model.pad, kind)
    cuts = [*np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])), rows]
    for a, b in zip(cuts, cuts[1:]):
        begin = (off[a:b + 1] - off[a]) // kind.itemsize + REACH
        yield a, np.concatenate([ahead, raw[off[a]:off[b]].view(kind)]), begin[:-1], np.diff(begin) - REACH


def _every(begin: np.ndarray, n: np.ndarray, from_: int = 0, stride: int = 1) -> np.ndarray:
    """The places from ``from_`` on, ``stride`` apart, of rows that begin at ``begin`` and have ``n`` places each."""
    count = np.maximum(0, -((from_ - n) // stride))
    ends = np.cumsum(count)
    return np.repeat(begin + from_ - stride * (ends - count), count) + stride * np.arange(count.sum())


def train_round(spark: SparkSession, encoded: DataFrame, model: Model, round_: int, stride: int = STRIDE) -> Model:
    """Weighted mean of what all tasks make of ``model``."""
    held = spark.sparkContext.broadcast(model.network())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = replace(held.value, weights=held.value.weights.copy())
        squares, seen, waiting = np.full(len(own.weights), FIRST_SQUARE, np.float32), 0, []

        def learn(pairs: list) -> None:
            context, targets = (np.concatenate(x) for x in zip(*pairs, strict=True))
            for a in range(0, len(targets), BATCH):
                step(own, squares, context[a:a + BATCH], targets[a:a + BATCH])

        for batch in batches:
            for _, spaced, begin, n in _pieces(batch.column(0), batch.column(1), own):
                at = _every(begin, n, round_ % stride, stride)
                if len(at):
                    waiting.append((_around(spaced, at), np.take(spaced, at).astype(np.int64)))
                    seen += len(at)
                if sum(len(t) for _, t in waiting) >= BATCH:
                    learn(waiting)
                    waiting = []
        if waiting:
            learn(waiting)
        if seen:
            whole = own.weights.astype(np.float64) * seen
            for part, a in enumerate(range(0, len(whole), PART)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part]), pa.array([TaskContext.get().partitionId() % GROUPS]), pa.array([float(seen)]),
                     pa.array([whole[a:a + PART].astype(np.float32).tobytes()])], ["part", "salt", "n", "weights"])

    made = encoded.select("piece", "tokens").mapInArrow(run, "part long, salt long, n double, weights binary")
    parts = sorted(_summed(_summed(made, "part", "salt"), "part").collect(), key=lambda r: r["part"])
    if not parts:
        return model
    return replace(model, weights=np.concatenate(
        [np.frombuffer(r["weights"], np.float32).astype(np.float64) / r["n"] for r in parts]).astype(np.float32))


def _trained(spark: SparkSession, documents: DataFrame, rounds: int, stride: int) -> tuple[Model, DataFrame]:
    """Model of all documents, and the written table of their entries."""
    model = start_counted(spark, documents)
    encoded = written(spark, encode(spark, documents, model), "entries")
    for round_ in range(rounds):
        model = train_round(spark, encoded, model, round_, stride)
    return model, encoded


def train(spark: SparkSession, documents: DataFrame, rounds: int = ROUNDS, stride: int = STRIDE) -> Model:
    """Model of all documents."""
    return _trained(spark, documents, rounds, stride)[0]


def _scored(spark: SparkSession, encoded: DataFrame, model: Model) -> DataFrame:
    held = spark.sparkContext.broadcast(model.network())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, doc_id, n_words, share, piece, tokens = batch.columns
            for a, spaced, begin, words in _pieces(piece, tokens, held.value):
                n, first = len(words), np.concatenate([[0], np.cumsum(words)])
                sums = np.concatenate([[0.0], np.cumsum(_log_probs(held.value, spaced, _every(begin, words)))])
                yield pa.RecordBatch.from_arrays(
                    [row.slice(a, n), doc_id.slice(a, n), n_words.slice(a, n), pa.array(np.diff(sums[first]) + share.slice(a, n).to_numpy())],
                    ["row", "doc_id", "n_words", "log_prob"])

    scored = encoded.select("row", "doc_id", "n_words", "share", "piece", "tokens").mapInArrow(
        run, "row long, doc_id long, n_words long, log_prob double")
    if model.table:
        rest = encoded.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", "w.words", "w.times")
        counted = spark.read.schema("word long, n long").parquet(model.table)
        more = rest.join(counted, rest["words"] == counted["word"], "left").groupBy("row").agg(
            F.sum(F.col("times") * F.coalesce(F.log("n"), F.lit(ONE_HASH))).alias("more"))
        scored = scored.join(more, "row", "left").withColumn("log_prob", F.col("log_prob") + F.coalesce("more", F.lit(0.0)))
    return scored.select("doc_id", "n_words", "log_prob", F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")).alias("mean_log_prob"))


def score(spark: SparkSession, documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, n_words, log_prob, mean_log_prob`` of every document."""
    encoded = encode(spark, documents, model)
    return _scored(spark, written(spark, encoded, "entries") if model.table else encoded, model)


def train_and_score(spark: SparkSession, documents: DataFrame, rounds: int = ROUNDS, stride: int = STRIDE) -> DataFrame:
    """``score`` of the documents under ``train`` on all of them; their entries are written once."""
    model, encoded = _trained(spark, documents, rounds, stride)
    return _scored(spark, encoded, model)
