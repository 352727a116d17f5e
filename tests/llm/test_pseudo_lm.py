"""The network's gradient, and scores of held-out and shuffled documents."""

import random
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwright.bindings.registry import QUERIES
from shelfwright.llm import pseudo_lm as M
from shelfwright.llm import queries


def test_gradient():
    rng = np.random.default_rng(1)
    model = M.start(np.arange(10, dtype=np.uint64))
    model = replace(model, weights=rng.normal(0, 0.3, len(model.weights)))
    tokens, first = rng.integers(0, M.ENTRIES, 60), np.array([0, 20, 20, 60])
    at = np.arange(60)
    loss = lambda w: -M.log_probs(replace(model, weights=w), tokens, first).mean()
    moved = replace(model, weights=model.weights.copy())
    squares = np.full(len(model.weights), 1e12)  # so that a step is the gradient times a known factor
    M.step(moved, squares, M.contexts(tokens, first, at), tokens, rate=1e6)
    gradient = model.weights - moved.weights
    for i in np.argsort(-np.abs(gradient))[:20]:
        up, down = model.weights.copy(), model.weights.copy()
        up[i] += 1e-5
        down[i] -= 1e-5
        assert gradient[i] == pytest.approx((loss(up) - loss(down)) / 2e-5, rel=1e-3)


def test_probabilities_sum_to_one():
    model = M.start(np.arange(5, dtype=np.uint64))
    first = np.array([0, 5])
    total = 0.0
    for entry in range(M.ENTRIES):
        total += np.exp(M.log_probs(model, np.array([3, 9, entry, 4, 8]), first)[2])
    assert total == pytest.approx(1, abs=1e-4)


def test_contexts_stay_in_their_document():
    got = M.contexts(np.arange(6), np.array([0, 2, 2, 6]), np.arange(6)).tolist()
    p = M.PAD
    assert got == [[p, p, 1, p], [p, 0, p, p], [p, p, 3, 4], [p, 2, 4, 5], [2, 3, 5, p], [3, 4, p, p]]


def test_training_learns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 4 = 0")
    taught, held = docs.where("doc_id % 8 = 0"), docs.where("doc_id % 8 = 4").limit(200).select("doc_id", "text")
    model = M.train(spark, taught, rounds=2, stride=2)
    untrained = M.start(M.count_words(taught))

    def mean(df, m):
        row = M.score(spark, df, m).agg(F.sum("log_prob").alias("s"), F.sum("n_words").alias("n")).first()
        return row.s / row.n

    rng = random.Random(1)
    rows = [(r.doc_id, r.text or "") for r in held.collect()]
    shuffled = spark.createDataFrame([(d, " ".join(rng.sample(t.split(), len(t.split())))) for d, t in rows], "doc_id long, text string")
    held = spark.createDataFrame(rows, "doc_id long, text string")
    good = mean(held, model)
    assert good > mean(held, untrained) + 1 and good > mean(shuffled, model)
    # The start scores as a unigram model; what neighbours tell comes on top.
    assert good > mean(held, M.start_counted(spark, taught)) + 0.2


def test_every_row_has_a_score(spark, documents, corpus, nothing):
    model = M.train(spark, documents)
    rows = M.score(spark, documents, model).collect()
    words = {d: len((t or "").split()) for d, t in corpus if d is not None}
    assert {r.doc_id: r.n_words for r in rows if r.doc_id is not None} == words and len(rows) == len(corpus)
    assert all((r.mean_log_prob is None and r.log_prob == 0) if not r.n_words else r.log_prob < 0 for r in rows)
    fresh = M.train(spark, nothing)
    assert np.array_equal(fresh.weights, M.start(np.zeros(0, np.uint64)).weights)
    assert M.score(spark, nothing, fresh).count() == 0 and M.score(spark, documents, fresh).count() == len(corpus)


@pytest.mark.parametrize("known", [0, 40, 1 << 18])
def test_words_of_a_bucket_have_their_own_probability(spark, known, monkeypatch):
    """Against counts in plain Python, whether tasks know the counts or they are joined."""
    monkeypatch.setattr(M, "KNOWN", known)
    rng = random.Random(3)
    texts = [" ".join(f"w{int(rng.paretovariate(0.4)) % 6000}" for _ in range(400)) for _ in range(40)]
    model = M.train(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert bool(model.table) == (known < 1 << 18)
    counts = Counter(" ".join(texts).split())
    hashes = {w: int(M.word_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]))[0][0]) for w in [*counts, "zzgibberish"]}
    own = set(model.hashes.tolist())
    rare = {w: counts[w] for w in counts if hashes[w] not in own}
    totals = Counter()
    for w, n in rare.items():
        totals[hashes[w] >> 58] += n
    assert len(rare) > 100
    several = [*texts[:5], "zzgibberish " + texts[0], None, next(iter(rare))]
    rows = spark.createDataFrame([(None if i == 2 else 1, t) for i, t in enumerate(several)], "doc_id long, text string").coalesce(1)
    want = []
    for t in several:
        words = (t or "").split()
        tokens = model.tokens(np.array([hashes[w] for w in words], np.uint64))
        entry = M.log_probs(model, tokens, np.array([0, len(words)]), 1 << 15).sum() if words else 0.0
        share = [np.log(rare.get(w, 2.0 ** -58) / (totals[hashes[w] >> 58] + 1)) for w in words if hashes[w] not in own]
        want.append((len(words), entry + sum(share)))
    got = sorted((r.n_words, r.log_prob) for r in M.score(spark, rows, model).collect())
    assert [n for n, _ in got] == sorted(n for n, _ in want)
    assert [p for _, p in got] == pytest.approx([p for _, p in sorted(want)], rel=1e-5)


def test_entries_grow_with_the_words(spark, monkeypatch):
    monkeypatch.setattr(M, "DISTINCT", 100)
    docs = spark.createDataFrame([(i, " ".join(f"v{(i * 7 + j) % 2000}" for j in range(100))) for i in range(200)], "doc_id long, text string")
    model = M.train(spark, docs)
    assert model.side > M.CLASSES
    assert len(model.hashes) > M.ENTRIES - M.BUCKETS
    first = np.array([0, 3])
    total = sum(np.exp(M.log_probs(model, np.array([1, e, 2]), first)[1]) for e in range(0, model.pad))
    assert total == pytest.approx(1, abs=1e-3) and all(r.log_prob < 0 for r in M.score(spark, docs, model).collect())


def test_every_place_is_a_target(spark, monkeypatch):
    """With the defaults, the rounds see as many targets as there are words."""
    assert M.ROUNDS % M.STRIDE == 0
    summed, seen = M._summed, []

    def counting(rows, *keys):
        if "salt" in keys:
            seen.append(rows.where("part = 0").agg(F.sum("n").alias("n")).first().n)
        return summed(rows, *keys)

    monkeypatch.setattr(M, "_summed", counting)
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i))) for i in range(1, 30)], "doc_id long, text string")
    M.train(spark, docs)
    assert sum(seen) == sum(range(1, 30)) * M.ROUNDS // M.STRIDE


def test_texts_are_read_twice(spark, monkeypatch):
    """Once to count and once for their entries; rounds and scores read these."""
    read, rows = spark.sparkContext.accumulator(0), [(i, f"a{i % 7} b c{i % 5} d") for i in range(50)] + [(None, None), (3, "")]

    def counting(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    documents = spark.createDataFrame(rows, "doc_id long, text string").mapInArrow(counting, "doc_id long, text string")
    monkeypatch.setattr(queries, "table", lambda *_: documents)
    got = QUERIES["op4_pseudo_likelihood"](spark, "").collect()
    assert read.value == 2 * len(rows)
    model = M.train(spark, documents)
    again = M.score(spark, documents, model).collect()
    assert len(got) == len(rows) and Counter((r.doc_id, r.n_words) for r in got) == Counter((r.doc_id, r.n_words) for r in again)
    assert sorted(r.log_prob for r in got) == pytest.approx(sorted(r.log_prob for r in again))


def test_run_sums_are_those_of_reduceat():
    rng = np.random.default_rng(4)
    for lengths in ([1], [1, 1, 2], [30], [8, 9, 1, 40, 2, 7, 1, 8], rng.integers(1, 14, 300), np.full(20, 9), np.full(20, 3)):
        first = np.cumsum(lengths) - lengths
        rows, values = rng.integers(0, 50, np.sum(lengths)), rng.normal(size=(50, 5)).astype(np.float32)
        order, got = M._run_sums(values, rows, first)
        assert sorted(order.tolist()) == list(range(len(first)))
        assert np.array_equal(got, np.add.reduceat(values[rows], first, axis=0)[order])


def test_places_of_words():
    rng = np.random.default_rng(5)
    close = np.uint64(77 << 40) + np.arange(20, dtype=np.uint64)  # alike in their leading bits
    for hashes in (close, rng.integers(0, 1 << 63, 1000, np.uint64) * np.uint64(2), np.array([0, (1 << 64) - 1], np.uint64)):
        hashes = np.unique(hashes)
        words = np.concatenate([hashes, hashes + np.uint64(1), close, np.array([0, (1 << 64) - 1], np.uint64)])
        want = {int(h): i for i, h in enumerate(hashes)}
        assert M._places(hashes, M._heads(hashes), words).tolist() == [want.get(int(w), -1) for w in words]


def test_many_entries_and_long_texts(spark):
    """Entries beyond 16 bits, rows of several pieces, nulls between them."""
    model = M.start(np.zeros(0, np.uint64), side=264)
    texts = ["one two three", None, " ".join(f"w{i}" for i in range(300_000)), "", " ".join(f"v{i % 9}" for i in range(300_000)), "four"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_words, r.log_prob) for r in M.score(spark, docs, model).collect()}
    for i, t in enumerate(texts):
        words = M.word_hashes(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len(t or "")]))[0]
        tokens = model.tokens(words)
        assert len(words) == 0 or tokens.min() > 1 << 16
        want = M.log_probs(model, tokens, np.array([0, len(words)])).sum() + len(words) * M.ONE_HASH
        assert got[i] == (len(words), pytest.approx(want, rel=1e-9))
