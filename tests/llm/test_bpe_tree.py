"""Tree concatenation against the library."""

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shelfwright.llm import bpe_tree as B
from shelfwright.llm import parts as P

from test_texts import scrap_texts

BYTES = public_tokenizers.path("byte_bpe_50k.json")
AWKWARD = ["\xa0", "　", " ", "\x85", "\x1c", "'", "'s", "'re", "don't", "é", "漢", "🙂", " ", "  ", "\n", "\r\n", "\t", "a", "the", "ing", "0", "12", "!!", "--", "A", "ſ", "\0"]


@pytest.fixture(scope="module")
def codec():
    return B.Codec(B.load(BYTES))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES)


def awkward(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(AWKWARD) for _ in range(rng.randint(1, 60))) for _ in range(n)]


def test_texts_equal_the_library(codec, library):
    texts = scrap_texts(1000, 7) + awkward(3000, 8) + ["x" * 5000, " " * 3000 + "y", "ab" * 4000 + " end", "漢字" * 900, "!?" * 700, "a<|endoftext|>b", "<|endoftext|>" * 3, "<|endoftext", None]
    got = list(codec.encode_column(pa.array(texts, pa.string())))
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == library.encode(text or "", add_special_tokens=False).ids, text
        assert codec.decode(ids) == (text or "") == library.decode(ids.tolist(), skip_special_tokens=False)


def test_forgetting_changes_nothing(codec, library, monkeypatch):
    monkeypatch.setattr(P, "REMEMBERED", 5)
    for text in scrap_texts(50, 9):
        assert next(codec.encode_column(pa.array([text]))).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 13, 40])
def test_leaves_of_any_size_join(codec, library, size):
    texts = awkward(250, size) + ["x" * 400, "a" * 257, "the" * 100, "'" * 60 + "s", " " * 90 + "x", "été" * 50, "isn't it" * 20]
    if size > 1:
        texts += ["".join(random.Random(size).choice("abcdehtrsin") for _ in range(900))]
    for text in texts:
        node = codec.tree([codec.leaf(text[a:a + size]) for a in range(0, len(text), size)])
        assert node.ids.tolist() == library.encode(text, add_special_tokens=False).ids, (size, text)
        assert node.starts.tolist() == B.run_starts(text).tolist()


@pytest.mark.parametrize("run", [1, 2, 7, 30])
def test_runs_of_any_size_join(codec, library, monkeypatch, run):
    monkeypatch.setattr(B, "RUN", run)
    rng = random.Random(run)
    words = ["a" * n for n in range(1, 70)] + ["ab" * 40, "aab" * 31, "ing" * 50, "internationalisation" * 9, "=" * 77]
    words += ["".join(rng.choice("abeinrstgh") for _ in range(rng.randint(1, 200))) for _ in range(150)] + ["é漢🙂" * 30]
    for word in words:
        data = word.encode()
        ids = codec.model.run(data)
        assert ids == codec.model.merge(data)
        if len(B.run_starts(word)) == 1:
            assert ids == library.encode(word, add_special_tokens=False).ids


def test_every_token_encodes_to_itself(codec):
    assert all(codec.model.merge(data) == [i] for i, data in codec.model.bytes.items() if i not in codec.model.special.values())


def test_other_models_are_refused():
    for name in ("word_bpe_49k.json",):
        with pytest.raises(ValueError):
            B.load(public_tokenizers.path(name))


def test_documents(spark, corpus, documents, nothing, library):
    long = " ".join(f"word{i} don't  stop" for i in range(4000)) + "y" * 70_000
    rows = [(1, long), (1, long), (2, f"{long}<|endoftext|>{long[:50_000]}"), (None, long + " "), (3, "z" * 40_000), (4, None)]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    tables = [(documents, corpus), (more, rows)]
    model = B.load(BYTES)
    for table, content in tables:
        want, ids = [], []
        for doc, text in content:
            own = library.encode(text or "", add_special_tokens=False).ids
            ids.append((doc, own))
            want.append((doc, len(own), hashlib.sha256(",".join(map(str, own)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
        assert sorted(map(tuple, B.round_trip(spark, table, model).collect()), key=str) == sorted(want, key=str)
        encoded = B.encode(spark, table, model)
        assert sorted(((r.doc_id, list(r.ids)) for r in encoded.collect()), key=str) == sorted(ids, key=str)
        back = B.decode(spark, encoded, model).collect()
        assert sorted(map(tuple, back), key=str) == sorted(((d, t or "") for d, t in content), key=str)
    assert B.round_trip(spark, nothing, model).count() == 0
    odd = spark.createDataFrame([(1, [99999999, -1, 64, 200]), (2, None)], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in B.decode(spark, odd, model).collect()} == {1: "a" + codec_bytes(model, 200).decode("utf-8", "replace"), 2: ""}


def codec_bytes(serialized, i):
    return B.Model(serialized).bytes[i]
