"""Language, tokens and pieces against the libraries, and held-out accuracy."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_format
from tokenizers import Tokenizer

from shelfwright.llm import langid as L
from shelfwright.llm import sp_viterbi as S
from shelfwright.llm import token_files as T

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
SCRAPS = ("the of   a\n\n aa  hello WORLD 12,345.67 été naïve 漢字仮名 ▁ x▁ e.g. don't ~~~~ ==== \t 🙂🙂 Ünïcode aaaaaaaa "
          "http://a.b/c?d=e&f <0x0A> </s> <|endoftext|> \x1c \x85 \xa0 ... I'll").split(" ")


def scrap_texts(n, seed=1):
    rng = random.Random(seed)
    out = ["", " ", "  ", "a", " a", "a ", "\n", "a" * 300, " " * 37, "x" + " " * 50 + "y", "漢" * 90, "the" * 200]
    out += [rng.choice(["", " ", "  "]).join(rng.choice(SCRAPS) for _ in range(rng.randint(1, 20))) for _ in range(n)]
    return out + ["".join(rng.choice("abcdeht .,\n  ieniron▁é") for _ in range(rng.randint(1, 90))) for _ in range(n)]


# --- language ------------------------------------------------------------------

def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fold = L.held_out(F.col("doc_id"))
    model = L.learn(docs.where(~fold), sample=300)
    rows = L.predict(spark, docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(L.held_out(F.col("doc_id"))).collect()
    assert len(rows) > 150 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def plain_grams(text):
    """N-grams of a text as strings, with the same rules."""
    line = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    for order in L.ORDERS:
        for i in range(len(line) - order + 1):
            gram = line[i:i + order]
            if " " not in gram[1:-1] and not (gram[0] == gram[-1] == " "):
                yield gram


def test_predictions_equal_plain_sets(spark):
    """Sets of the most frequent n-grams in plain Python, without filter or hash, give the same languages and shares."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.select("doc_id", "text", "lang").collect()]
    counts = defaultdict(Counter)
    for doc_id, text, lang in rows:
        if text is not None and lang is not None and zlib.crc32(str(doc_id).encode()) % 4 != 2:
            for gram in plain_grams(text):
                counts[lang, len(gram)][gram] += 1

    def signed(gram):
        return int(L.grams(np.array([ord(c) for c in gram], np.uint32), len(gram))[0].view(np.int64)[0])

    sets = defaultdict(set)
    for (lang, _), of in counts.items():
        sets[lang] |= {g for g, _ in sorted(of.items(), key=lambda x: (-x[1], signed(x[0])))[:L.TOP]}
    got = {r.doc_id: r for r in L.predict(spark, docs, L.learn(docs.where(~L.held_out(F.col("doc_id"))))).collect()}
    assert len(got) == len(rows) and len(sets) > 2
    for doc_id, text, _ in rows:
        grams = list(plain_grams(text or ""))
        shares = {lang: sum(g in of for g in grams) / max(1, len(grams)) for lang, of in sets.items()}
        if not any(c.isalpha() for c in text or ""):
            assert (got[doc_id].lang_pred, got[doc_id].score) == (L.UNKNOWN, 0)
            continue
        # A filter answers too often by chance, for one n-gram in thousands.
        slack = 0.01 + 1 / max(1, len(grams))
        assert abs(got[doc_id].score - shares[got[doc_id].lang_pred]) <= slack
        assert shares[got[doc_id].lang_pred] >= max(shares.values()) - slack


def test_fold(spark):
    ids = spark.createDataFrame([(i,) for i in range(200)] + [(None,)], "doc_id long")
    got = {r[0]: r[1] for r in ids.select("doc_id", L.held_out(F.col("doc_id"))).collect()}
    assert got.pop(None) and got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(200)}


def test_language_edges(spark, documents, corpus, nothing):
    taught = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate([("the house and the mouse", "en"), ("das haus und die maus", "de"), (None, "de"), ("x", None)] * 5)],
                                   "doc_id long, text string, lang string")
    model = L.learn(taught)
    assert model.languages == ["de", "en"]
    rows = {r.doc_id: r for r in L.predict(spark, documents, model).collect() if r.doc_id is not None}
    for doc, text in corpus:
        if doc is not None and not any(c.isalpha() for c in text or ""):
            assert (rows[doc].lang_pred, rows[doc].score) == ("und", 0.0)
    assert L.predict(spark, nothing, model).count() == 0
    empty = L.learn(taught.where("1 = 0"))
    assert {r.lang_pred for r in L.predict(spark, documents, empty).collect()} == {"und"}
    kept = L.accepted(spark, documents, model, 0.0)
    assert kept.columns == documents.columns


def test_masks_tell_all_languages_of_a_gram():
    many = [f"l{i:02}" for i in range(19)]
    model = L.build(many, [(name, 1000 * i + j) for i, name in enumerate(many) for j in range(20)] + [(name, 77) for name in many[3:9]])
    hits = model.hits(np.array([5003, 77], np.int64).view(np.uint64))
    assert hits[0, 5] == 1 and list(np.flatnonzero(hits[1]))[:6] == [3, 4, 5, 6, 7, 8]
    assert (model.chance() < 1e-3).all()


# --- token files ------------------------------------------------------------------

def test_tokens_equal_the_library():
    library, own = Tokenizer.from_file(BYTES), None
    library.encode_special_tokens = True
    with open(BYTES) as file:
        own = T.Encoder(file.read(), 2, "<u2")
    texts = scrap_texts(1500)
    for text, got in zip(texts, own.encode_all(texts), strict=True):
        assert np.frombuffer(got, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids + [2]


def test_files_hold_every_document(spark, corpus, documents, nothing, tmp_path):
    path = f"file://{tmp_path}/tokens"
    T.write(spark, documents, path, BYTES, 2)
    library, start, want = Tokenizer.from_file(BYTES), 0, []
    for doc, text in sorted(corpus, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted((tuple(r) for r in T.digest(spark, path).collect()), key=lambda r: r[1])
    assert got == want
    tokens = {r.start: r.tokens for r in T.read(spark, path).collect()}
    assert all(len(tokens[s]) == n and tokens[s][-1] == 2 for _, s, n, _ in want)
    T.write(spark, nothing, f"file://{tmp_path}/none", BYTES, 2)
    assert T.digest(spark, f"file://{tmp_path}/none").count() == 0


# --- pieces -----------------------------------------------------------------------

def unigram(serialized):
    """The same pieces as a unigram model."""
    spec = model_format.ModelProto()
    spec.ParseFromString(serialized)
    spec.trainer_spec.model_type = 1
    for piece in spec.pieces:
        piece.score = max(piece.score, -40000)
    return spec.SerializeToString()


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
def test_pieces_equal_the_library(kind):
    serialized = S.load(PIECES) if kind == "bpe" else unigram(S.load(PIECES))
    library, own = sentencepiece.SentencePieceProcessor(model_proto=serialized), S.Encoder(S.Model(serialized))
    texts = scrap_texts(1500)
    for text, got in zip(texts, own.encode_all(texts), strict=True):
        ids = np.frombuffer(got, np.int32).tolist()
        assert ids == library.encode(text)
        assert own.decode(ids) == text.replace("▁", " ")
        if text:  # the streaming search, without any memory of parts
            assert own.search("▁" + text.replace(" ", "▁")) == got


def test_window_is_bounded():
    model = S.Model(S.load(PIECES))
    lattice, most = S.Lattice(model), 0
    text = "▁" + "internationalisation" * 500
    pieces = []
    for character in text:
        pieces += lattice.push(character)
        most = max(most, len(lattice.tail))
    pieces += lattice.finish()
    assert "".join(pieces) == text and most < 8 * model.longest


def test_models_with_a_normaliser_are_refused():
    spec = model_format.ModelProto()
    spec.ParseFromString(S.load(PIECES))
    spec.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        S.Model(spec.SerializeToString())


def test_pieces_of_documents(spark, corpus, documents, nothing):
    model = S.load(PIECES)
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    rows = S.round_trip(spark, documents, model).collect()
    want = sorted((d, len(i), zlib.crc32(np.array(i, "<u4").tobytes()), len(t or ""), True) for d, t in corpus if d is not None for i in [library.encode(t or "")])
    assert sorted(tuple(r) for r in rows if r.doc_id is not None) == want
    encoded = S.encode(spark, documents, model)
    back = sorted((r.doc_id, r.text) for r in S.decode(spark, encoded, model).collect() if r.doc_id is not None)
    assert back == sorted((d, t or "") for d, t in corpus if d is not None)
    assert S.encode(spark, nothing, model).count() == 0


def test_vocabularies_of_any_size():
    """More pieces than the tables have room for without conflicts."""
    rng = random.Random(2)
    spec = model_format.ModelProto()
    spec.ParseFromString(S.load(PIECES))
    known = {p.piece for p in spec.pieces}
    for _ in range(60_000):
        piece = "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(3, 9)))
        if piece not in known:
            known.add(piece)
            spec.pieces.add(piece=piece, score=-50000.0 - len(known))
    sweep = S.Sweep(S.Model(spec.SerializeToString()))
    assert len(sweep.rest) and (sweep._lookup(sweep.keys) == np.arange(len(sweep.pieces))).all()
    others = sweep.keys ^ np.uint64(0x5A5A5A5A5A5A5A5A)
    assert (sweep._lookup(others[~np.isin(others, sweep.keys)]) < 0).all()
