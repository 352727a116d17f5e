"""Stages of the pipeline on planted cases, and the optional part of the entry module."""

import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
import sentencepiece

import __spark_entry__ as entry
import corpus_pipeline as P
from shelfwright.llm.sp_viterbi import load

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("corpus")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plain = [r.text for r in docs.where("lang = 'en' and length(text) between 900 and 3000").orderBy("doc_id").limit(6).collect()]
    item = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").orderBy("item_id").first().text
    near = plain[1].split(" ")
    near[7] = "changedword"
    rows = [(100_001, plain[0].upper()), (100_002, plain[0].lower()), (100_003, plain[0].lower()), (100_004, " ".join(near)), (100_005, plain[1]),
            (100_006, f"{plain[2]} {item} {plain[3]}"), (100_007, None), (100_008, " 123 ... "), (100_009, ""), (None, plain[4] + " own words here")]
    more = spark.createDataFrame([(d, t, None, "src", None) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.union(more).selectExpr("*", "1 as key", "'x' as component_id").write.parquet(f"{base}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(f"{base}/benchmark.parquet")
    return str(base)


def test_stages(spark, folder):
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    columns = docs.columns
    for name, stage in P.STAGES[:-1]:
        out = P.written(spark, stage(spark, docs, folder), name)
        assert out.columns == columns and out.count() <= docs.count()
        before = {r.doc_id: tuple(r) for r in docs.collect() if r.doc_id is not None}
        assert all(before[r.doc_id] == tuple(r) for r in out.collect() if r.doc_id is not None)
        kept.append({r.doc_id for r in out.collect()})
        docs = out
    language, exact, near, clean = kept
    assert not language & {100_007, 100_008, 100_009} and {100_001, 100_003, 100_006, None} <= language
    assert exact & {100_001, 100_002, 100_003} == {100_003} and None in exact
    assert len(near & {100_004, 100_005}) <= 1 and 100_003 in exact
    assert 100_006 in near and 100_006 not in clean and None in clean
    last = P.STAGES[-1][1](spark, docs, folder).collect()
    library = sentencepiece.SentencePieceProcessor(model_proto=load(P.public_tokenizers.path(P.PIECE_MODEL)))
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(last) == len(texts) and all(np.array_equal(r.ids, library.encode(texts[r.doc_id])) for r in last)
    assert sorted(map(str, P.run(spark, folder).collect())) == sorted(map(str, last))


def test_stages_of_nothing(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("1 = 0")
    for _, stage in P.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_decisions_hold_for_rows(spark, folder):
    """Rows without an id and rows that share one: each is decided on its own, and all columns come back."""
    texts = ["own words " + " ".join(f"w{i * 7 + k}" for i in range(30)) for k in range(4)]
    leak = spark.read.parquet(f"{folder}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(None, texts[0]), (None, texts[0]), (5, texts[0]), (7, texts[1]), (7, texts[1]), (7, texts[2]), (None, leak), (7, leak), (8, texts[3]), (None, None)]
    docs = spark.createDataFrame([(d, t, n) for n, (d, t) in enumerate(rows)], "doc_id int, text string, own_at int").repartition(3)

    def left(stage, docs=docs):
        out = stage(spark, docs, folder)
        assert out.schema == docs.schema
        return sorted((r.own_at, r.doc_id) for r in out.collect())

    exact = left(P.exact_copies)
    assert (2, 5) in exact and not {(0, None), (1, None)} & set(exact) and len({(3, 7), (4, 7)} & set(exact)) == 1
    assert {(5, 7), (8, 8), (9, None)} <= set(exact) and len({(6, None), (7, 7)} & set(exact)) == 1 and (7, 7) in exact
    near = left(P.near_copies)
    assert len([n for n, _ in near if n in (0, 1, 2)]) == len([n for n, _ in near if n in (3, 4)]) == len([n for n, _ in near if n in (6, 7)]) == 1
    assert {5, 8, 9} <= {n for n, _ in near}
    assert [n for n, _ in left(P.leaks)] == [0, 1, 2, 3, 4, 5, 8, 9]


def test_registered():
    names = [n for n in entry.queries() if n == "pipeline" or n.startswith("op")]
    assert sorted(n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()) == sorted(f"op{i}" for i in range(1, 14))
    assert "pipeline" in names and 4 <= len(P.STAGES) <= 5


def test_sql_of_queries(spark):
    sys.path.insert(0, str(ROOT / "tests"))
    import test_queries

    con = test_queries.connect(test_queries.SF)
    for name, sql in entry.oracle_sql().items():
        if name.startswith("op") and name[2].isdigit():
            df = entry.queries()[name](spark, test_queries.SF)
            columns = sorted(df.columns)
            relation = con.execute(sql)
            order = [[d[0] for d in relation.description].index(c) for c in columns]
            got = sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
            assert got == sorted((tuple(r[i] for i in order) for r in con.execute(sql).fetchall()), key=str), name


def test_entry_without_the_optional_part():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("shelfwright.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert len(e.queries()) > 80 and not [n for n in e.queries() if n.startswith("op1_") or n == "pipeline"]
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
