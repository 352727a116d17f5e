"""Training-corpus pipeline: from ``documents`` to token ids, each stage one of the operators in ``shelfwright.llm``.

A stage takes all that its predecessor kept, as a written table, and drops what its operator decides; only the last one changes
the columns. A decision holds for a row: rows without a ``doc_id`` and rows that share one are told apart.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwright.bindings.registry import query, table
from shelfwright.llm import extendible_dedup, langid, ngram_join, sp_viterbi, template_decon
from shelfwright.llm.frames import dropping, written

#: Least share of a document's n-grams that its language must know. Prose of any learned language has 0.8 and more.
LEAST_KNOWN = 0.2
PIECE_MODEL = "piece_bpe_32k.model"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; the labels of three quarters of the documents teach it."""
    model = langid.learn(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.accepted(spark, docs, model, LEAST_KNOWN)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest ``doc_id``."""
    return dropping(spark, docs, lambda rows: extendible_dedup.mark_copies(spark, rows).where("not kept"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest ``doc_id``."""
    return dropping(spark, docs, lambda rows: ngram_join.link_components(spark, rows).where("doc_id <> component_id"))


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item, neither its template nor a verbatim copy."""
    benchmark = table(spark, sf_dir, "benchmark")
    return dropping(spark, docs, lambda rows: template_decon.find_leaks(spark, rows, benchmark))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids``: piece ids of each document."""
    return sp_viterbi.encode(spark, docs, sp_viterbi.load(public_tokenizers.path(PIECE_MODEL)))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("exact_copies", exact_copies), ("near_copies", near_copies), ("leaks", leaks), ("pieces", pieces),
]

#: Language scores, template matches and piece ids are no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
