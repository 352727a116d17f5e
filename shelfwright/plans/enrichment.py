"""The enrichment pass: which listings ask for evidence, and what became of all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwright.functions.ids import url_hash
from shelfwright.operators.latest import first_by_key
from shelfwright.operators.quality import reject_cascade
from shelfwright.plans.silver import outcome_counts

#: Outcome of the counts -> counter of the pass.
COUNTERS = {"inserted": "created", "duplicate": "skipped", "error": "error"}


def gate(listings: DataFrame, url: str = "product_url", name: str = "product_name_raw") -> DataFrame:
    """Add ``url_hash`` and ``outcome``: ``error`` without url or name (an empty text is none, blanks are a text), else NULL."""
    lacks = [F.coalesce(F.col(c), F.lit("")) == "" for c in (url, name)]
    judged = reject_cascade(listings, [("error", lacks[0] | lacks[1])])
    return judged.withColumn("url_hash", F.when(F.col("outcome").isNull(), url_hash(F.col(url))))


def work_list(listings: DataFrame, index: DataFrame, order: list[str], url: str = "product_url", name: str = "product_name_raw") -> DataFrame:
    """The first listing of each url that has no index entry: what the pass has to enrich."""
    open_ = gate(listings, url, name).where("outcome is null").drop("outcome")
    fresh = open_.join(index.select("url_hash").distinct(), "url_hash", "left_anti")
    return first_by_key(fresh, ["url_hash"], order)


def counts(listings: DataFrame, index: DataFrame, url: str = "product_url", name: str = "product_name_raw") -> DataFrame:
    """``outcome, n_rows``: created, skipped (indexed before, or met again) and errors, with ``processed`` for all."""
    judged = gate(listings, url, name)
    per = outcome_counts(judged, "url_hash", index)
    named = F.create_map(*[F.lit(x) for pair in COUNTERS.items() for x in pair])
    counters = per.groupBy(named[F.col("outcome")].alias("outcome")).agg(F.sum("n_rows").alias("n_rows"))
    return counters.union(counters.agg(F.lit("processed"), F.coalesce(F.sum("n_rows"), F.lit(0).cast("bigint"))))
