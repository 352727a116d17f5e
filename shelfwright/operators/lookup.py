"""From market events to their evidence, and hints for events that have none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwright.functions.coerce import text_to_str
from shelfwright.functions.ids import url_hash
from shelfwright.functions.text import strip
from shelfwright.operators.latest import top_k


def index_by_hash(index: DataFrame) -> DataFrame:
    """One row per ``url_hash``: entry count, hypothesis count and single path.

    Counts and a minimum stand for the entries, so a hash with very many
    entries stays one row. Only a hash with exactly one entry gets a path.
    """
    lone = F.count("*") == 1
    if "readable" in index.columns:
        index = index.where("readable")
    return index.groupBy("url_hash").agg(
        F.count("*").alias("n_entries"),
        F.when(lone, F.min(F.coalesce(F.size("hypotheses"), F.lit(0)))).alias("n_hypotheses"),
        F.when(lone, F.min(F.when(F.size("hypotheses") == 1, F.get("hypotheses", F.lit(0))))).alias("path"),
    )


def lookup_chain(
    events: DataFrame, index: DataFrame, evidence: DataFrame, url: Column | str = "product_url"
) -> DataFrame:
    """Add index and evidence columns to every event.

    Events find their entry by ``sha256(url)``, the entry its evidence by path.
    Index and evidence are joined first, at product size; the much larger event
    side is then exchanged once, on a short hash of the hash: its 64 digits hardly
    compress and would be half of what is exchanged. They are compared as a whole
    after the exchange. ``evidence`` has one row per ``path``; its other columns are
    added as they are.
    """
    c = F.col(url) if isinstance(url, str) else url
    digest = url_hash(text_to_str(c))
    products = (
        index_by_hash(index)
        .join(evidence.withColumn("evidence_found", F.lit(True)), "path", "left")
        .withColumn("evidence_found", F.coalesce("evidence_found", F.lit(False)))
    )
    added = [n for n in products.columns if n != "url_hash"]
    events = events.drop("url_hash")
    keyed = events.withColumn("_key", F.xxhash64(digest))
    entries = products.withColumnsRenamed({"url_hash": "_hash"}).withColumn("_entry", F.xxhash64("_hash"))
    # Not as an equality, which would be a key of the exchange and of the sort. A blank text has no entry.
    same = F.array_contains(F.array("_hash"), url_hash(strip(c))) & (strip(c) != "")
    found = keyed.join(entries, (F.col("_key") == F.col("_entry")) & same, "left")
    return found.withColumn("url_hash", digest).select("url_hash", *events.columns, *added)


def index_hints(
    events: DataFrame, index: DataFrame, url: str = "product_url", name: str = "normalized_name", n: int = 5
) -> DataFrame:
    """Add up to ``n`` index paths with the event's url and with its name.

    Each list is cut to ``n`` before it is built.
    """
    def hints(key: str, out: str) -> DataFrame:
        some = top_k(index.where(F.col(key).isNotNull()), [key], ["index_path"], n, rank="_rank", ties=False)
        return some.groupBy(key).agg(F.sort_array(F.collect_list("index_path")).alias(out))

    by_url = hints("product_url", "url_hints").withColumnRenamed("product_url", url)
    by_name = hints("normalized_name", "name_hints").withColumnRenamed("normalized_name", name)
    none = F.array().cast("array<string>")
    return events.join(by_url, url, "left").join(by_name, name, "left").withColumns({
        "url_hints": F.coalesce("url_hints", none), "name_hints": F.coalesce("name_hints", none),
    })


def new_products(listings: DataFrame, index: DataFrame, url: str = "product_url") -> DataFrame:
    """Listings whose url hash is not indexed yet."""
    known = index.select("url_hash").distinct()
    return listings.withColumn("url_hash", url_hash(F.col(url))).join(known, "url_hash", "left_anti")
