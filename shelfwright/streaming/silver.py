"""The silver load over a stream of array pages.

Every batch of newly arrived pages goes through the whole load: index and evidence are read again (entries that arrived since count),
matched at product size, and the listings of the batch join them once. Variants, judged listings and facts are stores of batch
folders as in ``jobs``: a batch that is replayed replaces what it wrote, what all other folders hold is the state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfwright.operators.merge import conform_to_target
from shelfwright.plans import silver
from shelfwright.schemas import VARIANT
from shelfwright.session import written
from shelfwright.streaming import jobs

VARIANTS, JUDGED, FACTS = "variants", "judged", "facts"
_SCAN = ("ref", "file", "pos")


def load(
    listings: DataFrame, base: str, checkpoint: str, index: Callable[[], DataFrame], evidence: Callable[[], DataFrame], dim: DataFrame,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run the load for each batch of ``listings`` (from ``scan.stream_listings``), into stores below ``base``.

    ``index`` and ``evidence`` are called for every batch. The first arrival of a fact wins; within a batch the first in scan order.
    """
    def step(batch: DataFrame, run: str, batch_id: int) -> None:
        spark, place = batch.sparkSession, f"run={run}/batch_id={batch_id}"
        known = jobs.read_batches(spark, f"{base}/{VARIANTS}", VARIANT, besides=(run, batch_id), sharded=False)
        known = None if known is None else known.select(*VARIANT.names)
        new, products = silver.load_products(spark, evidence(), dim, known)
        conform_to_target(new, VARIANT).write.mode("overwrite").parquet(f"{base}/{VARIANTS}/{place}")
        pages = batch.withColumnRenamed("readable", "page_readable")
        found = silver.classify_observations(pages, index(), products)
        judged = written(spark, found.select("ref", "outcome", *[n for n in silver.FACT_INPUTS if n in found.columns]), "judged", silver.CODEC)
        stored = judged.select("ref", "file", "pos", "outcome", "observation_id").write.option("compression", silver.CODEC)
        stored.mode("overwrite").parquet(f"{base}/{JUDGED}/{place}")
        accepted = silver.accepted_observations(judged)
        jobs.append_batch(accepted, f"{base}/{FACTS}", accepted.schema, "observation_id", ["file", "pos"], run, batch_id, silver.CODEC, stored=True)

    return jobs.each_batch(listings, step, checkpoint, trigger)


def facts(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """All facts so far in the columns and types of ``schema``."""
    stored = T.StructType([*[f for f in schema.fields if f.name != "observed_at"], T.StructField("observed_at", T.StringType())])
    return conform_to_target(jobs.read_batches(spark, f"{base}/{FACTS}", stored), schema)


def outcomes(spark: SparkSession, base: str) -> DataFrame:
    """Rows per outcome over all batches."""
    schema = T.StructType([T.StructField("outcome", T.StringType()), T.StructField("observation_id", T.StringType())])
    return silver.outcome_counts(jobs.read_batches(spark, f"{base}/{JUDGED}", schema, sharded=False), "observation_id")
