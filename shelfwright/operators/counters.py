"""Counters that come from the pass that writes, instead of a second read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ACCEPTED, TOTAL = "accepted", "total"


def counted(df: DataFrame, outcomes: Sequence[str], column: str = "outcome") -> tuple[DataFrame, Observation]:
    """``df``, and an observation of its rows per outcome, of accepted rows (NULL) and of all; filled by the next write of ``df``.

    It has to stand last before the write: then each written task counts once, also where tasks are repeated.
    """
    seen = Observation()
    counts = [F.count_if(F.col(column) == name).alias(name) for name in outcomes]
    return df.observe(seen, *counts, F.count_if(F.col(column).isNull()).alias(ACCEPTED), F.count("*").alias(TOTAL)), seen


def tally(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df``, and an observation of its number of rows."""
    seen = Observation()
    return df.observe(seen, F.count("*").alias(TOTAL)), seen


def rows(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """``outcome, n_rows`` of the counters that are not zero."""
    return spark.createDataFrame([(k, v) for k, v in sorted(counts.items()) if v], "outcome string, n_rows bigint")
