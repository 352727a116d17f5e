"""Latest, first and top rows per key.

All three rank inside a window and filter on the rank. Catalyst turns that into
a group limit on both sides of the exchange: every task first cuts its own rows
to the wanted number per key, so a key that holds a third of the table crosses
the network as a few rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Keys = Sequence[str | Column]


def _cols(keys: Keys) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def first_by_key(df: DataFrame, keys: Keys, order: Keys) -> DataFrame:
    """The first row of every key in ``order``, which must end unique."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*_cols(order))
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def latest_by_key(df: DataFrame, keys: Keys, time: str, tie: Keys = ()) -> DataFrame:
    """The newest row of every key; ``tie`` decides between equal times.

    Rows without a time are older than all others.
    """
    return first_by_key(df, keys, [F.col(time).desc_nulls_last(), *_cols(tie)])


def top_k(
    df: DataFrame, part: Keys, order: Keys, k: int, rank: str = "rank", ties: bool = True
) -> DataFrame:
    """Rows ranked ``<= k`` per ``part``; with ``ties`` equal rows share a rank."""
    w = Window.partitionBy(*_cols(part)).orderBy(*_cols(order))
    ranked = df.withColumn(rank, (F.rank() if ties else F.row_number()).over(w))
    return ranked.where(F.col(rank) <= k)


def first_rows(df: DataFrame, order: Keys, n: int | None) -> DataFrame:
    """The first ``n`` rows in ``order``; all of them without ``n``."""
    return df if n is None else df.orderBy(*_cols(order)).limit(n)
