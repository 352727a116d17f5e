"""Session settings the jobs were planned for, and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Scratch folder of a local session without ``spark.checkpoint.dir``.
SCRATCH = "shelfwright.scratch.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "shelfwright", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution, skew splitting and UTC times."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a hot key even where the split costs one more exchange.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.ui.enabled": "false",
        # Do not record a Python stack for every column expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def workspace(spark: SparkSession, name: str) -> str:
    """New folder for files that outlive one task.

    It lies in the shared folder of ``spark.checkpoint.dir``, which every
    executor reaches. Only a local session without that setting, as in tests,
    gets a folder of its own, one for all its files, in ``SCRATCH``.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH, None)
    if not shared:
        shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="shelfwright-")
        spark.conf.set(SCRATCH, shared)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly to as many partitions as a shuffle has: a small file can hold very many rows, and one task would work on all."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What an action inside exchanges goes from the disks when the action ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def written(spark: SparkSession, df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder, read back: computed once, and its lineage ends there.

    The folder lies below ``spark.checkpoint.dir``; who owns that folder clears it. ``codec`` is a
    compression other than the session's, for tables of very many wide rows.
    """
    path = workspace(spark, name)
    with shuffles_freed(spark):
        (df.write if codec is None else df.write.option("compression", codec)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
