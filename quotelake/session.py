"""Session helpers: shared work folder, small tables, size-checked broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.config import DEFAULT


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session (tests) may name none; it gets a temporary one. On a
    cluster every machine would write to a disk of its own, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quotelake-"))
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written_once(df: DataFrame) -> DataFrame:
    """Write a table once and go on from the written rows.

    A reliable checkpoint: it lives in the shared folder and survives the loss
    of any executor.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_table(df: DataFrame) -> DataFrame:
    """Keep a small derived table, so a large scan behind it is not repeated."""
    return written_once(df)


def fits(df: DataFrame, limit: int) -> bool:
    """Whether ``df`` has at most ``limit`` bytes, by its rows and their width."""
    return df.count() * df._jdf.schema().defaultSize() <= limit


def bounded_broadcast(df: DataFrame, limit: int = DEFAULT.broadcast_bytes) -> DataFrame:
    """Broadcast ``df`` if it provably has at most ``limit`` bytes, else leave it.

    Above the bound the join stays a shuffled equi-join.
    """
    return F.broadcast(df) if fits(df, limit) else df
