"""Shared scratch space of a session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str | None:
    """A new folder below the one the session names in `spark.checkpoint.dir`.

    Where none is named, a local session (tests) gets a temporary one and a cluster none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root and spark.sparkContext.master.startswith("local"):
        root = tempfile.mkdtemp(prefix="optionflow-")
    return f"{root}/optionflow-{uuid.uuid4().hex}" if root else None


def settled(df: DataFrame) -> DataFrame:
    """The same rows read back from a table in the shared folder.

    Cuts the lineage of rows that several branches of a plan use. Without a shared folder
    the branches compute them again.
    """
    folder = shared_folder(df.sparkSession)
    if folder is None:
        return df
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Hash-partition by columns into exactly the session's number of shuffle partitions.

    For Python stages: they cost more per byte than the sizes adaptive execution merges
    partitions by are made for.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)
