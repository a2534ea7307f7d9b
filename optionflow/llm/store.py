"""Tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder below `spark.checkpoint.dir`.

    Where that is unset, a local session (tests) gets a temporary folder; on a cluster
    it is an error, since no folder is known to be shared.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root}/llm-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """The same rows, written to a table in the shared folder and read back.

    Cuts the lineage: a lost executor costs a read of this table, not the work before it.
    """
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def drop(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables that `kept` has made, by the file system the session itself uses."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for df in tables:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
