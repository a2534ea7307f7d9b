"""Driving a stream to the end of its input, with an idempotent file sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..workspace import shared_folder


def work_folder(spark: SparkSession) -> str:
    """Folder for a stream's input copies, checkpoint and output; it has to be shared."""
    folder = shared_folder(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    return folder


def batch_writer(path: str):
    """`foreachBatch` function: one folder per batch, rewritten whole when a batch repeats."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def start(stream: DataFrame, folder: str, mode: str = "append", write=None, every: str = "500 milliseconds"):
    """Run until stopped. The interval sets the latency only: results follow event time."""
    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write or batch_writer(f"{folder}/out"))
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(processingTime=every)
        .start()
    )


def drain(stream: DataFrame, folder: str, mode: str = "append", write=None) -> None:
    """Run over all input there is, then stop. Restarting on the same folder goes on from
    its checkpoint."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write or batch_writer(f"{folder}/out"))
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def written(spark: SparkSession, folder: str, schema) -> DataFrame:
    """Everything the batches wrote, with their `batch_id`."""
    return spark.read.schema(schema).parquet(f"{folder}/out")
