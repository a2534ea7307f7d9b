"""Given tables replayed as file streams in arrival order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from optionflow.sources import readers
from optionflow.streaming import runs

STRETCHES = 4
CLOSING_KEY = "~close"
CLOSING_MS = 3_600_000


def with_closing_tick(ticks: DataFrame) -> DataFrame:
    """One more tick, of an instrument of its own, that moves the watermark past the end."""
    last = ticks.agg((F.max("seq") + 1).alias("seq"), (F.max("ltt") + CLOSING_MS).alias("ltt"))
    fixed = {
        "instrument_key": F.lit(CLOSING_KEY),
        "arrival_ms": F.col("ltt"),
        "ltp": F.lit(0.0),
        "bid_p": F.lit(0.0),
        "ask_p": F.lit(0.0),
        **{c: F.lit(1).cast("bigint") for c in ("ltq", "vtt", "oi")},
    }
    return ticks.unionByName(last.withColumns(fixed))


def _plus(schema: T.StructType, name: str) -> T.StructType:
    return T.StructType([*schema, T.StructField(name, T.LongType())])


def run(
    spark: SparkSession,
    rows: DataFrame,
    build,
    mode: str = "append",
    stretches: int = STRETCHES,
    sink=None,
    before=None,
    added: str = "",
) -> DataFrame | None:
    """Replay rows through `build` and read back what it wrote.

    The input folder grows by one stretch of arrival order at a time. The query is stopped
    and restarted from its checkpoint in between, so each stretch is one micro-batch, of any
    number of files, and every run is also a recovery test.

    `sink(folder)` makes another batch function than the plain one. If it writes to `folder`/out too, `added`
    says with which columns; else there is nothing to read back. `before(folder, stretch)` runs ahead of each stretch.
    """
    folder = runs.work_folder(spark)
    stage(spark, rows, folder, stretches)
    staged = spark.read.schema(_plus(rows.schema, "stretch")).parquet(f"{folder}/staged")
    for i in range(stretches):
        staged.filter(F.col("stretch") == i).drop("stretch").write.mode("append").parquet(f"{folder}/input")
        if before:
            before(folder, i)
        out = build(readers.stream(spark, f"{folder}/input", rows.schema, files_per_trigger=None))
        runs.drain(out, folder, mode, sink(folder) if sink else None)
    if sink:
        if not added:
            return None
        schema = T.StructType([*T.StructType.fromDDL(added), T.StructField("batch_id", T.LongType())])
        return runs.written(spark, folder, schema)
    return runs.written(spark, folder, _plus(out.schema, "batch_id"))


def stage(spark: SparkSession, rows: DataFrame, folder: str, stretches: int) -> None:
    """The rows by stretches of equal width along `seq`."""
    last = rows.agg(F.max("seq").alias("seq")).scalar()
    stretch = F.call_function("div", F.col("seq") * stretches, last + 1)
    rows.withColumn("stretch", stretch).write.partitionBy("stretch").parquet(f"{folder}/staged")
