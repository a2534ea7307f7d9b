"""Batch and stream scans. Schemas are explicit; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import json_array, schemas


def instrument_master(spark: SparkSession, path: str) -> DataFrame:
    """JSON array of contracts; `seq` is the file order. The file is read in many ranges, unless it is compressed as a whole."""
    return json_array.read(spark, path, schemas.INSTRUMENT_MASTER)


def option_chain(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return _table(spark, path, fmt, schemas.OPTION_CHAIN)


def strike_table(spark: SparkSession, path: str, fmt: str = "csv", missing_ok: bool = False) -> DataFrame:
    """The strike table as it is now. Called inside `foreachBatch`, every micro-batch sees
    the current file; with `missing_ok` an unreadable one is an empty table."""
    try:
        return _table(spark, path, fmt, schemas.STRIKE_TABLE)
    except Exception as error:  # AnalysisException: path does not exist
        if not missing_ok or "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schemas.STRIKE_TABLE)


def _table(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame:
    reader = spark.read.schema(schema)
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)


def alert_log(spark: SparkSession, path: str) -> DataFrame:
    """The log of any mix of profiles: older rows read the newer columns as null."""
    return spark.read.option("mergeSchema", True).parquet(path)


def movers_lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path)
    return lines.select(F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"))


def quotes(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _table(spark, path, fmt, schemas.SPOT_QUOTE)


def stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_trigger: int | None = 8
) -> DataFrame:
    """Growing folder of files in arrival order. A broker source plugs in the same way where
    its connector is installed."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def marked_tick_messages(lines: DataFrame) -> DataFrame:
    """JSON text lines -> (value, seq, arrival_ms, feeds, dead): `dead` lines cannot be read."""
    schema = T.StructType([*schemas.TICK_MESSAGE, T.StructField("_corrupt", T.StringType())])
    opts = {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}
    read = lines.select("value", F.from_json("value", schema, opts).alias("m"))
    bad = F.col("m").isNull() | F.col("m._corrupt").isNotNull() | F.col("m.feeds").isNull()
    return read.select("value", "m.seq", "m.arrival_ms", "m.feeds", bad.alias("dead"))


def decode_tick_messages(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JSON text lines -> feed messages, and the lines that cannot be read (quarantine)."""
    read = marked_tick_messages(lines)
    return read.filter(~F.col("dead")).select("seq", "arrival_ms", "feeds"), read.filter("dead").select("value")
