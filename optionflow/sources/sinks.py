"""Batch writers and the idempotent micro-batch sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators import chain as chains, records
from ..plans.profiles import Profile
from . import schemas, versions


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_list(chain: DataFrame, column: str, path: str) -> None:
    """Distinct values, one per line, in order of first appearance in the sorted chain."""
    first = F.min(F.struct(*chains.CHAIN_INDEX)).alias("first")
    values = chain.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(first)
    values.orderBy("first").select(F.col("value").cast("string")).write.mode("overwrite").text(path)


def create_alert_table(spark: SparkSession, name: str, profile: str, path: str) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.ALERT_LOG[profile])
    spark.sql(
        f"create table if not exists {name} ({columns}, trade_date date, batch_id bigint) "
        f"using parquet partitioned by (trade_date, batch_id) location '{path}'"
    )


def append_to_table(spark: SparkSession, name: str, rows: DataFrame, batch_id: int) -> None:
    """Append one batch to a catalog table of `create_alert_table`. Columns that the table lacks are added to it, those that
    the batch lacks are null; a repeated batch overwrites only its own partitions."""
    have = {c.lower() for c in spark.table(name).columns}
    new = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name.lower() not in have]
    if new:
        spark.sql(f"alter table {name} add columns ({', '.join(new)})")
    location = spark.sql(f"describe formatted {name}").filter("col_name = 'Location'").first()["data_type"]
    append_alerts(rows, location, batch_id)
    spark.sql(f"msck repair table {name}")


def append_alerts(rows: DataFrame, path: str, batch_id: int) -> None:
    """Append one batch to the log. A repeated batch overwrites only its own partitions, so
    delivery at least once leaves each alert once."""
    (
        rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("trade_date", "batch_id")
        .parquet(path)
    )


def publish(rows: DataFrame, path: str, batch_id: int) -> None:
    """JSON messages of one batch, in a folder of their own."""
    records.to_messages(rows).write.mode("overwrite").text(f"{path}/batch_id={batch_id}")


def log_and_publish(log_path: str, queue_path: str, profile: Profile, keep: tuple[str, ...] = ("trade_date",)) -> Callable:
    """`foreachBatch` function: log first, then publish. The log has the columns of the
    profile's alert log, the message its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            append_alerts(records.log_rows(batch, profile, keep), log_path, batch_id)
            publish(batch.drop(*keep), queue_path, batch_id)
        finally:
            batch.unpersist()

    return write


def write_high_conviction(alerts: DataFrame, path: str, batch_id: int, tz: str = "UTC") -> None:
    """The lines of one batch, in a folder of their own: a repeated batch rewrites it."""
    lines = records.high_conviction_feed(alerts, tz).select("line")
    lines.write.mode("overwrite").text(f"{path}/batch_id={batch_id}")


def upsert(path: str, keys: list[str], keep: int = 2) -> Callable:
    """`foreachBatch` function for a table with one row per key: a batch's rows replace those of their keys.

    The table is a version per batch, made from the one before it, so a repeated batch gives the same table and
    readers never see half of one. A batch writes the whole table: for tables of keys, not of events. Batches have
    one row per key.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = versions.read(spark, path, versions.current(spark, path, batch_id - 1))
        rows = batch
        if before is not None:
            same = [before[k].eqNullSafe(batch[k]) for k in keys]
            rows = before.join(batch.select(*keys), same, "left_anti").unionByName(batch)
        versions.write(rows, path, batch_id)
        versions.prune(spark, path, keep)

    return write


def upserted(spark: SparkSession, path: str) -> DataFrame:
    """The table of `upsert` as it is now."""
    return versions.read(spark, path, versions.current(spark, path))


def decoded_or_dead(path: str, decode: Callable[[DataFrame], DataFrame]) -> Callable:
    """`foreachBatch` function that writes readable lines to `path`/lines/batch_id=N/dead=false, the others to dead=true, in
    one pass, and how many of either to `path`/counts.

    `decode` keeps the lines (`value`) and adds a boolean `dead`. The counts are observed while the lines are written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"lines_{batch_id}")
        rows = decode(batch).observe(
            seen, F.count_if(~F.col("dead")).alias("good"), F.count_if("dead").alias("bad")
        )
        rows.write.mode("overwrite").partitionBy("dead").parquet(f"{path}/lines/batch_id={batch_id}")
        counts = batch.sparkSession.createDataFrame([(seen.get["good"], seen.get["bad"])], "good bigint, bad bigint")
        counts.write.mode("overwrite").parquet(f"{path}/counts/batch_id={batch_id}")

    return write
