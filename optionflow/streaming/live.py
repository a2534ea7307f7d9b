"""Streaming forms of the operators. Each takes a streaming DataFrame and returns one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ..functions import classify, clock
from ..operators import alerts as windows, board, registry, trades as trade_ops
from ..plans.profiles import OI_LOCK, STEP_MS, Profile
from . import processors, windows as machines

NO_TIMEOUT, EVENT_TIME = GroupStateTimeout.NoTimeout, GroupStateTimeout.EventTimeTimeout

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State on local disk with checkpointed deltas instead of the executor heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def by_slot(rows: DataFrame, key: str):
    """Rows by group of keys, for steps that take all keys of a group at once: calls cost more than rows."""
    return rows.withColumn("slot", F.pmod(F.xxhash64(key), F.lit(processors.SLOTS))).groupBy("slot")


def dedup_ticks(ticks: DataFrame) -> DataFrame:
    """Tick stream -> trade stream.

    The state, two numbers per instrument, stays as long as the stream: whatever the gap, the
    next tick is held against the last one. A step takes all instruments of a group at once, as
    calls cost more than rows.
    """
    step = processors.dedup(processors.names(trade_ops.TRADE_COLUMNS))
    accepted = by_slot(trade_ops.with_defaults(ticks), "instrument_key")
    return trade_ops.finish(
        accepted.applyInPandasWithState(step, trade_ops.TRADE_COLUMNS, processors.LAST_STATE, "append", NO_TIMEOUT)
    )


def latch_oi(ticks: DataFrame, lock: str = OI_LOCK, tz: str = "UTC", lateness: str = "1 hour") -> DataFrame:
    """First positive open interest at or after the lock time, per instrument and trade date.

    Runs in update mode: a key and date is sent again with each batch that has ticks of it, with
    what is first by `seq` so far; the last one sent counts. The state of a date is dropped
    once the watermark has passed its end.
    """
    at = F.col("arrival_ms")
    late = trade_ops.with_defaults(ticks).filter((F.col("oi") > 0) & clock.at_or_after(at, lock, tz))
    # local wall time as if it were UTC, so that one-day windows are trade dates
    wall = late.withColumn("wall", F.from_utc_timestamp(F.timestamp_millis(at), tz)).withWatermark("wall", lateness)
    day = F.call_function("div", F.unix_seconds("day.start"), F.lit(86_400)).cast("int")
    return (
        wall.groupBy("instrument_key", F.window("wall", "1 day").alias("day"))
        .agg(F.min_by("oi", "seq").alias("base_oi"), F.min_by("arrival_ms", "seq").alias("locked_ms"))
        .select("instrument_key", F.date_from_unix_date(day).alias("trade_date"), "base_oi", "locked_ms")
    )


def _timed(trades: DataFrame, clock_col: str, lateness: str) -> DataFrame:
    """Trades with an event-time column; rows later than the watermark are dropped."""
    return trades.withColumn("ts", F.timestamp_millis(F.col(clock_col))).withWatermark("ts", lateness)


def reset_alerts(trades: DataFrame, profile: Profile, lateness: str | None = None) -> DataFrame:
    """Reset-on-alert windows (value bars without a window) on a trade stream.

    Spark sums the trades into buckets first, map-side, so a step sees at most two rows per
    second of an instrument. A step takes all instruments of a group at once.
    """
    buckets = trade_ops.bucket_stream(trades, profile.clock, lateness or f"{profile.window_s or 5} seconds")
    fold = processors.ResetWindow(profile.width, profile.threshold_paise, processors.names(windows.ALERT_COLUMNS))
    found = by_slot(buckets, "instrument_key").transformWithStateInPandas(
        fold, windows.ALERT_COLUMNS, outputMode="Append", timeMode="None"
    )
    return found.withColumn("alert_ms", F.col("b") * STEP_MS)


def timed_buckets(timed_trades: DataFrame) -> DataFrame:
    """Whole half-second buckets with their event time, sent when the watermark has passed them."""
    step = F.window("ts", f"{STEP_MS} milliseconds")
    found = timed_trades.groupBy("instrument_key", step.alias("step")).agg(*trade_ops.bucket_values())
    instant = F.call_function("div", F.unix_millis("step.end"), F.lit(STEP_MS))
    return found.select("*", F.window_time("step").alias("ts"), instant.alias("b")).drop("step")


def sliding_bursts(trades: DataFrame, profile: Profile, lateness: str | None = None) -> DataFrame:
    """Sliding windows on a trade stream. Append mode emits each window once it is final. There is no long baseline
    volume, so no acceleration.

    The state is the buckets of the last window: no bucket is copied into each window that holds it.
    """
    timed = _timed(trades, profile.clock, lateness or f"{profile.window_s} seconds")
    columns = windows.ALERT_COLUMNS
    machine = machines.TwoHorizons(
        profile.width, profile.width, profile.threshold_paise, processors.names(columns), STEP_MS, skip_nulls=True
    )
    buckets = by_slot(timed_buckets(timed), "instrument_key")
    found = buckets.transformWithStateInPandas(machine, columns, outputMode="Append", timeMode="EventTime")
    return found.select(
        "instrument_key",
        "b",
        "paise",
        "vol",
        "n",
        "buy",
        "sell",
        "first_price",
        "last_price",
        "first_oi",
        "last_oi",
        "last_ms",
        classify.flow_side(F.col("buy"), F.col("sell")).alias("side"),
    )


def register(
    alerts: DataFrame, tie: Sequence[str] = ("instrument_key",), tz: str = "UTC", lateness: str = "1 hour"
) -> DataFrame:
    """Alert stream with `reg_key` -> the same with the strike's running state.

    Alerts count in the order in which their batches arrive, and within a batch in order of
    time. The state of a strike and trade date is dropped once the watermark, `lateness` behind the newest
    alert, has passed the date's end; alerts behind the watermark are dropped.
    """
    at = F.col("alert_ms")
    dated = alerts.withColumn("trade_date", clock.trade_date(at, tz))
    timed = dated.withColumn("ts", F.timestamp_millis(at)).withWatermark("ts", lateness)
    ends = F.unix_millis(F.to_utc_timestamp(F.date_add("trade_date", 1).cast("timestamp"), tz))
    times = ["first_ms", "second_ms", "last_alert_ms"]
    added = ["alert_count", "cumulative_paise", *times]
    schema = T.StructType([*dated.schema, *[T.StructField(c, T.LongType()) for c in added]])
    step = processors.registry(schema.fieldNames(), ["alert_ms", *tie])
    seen = (
        timed.withColumn("day_end_ms", ends)
        .groupBy("reg_key", "trade_date")
        .applyInPandasWithState(step, schema, processors.REGISTRY_STATE, "append", EVENT_TIME)
    )
    return registry.with_gaps(seen)


def heat_scores(alerts: DataFrame, tick_ms: int = 1000, lateness: str = "1 hour") -> DataFrame:
    """Alert stream -> score per touched ticker as of its latest alert (update mode).

    A ticker's state is dropped once the watermark has passed the time at which its score is 0.
    """
    scored = alerts.select("ticker", "alert_ms", board.alert_points(F.col("paise")).alias("points"))
    timed = scored.withColumn("ts", F.timestamp_millis("alert_ms")).withWatermark("ts", lateness)
    return timed.groupBy("ticker").applyInPandasWithState(
        processors.heat(board.DECAY, tick_ms), f"ticker string, {processors.HEAT_STATE}", processors.HEAT_STATE, "update", EVENT_TIME
    )
