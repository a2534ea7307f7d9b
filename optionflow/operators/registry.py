"""Alert history, strike registry, open-interest baseline and their joins to alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import classify, clock
from . import asof, ordered

REGISTRY_CHUNK_MS = 60_000


def history(log: DataFrame, run_date) -> DataFrame:
    """Average alerts and value per trading day of every strike, without the run date.

    One row per `reg_key`: strikes whose parts spell the same key count as one. Days are
    reduced first, so a busy strike arrives at the second step as one row per day. Rows without a
    timestamp belong to no day and are left out.
    """
    key = classify.reg_key(F.col("ticker"), F.col("strike"), F.col("option_type"))
    per_day = (
        log.withColumn("day", F.substring("timestamp", 1, 10))
        .filter(F.col("day") != F.date_format(F.lit(run_date).cast("date"), clock.DAY))
        .groupBy(key.alias("reg_key"), "day")
        .agg(F.count(F.lit(1)).alias("alerts"), F.sum("paise").alias("paise"))
    )
    return (
        per_day.groupBy("reg_key")
        .agg(
            F.sum("alerts").alias("total_alerts"),
            F.sum("paise").alias("total_paise"),
            F.count("day").alias("trading_days"),
        )
        .filter("trading_days > 0")
        .select(
            "reg_key",
            (F.col("total_alerts") / F.col("trading_days")).alias("avg_alerts_per_day"),
            (F.col("total_paise") / F.col("trading_days")).alias("avg_paise_per_day"),
            "trading_days",
        )
    )


def register(
    alerts: DataFrame,
    tie: Sequence[str] = ("instrument_key",),
    tz: str = "UTC",
    chunk_ms: int = REGISTRY_CHUNK_MS,
) -> DataFrame:
    """Running state of each strike: visits, value, minutes active, first and last gap.

    Scoped by (reg_key, trade_date). Gaps are seconds and null below three alerts.
    """
    scope = ["reg_key", "trade_date"]
    dated = alerts.withColumn("trade_date", clock.trade_date(F.col("alert_ms"), tz))
    heads = (
        ordered.first_rows(dated.select(*scope, "alert_ms", *tie), scope, ["alert_ms", *tie], 2)
        .groupBy(*scope)
        .agg(
            F.min("alert_ms").alias("first_ms"),
            F.max(F.when(F.col("row_no") == 2, F.col("alert_ms"))).alias("second_ms"),
        )
    )
    seen = ordered.running(
        dated,
        scope,
        ["alert_ms", *tie],
        F.call_function("div", F.col("alert_ms"), F.lit(chunk_ms)),
        sums={"alert_count": F.lit(1).cast("bigint"), "cumulative_paise": F.col("paise")},
        previous={"last_alert_ms": F.col("alert_ms")},
        constants=heads,
    )
    return with_gaps(seen)


def with_gaps(seen: DataFrame) -> DataFrame:
    """Minutes active, first and last gap from the first, second and previous alert times."""
    third = F.col("alert_count") >= 3
    return seen.withColumns(
        {
            "minutes_active": (F.col("alert_ms") - F.col("first_ms")) / 60_000,
            "first_gap": F.when(third, (F.col("second_ms") - F.col("first_ms")) / 1000),
            "last_gap": F.when(third, (F.col("alert_ms") - F.col("last_alert_ms")) / 1000),
        }
    ).drop("first_ms", "second_ms", "last_alert_ms")


def oi_baseline(rows: DataFrame, lock: str = "09:30", tz: str = "UTC", clock_col: str = "arrival_ms") -> DataFrame:
    """First positive open interest at or after the lock time, per instrument and trade date.

    `rows` are ticks (duplicates latch too).
    """
    at = F.col(clock_col)
    return (
        rows.filter((F.col("oi") > 0) & clock.at_or_after(at, lock, tz))
        .groupBy("instrument_key", clock.trade_date(at, tz).alias("trade_date"))
        .agg(F.min_by("oi", "seq").alias("base_oi"), F.min_by(at, F.col("seq")).alias("locked_ms"))
    )


def with_oi_growth(alerts: DataFrame, baseline: DataFrame, tz: str = "UTC") -> DataFrame:
    """Growth since the baseline; an alert before the baseline is locked has none."""
    keys = ["instrument_key", "trade_date"]
    dated = alerts.withColumn("trade_date", clock.trade_date(F.col("alert_ms"), tz))
    base = F.when(F.col("locked_ms") <= F.col("alert_ms"), F.col("base_oi"))
    return (
        dated.join(baseline, keys, "left")
        .withColumn("oi_growth", classify.oi_growth(F.col("last_oi"), base))
        .drop("trade_date", "base_oi", "locked_ms")
    )


def with_instrument(alerts: DataFrame, dim: DataFrame) -> DataFrame:
    """Name, strike text and type of each alert; an unknown key is its own name."""
    return alerts.join(dim, "instrument_key", "left").select(
        *alerts.columns,
        F.coalesce("name", "instrument_key").alias("ticker"),
        F.coalesce(classify.strike_text(F.col("strike")), F.lit("")).alias("strike"),
        F.coalesce("type", F.lit("")).alias("option_type"),
    )


def with_atm_flag(alerts: DataFrame, atm: DataFrame) -> DataFrame:
    """`is_atm`: the alert's key is one of its company's two at-the-money keys."""
    key = F.col("instrument_key")
    here = (key == F.col("atm_ce")) | (key == F.col("atm_pe"))
    return (
        alerts.join(atm.withColumnRenamed("name", "ticker"), "ticker", "left")
        .withColumn("is_atm", F.coalesce(here, F.lit(False)))
        .drop("atm_ce", "atm_pe")
    )


def with_atm_versions(alerts: DataFrame, strike_tables: DataFrame, starts: DataFrame) -> DataFrame:
    """`is_atm` by the strike table in force at the alert: the last version with `valid_from` <= `alert_ms`.

    `strike_tables` holds the rows of all versions with `version`, `starts` their (version, valid_from). An alert before the
    first version, or of a company that its version lacks, is not at the money.
    """
    stamped = asof.asof_join(alerts, starts, [], "alert_ms", "valid_from", ["version"])
    first = F.min(F.struct("underlying_key", "atm_ce", "atm_pe")).alias("r")
    keys = strike_tables.groupBy("version", F.col("name").alias("ticker")).agg(first)
    key = F.col("instrument_key")
    joined = stamped.join(keys, ["version", "ticker"], "left")
    here = (key == F.col("r.atm_ce")) | (key == F.col("r.atm_pe"))
    return joined.withColumn("is_atm", F.coalesce(here, F.lit(False))).drop("r")


def with_reg_key(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn(
        "reg_key", classify.reg_key(F.col("ticker"), F.col("strike"), F.col("option_type"))
    )
