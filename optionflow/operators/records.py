"""Scored alerts -> alert records as logged and published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import clock, money
from ..plans.profiles import Profile
from ..sources import schemas


def record_columns(profile: Profile, tz: str = "UTC") -> dict[str, Column]:
    """Every field a record can have. Rounding is half-even on binary values."""
    c = F.col
    instant = c("alert_ms") if profile.clock == "arrival_ms" else c("last_ms")
    ltp = c("last_price") if profile.category == "momentum" else money.half_even(c("last_price"), 2)
    return {
        "timestamp": clock.clock_text(instant, profile.time_text, tz),
        "ticker": c("ticker"),
        "strike": c("strike"),
        "option_type": c("option_type"),
        "value": money.rupees(c("paise")),
        "ltp": ltp,
        "oi": c("last_oi").cast("bigint"),
        "category": c("category"),
        "ltp_change": money.half_even(c("last_price") - c("first_price"), 2),
        "oi_change": (c("last_oi") - c("first_oi")).cast("double"),
        "volume": c("vol").cast("double"),
        "avg_trade_size": money.half_even(money.rupees(c("paise")) / c("n"), 0),
        "is_atm": c("is_atm"),
        "alert_count": c("alert_count").cast("int"),
        "time_active_minutes": money.half_even(c("minutes_active"), 1),
        "oi_growth_from_open": money.half_even(c("oi_growth"), 1),
        "cumulative_value": money.rupees(c("cumulative_paise")),
        "conviction": c("conviction"),
        "conviction_label": c("conviction_label"),
        "side": c("side"),
        "acceleration": money.half_even(c("acceleration"), 1),
        "delta_pct": money.half_even(c("delta_pct"), 1),
    }


def alert_records(alerts: DataFrame, profile: Profile, tz: str = "UTC", keep: tuple[str, ...] = ()) -> DataFrame:
    """Records in the profile's message layout; `keep` adds columns such as alert_ms."""
    built = record_columns(profile, tz)
    fields = schemas.ALERT_MESSAGE[profile.name].fieldNames()
    return alerts.select(*keep, *[built[f].alias(f) for f in fields])


def log_rows(records: DataFrame, profile: Profile, keep: tuple[str, ...] = ()) -> DataFrame:
    """The message without its message-only fields: one log row."""
    return records.select(*keep, *schemas.ALERT_LOG[profile.name].fieldNames())


def high_conviction_feed(alerts: DataFrame, tz: str = "UTC") -> DataFrame:
    """Lines, in a format of our own, of the HIGH_CONVICTION alerts. Numbers are rounded half-even on binary values."""
    c = F.col
    line = F.format_string(
        "HIGH CONVICTION | %s %s %s | Score: %d | OI+%s%% | Alerts today: %d | Active: %smin | ₹%s total | %s",
        c("ticker"),
        c("strike"),
        c("option_type"),
        c("conviction"),
        money.fixed_text(c("oi_growth"), 0),
        c("alert_count"),
        money.fixed_text(c("minutes_active"), 0),
        money.lakh_text(c("cumulative_paise"), ties_up=False),
        clock.clock_text(c("alert_ms"), "HH:mm", tz),
    )
    return alerts.filter(c("conviction_label") == "HIGH_CONVICTION").withColumn("line", line)


def normal_form(rows: DataFrame, profile: Profile, tz: str = "UTC", numbered: bool = True) -> DataFrame:
    """Log rows or decoded messages with `paise`, `alert_ms` and `seq`, as history, heat and recent lists take them.

    A time text without a date or year takes it from `trade_date`. `seq`, the order in which the rows are
    read, is only needed to break ties of recent lists; it keeps a table out of scalar subqueries.
    """
    text, layout = F.col("timestamp"), profile.time_text
    if "dd" not in layout:
        text, layout = F.concat_ws(" ", F.col("trade_date").cast("string"), text), f"yyyy-MM-dd {layout}"
    elif "yyyy" not in layout:
        text, layout = F.concat_ws(" ", F.year("trade_date").cast("string"), text), f"yyyy {layout}"
    wall = F.to_timestamp_ntz(text, F.lit(layout))
    at = F.timestamp_diff("MILLISECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.convert_timezone(F.lit(tz), F.lit("UTC"), wall))
    added = {"paise": F.round(F.col("value") * money.PAISE).cast("bigint"), "alert_ms": at.cast("bigint")}
    if numbered:
        added["seq"] = F.monotonically_increasing_id()
    return rows.withColumns(added)


def to_messages(records: DataFrame) -> DataFrame:
    return records.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def from_messages(lines: DataFrame, profile: Profile) -> tuple[DataFrame, DataFrame]:
    """Decoded records, and the lines that are not valid messages."""
    fields = schemas.ALERT_MESSAGE[profile.name]
    schema = T.StructType([*fields, T.StructField("_corrupt", T.StringType())])
    opts = {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}
    decoded = lines.select("value", F.from_json("value", schema, opts).alias("m"))
    bad = F.col("m").isNull() | F.col("m._corrupt").isNotNull()
    good = decoded.filter(~bad).select(*[f"m.{f}" for f in fields.fieldNames()])
    return good, decoded.filter(bad).select("value")
