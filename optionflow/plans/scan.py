"""The scanner pipeline: ticks -> trades -> buckets -> alerts -> categories -> scores -> records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import classify, score as points
from ..operators import alerts as windows, chain as chains, registry, trades as trade_ops
from ..workspace import settled
from .profiles import OI_LOCK, STEP_MS, Profile


def detect(trades: DataFrame, profile: Profile) -> DataFrame:
    """Alerts of a profile's window in normal form, with their check time `alert_ms`."""
    buckets = trade_ops.buckets(trades, profile.clock)
    if profile.reset_on_alert:
        found = windows.reset_alerts(buckets, profile.width, profile.threshold_paise)
        if profile.base_width:
            base = windows.trailing_volume(buckets, profile.base_width)
            found = found.join(base, ["instrument_key", "b"])
    else:
        found = windows.sliding_alerts(buckets, profile.width, profile.threshold_paise, profile.base_width)
    return found.withColumn("alert_ms", F.col("b") * STEP_MS)


def categorise(alerts: DataFrame, profile: Profile) -> DataFrame:
    c = F.col
    if profile.category == "momentum":
        return alerts.withColumn("category", classify.momentum_category(c("first_price"), c("last_price")))
    if profile.category == "flow":
        state = classify.flow_category(
            c("first_price"), c("last_price"), c("first_oi"), c("last_oi"), profile.quiet_exit
        )
        return alerts.withColumn("category", state)
    out = alerts.withColumns(
        {
            "side": classify.flow_side(c("buy"), c("sell")),
            "delta_pct": classify.delta_pct(c("buy"), c("sell")),
        }
    ).withColumn("category", c("side"))
    if profile.base_width:
        fast = classify.acceleration(c("vol"), c("base_vol"), profile.window_s, profile.baseline_s)
        out = out.withColumn("acceleration", fast)
    return out


def score(alerts: DataFrame, history: DataFrame, profile: Profile) -> DataFrame:
    """Conviction and label of registered alerts (`registry.register`) against history."""
    c = F.col
    joined = alerts.join(history, "reg_key", "left")
    if profile.score == "day":
        value = points.day_conviction(
            c("oi_growth"),
            c("alert_count"),
            c("minutes_active"),
            c("first_gap"),
            c("last_gap"),
            c("avg_alerts_per_day"),
            c("avg_paise_per_day"),
            c("trading_days"),
            c("cumulative_paise"),
        )
    else:
        value = points.flow_conviction(
            c("oi_growth"), c("alert_count"), c("acceleration"), c("delta_pct"), c("avg_alerts_per_day")
        )
    return (
        joined.withColumn("conviction", value)
        .withColumn("conviction_label", points.conviction_label(c("conviction")))
        .drop("avg_alerts_per_day", "avg_paise_per_day", "trading_days")
    )


def scan(
    ticks: DataFrame,
    chain: DataFrame,
    profile: Profile,
    strike_table: DataFrame | None = None,
    history: DataFrame | None = None,
    tz: str = "UTC",
    assume_monotone: bool = False,
    settle: bool = True,
    lock: str = OI_LOCK,
) -> DataFrame:
    """Scored alerts of a whole tick table; `records.alert_records` gives their final layout.

    The registry reads its alerts three times, so with `settle` they are written once to the
    session's shared folder.
    """
    spark = ticks.sparkSession
    trades = trade_ops.trades(ticks, assume_monotone)
    found = categorise(detect(trades, profile), profile)
    keys = chains.active_keys(strike_table) if strike_table is not None else None
    dim = chains.instrument_dim(chain, keys, calls_first=profile.name == "sliding")
    named = registry.with_instrument(found, dim)
    if profile.category == "momentum":
        if strike_table is None:
            return named.withColumn("is_atm", F.lit(False))
        return registry.with_atm_flag(named, chains.atm_keys(strike_table))
    if not profile.score:
        return named
    base = registry.oi_baseline(ticks, lock, tz)
    grown = registry.with_oi_growth(named, base, tz)
    keyed = registry.with_reg_key(grown)
    registered = registry.register(settled(keyed) if settle else keyed, tz=tz)
    return score(registered, history if history is not None else _no_history(spark), profile)


def _no_history(spark) -> DataFrame:
    return spark.createDataFrame(
        [], "reg_key string, avg_alerts_per_day double, avg_paise_per_day double, trading_days bigint"
    )


