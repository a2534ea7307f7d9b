"""Registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from optionflow.functions import classify
from optionflow.operators import alerts as windows, board, chain as chains, ordered, records, registry, trades as trade_ops
from optionflow.plans import profiles as P, scan
from optionflow.streaming import live
from optionflow.workspace import settled

from . import proxy, streams

EXPIRY = datetime(2026, 2, 24, 18, 29, 59)
RUN_DATE = date(2024, 1, 30)
LOCK = "00:10"  # the compressed feed runs from 00:00 to 00:43
SLOW_RESET = replace(P.RESET, window_s=120)
MINUTE_MS = 60_000

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


# ---------------------------------------------------------------- shared inputs


def _chain(spark, d):
    return chains.option_chain(proxy.master(spark, d), EXPIRY)


def _companies(spark, d):
    return chains.companies(_chain(spark, d))


def _strikes(spark, d, companies=None):
    companies = companies if companies is not None else _companies(spark, d)
    return chains.directional_strikes(companies, chains.spot_prices(proxy.quotes(spark, d)))


def _stored(spark, d):
    """Chain and strike table as stored tables: the scanner reads them several times."""
    companies = settled(_companies(spark, d))
    return companies, settled(_strikes(spark, d, companies))


def _trades(spark, d):
    return trade_ops.trades(proxy.ticks(spark, d), assume_monotone=True)


def _log(spark, d):
    return registry.with_reg_key(proxy.alert_log(spark, d))


def _history(spark, d):
    return registry.history(proxy.alert_log(spark, d), RUN_DATE)


def _drop_flow(alerts):
    return alerts.drop("alert_ms")


# ---------------------------------------------------------------- chain


@query
def option_chain(spark, d):
    return chains.sorted_chain(_chain(spark, d))


@query
def sorted_contracts(spark, d):
    rows = chains.sorted_contracts(chains.contracts(proxy.master(spark, d), EXPIRY))
    return rows.select("name", "instrument_type", "strike_price", "instrument_key", "expiry", "lot_size")


@query
def chain_value_lists(spark, d):
    kept = _companies(spark, d)
    columns = ["name", "underlying_key"]
    lists = [
        chains.distinct_values(kept, c).select(F.lit(c).alias("list"), F.col(c).alias("value")) for c in columns
    ]
    return lists[0].unionByName(lists[1])


@query
def company_count(spark, d):
    return _companies(spark, d).agg(F.countDistinct("name").alias("companies"), F.count(F.lit(1)).alias("chain_rows"))


@query
def spot_snapshot(spark, d):
    return chains.spot_prices(proxy.quotes(spark, d))


@query
def directional_strikes(spark, d):
    return _strikes(spark, d)


@query
def active_keys(spark, d):
    return chains.active_keys(_strikes(spark, d))


@query
def instrument_dim(spark, d):
    return chains.instrument_dim(_companies(spark, d), chains.active_keys(_strikes(spark, d)))


@query
def instrument_dim_whole_chain(spark, d):
    return chains.instrument_dim(_companies(spark, d), calls_first=True)


# ---------------------------------------------------------------- ticks and buckets


@query
def tick_messages(spark, d):
    return trade_ops.explode_messages(proxy.messages(spark, d))


@query
def tick_messages_many(spark, d):
    """Messages of several instruments each."""
    return trade_ops.explode_messages(proxy.grouped_messages(spark, d))


@query
def tick_trades_fold(spark, d):
    return trade_ops.trades(proxy.noisy_ticks(spark, d))


@query
def tick_trades_lag(spark, d):
    return _trades(spark, d)


@query
def trade_buckets(spark, d):
    return trade_ops.buckets(_trades(spark, d)).withColumn("avg_paise", F.col("paise") / F.col("n"))


# ---------------------------------------------------------------- window alerts


@query
def burst_alerts(spark, d):
    found = scan.detect(_trades(spark, d), replace(P.SLIDING, baseline_s=None))
    return _drop_flow(scan.categorise(found, replace(P.SLIDING, baseline_s=None)))


@query
def burst_acceleration(spark, d):
    found = scan.categorise(scan.detect(_trades(spark, d), P.SLIDING), P.SLIDING)
    return found.select("instrument_key", "b", "paise", "vol", "base_vol", "acceleration", "delta_pct", "side")


@query
def burst_reset_acceleration(spark, d):
    """Two horizons with reset: one alert per burst."""
    profile = replace(P.SLIDING, reset_on_alert=True)
    found = scan.categorise(scan.detect(_trades(spark, d), profile), profile)
    return found.select("instrument_key", "b", "paise", "vol", "base_vol", "acceleration", "delta_pct", "side")


@query
def burst_windows(spark, d):
    timed = _trades(spark, d).withColumn("ts", F.timestamp_millis("ltt"))
    found = windows.windowed_bursts(timed, P.BURST_S, P.STEP_MS, P.THRESHOLD_PAISE)
    end = F.call_function("div", F.unix_millis("w.end"), F.lit(P.STEP_MS))
    return found.select("instrument_key", end.alias("b"), "paise", "vol", "n", "buy", "sell")


def _reset(spark, d, profile):
    found = scan.categorise(scan.detect(_trades(spark, d), profile), profile)
    return _drop_flow(found)


@query
def rolling_reset_alerts(spark, d):
    return _reset(spark, d, P.RESET)


@query
def rolling_reset_alerts_120s(spark, d):
    return _reset(spark, d, SLOW_RESET)


@query
def arrival_reset_alerts(spark, d):
    return _reset(spark, d, P.ARRIVAL)


@query
def value_bars(spark, d):
    return _reset(spark, d, P.BARS)


@query
def category_6state(spark, d):
    found = scan.detect(_trades(spark, d), SLOW_RESET)
    ends = [F.col(c) for c in ("first_price", "last_price", "first_oi", "last_oi")]
    return found.select(
        "instrument_key",
        "b",
        classify.flow_category(*ends, quiet_exit="EXITING").alias("category_exiting"),
        classify.flow_category(*ends, quiet_exit="DISTRIBUTION").alias("category_distribution"),
        classify.momentum_category(ends[0], ends[1]).alias("category_momentum"),
    )


# ---------------------------------------------------------------- joins, registry, scores


@query
def atm_flag(spark, d):
    companies, strikes = _stored(spark, d)
    found = scan.detect(_trades(spark, d), P.ARRIVAL)
    named = registry.with_instrument(found, chains.instrument_dim(companies))
    flagged = registry.with_atm_flag(named, chains.atm_keys(strikes))
    return flagged.select("instrument_key", "b", "ticker", "strike", "option_type", "is_atm")


@query
def oi_baseline_growth(spark, d):
    found = scan.detect(_trades(spark, d), SLOW_RESET)
    base = registry.oi_baseline(proxy.ticks(spark, d), LOCK)
    return registry.with_oi_growth(found, base).select("instrument_key", "b", "last_oi", "oi_growth")


@query
def historical_baseline(spark, d):
    return _history(spark, d)


@query
def strike_registry(spark, d):
    return registry.register(_log(spark, d), tie=("seq",)).select(
        "reg_key",
        "trade_date",
        "seq",
        "alert_count",
        "cumulative_paise",
        "minutes_active",
        "first_gap",
        "last_gap",
    )


def _registered(spark, d):
    """The log's days compressed twelvefold, with made-up signals per row, and registered."""
    seq, ms = F.col("seq"), F.col("alert_ms")
    day = ms - ms % 86_400_000
    log = _log(spark, d).withColumns(
        {
            "alert_ms": day + F.call_function("div", ms - day, F.lit(12)),
            "oi_growth": (seq % 120 - 20).cast("double"),
            "acceleration": (seq % 13) / 2,
            "delta_pct": (seq % 101).cast("double"),
        }
    )
    return registry.register(log, tie=("seq",))


def _scored(spark, d, profile):
    return scan.score(_registered(spark, d), _history(spark, d), profile)


@query
def conviction_day(spark, d):
    return _scored(spark, d, P.RESET).select("reg_key", "seq", "conviction", "conviction_label")


@query
def conviction_flow(spark, d):
    return _scored(spark, d, P.SLIDING).select("reg_key", "seq", "conviction", "conviction_label")


@query
def high_conviction_feed(spark, d):
    return records.high_conviction_feed(_scored(spark, d, P.RESET)).select("seq", "line")


# ---------------------------------------------------------------- whole scans


def _scan(spark, d, profile, noisy=False):
    companies, strikes = _stored(spark, d)
    return scan.scan(
        proxy.noisy_ticks(spark, d) if noisy else proxy.ticks(spark, d),
        companies,
        profile,
        strike_table=strikes if profile.name != "sliding" else None,
        history=_history(spark, d),
        assume_monotone=not noisy,
        lock=LOCK,
    )


@query
def scan_arrival(spark, d):
    return records.alert_records(_scan(spark, d, P.ARRIVAL), P.ARRIVAL, keep=("instrument_key", "b"))


@query
def scan_bars(spark, d):
    return records.alert_records(_scan(spark, d, P.BARS), P.BARS, keep=("instrument_key", "b"))


@query
def scan_reset(spark, d):
    return records.alert_records(_scan(spark, d, SLOW_RESET), SLOW_RESET, keep=("instrument_key", "b"))


@query
def scan_sliding(spark, d):
    return records.alert_records(_scan(spark, d, P.SLIDING), P.SLIDING, keep=("instrument_key", "b"))


@query
def scan_arrival_fold(spark, d):
    return records.alert_records(_scan(spark, d, P.ARRIVAL, noisy=True), P.ARRIVAL, keep=("instrument_key", "b"))


@query
def scan_bars_fold(spark, d):
    return records.alert_records(_scan(spark, d, P.BARS, noisy=True), P.BARS, keep=("instrument_key", "b"))


@query
def scan_reset_fold(spark, d):
    return records.alert_records(_scan(spark, d, SLOW_RESET, noisy=True), SLOW_RESET, keep=("instrument_key", "b"))


@query
def scan_sliding_fold(spark, d):
    return records.alert_records(_scan(spark, d, P.SLIDING, noisy=True), P.SLIDING, keep=("instrument_key", "b"))


@query
def alert_json_roundtrip(spark, d):
    built = records.alert_records(_scan(spark, d, P.BARS), P.BARS)
    decoded, _ = records.from_messages(records.to_messages(built), P.BARS)
    return decoded


# ---------------------------------------------------------------- board


@query
def heat_board(spark, d):
    log = proxy.alert_log(spark, d)
    at = log.agg(F.max("alert_ms")).scalar()
    hot = board.leaderboard(board.heat(log, at, MINUTE_MS))
    return hot.select("ticker", F.floor(F.col("heat") * 100).cast("bigint").alias("heat_100"), "alerts", "is_hot")


@query
def recent_alerts(spark, d):
    return board.recent(proxy.alert_log(spark, d)).select(
        "ticker", "side", "row_no", "seq", "timestamp", "strike", "paise", "is_whale"
    )


@query
def movers(spark, d):
    return board.sorted_movers(board.movers(proxy.movers_lines(spark, d), _companies(spark, d)))


# ---------------------------------------------------------------- streams


@query
def stream_dedup(spark, d):
    live.use_rocksdb(spark)
    out = streams.run(spark, proxy.noisy_ticks(spark, d), lambda t: live.dedup_ticks(t))
    return out.drop("batch_id")


def _closed_trades(spark, d):
    return trade_ops.trades(streams.with_closing_tick(proxy.ticks(spark, d)), assume_monotone=True)


@query
def stream_burst(spark, d):
    live.use_rocksdb(spark)
    out = streams.run(spark, _closed_trades(spark, d), lambda t: live.sliding_bursts(t, P.SLIDING))
    return out.select("instrument_key", "b", "paise", "vol", "n", "buy", "sell", "side")


@query
def stream_reset(spark, d):
    live.use_rocksdb(spark)
    build = lambda t: live.reset_alerts(t, SLOW_RESET, "5 seconds")
    return _drop_flow(streams.run(spark, _closed_trades(spark, d), build).drop("batch_id"))


@query
def stream_bars(spark, d):
    live.use_rocksdb(spark)
    build = lambda t: live.reset_alerts(t, P.BARS, "5 seconds")
    return _drop_flow(streams.run(spark, _closed_trades(spark, d), build).drop("batch_id"))


def _latched(out):
    """The last one sent counts."""
    newest = [F.max_by(c, "batch_id").alias(c) for c in ("base_oi", "locked_ms")]
    return out.groupBy("instrument_key", "trade_date").agg(*newest)


@query
def stream_oi_latch(spark, d):
    live.use_rocksdb(spark)
    return _latched(streams.run(spark, proxy.ticks(spark, d), lambda t: live.latch_oi(t, LOCK), mode="update"))


REGISTERED = (
    "reg_key",
    "trade_date",
    "seq",
    "alert_count",
    "cumulative_paise",
    "minutes_active",
    "first_gap",
    "last_gap",
)


@query
def stream_registry(spark, d):
    live.use_rocksdb(spark)
    log = _log(spark, d).select("reg_key", "alert_ms", "seq", "paise")
    return streams.run(spark, log, lambda a: live.register(a, ("seq",))).select(*REGISTERED)


DAY_MS = 86_400_000


@query
def stream_registry_late(spark, d):
    """Days arrive in the order of their last digit, a strike's alerts of a day in order of time."""
    live.use_rocksdb(spark)
    at, seq = F.col("alert_ms"), F.col("event_seq")
    log = _log(spark, d).select("reg_key", "alert_ms", F.col("seq").alias("event_seq"), "paise")
    day = F.call_function("div", at, F.lit(DAY_MS))
    late = log.withColumn("seq", (day % 10) * 1_000_000_000_000 + seq)
    places = ordered.running(late, [], ["seq"], ordered.row_chunk(F.col("seq"), proxy.CHUNK_ROWS), sums={"place": F.lit(1).cast("bigint")})
    arrived = places.drop("seq").withColumnRenamed("place", "seq")
    out = streams.run(spark, arrived, lambda a: live.register(a, ("event_seq",), lateness="400 days"))
    return out.drop("seq").withColumnRenamed("event_seq", "seq").select(*REGISTERED)


@query
def stream_oi_latch_late(spark, d):
    """The ticks arrive backwards; the first one by number counts."""
    live.use_rocksdb(spark)
    rows = proxy.ticks(spark, d)
    back = rows.withColumn("tick_no", F.col("seq")).withColumn("seq", rows.agg(F.max("seq")).scalar() - F.col("seq"))

    def build(t):
        return live.latch_oi(t.drop("seq").withColumnRenamed("tick_no", "seq"), LOCK, lateness="400 days")

    return _latched(streams.run(spark, back, build, mode="update"))


@query
def stream_heat(spark, d):
    """Latest score per ticker: the last batch that touched it wins."""
    live.use_rocksdb(spark)
    out = streams.run(spark, proxy.alert_log(spark, d), lambda a: live.heat_scores(a, MINUTE_MS), mode="update")
    last = out.groupBy("ticker").agg(
        F.max_by("heat", "batch_id").alias("heat"), F.max_by("at_tick", "batch_id").alias("at_tick")
    )
    return last.select("ticker", "at_tick", F.round("heat", 6).alias("heat"))
