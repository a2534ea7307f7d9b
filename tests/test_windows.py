"""Trades, buckets and window alerts on Spark, against the models."""

import random

import pytest
from pyspark.sql import functions as F

from optionflow.operators import alerts as windows, trades as trade_ops
from optionflow.plans import profiles as P, scan

from . import model

TICK_SCHEMA = (
    "instrument_key string, seq bigint, arrival_ms bigint, ltt bigint, ltp double, ltq bigint, "
    "vtt bigint, oi bigint, bid_p double, ask_p double"
)


def ticks(spark, rows):
    """rows: (key, seq, ltt, vtt, ltq)"""
    full = [(k, s, t, t, 10.0, q, v, 100, 9.0, 10.0) for k, s, t, v, q in rows]
    return spark.createDataFrame(full, TICK_SCHEMA)


def noisy_feed(seed, keys=4, n=120, hot=True):
    rng = random.Random(seed)
    rows, seq = [], 0
    state = {}
    for _ in range(n):
        k = "k0" if hot and rng.random() < 0.5 else f"k{rng.randrange(keys)}"
        ltt, vtt = state.get(k, (0, 0))
        ltt, vtt = ltt + rng.choice([-3, 0, 0, 1, 5]), vtt + rng.choice([-20, 0, 0, 1, 7])
        ltt, vtt = max(ltt, 0), max(vtt, 0)
        if rng.random() < 0.05:
            vtt = 0
        state[k] = (ltt, vtt)
        rows.append((k, seq, ltt, vtt, rng.randrange(4)))
        seq += rng.choice([1, 1, 3])
    return rows


@pytest.mark.parametrize("seed,chunk_rows", [(1, 1), (1, 7), (2, 40), (3, 1 << 24)])
def test_trades_equal_the_model(spark, small_batches, seed, chunk_rows):
    rows = noisy_feed(seed)
    shuffled = random.Random(0).sample(rows, len(rows))
    out = trade_ops.trades(ticks(spark, shuffled), chunk_rows=chunk_rows)
    got = sorted((r.instrument_key, r.seq, r.qty) for r in out.collect())
    assert got == sorted(model.trades(rows))


@pytest.mark.parametrize("chunk_rows", [3, 1 << 24])
def test_lag_equals_fold_on_monotone_feeds(spark, chunk_rows):
    rows, ltt, vtt = [], 0, 0
    rng = random.Random(5)
    for seq in range(80):
        ltt, vtt = ltt + rng.randrange(3), vtt + rng.randrange(3)
        rows.append((f"k{seq % 3}", seq, ltt, vtt, 2))
    feed = ticks(spark, rows)
    fold = trade_ops.trades(feed, chunk_rows=chunk_rows)
    lag = trade_ops.trades(feed, assume_monotone=True, chunk_rows=chunk_rows)
    assert sorted(fold.collect()) == sorted(lag.select(fold.columns).collect())


def test_lag_is_wrong_on_the_known_out_of_order_feed(spark):
    """Why the fold is the default."""
    rows = [("k", 1, 10, 100, 5), ("k", 2, 9, 90, 1), ("k", 3, 10, 95, 1), ("k", 4, 11, 95, 1), ("k", 5, 12, 110, 1)]
    fold = [(r.seq, r.qty) for r in trade_ops.trades(ticks(spark, rows)).orderBy("seq").collect()]
    lag = [r.seq for r in trade_ops.trades(ticks(spark, rows), assume_monotone=True).orderBy("seq").collect()]
    assert fold == [(1, 5), (5, 15)] and 3 in lag


def test_absent_numbers_read_as_zero(spark):
    rows = [("k", 1, None, 5, 2.5, 3, 7, None, None, None), ("k", 2, None, 6, 2.5, 3, 9, None, None, None)]
    out = trade_ops.trades(spark.createDataFrame(rows, TICK_SCHEMA)).orderBy("seq").collect()
    assert [(r.seq, r.qty, r.oi, r.side, r.arrival_ms, r.paise) for r in out] == [
        (1, 3, 0, "BUY", 5, 750),
        (2, 2, 0, "BUY", 6, 500),
    ]


def test_messages_of_other_variants_are_left_out(spark):
    from optionflow.sources import schemas

    level = ((2.0, 5, 3), (1.0, 3.0), 7, 50)
    feeds = {"a": (level,), "b": (None,)}
    out = trade_ops.explode_messages(spark.createDataFrame([(1, 6, feeds)], schemas.TICK_MESSAGE))
    assert [tuple(r) for r in out.collect()] == [("a", 1, 6, 5, 2.0, 3, 7, 50, 1.0, 3.0)]


def trade_rows(seed, n=150, span_ms=40_000, keys=3):
    rng = random.Random(seed)
    times = sorted(rng.randrange(span_ms) for _ in range(n))
    return [(f"k{rng.randrange(keys)}", i, t, rng.randrange(1, 30)) for i, t in enumerate(times)]


def trade_frame(spark, rows):
    """Price 1.00 each, so paise = 100 * qty."""
    full = [(k, s, t + 250, t, 1.0, q, 100 * q, 1000 + s, "BUY" if s % 3 else "SELL") for k, s, t, q in rows]
    schema = "instrument_key string, seq bigint, arrival_ms bigint, ltt bigint, price double, qty bigint, paise bigint, oi bigint, side string"
    return spark.createDataFrame(full, schema)


def model_buckets(rows, shift=0):
    out = {}
    for k, _, t, q in rows:
        at = (k, (t + shift) // 500 + 1)
        out[at] = out.get(at, 0) + 100 * q
    return [(k, b, v) for (k, b), v in out.items()]


@pytest.mark.parametrize("width", [1, 10, 40, None])
@pytest.mark.parametrize("seed", [1, 2])
def test_reset_alerts_equal_the_model(spark, small_batches, width, seed):
    rows = trade_rows(seed)
    found = windows.reset_alerts(trade_ops.buckets(trade_frame(spark, rows)), width, 6000)
    got = sorted((r.instrument_key, r.b, r.paise) for r in found.collect())
    assert got == sorted(a[:3] for a in model.reset_alerts(model_buckets(rows), width, 6000))


@pytest.mark.parametrize("width, slice_steps", [(1, 3), (5, 4), (10, 25), (None, 1), (None, 5), (None, 20)])
def test_reset_alerts_in_slices_equal_the_model(spark, small_batches, width, slice_steps):
    rows = trade_rows(7, n=300, span_ms=60_000) + trade_rows(8, n=60, span_ms=300_000, keys=1)
    rows = [(k if i % 11 else None, i, t, q if i % 13 else 0) for i, (k, _, t, q) in enumerate(sorted(rows, key=lambda r: r[2]))]
    buckets = trade_ops.buckets(trade_frame(spark, rows))
    found = windows.reset_alerts(buckets, width, 6000, slice_steps)
    whole = windows.reset_alerts(buckets, width, 6000, 10**9)
    order = lambda r: (r.instrument_key or "", r.b)
    assert sorted(found.collect(), key=order) == sorted(whole.select(found.columns).collect(), key=order)
    got = sorted((r.instrument_key or "", r.b, r.paise) for r in found.collect())
    named = [(k or "", b, v) for k, b, v in model_buckets(rows)]
    assert got == sorted(a[:3] for a in model.reset_alerts(named, width, 6000))


def test_slices_of_a_long_history_are_told_apart(spark):
    """A key that trades all day and rests over night is a stretch a day; one that never rests is one stretch."""
    day, busy = 86_400_000, [("day", i, d * 86_400_000 + t, 1) for i, (d, t) in enumerate((d, t) for d in range(4) for t in range(0, 8 * 3_600_000, 3_600_000 - 1))]
    rest = [("all", 10_000 + i, t, 1) for i, t in enumerate(range(0, 4 * day, 400_000))]
    found = windows.stretches(trade_ops.buckets(trade_frame(spark, busy + rest)), 10)
    count = {r.instrument_key: r.n for r in found.groupBy("instrument_key").agg(F.countDistinct("stretch").alias("n")).collect()}
    assert count["day"] >= 4 and count["all"] > 4
    found = windows.stretches(trade_ops.buckets(trade_frame(spark, busy + rest)), 1000)
    assert {r.instrument_key: r.n for r in found.groupBy("instrument_key").agg(F.countDistinct("stretch").alias("n")).collect()}["all"] == 1


@pytest.mark.parametrize("slice_steps", [7, 25, 28_800])
def test_sliding_alerts_equal_the_model(spark, slice_steps):
    rows = trade_rows(3)
    found = windows.sliding_alerts(trade_ops.buckets(trade_frame(spark, rows)), 6, 6000, 30, slice_steps)
    got = sorted((r.instrument_key, r.b, r.paise, r.base_vol * 100) for r in found.collect())
    want = model.sliding_alerts(model_buckets(rows), 6, 6000, 30)
    assert got == [(k, b, v, base) for k, b, v, _, base in want]
    # first and last values are those of the window's first and last bucket
    first = {(k, b): x for k, b, _, x, _ in want}
    prices = trade_ops.buckets(trade_frame(spark, rows)).collect()
    oi = {(r.instrument_key, r.b): r.first_oi for r in prices}
    assert all(r.first_oi == oi[(r.instrument_key, first[(r.instrument_key, r.b)])] for r in found.collect())


def test_time_windows_equal_the_bucket_form(spark):
    rows = trade_rows(4)
    trades = trade_frame(spark, rows)
    a = windows.sliding_alerts(trade_ops.buckets(trades), 20, 6000)
    b = windows.windowed_bursts(trades.withColumn("ts", F.timestamp_millis("ltt")), 10, 500, 6000)
    b = b.select("instrument_key", (F.unix_millis("w.end") / 500).cast("bigint").alias("b"), "paise", "vol", "n", "buy", "sell")
    assert sorted(a.select(b.columns).collect()) == sorted(b.collect())


def test_threshold_is_inclusive_and_old_trades_leave(spark):
    rows = [("k", 0, 0, 30), ("k", 1, 4_900, 30), ("z", 2, 0, 30), ("z", 3, 5_000, 30)]
    found = windows.reset_alerts(trade_ops.buckets(trade_frame(spark, rows)), 10, 6000)
    assert [(r.instrument_key, r.paise) for r in found.collect()] == [("k", 6000)]


def test_empty_input(spark):
    none = trade_frame(spark, []).filter("false")
    for width in (10, None):
        assert windows.reset_alerts(trade_ops.buckets(none), width, 1).count() == 0
    assert windows.sliding_alerts(trade_ops.buckets(none), 20, 1, 1800).count() == 0
    assert trade_ops.trades(ticks(spark, [("k", 1, 1, 1, 1)]).filter("false")).count() == 0


def test_arrival_clock_uses_arrival_time(spark):
    rows = trade_rows(6)
    found = scan.detect(trade_frame(spark, rows), P.Profile("x", "arrival_ms", 5, True, "momentum", threshold_paise=6000))
    got = sorted((r.instrument_key, r.b) for r in found.collect())
    assert got == sorted(a[:2] for a in model.reset_alerts(model_buckets(rows, 250), 10, 6000))


def test_reset_without_sliding_duplicates(spark):
    """One burst alerts once with reset and on every check without it."""
    trades = trade_frame(spark, [("k", 0, 0, 100)])
    assert windows.reset_alerts(trade_ops.buckets(trades), 20, 6000).count() == 1
    assert windows.sliding_alerts(trade_ops.buckets(trades), 20, 6000).count() == 20
