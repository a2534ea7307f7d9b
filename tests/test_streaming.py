"""Streams give what the batch operators give, across restarts and micro-batch cuts."""

from dataclasses import replace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks import streams
from optionflow.operators import alerts as windows, records, registry, trades as trade_ops
from optionflow.plans import profiles as P, scan
from optionflow.sources import readers, sinks
from optionflow.streaming import live, processors, runs

from . import model
from .machines import alone, instants, ordered, played
from .test_windows import noisy_feed, ticks, trade_frame, trade_rows


@pytest.fixture(autouse=True)
def rocksdb(spark):
    live.use_rocksdb(spark)


def test_dedup_equals_batch(spark):
    rows = noisy_feed(11)
    out = streams.run(spark, ticks(spark, rows), lambda t: live.dedup_ticks(t))
    assert sorted((r.instrument_key, r.seq, r.qty) for r in out.collect()) == sorted(model.trades(rows))


class Held:
    """State of one group outside of a stream."""

    exists, get = False, None

    def update(self, value):
        self.exists, self.get = True, value


def test_dedup_takes_many_instruments_in_one_call():
    """One call a batch for all instruments of a group, null key included, with the state of those that pause."""
    rows = [(k and f"k{k}", s, (s * 7 + (k or 0)) % 40, (s * 5 + (k or 0)) % 90, 3) for s in range(60) for k in (None, *range(1, 50))]
    rows = [(k, i, *rest) for i, (k, _, *rest) in enumerate(rows) if not (k == "k3" and 700 < i < 2300)]
    frame = pd.DataFrame(rows, columns=["instrument_key", "seq", "ltt", "vtt", "ltq"])
    step, held = processors.dedup(["instrument_key", "seq", "qty"]), Held()
    out = []
    for a in range(0, len(frame), 700):
        part = frame.iloc[a : a + 700].iloc[::-1]
        out += step((0,), iter([part.iloc[:300], part.iloc[300:]]), held)
    assert len(out) == 5
    got = pd.concat(out).query("qty > 0").fillna({"instrument_key": ""})
    want = model.trades([(k or "", *rest) for k, *rest in rows])
    assert sorted(got.itertuples(index=False, name=None)) == sorted(want)


def test_dedup_of_many_instruments_breaks_ties_as_that_of_one():
    rows = [(f"k{i % 3}", i // 6 % 40, i * 7 % 90, i * 11 % 70, 3) for i in range(900)]
    frame = pd.DataFrame(rows, columns=["instrument_key", "seq", "ltt", "vtt", "ltq"])
    step = processors.dedup(["instrument_key", "seq", "ltt", "vtt", "qty"])
    (together,) = step((0,), iter([frame]), Held())
    alone = [next(step((0,), iter([part]), Held())) for _, part in frame.groupby("instrument_key")]
    assert together.to_dict("records") == pd.concat(alone).to_dict("records")


@pytest.mark.parametrize("width", [12, None])
def test_reset_takes_many_instruments_in_one_call(width):
    """One call a batch for all instruments of a group: each gets what it gets alone, also beside null values."""
    batches = [instants(batch, 40, odd=True) for batch in range(4)]
    columns = processors.names(windows.ALERT_COLUMNS)
    machine = lambda: processors.ResetWindow(width, 300, columns)
    together, calls = played(machine(), batches)
    assert calls == 4 and len(together) > 100
    assert ordered(together) == alone(machine, batches)


@pytest.mark.parametrize("window_s", [5, None])
def test_reset_equals_batch(spark, window_s):
    profile = replace(P.RESET, window_s=window_s, threshold_paise=6000)
    rows = trade_rows(12)
    closing = [("~close", 10_000, 10_000_000, 1)]
    stream = trade_frame(spark, rows + closing)
    out = streams.run(spark, stream, lambda t: live.reset_alerts(t, profile, "2 seconds"))
    want = scan.detect(trade_frame(spark, rows), profile)
    assert sorted(out.select(want.columns).collect()) == sorted(want.collect())


def test_sliding_equals_batch(spark):
    profile = replace(P.SLIDING, threshold_paise=6000)
    rows = trade_rows(13)
    stream = trade_frame(spark, rows + [("~close", 10_000, 10_000_000, 1)])
    out = streams.run(spark, stream, lambda t: live.sliding_bursts(t, profile))
    want = scan.detect(trade_frame(spark, rows), profile)
    keep = ["instrument_key", "b", "paise", "vol", "n", "buy", "sell"]
    assert sorted(out.select(keep).collect()) == sorted(want.select(keep).collect())


def test_sliding_state_is_buckets(spark, tmp_path):
    """No bucket is copied into the windows that hold it."""
    stream = spark.readStream.schema(trade_frame(spark, trade_rows(13, n=5)).schema).parquet(str(tmp_path))
    assert "Expand" not in live.sliding_bursts(stream, P.SLIDING)._jdf.queryExecution().analyzed().toString()


def test_sliding_edges_equal_batch(spark):
    profile = replace(P.SLIDING, threshold_paise=6000)
    rows = trade_rows(13) + [("~close", 10_000, 10_000_000, 1)]
    moved = {"price": F.col("price") + F.col("seq") % 7, "oi": F.when(F.col("seq") % 3 > 0, F.col("seq") * 10)}
    stream = trade_frame(spark, rows).withColumns(moved)
    out = streams.run(spark, stream, lambda t: live.sliding_bursts(t, profile))
    want = scan.detect(stream, profile).filter("instrument_key != '~close'")
    keep = ["instrument_key", "b", "paise", "first_price", "last_price", "first_oi", "last_oi", "last_ms"]
    key = lambda r: (r.instrument_key, r.b)
    got = sorted(out.select(keep).collect(), key=key)
    assert got and got == sorted(want.select(keep).collect(), key=key)
    assert any(r.first_oi != r.last_oi for r in got)


def test_late_trades_are_dropped(spark):
    """A trade older than the watermark when its stretch arrives does not count."""
    profile = replace(P.RESET, threshold_paise=100)
    rows = [("k", 0, 1_000, 1), ("k", 1, 60_000, 1), ("k", 2, 120_000, 1), ("k", 3, 2_000, 50), ("~close", 5, 9_000_000, 1)]
    out = streams.run(spark, trade_frame(spark, rows), lambda t: live.reset_alerts(t, profile, "1 second"), stretches=6)
    assert sorted((r.b, r.paise) for r in out.collect() if r.instrument_key == "k") == [(3, 100), (121, 100), (241, 100)]


def test_oi_latch_equals_batch(spark):
    feed = ticks(spark, noisy_feed(14)).withColumns(
        {"oi": F.col("seq") % 5 * 10, "arrival_ms": F.col("seq") * 1000}
    )
    out = streams.run(spark, feed, lambda t: live.latch_oi(t, "00:01"), mode="update")
    newest = [F.max_by(c, "batch_id").alias(c) for c in ("base_oi", "locked_ms")]
    out = out.groupBy("instrument_key", "trade_date").agg(*newest)
    want = registry.oi_baseline(trade_ops.with_defaults(feed), "00:01")
    assert sorted(out.select(want.columns).collect()) == sorted(want.collect())


def test_registry_equals_the_model(spark):
    rows = [("hot" if i % 2 else f"r{i % 5}", 1000 + i * 700 % 40_000 + (i // 20) * 40_000, i, i + 1) for i in range(60)]  # a watermark starts at 0
    alerts = spark.createDataFrame(rows, "reg_key string, alert_ms bigint, seq bigint, paise bigint")
    out = streams.run(spark, alerts, lambda a: live.register(a, ("seq",)), stretches=2)
    got = sorted(
        (r.reg_key, r.seq, r.alert_count, r.cumulative_paise, r.minutes_active, r.first_gap, r.last_gap)
        for r in out.collect()
    )
    assert got == model.registry(rows)


def test_heat_equals_the_model(spark):
    rows = [(f"T{i % 3}", i * 7_000 + (i % 4) * 300_000, i, i * 1_000_000) for i in range(40)]
    rows = [(t, i * 9_000 if i < 20 else i * 9_000 + 500_000, i, p) for i, (t, _, _, p) in enumerate(rows)]
    alerts = spark.createDataFrame(rows, "ticker string, alert_ms bigint, seq bigint, paise bigint")
    out = streams.run(spark, alerts, lambda a: live.heat_scores(a), mode="update")
    last = {}
    for r in out.orderBy("batch_id").collect():
        last[r.ticker] = r.heat
    for t in ("T0", "T1", "T2"):
        mine = [(ms // 1000, 100 + min(p / 10_000_000, 50)) for tt, ms, _, p in rows if tt == t]
        assert last[t] == pytest.approx(model.heat(mine))


def test_live_chain_from_messages_to_log_and_queue(spark, tmp_path):
    """Ticks -> dedup -> windows -> records -> log and queue, in one streaming query."""
    profile = replace(P.BARS, threshold_paise=6000)
    rows = noisy_feed(15, hot=False)
    rows = [(k, s, 1000 * (t + 1), v, q) for k, s, t, v, q in rows] + [("~close", 9_999, 90_000_000, 5, 5)]
    feed = ticks(spark, rows)
    source, out = str(tmp_path / "in"), str(tmp_path)
    feed.write.parquet(source)
    ticked = readers.stream(spark, source, feed.schema, files_per_trigger=None)
    alerts = live.reset_alerts(live.dedup_ticks(ticked), profile, "1 hour")
    dim = spark.createDataFrame([("k1", "ONE", 10.0, "CE")], "instrument_key string, name string, strike double, type string")
    named = registry.with_instrument(scan.categorise(alerts, profile), dim)
    built = records.alert_records(named, profile).withColumn("trade_date", F.lit("1970-01-01").cast("date"))
    runs.drain(built, out, write=sinks.log_and_publish(f"{out}/log", f"{out}/queue", profile))

    batch = scan.categorise(scan.detect(trade_ops.trades(feed), profile), profile)
    want = records.alert_records(registry.with_instrument(batch, dim), profile)
    log = readers.alert_log(spark, f"{out}/log").drop("batch_id", "trade_date")
    assert want.count() > 0
    assert log.columns == want.drop("avg_trade_size").columns
    assert sorted(log.collect()) == sorted(want.drop("avg_trade_size").collect())
    good, bad = records.from_messages(spark.read.text(f"{out}/queue").select("value"), profile)
    assert sorted(good.collect()) == sorted(want.collect()) and bad.count() == 0


def test_strike_table_is_read_again_in_each_batch(spark, tmp_path):
    seen = []

    def write(batch, batch_id):
        seen.append(readers.strike_table(spark, str(tmp_path / "strikes"), missing_ok=True).count())

    source = str(tmp_path / "in")
    frame = trade_frame(spark, trade_rows(1, n=5))
    strikes = spark.createDataFrame([("A", "u", 1.0, *[None] * 8)], readers.schemas.STRIKE_TABLE)
    for i in range(2):
        frame.write.mode("append").parquet(source)
        runs.drain(readers.stream(spark, source, frame.schema, files_per_trigger=None), str(tmp_path / "q"), write=write)
        if i == 0:
            sinks.write_csv(strikes, str(tmp_path / "strikes"))
    assert seen[0] == 0 and seen[-1] == 1
