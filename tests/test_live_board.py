"""Hot and cold tickers, newest lists and dead letters on streams."""

import random

import pytest
from pyspark.sql import functions as F

from checks import streams
from optionflow.operators import board
from optionflow.sources import readers, sinks
from optionflow.streaming import board as live_board, live


@pytest.fixture(autouse=True)
def rocksdb(spark):
    live.use_rocksdb(spark)


def changes(alerts, until):
    """(ticker, tick, hot) by decaying every ticker's score tick by tick."""
    found = []
    for t in {a[0] for a in alerts}:
        points = {}
        for ticker, ms, _, paise, *_ in alerts:
            if ticker == t:
                points[ms // 1000] = points.get(ms // 1000, 0) + 100 + min(paise / 10_000_000, 50)
        score, hot = 0.0, False
        for tick in range(until):
            score *= 0.98
            score = (score if score >= 1 else 0.0) + points.get(tick, 0)
            if hot != (score > 200):
                hot = not hot
                found.append((t, tick, hot))
    return sorted(found)


def test_tickers_cool_without_alerts(spark):
    rng = random.Random(3)
    rows = [(f"T{rng.randrange(4)}", 1000 + i * 9_000 + (i // 30) * 500_000, i, rng.randrange(10**9), "CE") for i in range(90)]
    rows += [("T0", rows[-1][1] + 100, 90, 10**9, "CE"), ("T0", rows[-1][1] + 200, 91, 10**9, "CE")]
    closing = ("~close", 10_000_000, 92, 1, "CE")
    alerts = spark.createDataFrame(rows + [closing], "ticker string, alert_ms bigint, seq bigint, paise bigint, option_type string")
    out = streams.run(spark, alerts, lambda a: live_board.hot_changes(a, lateness="1 second"), stretches=3)
    got = sorted((r.ticker, r.tick, r.is_hot) for r in out.collect() if r.ticker != "~close")
    want = changes(rows, 9_000)
    assert got == want and any(not h for *_, h in want)


def test_ticks_until_is_the_first():
    rng = random.Random(1)
    for _ in range(500):
        score, bound = rng.uniform(1, 5000), rng.choice([1.0, 200.0])
        n = live_board.ticks_until(score, bound, 0.98)
        assert score * 0.98**n <= bound and (n == 0 or score * 0.98 ** (n - 1) > bound)


def test_newest_lists_in_any_order(spark):
    rng = random.Random(2)
    rows = [(f"T{rng.randrange(2)}", rng.randrange(40) * 1000, i, i * 10, rng.choice(["ce", "PE", None]), None if i % 9 == 0 else str(i)) for i in range(120)]
    alerts = spark.createDataFrame(rows, "ticker string, alert_ms bigint, event_seq bigint, paise bigint, option_type string, timestamp string")
    alerts = alerts.withColumns({"strike": F.lit("1.0"), "seq": F.pmod(F.xxhash64("event_seq"), F.lit(1000))})

    def build(a):
        return live_board.newest(a.drop("seq").withColumnRenamed("event_seq", "seq"), 7)

    out = streams.run(spark, alerts, build, mode="update", stretches=3)
    last = out.groupBy("ticker", "side").agg(F.max("batch_id").alias("batch_id"))
    got = out.join(last, ["ticker", "side", "batch_id"])
    want = board.recent(alerts.drop("seq").withColumnRenamed("event_seq", "seq"), 7)
    keep = ["ticker", "side", "row_no", "seq", "alert_ms", "timestamp", "strike", "paise"]
    order = lambda r: (r.ticker, r.side, r.row_no)
    assert sorted(got.select(keep).collect(), key=order) == sorted(want.select(keep).collect(), key=order)


def test_dead_letters_are_counted_and_kept(spark, tmp_path):
    write = sinks.decoded_or_dead(str(tmp_path), readers.marked_tick_messages)
    good = '{"seq": 1, "arrival_ms": 2, "feeds": {"k": {"first_level": null}}}'
    lines = [[good, "{", ""], [good], [], [None, "x"]]
    for i, some in enumerate(lines):
        for _ in range(2):
            write(spark.createDataFrame([(v,) for v in some], "value string"), i)
    counts = {r.batch_id: (r.good, r.bad) for r in spark.read.parquet(f"{tmp_path}/counts").collect()}
    assert counts == {0: (1, 2), 1: (1, 0), 2: (0, 0), 3: (0, 2)}
    dead = spark.read.parquet(f"{tmp_path}/lines").filter("dead = 'true'").select("batch_id", "value").collect()
    assert sorted(((r.batch_id, r.value) for r in dead), key=str) == [(0, ""), (0, "{"), (3, "x"), (3, None)]
