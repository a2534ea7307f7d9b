import itertools
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from optionflow.functions import classify, clock, money, score

from . import model


def column(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


@pytest.mark.parametrize("quiet_exit", ["EXITING", "DISTRIBUTION"])
def test_flow_category_table(spark, quiet_exit):
    flat, up, down = 1000.0, 1010.0, 990.0
    same, rise, fall = 1000, 1010, 990
    want = {
        (flat, rise): "ACCUMULATION",
        (flat, fall): quiet_exit,
        (flat, same): "ACCUMULATION",
        (up, rise): "LONG_BUILDUP",
        (down, rise): "SHORT_BUILDUP",
        (up, fall): "SHORT_COVERING",
        (down, fall): "LONG_UNWINDING",
        (up, same): "LONG_BUILDUP",
        (down, same): "SHORT_BUILDUP",
        # exactly at a limit: 0.3 % is still flat, 0.5 % is still unchanged
        (1003.0, fall): quiet_exit,
        (997.0, rise): "ACCUMULATION",
        (1003.1, rise): "LONG_BUILDUP",
        (up, 1005): "LONG_BUILDUP",
        (up, 995): "LONG_BUILDUP",
        (up, 994): "SHORT_COVERING",
    }
    rows = [(1000.0, p, 1000, oi) for p, oi in want]
    state = classify.flow_category(F.col("fp"), F.col("lp"), F.col("fo"), F.col("lo"), quiet_exit)
    got = column(spark, rows, "fp double, lp double, fo bigint, lo bigint", state)
    assert [g[0] for g in got] == list(want.values())


def test_flow_category_without_first_price_or_oi(spark):
    state = classify.flow_category(F.col("fp"), F.col("lp"), F.col("fo"), F.col("lo"))
    got = column(spark, [(0.0, 5.0, 0, 9), (10.0, 20.0, 0, 9)], "fp double, lp double, fo bigint, lo bigint", state)
    assert got == [("ACCUMULATION",), ("LONG_BUILDUP",)]


def test_momentum_category(spark):
    c = classify.momentum_category(F.col("a"), F.col("b"))
    got = column(spark, [(1.0, 1.01), (1.0, 1.5), (0.0, 0.02), (1.5, 1.0)], "a double, b double", c)
    assert [g[0] for g in got] == ["HIDDEN_ACCUMULATION", "MOMENTUM", "MOMENTUM", "MOMENTUM"]


def test_trade_side_and_flow(spark):
    side = classify.trade_side(F.col("p"), F.col("bid"), F.col("ask"))
    got = column(spark, [(2.0, 1.0, 3.0), (1.9, 1.0, 3.0), (0.0, None, None)], "p double, bid double, ask double", side)
    assert [g[0] for g in got] == ["BUY", "SELL", "BUY"]
    flow = [classify.flow_side(F.col("b"), F.col("s")), classify.delta_pct(F.col("b"), F.col("s"))]
    got = column(spark, [(3, 1), (2, 2), (0, 0), (0, 5)], "b bigint, s bigint", *flow)
    assert got == [("BUY_SCRAPE", 75.0), ("SELL_SCRAPE", 50.0), ("SELL_SCRAPE", 50.0), ("SELL_SCRAPE", 0.0)]


def test_acceleration_and_growth(spark):
    got = column(spark, [(10, 10), (10, 1000)], "v bigint, base bigint", classify.acceleration(F.col("v"), F.col("base"), 10, 900))
    assert got == [(90.0,), (10 * 6 / (1000 / 15),)]
    growth = classify.oi_growth(F.col("l"), F.col("b"))
    assert column(spark, [(150, 100), (50, 100), (50, 0), (50, None)], "l bigint, b bigint", growth) == [
        (50.0,),
        (-50.0,),
        (0.0,),
        (0.0,),
    ]


def test_texts(spark):
    strike = classify.strike_text(F.col("s"))
    got = column(spark, [(1600.0,), (1.5,), (12345678.0,), (None,)], "s double", strike)
    assert [g[0] for g in got] == ["1600.0", "1.5", "12345678.0", None]
    key = classify.reg_key(F.col("n"), F.col("s"), F.col("t"))
    got = column(spark, [("A", "1.0", "CE"), ("A", None, None)], "n string, s string, t string", key)
    assert [g[0] for g in got] == ["A-1.0-CE", "A--"]
    assert column(spark, [(12_345_678,)], "p bigint", money.lakh_text(F.col("p"))) == [("1.2L",)]


def test_clock_does_not_depend_on_the_session_zone(spark):
    ms = 1771957799000
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            row = spark.createDataFrame([(ms,)], "ms bigint").select(
                clock.utc_clock(F.col("ms")),
                clock.clock_text(F.col("ms"), clock.DAY_TIME, "Asia/Kolkata"),
                clock.clock_text(F.col("ms"), clock.MONTH_TIME),
                clock.at_or_after(F.col("ms"), "18:29"),
                clock.at_or_after(F.col("ms"), "18:30"),
            ).first()
            want = (datetime(2026, 2, 24, 18, 29, 59), "24/02/2026 23:59:59", "Feb 24 18:29:59", True, False)
            assert tuple(row) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_day_conviction_equals_the_model(spark):
    growth = [-5.0, 0.0, 10.0, 66.0, 67.0, 500.0]
    counts = [1, 2, 3, 5, 6, 9, 10, 50]
    minutes = [0.0, 4.9, 5.0, 19.9, 20.0, 45.0, 90.0]
    gaps = [(None, None), (0.0, 1.0), (10.0, 4.9), (10.0, 5.0), (10.0, 7.5), (10.0, 9.0)]
    history = [None, (2.0, 100.0, 1), (2.0, 100.0, 2), (10.0, 1000.0, 3), (0.0, 0.0, 5)]
    rows = [
        (g, c, m, *(gap if c >= 3 else (None, None)), *(h or (None, None, None)), 400)
        for g, c, m, gap, h in itertools.product(growth, counts, minutes, gaps, history)
        if c < 3 or gap[0] is not None
    ]
    schema = "g double, c bigint, m double, fg double, lg double, aa double, av double, td bigint, cum bigint"
    cols = [F.col(c) for c in ("g", "c", "m", "fg", "lg", "aa", "av", "td", "cum")]
    value = score.day_conviction(*cols)
    got = column(spark, rows, schema, value, score.conviction_label(value))
    want = [model.day_score(r[0], r[1], r[2], r[3], r[4], r[5:8] if r[7] else None, r[8]) for r in rows]
    assert [g[0] for g in got] == want
    assert max(want) == 150  # the parts reach 160
    label = lambda s: "HIGH_CONVICTION" if s >= 100 else "SUSPICIOUS" if s >= 60 else "WATCHING" if s >= 30 else "NOISE"
    assert [g[1] for g in got] == [label(s) for s in want]


def test_flow_conviction_steps(spark):
    rows = [
        (0.0, 1, 0.0, 50.0, None, 0),
        (100.0, 1, 0.0, 50.0, None, 40),
        (0.0, 5, 0.0, 50.0, None, 15),
        (0.0, 10, 0.0, 50.0, None, 30),
        (0.0, 1, 1.5, 50.0, None, 10),
        (0.0, 1, 3.0, 50.0, None, 20),
        (0.0, 1, 5.0, 50.0, None, 30),
        (0.0, 1, 0.0, 85.0, None, 20),
        (0.0, 1, 0.0, 15.0, None, 20),
        (0.0, 1, 0.0, 84.9, None, 0),
        (0.0, 4, 0.0, 50.0, 2.0, 0),
        (0.0, 4, 0.0, 50.0, 1.9, 30),
        (100.0, 10, 5.0, 100.0, 1.0, 150),
        (3.0, 1, 0.0, 50.0, None, 1),  # 1.8 is cut, not rounded
    ]
    value = score.flow_conviction(*[F.col(c) for c in ("g", "c", "a", "d", "h")])
    got = column(spark, rows, "g double, c bigint, a double, d double, h double, want int", value, "want")
    assert [g[0] for g in got] == [g[1] for g in got]


def test_numbers_are_rounded_by_their_binary_value(spark):
    import random

    rng = random.Random(5)
    values = [0.0, 0.5, 1.5, 2.5, 0.25, 0.75, 0.35, 0.05, 0.15, 2.675, 1.005, -0.4, -2.5, 1e13 + 0.5, 0.004, 0.0039, 123456.785]
    values += [rng.randrange(10**7) / 200 for _ in range(400)] + [rng.uniform(-1e4, 1e4) for _ in range(200)] + [2.0**k for k in range(-9, 40)]
    exprs = [money.half_even(F.col("x"), d) for d in (0, 1, 2)] + [money.fixed_text(F.col("x"), d) for d in (0, 1)]
    got = column(spark, [(v,) for v in values], "x double", F.struct(*[e.alias(f"e{i}") for i, e in enumerate(exprs)]))
    for v, (row,) in zip(values, got):
        assert tuple(row)[:3] == (float(round(v, 0)), round(v, 1), round(v, 2)), v
        assert tuple(row)[3:] == (f"{v:.0f}", f"{v:.1f}"), v


def test_numbers_in_text(spark):
    from optionflow.functions import text

    cells = ["1.0", "-2", "+.5", "3.", "1e3", "1.0d", "2f", "0x1", "", "n/a", "NaN", "inf", None]
    got = [r for (r,) in column(spark, [(c,) for c in cells], "c string", text.number(F.col("c")))]
    assert got[:5] == [1.0, -2.0, 0.5, 3.0, 1000.0] and got[5:10] == [None] * 5 and got[12] is None
    assert got[10] != got[10] and got[11] == float("inf")


def test_rounding_names_its_number_a_few_times(spark):
    """Spelled out it was named 20 times and more, and code made of a few roundings was too long to be compiled."""
    for made in (money.half_even(F.col("price"), 2), money.fixed_text(F.col("price"), 0), money.fixed_text(F.col("price"), 1)):
        assert str(made).count("price") <= 3
