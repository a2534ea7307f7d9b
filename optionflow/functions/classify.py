"""Alert classifiers as Column expressions; all stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
PRICE_STILL = 0.02
PRICE_DEAD_ZONE = 0.003
OI_DEAD_ZONE = 0.005
NO_FLOW_DELTA_PCT = 50.0


def ratio(num: Column, den: Column, default: float = 0.0) -> Column:
    """num/den where den is positive, else the default."""
    return F.when(den > 0, num / den).otherwise(F.lit(default))


def momentum_category(first_price: Column, last_price: Column) -> Column:
    return F.when(F.abs(last_price - first_price) < PRICE_STILL, "HIDDEN_ACCUMULATION").otherwise("MOMENTUM")


def flow_category(
    first_price: Column, last_price: Column, first_oi: Column, last_oi: Column, quiet_exit: str = "EXITING"
) -> Column:
    """Six states from price direction and open-interest direction.

    `quiet_exit` is the label for a still price with falling open interest.
    """
    move = last_price - first_price
    oi_pct = ratio(last_oi - first_oi, first_oi)
    rising, falling = oi_pct > OI_DEAD_ZONE, oi_pct < -OI_DEAD_ZONE
    up, down = move > 0, move < 0
    return (
        F.when(
            F.abs(ratio(move, first_price)) <= PRICE_DEAD_ZONE,
            F.when(falling, quiet_exit).otherwise("ACCUMULATION"),
        )
        .when(up & falling, "SHORT_COVERING")
        .when(down & falling, "LONG_UNWINDING")
        .when(up, "LONG_BUILDUP")
        .otherwise("SHORT_BUILDUP")
    )


def trade_side(price: Column, bid: Column, ask: Column) -> Column:
    """Aggressor side; an absent book has mid price 0 and so reads as BUY."""
    mid = (F.coalesce(bid, F.lit(0.0)) + F.coalesce(ask, F.lit(0.0))) / 2
    return F.when(price >= mid, "BUY").otherwise("SELL")


def delta_pct(buy: Column, sell: Column) -> Column:
    total = buy + sell
    return F.when(total > 0, buy / total * 100).otherwise(F.lit(NO_FLOW_DELTA_PCT))


def flow_side(buy: Column, sell: Column) -> Column:
    return F.when(buy > sell, "BUY_SCRAPE").otherwise("SELL_SCRAPE")


def acceleration(burst_vol: Column, base_vol: Column, burst_s: float, base_s: float) -> Column:
    """Burst volume per minute over the baseline's volume per minute.

    The baseline always divides by its full length, so a cold start reads high.
    """
    per_min = base_vol / F.lit(base_s / 60)
    return F.when(per_min > 0, burst_vol * F.lit(60 / burst_s) / per_min).otherwise(F.lit(1.0))


def oi_growth(last_oi: Column, base_oi: Column) -> Column:
    """Growth in percent; no baseline (null or 0) gives 0."""
    base = F.coalesce(base_oi, F.lit(0))
    return F.when(base > 0, (last_oi - base) / base * 100).otherwise(F.lit(0.0))


def strike_text(strike: Column) -> Column:
    """Strike as text with its decimal point: 1600.0; also right from 1e7 up, where a
    plain cast switches to exponent form."""
    long_form = F.when(strike.isNotNull(), F.format_string("%.1f", strike))
    return F.when(F.abs(strike) < 1e7, strike.cast("string")).otherwise(long_form)


def reg_key(name: Column, strike: Column, option_type: Column) -> Column:
    """`NAME-STRIKE-TYPE`; a missing part is an empty one, so the two dashes always stay."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (name, strike, option_type)]
    return F.concat_ws("-", *parts)
