"""Row types of every table and message the engine reads or writes."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(text: str, **nested: T.DataType) -> T.StructType:
    """`name type, name type, ...`; usable before a session exists."""
    fields = [column.split() for column in text.split(", ")]
    return T.StructType([T.StructField(n, nested.get(t) or _TYPES[t]) for n, t in fields])


INSTRUMENT_MASTER = _struct(
    "segment string, name string, expiry bigint, instrument_type string, asset_symbol string, "
    "instrument_key string, strike_price double, lot_size int, exchange_token string, "
    "tick_size double, trading_symbol string, underlying_key string"
)

OPTION_CHAIN = _struct(
    "name string, asset_symbol string, expiry timestamp_ntz, ce_instrument_key string, "
    "strike_price double, pe_instrument_key string, lot_size int, tick_size double, "
    "underlying_key string"
)

SPOT_QUOTE = _struct("underlying_key string, last_price double, quoted_ms bigint")

STRIKE_TABLE = _struct(
    "name string, underlying_key string, spot_price double, atm_ce string, atm_pe string, "
    "minus_4_pe string, minus_5_pe string, minus_6_pe string, "
    "plus_4_ce string, plus_5_ce string, plus_6_ce string"
)

# One feed message: instrument key -> feed. `first_level` is null for the other feed variants.
_LTPC = _struct("ltp double, ltt bigint, ltq bigint")
_DEPTH = _struct("bid_p double, ask_p double")
_FIRST_LEVEL = _struct("ltpc ltpc, first_depth depth, vtt bigint, oi bigint", ltpc=_LTPC, depth=_DEPTH)
FEED = _struct("first_level level", level=_FIRST_LEVEL)
TICK_MESSAGE = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("arrival_ms", T.LongType()),
        T.StructField("feeds", T.MapType(T.StringType(), FEED)),
    ]
)

TICKS = _struct(
    "instrument_key string, seq bigint, arrival_ms bigint, ltt bigint, ltp double, ltq bigint, "
    "vtt bigint, oi bigint, bid_p double, ask_p double"
)

# The alert log grew by columns from profile to profile; one evolving table holds all of them.
_LOG_BASE = (
    "timestamp string, ticker string, strike string, option_type string, value double, "
    "ltp double, oi bigint, category string"
)
_LOG_MOVES = _LOG_BASE + ", ltp_change double, oi_change double, volume double"
_LOG_CONVICTION = _LOG_MOVES + (
    ", alert_count int, time_active_minutes double, oi_growth_from_open double, "
    "conviction int, conviction_label string"
)
_LOG_FLOW = _LOG_CONVICTION + ", side string, acceleration double, delta_pct double"

ALERT_LOG = {
    "arrival": _struct(_LOG_BASE),
    "bars": _struct(_LOG_MOVES),
    "reset": _struct(_LOG_CONVICTION),
    "sliding": _struct(_LOG_FLOW),
}

# The message carries a few fields the table does not.
ALERT_MESSAGE = {
    "arrival": _struct(_LOG_BASE + ", is_atm boolean"),
    "bars": _struct(_LOG_MOVES + ", avg_trade_size double"),
    "reset": _struct(_LOG_CONVICTION + ", avg_trade_size double, cumulative_value double"),
    "sliding": _struct(_LOG_FLOW),
}

MOVERS = _struct("name string, symbol string, pct_change double, change double")
