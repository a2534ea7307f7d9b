"""Option-market trade flow on Spark: chain, trades, window alerts, scores, leaderboard.

Every function takes and returns DataFrames.
"""

from .operators.board import heat, leaderboard, movers, recent
from .operators.chain import active_keys, companies, directional_strikes, instrument_dim, option_chain, spot_prices
from .operators.records import alert_records, from_messages, high_conviction_feed, to_messages
from .operators.registry import history, oi_baseline, register
from .operators.trades import buckets, explode_messages, trades
from .plans.profiles import ARRIVAL, BARS, PROFILES, RESET, SLIDING, Profile
from .plans.scan import categorise, detect as alerts, scan, score

__all__ = [
    "ARRIVAL",
    "BARS",
    "PROFILES",
    "RESET",
    "SLIDING",
    "Profile",
    "active_keys",
    "alert_records",
    "alerts",
    "buckets",
    "categorise",
    "companies",
    "directional_strikes",
    "explode_messages",
    "from_messages",
    "heat",
    "high_conviction_feed",
    "history",
    "instrument_dim",
    "leaderboard",
    "movers",
    "oi_baseline",
    "option_chain",
    "recent",
    "register",
    "scan",
    "score",
    "spot_prices",
    "to_messages",
    "trades",
]
