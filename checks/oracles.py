"""DuckDB statements equal to the registered queries, written from the operator definitions.

They use other means than the Spark plans: recursive steps, self joins and plain windows
over whole keys.
"""

from __future__ import annotations

# ---------------------------------------------------------------- views

TICKS = """
ticks as (
  select concat('NSE_FO|', cast(user_id as varchar)) as instrument_key, event_id as seq,
    (epoch_us(ts) - 1704067200000000) // 1000000 as ltt, value as ltp, 1 + event_id % 400 as ltq,
    cast(sum(1 + event_id % 400) over w as bigint) as vtt,
    cast(100000 + sum(case event_type when 'purchase' then 900 when 'signup' then 400
      when 'error' then -800 else 0 end) over w as bigint) as oi,
    value - 0.5 + cast(event_id % 3 as double) / 4 as bid_p, value + 0.25 as ask_p
  from events
  window w as (partition by user_id order by event_id rows unbounded preceding))"""

NOISY = (
    TICKS
    + """,
noisy as (
  select * replace (
    greatest(ltt - case when seq % 5 = 0 then 20000 when seq % 11 = 0 then 90000 else 0 end, 0) as ltt,
    greatest(vtt - case when seq % 7 = 0 then 700 when seq % 13 = 0 then vtt else 0 end, 0) as vtt)
  from ticks)"""
)

# On the monotone feed every tick is a trade of its own quantity.
TRADES = (
    TICKS
    + """,
trades as (
  select instrument_key, seq, ltt + 250 as arrival_ms, ltt, ltp as price, ltq as qty,
    cast(round(ltp * 100) as bigint) * ltq as paise, oi,
    case when ltp >= (bid_p + ask_p) / 2 then 'BUY' else 'SELL' end as side
  from ticks)"""
)


def buckets(clock: str = "ltt") -> str:
    return (
        TRADES
        + f""",
buckets as (
  select instrument_key, {clock} // 500 + 1 as b, cast(sum(paise) as bigint) as paise,
    cast(sum(qty) as bigint) as vol, count(*) as n, arg_min(price, seq) as first_price,
    arg_max(price, seq) as last_price, arg_min(oi, seq) as first_oi, arg_max(oi, seq) as last_oi,
    arg_max(ltt, seq) as last_ms,
    cast(sum(case when side = 'BUY' then qty else 0 end) as bigint) as buy,
    cast(sum(case when side = 'SELL' then qty else 0 end) as bigint) as sell
  from trades group by 1, 2)"""
    )


# Sums of the buckets joined to an alert as x, from its first to its last bucket.
WINDOW_VALUES = """cast(sum(x.paise) as bigint) as paise, cast(sum(x.vol) as bigint) as vol,
    cast(sum(x.n) as bigint) as n, arg_min(x.first_price, x.b) as first_price,
    arg_max(x.last_price, x.b) as last_price, arg_min(x.first_oi, x.b) as first_oi,
    arg_max(x.last_oi, x.b) as last_oi, arg_max(x.last_ms, x.b) as last_ms,
    cast(sum(x.buy) as bigint) as buy, cast(sum(x.sell) as bigint) as sell"""


def reset(width: int | None, clock: str = "ltt") -> str:
    """Steps through the buckets of all keys at once, carrying the sum at the last alert."""
    low = (
        f"coalesce(sum(paise) over (partition by instrument_key order by b "
        f"range between unbounded preceding and {width} preceding), 0)"
        if width
        else "0"
    )
    floor_b = f"greatest(p.reset_b, p.b - {width})" if width else "p.reset_b"
    return (
        buckets(clock)
        + f""",
steps as (
  select instrument_key, b, row_number() over w as i,
    cast(sum(paise) over (w rows unbounded preceding) as bigint) as total, cast({low} as bigint) as low
  from buckets window w as (partition by instrument_key order by b)),
path as (
  select instrument_key, b, i, case when total >= 5000000 then total else 0 end as reset_total,
    case when total >= 5000000 then b else -1000000 end as next_reset_b,
    cast(-1000000 as bigint) as reset_b, total >= 5000000 as fired
  from steps where i = 1
  union all
  select s.instrument_key, s.b, s.i,
    case when s.total - greatest(p.reset_total, s.low) >= 5000000 then s.total else p.reset_total end,
    case when s.total - greatest(p.reset_total, s.low) >= 5000000 then s.b else p.next_reset_b end,
    p.next_reset_b, s.total - greatest(p.reset_total, s.low) >= 5000000
  from path p join steps s on s.instrument_key = p.instrument_key and s.i = p.i + 1),
alerts as (
  select p.instrument_key, p.b, {WINDOW_VALUES}
  from path p join buckets x on x.instrument_key = p.instrument_key and x.b <= p.b and x.b > {floor_b}
  where p.fired group by 1, 2)"""
    )


SLIDING = (
    buckets()
    + f""",
alerts as (
  select g.instrument_key, g.b, {WINDOW_VALUES}
  from (select distinct instrument_key, b + unnest(range(20)) as b from buckets) g
  join buckets x on x.instrument_key = g.instrument_key and x.b <= g.b and x.b > g.b - 20
  group by 1, 2 having sum(x.paise) >= 5000000)"""
)

BASE_VOL = """,
based as (
  select a.*, (select cast(sum(x.vol) as bigint) from buckets x
    where x.instrument_key = a.instrument_key and x.b <= a.b and x.b > a.b - 1800) as base_vol
  from alerts a),
flow as (
  select *, vol * 6.0::double / (base_vol / 15.0::double) as acceleration,
    buy / (buy + sell) * 100 as delta_pct, case when buy > sell then 'BUY_SCRAPE' else 'SELL_SCRAPE' end as side
  from based)"""

ALERT_FIELDS = "instrument_key, b, paise, vol, n, first_price, last_price, first_oi, last_oi, last_ms, buy, sell"


def flow_category(quiet_exit: str) -> str:
    pct = "(case when first_price > 0 then (last_price - first_price) / first_price else 0 end)"
    oip = "(case when first_oi > 0 then (last_oi - first_oi) / first_oi else 0 end)"
    return f"""case
    when abs({pct}) <= 0.003 and {oip} < -0.005 then '{quiet_exit}'
    when abs({pct}) <= 0.003 then 'ACCUMULATION'
    when {oip} < -0.005 and last_price > first_price then 'SHORT_COVERING'
    when {oip} < -0.005 and last_price < first_price then 'LONG_UNWINDING'
    when last_price > first_price then 'LONG_BUILDUP' else 'SHORT_BUILDUP' end"""


MOMENTUM = "case when abs(last_price - first_price) < 0.02 then 'HIDDEN_ACCUMULATION' else 'MOMENTUM' end"

MASTER = """
master as (
  select p_partkey as seq, case when p_brand = 'Brand#9' then 'RELIANCE INDUSTRIES' else p_brand end as name,
    concat('SYM', p_brand) as asset_symbol,
    case when p_partkey % 50 = 49 then 1771900000000 else 1771957799000 end as expiry_ms,
    it.t as instrument_type,
    concat('NSE_FO|', cast(2 * p_partkey + (case it.t when 'CE' then 0 else 1 end) as varchar)) as instrument_key,
    case when p_partkey % 97 = 96 then null else cast(p_retailprice as double) end as strike_price,
    cast(25 * (1 + p_size % 4) as integer) as lot_size, cast(5 as double) as tick_size,
    case when p_partkey % 40 = 39 then 'NSE_EQ' else 'NSE_FO' end as segment,
    case when p_brand = 'Brand#3' then 'NSE_INDEX|3' else concat('NSE_EQ|', p_brand) end as underlying_key
  from part cross join (values ('CE'), ('PE'), ('FUT')) it(t)
  where not (p_partkey % 23 = 22 and it.t = 'PE')),
contracts as (
  select * exclude (expiry_ms), timestamp '2026-02-24 18:29:59' as expiry from master
  where segment = 'NSE_FO' and instrument_type in ('PE', 'CE') and expiry_ms = 1771957799000),
chain as (
  select name, asset_symbol, expiry, strike_price, lot_size, tick_size, underlying_key,
    arg_min(instrument_key, seq) filter (where instrument_type = 'CE') as ce_instrument_key,
    arg_min(instrument_key, seq) filter (where instrument_type = 'PE') as pe_instrument_key
  from contracts where strike_price is not null group by all),
companies as (
  select * from chain where underlying_key not like '%NSE_INDEX%' and name not like '%RELIANCE%'),
spot as (
  select underlying_key, case when underlying_key = 'NSE_EQ|Brand#5' then null
    when underlying_key = 'NSE_EQ|Brand#6' then 0.0::double
    else (min(strike_price) * 3 + max(strike_price) * 2) / 5 end as spot_price
  from master group by underlying_key)"""

STRIKES = (
    MASTER
    + """,
ranked as (
  select c.*, s.spot_price, row_number() over w as i,
    first_value(ce_instrument_key) over s as ce, first_value(pe_instrument_key) over s as pe,
    first_value(name) over w as lowest_name
  from companies c join spot s using (underlying_key) where s.spot_price <> 0
  window w as (partition by underlying_key order by strike_price, name, asset_symbol, expiry, lot_size, tick_size
      rows between unbounded preceding and current row),
    s as (partition by underlying_key, strike_price order by name, asset_symbol, expiry, lot_size, tick_size)),
center as (
  select underlying_key, i as atm_i from ranked
  qualify row_number() over (partition by underlying_key order by abs(strike_price - spot_price), i) = 1),
strikes as (
  select any_value(lowest_name) as name, underlying_key, any_value(spot_price) as spot_price,
    max(case when i = atm_i then ce end) as atm_ce, max(case when i = atm_i then pe end) as atm_pe,
    max(case when i = atm_i - 4 then pe end) as minus_4_pe, max(case when i = atm_i - 5 then pe end) as minus_5_pe,
    max(case when i = atm_i - 6 then pe end) as minus_6_pe, max(case when i = atm_i + 4 then ce end) as plus_4_ce,
    max(case when i = atm_i + 5 then ce end) as plus_5_ce, max(case when i = atm_i + 6 then ce end) as plus_6_ce
  from ranked join center using (underlying_key) group by underlying_key),
active as (
  select distinct instrument_key from (unpivot strikes on
    atm_ce, atm_pe, minus_4_pe, minus_5_pe, minus_6_pe, plus_4_ce, plus_5_ce, plus_6_ce
    into name slot value instrument_key))"""
)


def dim(order: str, where: str = "true") -> str:
    return f"""
legs as (
  select *, 'CE' as type, 0 as leg, ce_instrument_key as instrument_key from companies
  union all select *, 'PE', 1, pe_instrument_key from companies),
dim as (
  select instrument_key, name, strike_price as strike, type from legs
  where instrument_key is not null and {where}
  qualify row_number() over (partition by instrument_key order by {order}) = 1)"""


ROWWISE = (
    "name desc, asset_symbol desc, expiry desc, strike_price desc, lot_size desc, tick_size desc, "
    "underlying_key desc, leg desc"
)
CALLS_FIRST = "leg desc, " + ROWWISE
ACTIVE_ONLY = "instrument_key in (select instrument_key from active)"

LOG = """
log as (
  select strftime(ts, '%d/%m/%Y %H:%M:%S') as timestamp, epoch_us(ts) // 1000 as alert_ms, event_id as seq,
    cast(ts as date) as trade_date, concat('T', cast(user_id % 40 as varchar)) as ticker,
    cast(cast(900 + 10 * (user_id % 3) as double) as varchar) as strike,
    case when event_type in ('purchase', 'signup') then 'CE' else 'PE' end as option_type,
    cast(round(value * 100) as bigint) * (1 + event_id % 400) as paise
  from events),
history as (
  select concat(ticker, '-', strike, '-', option_type) as reg_key,
    count(*) / count(distinct substr(timestamp, 1, 10)) as avg_alerts_per_day,
    cast(sum(paise) as bigint) / count(distinct substr(timestamp, 1, 10)) as avg_paise_per_day,
    count(distinct substr(timestamp, 1, 10)) as trading_days
  from log where substr(timestamp, 1, 10) <> '30/01/2024' group by ticker, strike, option_type)"""


def registered(rows: str, tie: str) -> str:
    """Registry columns over `rows`, which has reg_key, trade_date and alert_ms."""
    return f"""
counted as (
  select *, row_number() over w as alert_count,
    cast(sum(paise) over (w rows unbounded preceding) as bigint) as cumulative_paise,
    first_value(alert_ms) over w as first_ms, nth_value(alert_ms, 2) over w as second_ms,
    lag(alert_ms) over w as last_alert_ms
  from {rows} window w as (partition by reg_key, trade_date order by alert_ms, {tie})),
registered as (
  select *, (alert_ms - first_ms) / 60000 as minutes_active,
    case when alert_count >= 3 then (second_ms - first_ms) / 1000 end as first_gap,
    case when alert_count >= 3 then (alert_ms - last_alert_ms) / 1000 end as last_gap
  from counted)"""


LABEL = """case when conviction >= 100 then 'HIGH_CONVICTION' when conviction >= 60 then 'SUSPICIOUS'
    when conviction >= 30 then 'WATCHING' else 'NOISE' end as conviction_label"""

DAY_SCORE = """cast(trunc(least(150.0::double,
    (case when oi_growth > 0 then least(oi_growth * 0.6::double, 40) else 0 end)
    + (case when alert_count >= 10 then 30 when alert_count >= 6 then 20 when alert_count >= 3 then 10
        when alert_count >= 2 then 5 else 0 end)
    + (case when minutes_active >= 90 then 20 when minutes_active >= 45 then 15 when minutes_active >= 20 then 8
        when minutes_active >= 5 then 3 else 0 end)
    + (case when first_gap > 0 and last_gap < first_gap * 0.5 then 20
        when first_gap > 0 and last_gap < first_gap * 0.75 then 10 else 0 end)
    + (case when trading_days >= 2 and avg_alerts_per_day > 0 then
        case when alert_count / avg_alerts_per_day >= 5 then 40 when alert_count / avg_alerts_per_day >= 3 then 25
          when alert_count / avg_alerts_per_day >= 2 then 12 else 0 end else 0 end)
    + (case when trading_days >= 2 and avg_paise_per_day > 0 and cumulative_paise / avg_paise_per_day >= 4
        then 10 else 0 end))) as integer) as conviction"""

FLOW_SCORE = """cast(trunc(least(150.0::double,
    (case when oi_growth > 0 then least(oi_growth * 0.6::double, 40) else 0 end)
    + (case when alert_count >= 10 then 30 when alert_count >= 5 then 15 else 0 end)
    + (case when acceleration >= 5 then 30 when acceleration >= 3 then 20 when acceleration >= 1.5 then 10 else 0 end)
    + (case when delta_pct >= 85 or delta_pct <= 15 then 20 else 0 end)
    + (case when alert_count > avg_alerts_per_day * 2 then 30 else 0 end))) as integer) as conviction"""


def scored(score: str) -> str:
    return f"""
scored as (
  select *, {LABEL} from (select r.*, {score} from registered r left join history h using (reg_key)))"""


SIGNALS = (
    LOG
    + """,
signals as (
  select * replace (epoch_ms(trade_date::timestamp) + (alert_ms - epoch_ms(trade_date::timestamp)) // 12 as alert_ms),
    concat(ticker, '-', strike, '-', option_type) as reg_key, cast(seq % 120 - 20 as double) as oi_growth,
    (seq % 13) / 2 as acceleration, cast(seq % 101 as double) as delta_pct
  from log)"""
)

BASELINE = """
baseline as (
  select instrument_key, arg_min(oi, seq) as base_oi, min(seq) as seq, arg_min(ltt + 250, seq) as locked_ms
  from ticks where oi > 0 and ltt + 250 >= 600000 group by 1)"""

# Alerts with their instrument, growth and registry key; `found` names the alert view.
NAMED = """
named as (
  select a.*, a.b * 500 as alert_ms, date '1970-01-01' as trade_date, coalesce(d.name, a.instrument_key) as ticker,
    coalesce(cast(d.strike as varchar), '') as strike, coalesce(d.type, '') as option_type
  from {found} a left join dim d using (instrument_key)),
grown as (
  select n.*, concat(ticker, '-', strike, '-', option_type) as reg_key,
    case when p.base_oi > 0 and p.locked_ms <= n.alert_ms
      then (n.last_oi - p.base_oi) / p.base_oi * 100 else 0 end as oi_growth
  from named n left join baseline p using (instrument_key))"""


def clock(ms: str, fmt: str) -> str:
    return f"strftime(make_timestamp({ms} * 1000), '{fmt}')"


MOVES = """ticker, strike, option_type, paise / 100 as value, round(last_price, 2) as ltp, last_oi as oi, category,
    round(last_price - first_price, 2) as ltp_change, cast(last_oi - first_oi as double) as oi_change,
    cast(vol as double) as volume"""
CONVICTION = """cast(alert_count as integer) as alert_count, cast(printf('%.1f', (minutes_active)::double) as double) as time_active_minutes,
    cast(printf('%.1f', (oi_growth)::double) as double) as oi_growth_from_open, conviction, conviction_label"""
DAY_TIME = "%d/%m/%Y %H:%M:%S"
MONTH_TIME = "%b %d %H:%M:%S"


def _with(*parts: str, recursive: bool = False) -> str:
    return f"with {'recursive ' if recursive else ''}" + ",".join(parts)


def _reset_query(width: int | None, category: str, clock_col: str = "ltt") -> str:
    body = _with(reset(width, clock_col), recursive=True)
    return f"{body} select {ALERT_FIELDS}, {category} as category from alerts"


BURST = f"""{_with(SLIDING)} select {ALERT_FIELDS}, side, side as category, delta_pct from (
  select *, case when buy > sell then 'BUY_SCRAPE' else 'SELL_SCRAPE' end as side,
    buy / (buy + sell) * 100 as delta_pct from alerts)"""
STREAM_BURST = f"{_with(SLIDING)} select instrument_key, b, paise, vol, n, buy, sell, case when buy > sell then 'BUY_SCRAPE' else 'SELL_SCRAPE' end as side from alerts"

FOLD = f"""{_with(NOISY, recursive=True)},
feed as (select *, row_number() over (partition by instrument_key order by seq) as i from noisy),
steps as (
  select instrument_key, i, seq, ltt > 0 or vtt > 0 as taken, case when ltt > 0 or vtt > 0 then ltt else 0 end as s_ltt,
    case when ltt > 0 or vtt > 0 then vtt else 0 end as s_vtt, ltq as qty
  from feed where i = 1
  union all
  select f.instrument_key, f.i, f.seq, f.ltt > s.s_ltt or f.vtt > s.s_vtt,
    case when f.ltt > s.s_ltt or f.vtt > s.s_vtt then f.ltt else s.s_ltt end,
    case when f.ltt > s.s_ltt or f.vtt > s.s_vtt then f.vtt else s.s_vtt end,
    case when s.s_vtt > 0 then f.vtt - s.s_vtt else f.ltq end
  from steps s join feed f on f.instrument_key = s.instrument_key and f.i = s.i + 1)
select f.instrument_key, f.seq, f.ltt, f.ltp as price, s.qty, cast(round(f.ltp * 100) as bigint) * s.qty as paise,
  f.oi, case when f.ltp >= (f.bid_p + f.ask_p) / 2 then 'BUY' else 'SELL' end as side, t.ltt + 250 as arrival_ms
from steps s join feed f using (instrument_key, seq) join ticks t using (instrument_key, seq)
where s.taken and s.qty > 0"""


def _bars_records(with_keys: bool) -> str:
    keys = "instrument_key, b, " if with_keys else ""
    body = _with(STRIKES, dim(ROWWISE, ACTIVE_ONLY), reset(None), BASELINE, NAMED.format(found="alerts"), recursive=True)
    return f"""{body}
select {keys}{clock('last_ms', MONTH_TIME)} as timestamp, {MOVES}, cast(printf('%.0f', (paise / 100 / n)::double) as double) as avg_trade_size
from (select *, {flow_category('DISTRIBUTION')} as category from grown)"""


ORACLES: dict[str, str] = {
    "option_chain": f"{_with(MASTER)} select * from chain",
    "sorted_contracts": f"""{_with(MASTER)} select name, instrument_type, strike_price, instrument_key, expiry, lot_size
from contracts""",
    "chain_value_lists": f"""{_with(MASTER)} select distinct 'name' as list, name as value from companies
union all select distinct 'underlying_key', underlying_key from companies""",
    "company_count": f"""{_with(MASTER)} select count(distinct name) as companies, count(*) as chain_rows
from companies""",
    "spot_snapshot": f"{_with(MASTER)} select * from spot",
    "directional_strikes": f"{_with(STRIKES)} select * from strikes",
    "active_keys": f"{_with(STRIKES)} select * from active",
    "instrument_dim": f"{_with(STRIKES, dim(ROWWISE, ACTIVE_ONLY))} select * from dim",
    "instrument_dim_whole_chain": f"{_with(MASTER, dim(CALLS_FIRST))} select * from dim",
    "tick_messages": f"""{_with(NOISY)} select n.instrument_key, n.seq, t.ltt + 250 as arrival_ms, n.ltt, n.ltp, n.ltq,
  n.vtt, n.oi, n.bid_p, n.ask_p from noisy n join ticks t using (instrument_key, seq) where n.seq % 7 <> 6""",
    "tick_messages_many": f"""{_with(NOISY)},
last as (
  select n.*, n.seq // 4 as message, max(t.ltt + 250) over (partition by n.seq // 4) as arrival_ms
  from noisy n join ticks t using (instrument_key, seq)
  qualify row_number() over (partition by n.seq // 4, instrument_key order by n.seq desc) = 1)
select instrument_key, message as seq, arrival_ms, ltt, ltp, ltq, vtt, oi, bid_p, ask_p from last where seq % 7 <> 6""",
    "tick_trades_fold": FOLD,
    "tick_trades_lag": f"{_with(TRADES)} select * from trades",
    "trade_buckets": f"{_with(buckets())} select *, paise / n as avg_paise from buckets",
    "burst_alerts": BURST,
    "burst_acceleration": f"""{_with(SLIDING + BASE_VOL)} select instrument_key, b, paise, vol, base_vol, acceleration,
  delta_pct, side from flow""",
    "burst_reset_acceleration": f"""{_with(reset(20) + BASE_VOL, recursive=True)} select instrument_key, b, paise, vol,
  base_vol, acceleration, delta_pct, side from flow""",
    "burst_windows": f"{_with(SLIDING)} select instrument_key, b, paise, vol, n, buy, sell from alerts",
    "rolling_reset_alerts": _reset_query(10, flow_category("EXITING")),
    "rolling_reset_alerts_120s": _reset_query(240, flow_category("EXITING")),
    "arrival_reset_alerts": _reset_query(10, MOMENTUM, "arrival_ms"),
    "value_bars": _reset_query(None, flow_category("DISTRIBUTION")),
    "category_6state": f"""{_with(reset(240), recursive=True)} select instrument_key, b,
  {flow_category('EXITING')} as category_exiting, {flow_category('DISTRIBUTION')} as category_distribution,
  {MOMENTUM} as category_momentum from alerts""",
    "atm_flag": f"""{_with(STRIKES, dim(ROWWISE), reset(10, 'arrival_ms'), recursive=True)},
named as (
  select a.instrument_key, a.b, coalesce(d.name, a.instrument_key) as ticker,
    coalesce(cast(d.strike as varchar), '') as strike, coalesce(d.type, '') as option_type
  from alerts a left join dim d using (instrument_key))
select n.*, coalesce(n.instrument_key in (s.atm_ce, s.atm_pe), false) as is_atm from named n left join
  (select * from strikes qualify row_number() over (partition by name order by underlying_key) = 1) s
  on s.name = n.ticker""",
    "oi_baseline_growth": f"""{_with(reset(240), BASELINE, recursive=True)} select a.instrument_key, a.b, a.last_oi,
  case when p.base_oi > 0 and p.locked_ms <= a.b * 500 then (a.last_oi - p.base_oi) / p.base_oi * 100
    else 0 end as oi_growth
from alerts a left join baseline p using (instrument_key)""",
    "historical_baseline": f"{_with(LOG)} select * from history",
    "strike_registry": f"""{_with(LOG)},
keyed as (select *, concat(ticker, '-', strike, '-', option_type) as reg_key from log),
{registered('keyed', 'seq')}
select reg_key, trade_date, seq, alert_count, cumulative_paise, minutes_active, first_gap, last_gap
from registered""",
    "stream_registry": f"""{_with(LOG)},
keyed as (select *, concat(ticker, '-', strike, '-', option_type) as reg_key from log),
{registered('keyed', 'seq')}
select reg_key, trade_date, seq, alert_count, cumulative_paise, minutes_active, first_gap, last_gap
from registered""",
    "conviction_day": f"""{_with(SIGNALS, registered('signals', 'seq'), scored(DAY_SCORE))}
select reg_key, seq, conviction, conviction_label from scored""",
    "conviction_flow": f"""{_with(SIGNALS, registered('signals', 'seq'), scored(FLOW_SCORE))}
select reg_key, seq, conviction, conviction_label from scored""",
    "high_conviction_feed": f"""{_with(SIGNALS, registered('signals', 'seq'), scored(DAY_SCORE))}
select seq, concat('HIGH CONVICTION | ', ticker, ' ', strike, ' ', option_type, ' | Score: ', conviction, ' | OI+',
  printf('%.0f', oi_growth), '% | Alerts today: ', alert_count, ' | Active: ', printf('%.0f', minutes_active), 'min | ₹',
  printf('%.1f', cumulative_paise / 100 / 100000), 'L total | ', {clock('alert_ms', '%H:%M')}) as line
from scored where conviction_label = 'HIGH_CONVICTION'""",
    "scan_arrival": f"""{_with(STRIKES, dim(ROWWISE, ACTIVE_ONLY), reset(10, 'arrival_ms'), BASELINE,
  NAMED.format(found='alerts'), recursive=True)}
select n.instrument_key, n.b, {clock('n.b * 500', '%H:%M:%S')} as timestamp, n.ticker, n.strike, n.option_type,
  n.paise / 100 as value, n.last_price as ltp, n.last_oi as oi, {MOMENTUM} as category,
  coalesce(n.instrument_key in (s.atm_ce, s.atm_pe), false) as is_atm
from grown n left join (select * from strikes
  qualify row_number() over (partition by name order by underlying_key) = 1) s on s.name = n.ticker""",
    "scan_bars": _bars_records(True),
    "scan_reset": f"""{_with(STRIKES, dim(ROWWISE, ACTIVE_ONLY), reset(240), BASELINE, NAMED.format(found='alerts'),
  LOG, registered('grown', 'instrument_key'), scored(DAY_SCORE), recursive=True)}
select instrument_key, b, {clock('last_ms', DAY_TIME)} as timestamp, {MOVES}, {CONVICTION},
  cast(printf('%.0f', (paise / 100 / n)::double) as double) as avg_trade_size, cumulative_paise / 100 as cumulative_value
from (select *, {flow_category('EXITING')} as category from scored)""",
    "scan_sliding": f"""{_with(MASTER, dim(CALLS_FIRST), SLIDING + BASE_VOL, BASELINE, NAMED.format(found='flow'),
  LOG, registered('grown', 'instrument_key'), scored(FLOW_SCORE))}
select instrument_key, b, {clock('last_ms', DAY_TIME)} as timestamp, {MOVES}, {CONVICTION}, side,
  cast(printf('%.1f', (acceleration)::double) as double) as acceleration, cast(printf('%.1f', (delta_pct)::double) as double) as delta_pct
from (select *, side as category from scored)""",
    "alert_json_roundtrip": _bars_records(False),
    "heat_board": f"""{_with(LOG)},
heat as (
  select ticker, sum((100 + least(paise / 10000000, 50))
    * pow(0.98::double, ((select max(alert_ms) from log) - alert_ms) // 60000)) as heat, count(*) as alerts
  from log group by ticker)
select ticker, cast(floor(heat * 100) as bigint) as heat_100, alerts, heat > 200 as is_hot from heat""",
    "recent_alerts": f"""{_with(LOG)} select ticker, side, row_no, seq, timestamp, strike, paise, paise > 50000000 as is_whale
from (select *, row_number() over (partition by ticker, side order by alert_ms desc, seq desc) as row_no
  from (select *, case when upper(option_type) = 'CE' then 'ce' else 'pe' end as side from log))
where row_no <= 50""",
    "movers": f"""{_with(MASTER)},
lines as (
  select s_suppkey as line_no, case when s_suppkey % 10 = 0 then '---- header ----'
    when s_suppkey % 10 = 1 then concat(s_name, ' | n/a | 1.0') when s_suppkey % 10 = 2 then concat(s_name, ' | 3.0%')
    else concat(case when s_suppkey % 4 = 0 then concat('SYMBrand#', cast(s_suppkey % 25 as varchar)) else s_name end,
      '  |  ', cast(s_nationkey - 12 as varchar), '.25%  |  ', cast(s_suppkey as varchar), '.5') end as line
  from supplier),
parsed as (
  select line_no, trim(split_part(line, '|', 1)) as symbol,
    try_cast(trim(replace(split_part(line, '|', 2), '%', '')) as double) as pct_change,
    try_cast(trim(split_part(line, '|', 3)) as double) as change
  from lines where len(string_split(line, '|')) >= 3)
select coalesce(n.name, p.symbol) as name, p.symbol, p.pct_change, p.change, p.line_no
from parsed p left join (select asset_symbol, min(name) as name from companies group by 1) n on n.asset_symbol = p.symbol
where p.pct_change is not null and p.change is not null""",
    "stream_dedup": FOLD,
    "stream_burst": STREAM_BURST,
    "stream_reset": f"{_with(reset(240), recursive=True)} select {ALERT_FIELDS} from alerts",
    "stream_bars": f"{_with(reset(None), recursive=True)} select {ALERT_FIELDS} from alerts",
    "stream_oi_latch": f"""{_with(TICKS, BASELINE)} select instrument_key, date '1970-01-01' as trade_date, base_oi,
  locked_ms from baseline""",
    "stream_heat": f"""{_with(LOG, recursive=True)},
feed as (
  select ticker, alert_ms // 60000 as tick, 100 + least(paise / 10000000, 50) as points,
    row_number() over (partition by ticker order by alert_ms, seq) as i from log),
steps as (
  select ticker, i, tick, points as heat from feed where i = 1
  union all
  select f.ticker, f.i, f.tick, f.points + case when s.heat * pow(0.98::double, f.tick - s.tick) >= 1
    then s.heat * pow(0.98::double, f.tick - s.tick) else 0 end
  from steps s join feed f on f.ticker = s.ticker and f.i = s.i + 1)
select ticker, tick as at_tick, round(heat, 6) as heat from steps
qualify row_number() over (partition by ticker order by i desc) = 1""",
}
ORACLES["stream_registry_late"] = ORACLES["stream_registry"]
ORACLES["stream_oi_latch_late"] = ORACLES["stream_oi_latch"]

# The scans over the noisy feed: its trades are those that the accept rule takes.
FOLD_TRADES = FOLD.removeprefix("with recursive ").replace("steps", "taken_steps")
FOLD_TRADES = FOLD_TRADES.replace("\nselect f.instrument_key", ",\ntrades as (\nselect f.instrument_key") + ")"
for _name in ("scan_arrival", "scan_bars", "scan_reset", "scan_sliding"):
    _sql = ORACLES[_name].replace(TRADES, FOLD_TRADES)
    ORACLES[f"{_name}_fold"] = _sql if _sql.startswith("with recursive ") else _sql.replace("with ", "with recursive ", 1)
