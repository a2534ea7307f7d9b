"""Registered queries of the live scanners, with their SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from optionflow.operators import board, chain as chains, records, registry, trades as trade_ops
from optionflow.plans import profiles as P, scan
from optionflow.sources import readers, sinks, versions
from optionflow.streaming import board as live_board, live, scanner

from . import oracles, proxy, queries as base, streams

LIVE: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def live_query(sql: str):
    """Register a stream with its SQL."""

    def add(f):
        def run(spark, d):
            live.use_rocksdb(spark)
            return f(spark, d)

        LIVE[f.__name__], SQL[f.__name__] = run, sql
        return f

    return add


def _feed(spark, d):
    return streams.with_closing_tick(proxy.ticks(spark, d))


# ---------------------------------------------------------------- two horizons, latched open interest


@live_query(oracles.ORACLES["burst_acceleration"])
def stream_acceleration(spark, d):
    """The burst windows with their 15-minute baseline, from ticks."""

    def build(ticks):
        return scan.categorise(scanner.detect(scanner.trades(ticks), P.SLIDING), P.SLIDING)

    out = streams.run(spark, _feed(spark, d), build)
    return out.select("instrument_key", "b", "paise", "vol", "base_vol", "acceleration", "delta_pct", "side")


@live_query(oracles.ORACLES["oi_baseline_growth"])
def stream_oi_growth(spark, d):
    """Alerts see the open interest that was latched as of their instant; the first come before the lock time."""

    def build(ticks):
        return scanner.with_oi_growth(scanner.detect(scanner.trades(ticks), base.SLOW_RESET), ticks, base.LOCK)

    return streams.run(spark, _feed(spark, d), build).select("instrument_key", "b", "last_oi", "oi_growth")


# ---------------------------------------------------------------- whole scans against a history that changes

LATENESS_MS = 5000

#: History by version, in SQL: the log of the feed's instruments without one day, another one each time.
VERSIONS = """
option_log as (
  select strftime(e.ts, '%d/%m/%Y') as day, cast(round(e.value * 100) as bigint) * (1 + e.event_id % 400) as paise,
    concat(coalesce(d.name, concat('NSE_FO|', cast(e.user_id as varchar))), '-', coalesce(cast(d.strike as varchar), ''), '-',
      coalesce(d.type, '')) as reg_key
  from events e left join dim d on d.instrument_key = concat('NSE_FO|', cast(e.user_id as varchar))),
versions as (
  select v as history_version, reg_key, count(*) / count(distinct day) as avg_alerts_per_day,
    cast(sum(paise) as bigint) / count(distinct day) as avg_paise_per_day, count(distinct day) as trading_days
  from option_log, range(4) r(v) where day <> strftime(date '2024-01-30' - cast(v as integer), '%d/%m/%Y') group by all),
stretches as (
  select v as history_version, max(case when seq * 4 // (top + 2) <= v then ltt end) - {late} as until_ms
  from ticks, (select max(seq) as top from ticks), range(3) r(v) group by v
  union all select 3, 1000000000000000),
"""


def _versioned(name: str, score: str) -> str:
    """A scan's SQL with the history version that was current when the alert became final."""
    sql = oracles.ORACLES[name].replace(oracles.LOG + ",", VERSIONS.replace("{late}", str(LATENESS_MS)).rstrip().rstrip(",") + ",")
    scored = f"""
scored as (
  select *, {oracles.LABEL} from (
    select x.*, {score} from (
      select r.*, (select min(s.history_version) from stretches s where r.alert_ms <= s.until_ms) as history_version from registered r) x
    left join versions h using (reg_key, history_version)))"""
    sql = sql.replace(oracles.scored(score), scored)
    head, result = sql.rsplit("select instrument_key, b,", 1)
    return f"{head}select history_version::bigint as history_version, instrument_key, b,{result}"


def _scan(spark, d, profile):
    companies = base._companies(spark, d)
    sliding = profile.name == "sliding"
    keys = None if sliding else chains.active_keys(base._strikes(spark, d, companies))
    dim = base.settled(chains.instrument_dim(companies, keys, calls_first=sliding))
    log = base.settled(proxy.option_log(spark, d, dim))

    def history(folder, stretch):
        versions.write(registry.history(log, base.RUN_DATE - timedelta(days=stretch)), f"{folder}/history", stretch)

    def finish(scored):
        return records.alert_records(scored, profile, keep=("instrument_key", "b"))

    def sink(folder):
        return scanner.scored_writer(folder, f"{folder}/history", profile, finish)

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in records.schemas.ALERT_MESSAGE[profile.name]]
    added = ", ".join(["instrument_key string", "b bigint", *fields, "history_version bigint"])
    out = streams.run(
        spark, _feed(spark, d), lambda t: scanner.scan_stream(t, dim, profile, base.LOCK), sink=sink, before=history, added=added
    )
    return out.drop("batch_id")


@live_query(_versioned("scan_reset", oracles.DAY_SCORE))
def stream_scan_reset(spark, d):
    """The reset scanner's records, each batch scored against the history that is current."""
    return _scan(spark, d, base.SLOW_RESET)


@live_query(_versioned("scan_sliding", oracles.FLOW_SCORE))
def stream_scan_sliding(spark, d):
    return _scan(spark, d, P.SLIDING)


# ---------------------------------------------------------------- the live board


def _log(spark, d):
    """The alert log and one more alert, of a ticker of its own, that moves the watermark past the end."""
    log = proxy.alert_log(spark, d)
    last = log.agg((F.max("seq") + 1).alias("seq"), (F.max("alert_ms") + 48 * streams.CLOSING_MS).alias("alert_ms"))
    fixed = {"timestamp": F.lit(""), "ticker": F.lit(streams.CLOSING_KEY), "strike": F.lit(""), "option_type": F.lit("CE")}
    return log.unionByName(last.withColumns({**fixed, "paise": F.lit(1).cast("bigint")}))


HOT = f"""{oracles._with(oracles.LOG, recursive=True)},
feed as (
  select *, row_number() over (partition by ticker order by tick) as i from (
    select ticker, alert_ms // 60000 as tick, sum(100 + least(paise / 10000000, 50)) as points from log group by all)),
steps as (
  select ticker, i, tick, points as heat from feed where i = 1
  union all
  select f.ticker, f.i, f.tick, f.points + case when s.heat * pow(0.98::double, f.tick - s.tick) >= 1
    then s.heat * pow(0.98::double, f.tick - s.tick) else 0 end
  from steps s join feed f on f.ticker = s.ticker and f.i = s.i + 1),
cooling as (
  select *, case when heat > 200 then tick + ceil(ln(200 / heat) / ln(0.98))::bigint end as cold,
    lead(tick) over (partition by ticker order by i) as following
  from steps),
entered as (select *, lag(cold) over (partition by ticker order by i) as before from cooling)
select ticker, tick, true as is_hot from entered where heat > 200 and (before is null or before < tick)
union all
select ticker, cold, false from entered where cold is not null and (following is null or cold < following)"""


@live_query(HOT)
def stream_hot_changes(spark, d):
    """Minutes at which tickers turn hot and cold; nothing arrives when they cool."""
    out = streams.run(spark, _log(spark, d), lambda a: live_board.hot_changes(a, base.MINUTE_MS))
    return out.filter(F.col("ticker") != streams.CLOSING_KEY).select("ticker", "tick", "is_hot")


@live_query(oracles.ORACLES["recent_alerts"])
def stream_recent(spark, d):
    """The newest alerts of each side; the log arrives shuffled."""
    log = proxy.alert_log(spark, d).withColumnRenamed("seq", "event_seq")
    rows = log.withColumn("seq", F.pmod(F.xxhash64("event_seq"), F.lit(1_000_000)))

    def build(alerts):
        return live_board.newest(alerts.drop("seq").withColumnRenamed("event_seq", "seq"))

    out = streams.run(spark, rows, build, mode="update")
    last = out.groupBy("ticker", "side").agg(F.max("batch_id").alias("batch_id"))
    kept = out.join(last, ["ticker", "side", "batch_id"])
    return kept.withColumn("is_whale", F.col("paise") > board.WHALE_PAISE).select(
        "ticker", "side", "row_no", "seq", "timestamp", "strike", "paise", "is_whale"
    )


@live_query(
    f"""with latest as ({oracles.ORACLES['stream_heat']}),
now as (
  select ticker, round(heat * pow(0.98::double, (select max(at_tick) from latest) - at_tick), 5) as heat
  from latest)
select row_number() over (order by case when heat >= 1 then heat else 0 end desc, ticker)::int as rank, ticker,
  case when heat >= 1 then heat else 0 end as heat from now""".replace("with latest as (with recursive", "with recursive latest as (with recursive")
)
def stream_leaderboard(spark, d):
    """The board from a table that every batch updates; each batch comes twice."""
    folders = []

    def sink(folder):
        folders.append(folder)
        write = sinks.upsert(f"{folder}/board", ["ticker"])

        def twice(batch, batch_id):
            write(batch, batch_id)
            write(batch, batch_id)

        return twice

    streams.run(spark, proxy.alert_log(spark, d), lambda a: live.heat_scores(a, base.MINUTE_MS), mode="update", sink=sink)
    scores = sinks.upserted(spark, f"{folders[-1]}/board")
    hot = board.ranked(scores, scores.agg(F.max("at_tick")).scalar())
    return hot.withColumn("heat", F.round("heat", 5))


# ---------------------------------------------------------------- malformed and late input

CUT = 40


@live_query(
    """with lines as (select event_id as seq, event_id * 4 // ((select max(event_id) from events) + 1) as batch_id from events),
counts as (select batch_id, count(*) filter (where seq % 50 <> 1) as good, count(*) filter (where seq % 50 = 1) as bad from lines group by 1)
select l.batch_id, l.seq % 50 = 1 as dead, count(*) as rows, any_value(c.good) as good, any_value(c.bad) as bad,
  cast(sum(case when l.seq % 50 <> 1 then l.seq end) as bigint) as seq_sum
from lines l join counts c using (batch_id) group by 1, 2"""
)
def stream_quarantine(spark, d):
    """Lines that cannot be read go to a table of their own; each batch counts both kinds while it writes."""
    folders = []
    line = F.to_json(F.struct("seq", "arrival_ms", "feeds"))
    rows = proxy.messages(spark, d).select(
        "seq", F.when(F.col("seq") % 50 == 1, F.substring(line, 1, CUT)).otherwise(line).alias("value")
    )

    def sink(folder):
        folders.append(folder)
        return sinks.decoded_or_dead(folder, readers.marked_tick_messages)

    streams.run(spark, rows, lambda lines: lines.select("value"), sink=sink)
    lines = spark.read.parquet(f"{folders[-1]}/lines")
    counts = spark.read.parquet(f"{folders[-1]}/counts")
    found = lines.groupBy("batch_id", "dead").agg(F.count(F.lit(1)).alias("rows"), F.sum("seq").alias("seq_sum"))
    joined = found.join(counts, "batch_id")
    return joined.select(F.col("batch_id").cast("bigint").alias("batch_id"), F.col("dead").cast("boolean").alias("dead"), "rows", "good", "bad", "seq_sum")


LATE = oracles.buckets().replace(
    "from trades group by 1, 2",
    f"""from (select *, case when seq % 97 = 0 then 3 else seq * 4 // (top + 1) end as stretch
    from trades, (select max(seq) as top from trades)) t
  where stretch < 3 or (ltt // 500 + 1) * 500 > (
    select max(ltt) - {LATENESS_MS} from trades, (select max(seq) as top from trades) where seq % 97 <> 0 and seq * 4 // (top + 1) < 3)
  group by 1, 2""",
)


@live_query(f"{oracles._with(LATE)} select * from buckets")
def stream_late(spark, d):
    """Every 97th trade comes with the last stretch; those that are behind the watermark, five seconds late, do not count."""
    trades = trade_ops.trades(proxy.ticks(spark, d), assume_monotone=True)
    top = trades.agg(F.max("seq")).scalar()
    event = trades.withColumn("event_seq", F.col("seq"))
    rows = event.withColumn("seq", F.when(F.col("event_seq") % 97 == 0, top).otherwise(F.col("event_seq")))
    closing = trades.agg(
        F.max("seq").alias("seq"), F.max("seq").alias("event_seq"), (F.max("ltt") + streams.CLOSING_MS).alias("ltt")
    )
    values = {
        "instrument_key": F.lit(streams.CLOSING_KEY), "arrival_ms": F.col("ltt"), "price": F.lit(0.0), "side": F.lit("BUY"),
        **{c: F.lit(0).cast("bigint") for c in ("qty", "paise", "oi")},
    }

    def build(t):
        return trade_ops.bucket_stream(t.drop("seq").withColumnRenamed("event_seq", "seq"), lateness=f"{LATENESS_MS} milliseconds")

    out = streams.run(spark, rows.unionByName(closing.withColumns(values)), build)
    return out.filter(F.col("instrument_key") != streams.CLOSING_KEY).drop("batch_id")
