"""Registered queries that write with the library's sinks and read back with its readers."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from optionflow.operators import board, chain as chains, records, registry, trades as trade_ops
from optionflow.plans import profiles as P, scan
from optionflow.sources import readers, sinks, versions
from optionflow.streaming import runs

from . import oracles, proxy, queries as base

STORED: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def stored(sql: str):
    """Register a query with its SQL."""

    def add(f):
        STORED[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


@stored(oracles.ORACLES["option_chain"])
def chain_csv(spark, d):
    folder = runs.work_folder(spark)
    sinks.write_csv(chains.option_chain(proxy.master(spark, d), base.EXPIRY), folder)
    return readers.option_chain(spark, folder)


@stored(oracles.ORACLES["directional_strikes"])
def strike_table_csv(spark, d):
    folder = runs.work_folder(spark)
    sinks.write_csv(base._strikes(spark, d), folder)
    return readers.strike_table(spark, folder)


@stored(
    f"""{oracles._with(oracles.MASTER)},
first as (select name as value, min(struct_pack(name, asset_symbol, expiry, strike_price, lot_size, tick_size, underlying_key)) as first_at
  from companies group by name)
select value, row_number() over (order by first_at) - 1 as place from first"""
)
def chain_list_text(spark, d):
    """The files hold the values in order, numbered by file and line."""
    folder = runs.work_folder(spark)
    sinks.write_list(base._companies(spark, d), "name", folder)
    read = spark.read.text(folder).select("value", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line"))
    before = base.ordered.running(read, [], ["file", "line"], F.col("file"), sums={"n": F.lit(1).cast("bigint")})
    return before.select("value", (F.col("n") - 1).alias("place"))


@stored(oracles.ORACLES["spot_snapshot"])
def spot_snapshot_table(spark, d):
    folder = runs.work_folder(spark)
    sinks.write_snapshot(chains.spot_prices(proxy.quotes(spark, d)), folder)
    return spark.read.parquet(folder)


@stored(
    oracles.ORACLES["movers"].replace("p.change, p.line_no", "p.change"),
)
def movers_text(spark, d):
    folder = runs.work_folder(spark)
    proxy.movers_lines(spark, d).select(F.col("line").alias("value")).write.text(folder)
    found = board.movers(readers.movers_lines(spark, folder), base._companies(spark, d))
    return found.select("name", "symbol", "pct_change", "change")


@stored(f"select * from ({oracles.ORACLES['tick_messages']}) where seq % 50 <> 1")
def tick_messages_json(spark, d):
    """Every fiftieth line is cut short and goes to quarantine."""
    folder = runs.work_folder(spark)
    line = F.to_json(F.struct("seq", "arrival_ms", "feeds"))
    cut = F.when(F.col("seq") % 50 == 1, F.substring(line, 1, 40)).otherwise(line)
    proxy.messages(spark, d).select(cut.alias("value")).write.text(folder)
    good, _ = readers.decode_tick_messages(spark.read.text(folder))
    return trade_ops.explode_messages(good)


def _records(spark, d):
    """The alert log as records of the scoring profile, with their trade date."""
    log = proxy.alert_log(spark, d)
    known = {
        "value": F.col("paise") / 100,
        "ltp": F.lit(1.0),
        "oi": F.col("seq"),
        "trade_date": F.to_date(F.substring("timestamp", 1, 10), "dd/MM/yyyy"),
    }
    rows = log.withColumns(known)
    fields = [f for f in records.schemas.ALERT_MESSAGE[P.RESET.name]]
    have = set(rows.columns)
    return rows.select(
        "trade_date",
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields],
        (F.col("seq") % 3).alias("part"),
    )


def _delivered(spark, d) -> str:
    """Log and queue after three batches, one of which came twice."""
    folder = runs.work_folder(spark)
    rows = _records(spark, d)
    write = sinks.log_and_publish(f"{folder}/log", f"{folder}/queue", P.RESET)
    for batch in (0, 1, 2, 1):
        write(rows.filter(F.col("part") == batch).drop("part"), batch)
    return folder


@stored(f"{oracles._with(oracles.LOG)} select * from history")
def log_history(spark, d):
    """History of the log that the sink wrote."""
    log = readers.alert_log(spark, f"{_delivered(spark, d)}/log")
    return registry.history(records.normal_form(log, P.RESET), base.RUN_DATE)


@stored(
    f"""{oracles._with(oracles.SIGNALS, oracles.registered('signals', 'seq'), oracles.scored(oracles.DAY_SCORE))}
select reg_key, seq, conviction, conviction_label from scored"""
)
def log_history_score(spark, d):
    """The scores of the day against the history read back from the log; one row per key, so no alert doubles."""
    log = readers.alert_log(spark, f"{_delivered(spark, d)}/log")
    history = registry.history(records.normal_form(log, P.RESET), base.RUN_DATE)
    return scan.score(base._registered(spark, d), history, P.RESET).select("reg_key", "seq", "conviction", "conviction_label")


@stored(
    f"""{oracles._with(oracles.LOG)}
select ticker, cast(floor(round(sum((100 + least(paise / 10000000, 50))
    * pow(0.98::double, ((select max(alert_ms // 1000 * 1000) from log) - alert_ms // 1000 * 1000) // 60000)), 6) * 100) as bigint) as heat_100,
  count(*) as alerts from log group by ticker"""
)
def messages_heat(spark, d):
    """The board from the messages that the sink published. Their time text has whole seconds."""
    lines = spark.read.text(f"{_delivered(spark, d)}/queue").select("value")
    good, _ = records.from_messages(lines, P.RESET)
    alerts = records.normal_form(good, P.RESET, numbered=False)
    hot = board.heat(alerts, alerts.agg(F.max("alert_ms")).scalar(), base.MINUTE_MS)
    return hot.select("ticker", F.floor(F.round("heat", 6) * 100).cast("bigint").alias("heat_100"), "alerts")


NULL_KEYS = f"""{oracles._with(oracles.TRADES)} select * replace
  (nullif(instrument_key, (select min(instrument_key) from ticks)) as instrument_key) from trades"""


def _null_key(spark, d):
    """The feed with one instrument's key missing."""
    rows = proxy.ticks(spark, d)
    key = F.col("instrument_key")
    return rows.withColumn("instrument_key", F.when(key != rows.agg(F.min("instrument_key")).scalar(), key))


@stored(NULL_KEYS)
def tick_trades_null_key_lag(spark, d):
    return trade_ops.trades(_null_key(spark, d), assume_monotone=True)


@stored(NULL_KEYS)
def tick_trades_null_key_fold(spark, d):
    return trade_ops.trades(_null_key(spark, d))


# ---------------------------------------------------------------- the master as one JSON array

ODD_TEXT = '}{ "\\], [\\\\'
RANGE_BYTES, RANGES = 65_536, 512


def _range_bytes(size: int) -> int:
    """Bytes per range of a file: small ones, so that a small file has many, and wider ones where there would be more than `RANGES`."""
    return max(RANGE_BYTES, -(-size // RANGES))


@stored(
    f"""{oracles._with(oracles.MASTER)}
select row_number() over (order by seq, case instrument_type when 'CE' then 0 when 'FUT' then 1 else 2 end) - 1 as seq, segment, name,
  expiry_ms as expiry, instrument_type, asset_symbol, instrument_key, strike_price, lot_size, tick_size, underlying_key,
  concat('{ODD_TEXT}', cast(seq as varchar)) as trading_symbol
from master"""
)
def master_json(spark, d):
    """The instrument master written as one JSON array, with braces, quotes and backslashes in strings, and read in many ranges."""
    folder = runs.work_folder(spark)
    master = proxy.master(spark, d).withColumn("trading_symbol", F.concat(F.lit(ODD_TEXT), F.col("seq").cast("string")))
    ends = master.agg(F.min(F.struct("seq", "instrument_type")).alias("a"), F.max(F.struct("seq", "instrument_type")).alias("b"))
    here = F.struct("seq", "instrument_type")
    row = F.to_json(F.struct(*[c for c in master.columns if c != "seq"]))
    line = F.concat(
        F.when(here == ends.select("a").scalar(), "[").otherwise(","), row, F.when(here == ends.select("b").scalar(), "]").otherwise("")
    )
    # the array is one file, so one task writes it
    ordered = master.select("seq", "instrument_type", line.alias("value")).repartition(1).sortWithinPartitions("seq", "instrument_type")
    ordered.select("value").write.text(folder)
    sizes = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    whole = spark.read.format("binaryFile").load(folder).agg(F.sum("length")).first()[0]
    try:
        for c in sizes:
            spark.conf.set(c, str(_range_bytes(whole or 0)))
        found = base.settled(readers.instrument_master(spark, folder))
    finally:
        for c, size in sizes.items():
            spark.conf.set(c, size)
    return found.select(
        "seq", "segment", "name", "expiry", "instrument_type", "asset_symbol", "instrument_key", "strike_price", "lot_size",
        "tick_size", "underlying_key", "trading_symbol",
    )


# ---------------------------------------------------------------- strike tables that change

#: Versions of the spot prices, as shares of the lowest and highest strike, and the instants from which they hold.
SPOTS = {0: (3, 2), 900_000: (2, 3), 1_700_000: (4, 1)}


def _atm_versions_sql() -> str:
    one = oracles._with(oracles.STRIKES)
    tables = []
    for start, (low, high) in SPOTS.items():
        sql = one.replace("min(strike_price) * 3 + max(strike_price) * 2", f"min(strike_price) * {low} + max(strike_price) * {high}")
        tables.append(
            f"select {start} as valid_from, name, atm_ce, atm_pe from ({sql} select * from strikes "
            "qualify row_number() over (partition by name order by underlying_key) = 1)"
        )
    starts = ", ".join(f"({start})" for start in SPOTS)
    return f"""{oracles._with(oracles.MASTER, oracles.dim(oracles.ROWWISE), oracles.reset(10, 'arrival_ms'), recursive=True)},
tables as ({" union all ".join(tables)}),
starts as (select s::bigint as valid_from from (values {starts}) v(s)),
named as (
  select a.instrument_key, a.b, a.b * 500 as alert_ms, coalesce(d.name, a.instrument_key) as ticker
  from alerts a left join dim d using (instrument_key)),
stamped as (select n.*, s.valid_from from named n asof left join starts s on n.alert_ms >= s.valid_from)
select x.instrument_key, x.b, x.ticker, x.valid_from as version, coalesce(x.instrument_key in (t.atm_ce, t.atm_pe), false) as is_atm
from stamped x left join tables t on t.valid_from = x.valid_from and t.name = x.ticker"""


@stored(_atm_versions_sql())
def atm_flag_versions(spark, d):
    """Alerts flagged by the strike table in force at their instant, over three versions."""
    folder = runs.work_folder(spark)
    companies = base.settled(base._companies(spark, d))
    level = proxy.master(spark, d).groupBy("underlying_key").agg(F.min("strike_price").alias("low"), F.max("strike_price").alias("high"))
    under = F.col("underlying_key")
    for start, (low, high) in SPOTS.items():
        price = F.when(under == "NSE_EQ|Brand#5", F.lit(None)).when(under == "NSE_EQ|Brand#6", 0.0)
        quotes = level.select(under, price.otherwise((F.col("low") * low + F.col("high") * high) / 5).alias("last_price"), F.lit(1).cast("bigint").alias("quoted_ms"))
        versions.write(chains.directional_strikes(companies, chains.spot_prices(quotes)), folder, start)
    found = scan.detect(base._trades(spark, d), P.ARRIVAL)
    named = registry.with_instrument(found, chains.instrument_dim(companies))
    flagged = registry.with_atm_versions(named, versions.every(spark, folder), versions.intervals(spark, folder))
    return flagged.select("instrument_key", "b", "ticker", "version", "is_atm")


# ---------------------------------------------------------------- one log of several profiles


@stored(
    f"""{oracles._with(oracles.LOG)}
select cast(seq % 3 as bigint) as batch_id, trade_date, timestamp, ticker, strike, option_type, paise / 100 as value, seq as oi,
  case when seq % 3 = 1 then case when seq % 2 = 0 then 'BUY_SCRAPE' else 'SELL_SCRAPE' end end as side,
  case when seq % 3 = 1 then cast(seq % 7 as double) end as acceleration, case when seq % 3 = 1 then cast(seq % 101 as double) end as delta_pct
from log"""
)
def log_mixed_profiles(spark, d):
    """A 16-column profile and a 19-column one append to one table; one batch comes twice."""
    name = f"alerts_{uuid.uuid4().hex}"
    sinks.create_alert_table(spark, name, P.RESET.name, runs.work_folder(spark))
    sinks.create_alert_table(spark, name, P.SLIDING.name, runs.work_folder(spark))  # there already: stays as it is
    rows = _records(spark, d)
    seq = F.col("oi")
    flow = {
        "side": F.when(seq % 2 == 0, "BUY_SCRAPE").otherwise("SELL_SCRAPE"),
        "acceleration": (seq % 7).cast("double"),
        "delta_pct": (seq % 101).cast("double"),
    }
    for batch in (0, 1, 2, 1):
        profile = P.SLIDING if batch == 1 else P.RESET
        some = rows.filter(F.col("part") == batch).drop("part")
        some = some.withColumns(flow) if batch == 1 else some
        sinks.append_to_table(spark, name, records.log_rows(some, profile, ("trade_date",)), batch)
    return spark.table(name).select(
        "batch_id", "trade_date", "timestamp", "ticker", "strike", "option_type", "value", "oi", "side", "acceleration", "delta_pct"
    )


# ---------------------------------------------------------------- documents and lists in order


@stored(
    f"""select name, symbol, pct_change, change, count(*) over () as count, 0::bigint as failed,
  row_number() over (order by pct_change desc, line_no) - 1 as place from ({oracles.ORACLES['movers']})"""
)
def movers_document(spark, d):
    """The report written as one JSON document and read back, with its count."""
    folder = runs.work_folder(spark)
    lines = board.movers_document(board.movers(proxy.movers_lines(spark, d), base._companies(spark, d)))
    lines.coalesce(1).write.text(folder)
    schema = "stocks array<struct<name string, symbol string, pct_change double, change double>>, count bigint, failed bigint"
    document = spark.read.schema(schema).json(folder, multiLine=True)
    return document.select("count", "failed", F.posexplode("stocks").alias("at", "s")).select(
        "s.*", "count", "failed", F.col("at").cast("bigint").alias("place")
    )
