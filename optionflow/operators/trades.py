"""Ticks -> trades -> half-second buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import classify, money
from ..workspace import spread
from . import folds, ordered

STEP_MS = 500
CHUNK_ROWS = 1 << 24

TRADE_COLUMNS = "instrument_key string, seq bigint, arrival_ms bigint, ltt bigint, ltp double, oi bigint, bid_p double, ask_p double, qty bigint"


def explode_messages(messages: DataFrame) -> DataFrame:
    """Feed messages -> one tick per instrument; other feed variants are left out."""
    feed = F.col("feed.first_level")
    return (
        messages.select("seq", "arrival_ms", F.explode("feeds").alias("instrument_key", "feed"))
        .filter(feed.isNotNull())
        .select(
            "instrument_key",
            "seq",
            "arrival_ms",
            feed["ltpc"]["ltt"].alias("ltt"),
            feed["ltpc"]["ltp"].alias("ltp"),
            feed["ltpc"]["ltq"].alias("ltq"),
            feed["vtt"].alias("vtt"),
            feed["oi"].alias("oi"),
            feed["first_depth"]["bid_p"].alias("bid_p"),
            feed["first_depth"]["ask_p"].alias("ask_p"),
        )
    )


def with_defaults(ticks: DataFrame) -> DataFrame:
    """Absent numbers read as 0, as in the feed's own encoding."""
    zero = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("ltt", "ltq", "vtt", "oi")}
    book = {c: F.coalesce(c, F.lit(0.0)) for c in ("bid_p", "ask_p")}
    return ticks.withColumns({**zero, **book, "arrival_ms": F.coalesce("arrival_ms", "ltt")})


def finish(accepted: DataFrame) -> DataFrame:
    return accepted.filter("qty > 0").select(
        "instrument_key",
        "seq",
        "arrival_ms",
        "ltt",
        F.col("ltp").alias("price"),
        "qty",
        money.to_paise(F.col("ltp"), F.col("qty")).alias("paise"),
        "oi",
        classify.trade_side(F.col("ltp"), F.col("bid_p"), F.col("ask_p")).alias("side"),
    )


def trades(ticks: DataFrame, assume_monotone: bool = False, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Trades from cumulative-volume ticks.

    A tick is accepted if its time or cumulative volume exceeds the last accepted tick's;
    its quantity is the volume difference (the tick's own quantity while the volume is 0)
    and only positive ones are trades. With `assume_monotone` (time and volume never fall
    along `seq`) the last accepted tick is the previous row and a lag does it.
    """
    ticks = with_defaults(ticks)
    if assume_monotone:
        return finish(_lag_difference(ticks, chunk_rows))
    return finish(_fold_difference(ticks, chunk_rows))


def _lag_difference(ticks: DataFrame, chunk_rows: int) -> DataFrame:
    state = ordered.running(
        ticks,
        ["instrument_key"],
        ["seq"],
        ordered.row_chunk(F.col("seq"), chunk_rows),
        previous={"last_ltt": F.col("ltt"), "last_vtt": F.col("vtt")},
    )
    ltt, vtt = (F.coalesce(c, F.lit(0)) for c in ("last_ltt", "last_vtt"))
    return state.filter((F.col("ltt") > ltt) | (F.col("vtt") > vtt)).withColumn(
        "qty", F.when(vtt > 0, F.col("vtt") - vtt).otherwise(F.col("ltq"))
    )


def _fold_difference(ticks: DataFrame, chunk_rows: int) -> DataFrame:
    """Exact for any feed. Three passes: a narrow one that reduces each chunk of a key to one
    row, a scan of those rows that gives each chunk its entry state, and the full one."""
    by = ["instrument_key", "chunk"]
    chunked = ticks.withColumn("chunk", ordered.row_chunk(F.col("seq"), chunk_rows))
    summaries = (
        spread(chunked.select(*by, "seq", "ltt", "vtt"), *by)
        .sortWithinPartitions(*by, "seq")
        .mapInPandas(
            folds.summarise_chunks,
            "instrument_key string, chunk bigint, max_ltt bigint, max_vtt bigint, ltt bigint, vtt bigint",
        )
    )
    entries = (
        summaries.repartition("instrument_key")
        .sortWithinPartitions(*by)
        .mapInPandas(folds.enter_chunks, "instrument_key string, chunk bigint, ltt bigint, vtt bigint")
    )
    rows = chunked.select(
        *by, "seq", "arrival_ms", "ltt", "ltp", "ltq", "vtt", "oi", "bid_p", "ask_p", F.lit(False).alias("is_entry")
    )
    zeros = {c: F.lit(0).cast("bigint") for c in ("seq", "arrival_ms", "ltq", "oi")}
    zeros |= {c: F.lit(0.0) for c in ("ltp", "bid_p", "ask_p")}
    marked = rows.unionByName(entries.withColumns({**zeros, "is_entry": F.lit(True)}))
    return (
        spread(marked, *by)
        .sortWithinPartitions(*by, F.desc("is_entry"), "seq")
        .mapInPandas(folds.difference_volume, TRADE_COLUMNS)
    )


def bucket_values() -> list[Column]:
    """What is kept of the trades of one instrument and check instant."""
    buy = F.when(F.col("side") == "BUY", F.col("qty")).otherwise(0)
    seq = F.col("seq")
    return [
        F.sum("paise").alias("paise"),
        F.sum("qty").alias("vol"),
        F.count(F.lit(1)).alias("n"),
        F.min_by("price", seq).alias("first_price"),
        F.max_by("price", seq).alias("last_price"),
        F.min_by("oi", seq).alias("first_oi"),
        F.max_by("oi", seq).alias("last_oi"),
        F.max_by("ltt", seq).alias("last_ms"),
        F.sum(buy).alias("buy"),
        F.sum(F.col("qty") - buy).alias("sell"),
    ]


def buckets(trades: DataFrame, clock: str = "ltt", step_ms: int = STEP_MS) -> DataFrame:
    """Trades reduced to one row per instrument and check instant.

    A trade at `clock` counts from check instant `b = floor(clock / step) + 1` on. The
    aggregation combines map-side, so a hot instrument costs at most one row per instant
    and map task.
    """
    instant = (F.floor(F.col(clock) / step_ms) + 1).cast("bigint")
    return trades.groupBy("instrument_key", instant.alias("b")).agg(*bucket_values())


def bucket_stream(
    trades: DataFrame, clock: str = "ltt", lateness: str = "5 seconds", step_ms: int = STEP_MS
) -> DataFrame:
    """`buckets` of a trade stream: each is emitted once, whole, when the watermark has passed
    it. Trades later than that are dropped."""
    timed = trades.withColumn("ts", F.timestamp_millis(clock)).withWatermark("ts", lateness)
    step = F.window("ts", f"{step_ms} milliseconds")
    instant = F.call_function("div", F.unix_millis("step.end"), F.lit(step_ms))
    found = timed.groupBy("instrument_key", step.alias("step")).agg(*bucket_values())
    return found.select("*", instant.alias("b")).drop("step")
