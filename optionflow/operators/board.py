"""Leaderboard: decayed heat, recent alerts per side, movers report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import money, text
from . import ordered

# Fixed values.
ALERT_POINTS = 100.0
VALUE_POINTS_MAX = 50.0
VALUE_POINTS_PAISE = 100_000 * 100
DECAY = 0.98
HOT_SCORE = 200.0
WHALE_PAISE = 500_000 * 100
ROWS_KEPT = 50


def alert_points(paise: Column) -> Column:
    return F.lit(ALERT_POINTS) + F.least(paise / F.lit(VALUE_POINTS_PAISE), F.lit(VALUE_POINTS_MAX))


def heat(alerts: DataFrame, at_ms: Column | int, tick_ms: int = 1000) -> DataFrame:
    """Score per ticker at one instant: each alert's points, decayed once per elapsed tick.

    `at_ms` may be a scalar subquery. Alerts after it do not count.
    """
    at = at_ms if isinstance(at_ms, Column) else F.lit(at_ms)
    age = F.floor((at - F.col("alert_ms")) / tick_ms)
    return (
        alerts.filter(F.col("alert_ms") <= at)
        .groupBy("ticker")
        .agg(
            F.sum(alert_points(F.col("paise")) * F.pow(F.lit(DECAY), age)).alias("heat"),
            F.count(F.lit(1)).alias("alerts"),
        )
        .withColumn("is_hot", F.col("heat") > HOT_SCORE)
    )


def leaderboard(heat: DataFrame) -> DataFrame:
    return heat.orderBy(F.desc("heat"), "ticker")


def board_side(option_type: Column) -> Column:
    return F.when(F.upper(option_type) == "CE", "ce").otherwise("pe")


def recent(alerts: DataFrame, n: int = ROWS_KEPT, tie: str = "seq") -> DataFrame:
    """The newest n alerts per ticker and side, numbered from the newest."""
    sided = alerts.withColumn("side", board_side(F.col("option_type")))
    rows = ordered.first_rows(sided, ["ticker", "side"], [F.desc("alert_ms"), F.desc(tie)], n)
    return rows.withColumns(
        {"is_whale": F.col("paise") > WHALE_PAISE, "value_text": money.lakh_text(F.col("paise"))}
    )


def movers(lines: DataFrame, chain: DataFrame) -> DataFrame:
    """`SYMBOL | 2.88% | 27.30` lines -> named rows; malformed lines are skipped."""
    part = F.split(F.trim("line"), r"\|")
    cell = lambda i: F.trim(F.get(part, F.lit(i)))
    parsed = (
        lines.filter(F.size(part) >= 3)
        .select(
            "line_no",
            cell(0).alias("symbol"),
            text.number(F.trim(F.replace(cell(1), F.lit("%"), F.lit("")))).alias("pct_change"),
            text.number(cell(2)).alias("change"),
        )
        .filter(F.col("pct_change").isNotNull() & F.col("change").isNotNull())
    )
    # The chain is kept in name order, so the first row of a symbol has its least name.
    names = (
        chain.filter(F.col("asset_symbol").isNotNull())
        .groupBy(F.col("asset_symbol").alias("symbol"))
        .agg(F.min("name").alias("name"))
    )
    return parsed.join(names, "symbol", "left").select(
        F.coalesce("name", "symbol").alias("name"), "symbol", "pct_change", "change", "line_no"
    )


def sorted_movers(movers: DataFrame) -> DataFrame:
    return movers.orderBy(F.desc("pct_change"), "line_no")


def movers_document(movers: DataFrame) -> DataFrame:
    """The report as the lines of one JSON document: stocks in report order, their count, and 0 failed.

    Nothing is gathered: the last stock, which has no comma behind it, and the count are aggregates.
    """
    place = [F.desc("pct_change"), "line_no"]
    last = movers.agg(F.max(F.struct((-F.col("pct_change")).alias("p"), F.col("line_no").alias("l")))).scalar()
    stock = F.to_json(F.struct("name", "symbol", "pct_change", "change"))
    is_last = F.struct((-F.col("pct_change")).alias("p"), F.col("line_no").alias("l")) == last
    stocks = movers.select(F.lit(1).alias("part"), "pct_change", "line_no", F.when(is_last, stock).otherwise(F.concat(stock, F.lit(","))).alias("value"))
    end = movers.agg(F.count(F.lit(1)).alias("n"))
    tail = end.select(F.lit(2).alias("part"), F.format_string('],"count":%d,"failed":0}', "n").alias("value"))
    head = end.select(F.lit(0).alias("part"), F.lit('{"stocks":[').alias("value"))
    lines = stocks.unionByName(head, allowMissingColumns=True).unionByName(tail, allowMissingColumns=True)
    return lines.orderBy("part", *place).select("value")


def ranked(scores: DataFrame, at_tick: Column | int, n: int = 1000) -> DataFrame:
    """The n hottest tickers at a tick, numbered: (rank, ticker, heat). `scores` has each ticker's heat as of `at_tick`.

    The sort stops at n rows per task, so what one task numbers does not grow with the tickers.
    """
    left = F.col("heat") * F.pow(F.lit(DECAY), at_tick - F.col("at_tick"))
    now = scores.select("ticker", F.when(left >= 1, left).otherwise(0.0).alias("heat"))
    best = now.orderBy(F.desc("heat"), "ticker").limit(n)
    return best.select(F.row_number().over(W.orderBy(F.desc("heat"), "ticker")).alias("rank"), "ticker", "heat")
