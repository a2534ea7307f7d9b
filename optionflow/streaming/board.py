"""The live board: tickers that turn hot and cold, and the newest alerts of each side."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import board
from .processors import joined, names

# Python workers get these classes with the task, so they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RECENT = "seq bigint, alert_ms bigint, timestamp string, strike string, paise bigint"


def ticks_until(score: float, bound: float, decay: float) -> int:
    """The fewest ticks after which a score has fallen to the bound."""
    n = max(0, math.ceil(math.log(bound / score) / math.log(decay)))
    while n and score * decay ** (n - 1) <= bound:
        n -= 1
    while score * decay**n > bound:
        n += 1
    return n


class HotState(StatefulProcessor):
    """A ticker's score, tick by tick; sends a row when it becomes hot and when it has cooled.

    Rows are the points of whole ticks, sent once the watermark has passed them. While a score is hot a timer waits for the
    end of the tick in which it cools; then one waits for the score to reach 0, and the state is cleared.
    """

    def __init__(self, decay: float, hot: float, tick_ms: int) -> None:
        self.decay, self.bound, self.tick_ms = decay, hot, tick_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.score = handle.getValueState("score", "heat double, at_tick bigint, hot boolean, timer bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        heat, at, hot, timer = self.score.get() if self.score.exists() else (0.0, 0, False, None)
        if timer is not None:
            self.handle.deleteTimer(timer)
        sent = []
        new = joined(rows, ["tick"])
        for tick, points in zip(new["tick"].tolist(), new["points"].tolist()):
            if hot and at + ticks_until(heat, self.bound, self.decay) < tick:
                hot = False
                sent.append((at + ticks_until(heat, self.bound, self.decay), False))
            left = heat * self.decay ** (tick - at)
            heat, at = (left if left >= 1 else 0.0) + points, tick
            if heat > self.bound and not hot:
                hot = True
                sent.append((tick, True))
        yield from self.rows(key, [*sent, *self.wait(heat, at, hot, timerValues.getCurrentWatermarkInMs())])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        heat, at, hot, _ = self.score.get()
        yield from self.rows(key, self.wait(heat, at, hot, timerValues.getCurrentWatermarkInMs()))

    def end(self, tick: int) -> int:
        return (tick + 1) * self.tick_ms

    def wait(self, heat: float, at: int, hot: bool, watermark_ms: int) -> list[tuple[int, bool]]:
        """What has come by now of a score that gets no more points; the state is kept with a timer for what comes next, if it is not 0."""
        sent = []
        cold = at + ticks_until(heat, self.bound, self.decay)
        if hot and self.end(cold) <= watermark_ms:
            hot = False
            sent.append((cold, False))
        due = self.end(cold if hot else at + ticks_until(heat, 1.0, self.decay))
        if due <= watermark_ms:
            self.score.clear()
        else:
            self.handle.registerTimer(due)
            self.score.update((heat, at, hot, due))
        return sent

    def rows(self, key, sent: list[tuple[int, bool]]) -> Iterator[pd.DataFrame]:
        if sent:
            ticker = pd.Series([key[0]] * len(sent), dtype=object)
            yield pd.DataFrame({"ticker": ticker, "tick": [t for t, _ in sent], "is_hot": [h for _, h in sent]})

    def close(self) -> None:
        pass


def hot_changes(alerts: DataFrame, tick_ms: int = 1000, lateness: str = "1 hour") -> DataFrame:
    """Alert stream -> (ticker, tick, is_hot): the ticks at which a ticker's score rises above the hot score or falls to it.

    A score is judged at the end of a tick, with all its alerts, and cools without any. Alerts later than the watermark are
    dropped.
    """
    scored = alerts.select("ticker", F.timestamp_millis("alert_ms").alias("ts"), board.alert_points(F.col("paise")).alias("points"))
    span = F.window("ts", f"{tick_ms} milliseconds").alias("span")
    summed = scored.withWatermark("ts", lateness).groupBy("ticker", span).agg(F.sum("points").alias("points"))
    tick = F.call_function("div", F.unix_millis("span.start"), F.lit(tick_ms)).alias("tick")
    rows = summed.select("ticker", tick, "points", F.window_time("span").alias("ts"))
    machine = HotState(board.DECAY, board.HOT_SCORE, tick_ms)
    return rows.groupBy("ticker").transformWithStateInPandas(
        machine, "ticker string, tick bigint, is_hot boolean", outputMode="Append", timeMode="EventTime"
    )


class Newest(StatefulProcessor):
    """The n newest alerts of one ticker and side, in whatever order they arrive; the state is their list."""

    def __init__(self, n: int) -> None:
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.list = handle.getListState("newest", RECENT)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        columns = names(RECENT)
        new = pd.concat(list(rows), ignore_index=True)[columns]
        held = list(self.list.get()) if self.list.exists() else []
        known = pd.DataFrame(held, columns=columns) if held else new.iloc[:0]
        every = pd.concat([known, new], ignore_index=True) if held else new
        best = every.sort_values(["alert_ms", "seq"], ascending=False, ignore_index=True).head(self.n)
        if best["seq"].tolist() == known["seq"].tolist():
            return
        cells = [tuple(None if pd.isna(v) else v for v in r) for r in best.astype(object).itertuples(index=False)]
        self.list.put(cells)
        yield best.assign(ticker=key[0], side=key[1], row_no=range(1, len(best) + 1))[["ticker", "side", "row_no", *columns]]

    def close(self) -> None:
        pass


def newest(alerts: DataFrame, n: int = board.ROWS_KEPT) -> DataFrame:
    """Alert stream -> the n newest alerts per ticker and side, as a whole list whenever it changes (update mode); the last one sent counts.

    Of alerts at one instant the larger `seq` is the newer. Late ones take their place if it is still among the n.
    """
    sided = alerts.withColumn("side", board.board_side(F.col("option_type"))).select("ticker", "side", *names(RECENT))
    return sided.groupBy("ticker", "side").transformWithStateInPandas(
        Newest(n), f"ticker string, side string, row_no bigint, {RECENT}", outputMode="Update", timeMode="None"
    )
