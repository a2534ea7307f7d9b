"""Per-key steps of the stateful streams.

Spark keeps one state row per key and calls a step with the key's rows of a micro-batch. The
kernels are those of the batch operators, so a stream gives what they give.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState

from ..operators.folds import difference, resets, window_rows

# Python workers get these functions with the task, so they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Step = Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]

#: Keys are dealt to so many groups. A group has one state and one call a micro-batch, as calls cost more than rows.
SLOTS = 256
LAST_STATE = "instrument_key array<string>, ltt array<bigint>, vtt array<bigint>"
BUCKETS = (
    "b bigint, paise bigint, vol bigint, n bigint, first_price double, last_price double, first_oi bigint, "
    "last_oi bigint, last_ms bigint, buy bigint, sell bigint"
)
REGISTRY_STATE = "alert_count bigint, cumulative_paise bigint, first_ms bigint, second_ms bigint, last_ms bigint"
HEAT_STATE = "heat double, at_tick bigint"


def names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


#: Rows of a group's keys: `rows` holds numbers as an Arrow stream, whose `of` says which key.
ROWS_STATE = "keys array<string>, rows binary"


def joined(frames: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    return pd.concat(list(frames), ignore_index=True).sort_values(order, ignore_index=True)


def packed(rows: pd.DataFrame) -> bytes:
    """Rows of numbers as an Arrow stream."""
    table, sink = pa.Table.from_pandas(rows, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as stream:
        stream.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_pandas()


def numbered(keys: list, values: pd.Series) -> tuple[list, np.ndarray]:
    """Which key each value is; new ones are added to the keys."""
    of, found = pd.factorize(values, use_na_sentinel=False)
    place = {k: i for i, k in enumerate(keys)}
    at = [place.setdefault(None if pd.isna(k) else k, len(place)) for k in found]
    return list(place), np.array(at, np.int64)[of]


def by_key(frames: list[pd.DataFrame]) -> pd.DataFrame:
    """All rows by key and instant."""
    rows = pd.concat([f for f in frames if len(f)], ignore_index=True)
    return rows.iloc[np.lexsort((rows["b"].to_numpy(), rows["of"].to_numpy()))].reset_index(drop=True)


def dedup(columns: list[str]) -> Step:
    """Ticks of a group of instruments -> trades; the state is the last accepted time and volume of each."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ticks = pd.concat(list(frames), ignore_index=True)
        of, found = pd.factorize(ticks["instrument_key"], use_na_sentinel=False)
        found = [None if pd.isna(k) else k for k in found]
        keys, *times = state.get if state.exists else ([], [], [])
        known = dict(zip(keys, zip(*times)))
        ltt, vtt = (np.array(v, np.int64) for v in zip(*[known.get(k, (0, 0)) for k in found]))
        # each instrument is sorted by itself: where numbers repeat, their order is that of a sort of its own rows
        seq, by_key = ticks["seq"].to_numpy(), np.argsort(of, kind="stable")
        parts = np.split(by_key, np.flatnonzero(np.diff(of[by_key])) + 1)
        ticks = ticks.assign(of=of, is_entry=False).iloc[np.concatenate([part[np.argsort(seq[part])] for part in parts])]
        entry = ticks.drop_duplicates("of").assign(ltt=ltt, vtt=vtt, is_entry=True)
        rows = pd.concat([entry, ticks], ignore_index=True)
        rows = rows.iloc[np.argsort(rows["of"].to_numpy(), kind="stable")].reset_index(drop=True)
        accepted, last = difference(rows, ["of"])
        known.update(zip(found, zip(last["ltt"].tolist(), last["vtt"].tolist())))
        state.update((list(known), *map(list, zip(*known.values()))))
        yield accepted[columns]

    return step


class ResetWindow(StatefulProcessor):
    """Reset-on-alert windows and value bars; the state is the live buckets of one window of each key of a group.

    Buckets arrive whole and, from one micro-batch to the next, in order of their instants. A
    processor, since the buckets are a streaming aggregate, which the step functions can't follow.
    """

    def __init__(self, width: int | None, threshold_paise: int, columns: list[str]) -> None:
        self.width, self.threshold, self.out = width, threshold_paise, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.live = handle.getValueState("live", ROWS_STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        keys, frames = [], []
        if held := self.live.exists():
            keys, known = self.live.get()
            frames = [unpacked(known)]
        keys, of = numbered(keys, new["instrument_key"])
        worth = pd.to_numeric(new["paise"]).fillna(0).astype("int64")  # trades without a price have no value
        buckets = by_key([*frames, new[names(BUCKETS)].assign(of=of, paise=worth)])
        found, kept = zip(*map(self.advance, self.parts(buckets)))
        kept = pd.concat(kept, ignore_index=True)
        if len(kept):
            used, kept["of"] = np.unique(kept["of"], return_inverse=True)
            self.live.update(([keys[i] for i in used], packed(kept)))
        elif held:
            self.live.clear()
        found = pd.concat([f for f in found if len(f)] or found[:1], ignore_index=True)
        if len(found):
            yield self.finish(found.assign(instrument_key=np.array(keys, object)[found["of"]]))

    def parts(self, buckets: pd.DataFrame) -> list[pd.DataFrame]:
        """All keys at once, but for those with a negative value: running sums are not sorted then."""
        of, odd = buckets["of"].to_numpy(), buckets["paise"].to_numpy() < 0
        if not odd.any():
            return [buckets]
        alone = np.isin(of, of[odd])
        sound, single = buckets[~alone], [part.reset_index(drop=True) for _, part in buckets[alone].groupby("of")]
        return [sound.reset_index(drop=True), *single] if len(sound) else single

    def advance(self, buckets: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        """Alerts, and the rows that stay live: the buckets of the window, or the open bar as one row."""
        begin, alert, live = resets(buckets, ["of"], self.width, self.threshold)
        at = np.flatnonzero(live)
        if self.width is None and len(at):
            edge = np.flatnonzero(np.diff(buckets["of"].to_numpy()[at]))
            kept = window_rows(buckets, at[np.append(0, edge + 1)], at[np.append(edge, len(at) - 1)])
        else:
            kept = buckets.iloc[at]
        return window_rows(buckets, begin, alert), kept

    def finish(self, found: pd.DataFrame) -> pd.DataFrame:
        return found[self.out]

    def close(self) -> None:
        pass


def registry(columns: list[str], order: list[str]) -> Step:
    """Running state of one strike and trade date, until the watermark passes the date's end."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        alerts = joined(frames, order)
        count, total, first, second, last = state.get if state.exists else (0, 0, None, None, None)
        at = alerts["alert_ms"]
        first = int(at.iloc[0]) if first is None else first
        nth = count + 1 + np.arange(len(alerts))
        if second is None and (nth >= 2).any():
            second = int(at[nth == 2].iloc[0])
        out = alerts.assign(
            alert_count=nth,
            cumulative_paise=total + alerts["paise"].cumsum(),
            first_ms=first,
            second_ms=pd.array(np.where(nth >= 2, second or 0, 0), dtype="Int64"),
            last_alert_ms=at.shift().astype("Int64").fillna(pd.NA if last is None else last),
        )
        out.loc[nth < 2, "second_ms"] = pd.NA
        state.update((int(nth[-1]), int(out["cumulative_paise"].iloc[-1]), first, second, int(at.iloc[-1])))
        state.setTimeoutTimestamp(int(alerts["day_end_ms"].iloc[0]))
        yield out[columns]

    return step


def heat(decay: float, tick_ms: int) -> Step:
    """Decayed score of one ticker, as of its latest alert.

    A late alert counts with what is left of its points by now. A score that falls below 1 is
    0 from then on, as if it were decayed every tick, and its state is dropped.
    """
    # an alert adds 100 points, so a score can only fall below 1 over a gap of this many ticks
    long_gap = math.ceil(math.log(1 / 100) / math.log(decay)) - 1

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        alerts = joined(frames, ["alert_ms"])
        tick, points = alerts["alert_ms"].to_numpy() // tick_ms, alerts["points"].to_numpy()
        score, at = state.get if state.exists else (0.0, int(tick[0]))
        late = tick < at
        score += float((points[late] * decay ** (at - tick[late])).sum())
        tick, points = tick[~late], points[~late]
        gaps = np.flatnonzero(np.diff(np.concatenate([[at], tick])) >= long_gap)
        for a, b in zip([0, *gaps], [*gaps, len(tick)]):
            if a == b:
                continue
            begin, end = int(tick[a]), int(tick[b - 1])
            left = score * decay ** (begin - at)
            score = (left if left >= 1 else 0.0) * decay ** (end - begin)
            score += float((points[a:b] * decay ** (end - tick[a:b])).sum())
            at = end
        state.update((score, at))
        cold = at + math.ceil(math.log(1 / max(score, 1)) / math.log(decay)) + 1
        state.setTimeoutTimestamp(max(cold * tick_ms, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"ticker": [key[0]], "heat": [score], "at_tick": [at]})

    return step
