"""The two order-dependent recurrences, as numpy kernels over sorted Arrow batches.

Spark partitions and sorts the rows; each kernel then streams through its partition and
carries only a bounded state from batch to batch, so no group is ever held in memory.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle

# Python workers get these functions with the task, so they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _starts(pdf: pd.DataFrame, by: list[str]) -> np.ndarray:
    """True where a new group begins."""
    out = np.zeros(len(pdf), dtype=bool)
    for c in by:
        v = pdf[c].to_numpy()
        out[1:] |= v[1:] != v[:-1]
    out[:1] = True
    return out


# Rows per kernel call. Arrow batches are smaller, and the kernels cost more per call than per row.
KERNEL_ROWS = 200_000


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held, size = [], 0
    for pdf in batches:
        if len(pdf):
            held.append(pdf)
            size += len(pdf)
        if size >= KERNEL_ROWS:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


# ---------------------------------------------------------------- accepted ticks


def accept(first: np.ndarray, ltt: np.ndarray, vtt: np.ndarray) -> np.ndarray:
    """Which rows become the new state; the first row of a group is its starting state.

    A row is accepted when its time or its volume exceeds the state's. A row exceeding all
    earlier rows in either one is accepted whatever the state is; between two such rows the
    state is only in doubt if some row exceeds the first of them, and just those stretches
    are stepped through.
    """
    group = np.cumsum(first)
    record = first.copy()
    for v in (ltt, vtt):
        top = pd.Series(v).groupby(group).cummax().to_numpy()
        record[1:] |= ~first[1:] & (v[1:] > top[:-1])
    at = np.maximum.accumulate(np.where(record, np.arange(len(ltt)), 0))
    doubt = ~record & ((ltt > ltt[at]) | (vtt > vtt[at]))
    taken = record.copy()
    if doubt.any():
        for start in np.unique(at[doubt]):
            time, volume, i = ltt[start], vtt[start], start + 1
            while i < len(ltt) and not record[i]:
                if ltt[i] > time or vtt[i] > volume:
                    time, volume, taken[i] = ltt[i], vtt[i], True
                i += 1
    return taken


def summarise_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per (instrument_key, chunk): highest time and volume, and the state the chunk
    leaves behind once any of its rows is accepted. That state does not depend on the state
    the chunk was entered with: the first accepted row exceeds all rows before it."""
    by = ["instrument_key", "chunk"]
    cols = [*by, "max_ltt", "max_vtt", "ltt", "vtt"]
    open_group: pd.DataFrame | None = None
    for pdf in _joined(batches):
        rows = pdf[[*by, "ltt", "vtt"]].assign(max_ltt=pdf["ltt"], max_vtt=pdf["vtt"])
        if open_group is not None:
            rows = pd.concat([open_group, rows], ignore_index=True)
        first = _starts(rows, by)
        taken = accept(first, rows["ltt"].to_numpy(), rows["vtt"].to_numpy())
        group = np.cumsum(first)
        high = rows.groupby(group)[["max_ltt", "max_vtt"]].max()
        done = rows[taken].groupby(group[taken])[[*by, "ltt", "vtt"]].last().join(high)[cols]
        open_group = done.iloc[-1:]
        if len(done) > 1:
            yield done.iloc[:-1]
    if open_group is not None:
        yield open_group


def enter_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Entry state of each chunk from the chunk summaries, sorted by key and chunk."""
    key, ltt, vtt = None, 0, 0
    for pdf in batches:
        entry = []
        for k, hi_ltt, hi_vtt, end_ltt, end_vtt in zip(
            pdf["instrument_key"], pdf["max_ltt"], pdf["max_vtt"], pdf["ltt"], pdf["vtt"]
        ):
            if k != key:
                key, ltt, vtt = k, 0, 0
            entry.append((ltt, vtt))
            if hi_ltt > ltt or hi_vtt > vtt:
                ltt, vtt = end_ltt, end_vtt
        yield pdf[["instrument_key", "chunk"]].assign(
            ltt=np.array([e[0] for e in entry], dtype="int64"), vtt=np.array([e[1] for e in entry], dtype="int64")
        )


def difference(rows: pd.DataFrame, by: list[str]) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Accepted rows with the quantity since the previous state, and the last state of each group.

    Each group begins with its starting state, marked `is_entry`.
    """
    vtt, ltq = rows["vtt"].to_numpy(), rows["ltq"].to_numpy()
    first = _starts(rows, by)
    taken = np.flatnonzero(accept(first, rows["ltt"].to_numpy(), vtt))
    before = vtt[np.concatenate([taken[:1], taken[:-1]])]
    qty = np.where(before > 0, vtt[taken] - before, ltq[taken])
    out = rows.iloc[taken].assign(qty=qty)
    # a group's first row is always taken
    last = taken[np.append(np.flatnonzero(first[taken])[1:], len(taken)) - 1]
    return out[~out["is_entry"].to_numpy(dtype=bool)], rows.iloc[last].assign(is_entry=True)


def difference_volume(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """`difference` over the (instrument_key, chunk) groups of a partition."""
    state: pd.DataFrame | None = None
    for pdf in _joined(batches):
        rows = pdf if state is None else pd.concat([state, pdf], ignore_index=True)
        out, ended = difference(rows, ["instrument_key", "chunk"])
        state = ended.iloc[-1:]
        yield out.drop(columns=["is_entry", "chunk", "vtt", "ltq"])


# ---------------------------------------------------------------- reset-on-alert windows


def reset_windows(
    batches: Iterator[pd.DataFrame], by: list[str], width: int | None, threshold: int
) -> Iterator[pd.DataFrame]:
    """Alerts of windows that are emptied whenever they alert.

    Rows are buckets sorted by (by, b). A window holds the buckets of the last `width` check
    instants (all of them if None) since the last alert, and alerts at value >= threshold.
    """
    held: pd.DataFrame | None = None
    for pdf in _joined(batches):
        rows = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        begin, alert, live = resets(rows, by, width, threshold)
        if len(alert):
            yield window_rows(rows, begin, alert)
        # only the last group can go on in the next batch
        last = np.flatnonzero(_starts(rows, by))[-1]
        at = last + np.flatnonzero(live[last:])
        held = rows.iloc[at] if len(at) else None
        if width is None and held is not None:
            held = window_rows(rows, at[:1], at[-1:])


def resets(rows: pd.DataFrame, by: list[str], width: int | None, threshold: int):
    """First and last row of each alert's window, and which rows stay live after the end."""
    n = len(rows)
    first = _starts(rows, by)
    index = np.arange(n)
    low = np.maximum.accumulate(np.where(first, index, 0))
    if width is not None:
        b = rows["b"].to_numpy()
        offset = b - b.min() + np.cumsum(first) * (b.max() - b.min() + width + 1)
        low = np.maximum(low, np.searchsorted(offset, offset - width, side="right"))
    total = np.concatenate([[0], np.cumsum(rows["paise"].to_numpy())])
    # Next alert after a reset just before row s: either the sum since s reaches the
    # threshold while row s is still in the window, or a later full window does.
    since = np.searchsorted(total, total[:n] + threshold, side="left") - 1
    full = np.flatnonzero(total[1:] - total[low] >= threshold)
    past = np.searchsorted(low, index, side="right")
    full_at = np.append(full, n)[np.searchsorted(full, past)]
    inside = (since < n) & (low[np.minimum(since, n - 1)] <= index)
    following = np.where(inside, since, full_at)

    begin, alert, s = [], [], 0
    while s < n:
        j = int(following[s])
        if j >= n:
            break
        alert.append(j)
        begin.append(max(s, int(low[j])))
        s = j + 1
    begin, alert = np.array(begin, dtype="int64"), np.array(alert, dtype="int64")

    # A row is live if nothing in its group alerted at or after it and it is still in the
    # window at the check after the group's last bucket.
    group = np.cumsum(first) - 1
    end = np.append(np.flatnonzero(first)[1:], n) - 1
    done = np.full(len(end), -1)
    done[group[alert]] = alert
    live = index > done[group]
    if width is not None:
        live &= b > b[end[group]] + 1 - width
    return begin, alert, live


def window_rows(rows: pd.DataFrame, begin: np.ndarray, end: np.ndarray) -> pd.DataFrame:
    """One row per window [begin, end]: sums, first and last values."""
    out = rows.iloc[end].copy()
    for c in ("paise", "vol", "n", "buy", "sell"):
        total = np.concatenate([[0], np.cumsum(rows[c].to_numpy())])
        out[c] = total[end + 1] - total[begin]
    for c in ("first_price", "first_oi"):
        out[c] = rows[c].to_numpy()[begin]
    return out


# ---------------------------------------------------------------- value bars, chunk by chunk


def _whole(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """Sorted batches cut at ends of groups: whole groups, many at a time."""
    held: pd.DataFrame | None = None
    for pdf in _joined(batches):
        rows = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        last = int(np.flatnonzero(_starts(rows, by))[-1])
        if last:
            yield rows.iloc[:last]
        held = rows.iloc[last:].reset_index(drop=True)
    if held is not None:
        yield held


def _rising(frames: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """The same; groups are handed on one by one where a value is negative, as their running sums are not sorted then."""
    for rows in frames:
        if (rows["paise"] >= 0).all():
            yield rows
        else:
            yield from (part for _, part in rows.groupby(np.cumsum(_starts(rows, by))))


def bar_ends(total: np.ndarray, end: np.ndarray, threshold: int) -> np.ndarray:
    """For a bar that begins at each row: the row that completes it, or `end`, the end of the row's group.

    `total` are running sums from 0 over all groups.
    """
    return np.minimum(np.searchsorted(total, total[:-1] + threshold, side="left") - 1, end)


def open_after(ends: np.ndarray, end: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For a bar that begins at each row: the row at which the bar begins that is still open at the group's end, or `end`.

    The jumps from bar to bar are doubled until none leads further. A group has one place more than rows, for its end.
    """
    n = len(ends)
    place = np.arange(n) + group
    jump = np.arange(n + int(group[-1]) + 1)
    jump[place] = np.where(ends < end, ends + 1 + group, place)
    while True:
        further = jump[jump]
        if (further == jump).all():
            break
        jump = further
    return jump[place] - group


BAR_SUMMARY = "instrument_key string, chunk bigint, first_b bigint, low bigint, rest bigint, open_b bigint"


def summarise_bars(batches: Iterator[pd.DataFrame], threshold: int) -> Iterator[pd.DataFrame]:
    """What a chunk does to the value that the open bar brings in: a row for each range of values, from `low` on.

    The bar that is open after the chunk has value `rest` since bucket `open_b`. In the range that completes no
    bar, `open_b` is null and `rest` is what the chunk adds.
    """
    by = ["instrument_key", "chunk"]
    for rows in _rising(_whole(batches, by), by):
        b, n = rows["b"].to_numpy(), len(rows)
        total = np.concatenate([[0], np.cumsum(rows["paise"].to_numpy())])
        begins = np.flatnonzero(_starts(rows, by))
        finish = np.append(begins[1:], n)
        group = np.repeat(np.arange(len(begins)), finish - begins)
        begin, end = begins[group], finish[group]
        ends = bar_ends(total, end, threshold)
        left = open_after(ends, end, group)
        # rows that complete the incoming bar for some value below the threshold, the last of them for the least
        sums = total[1:] - total[begin]
        at = np.flatnonzero((sums > 0) & (total[1:] > total[:-1]) & (np.arange(n) <= ends[begin]))
        after = np.where(at + 1 < end[at], left[np.minimum(at + 1, n - 1)], end[at])
        open_b = np.where(after < end[at], b[np.minimum(after, n - 1)], -1)
        whole = total[finish] - total[begins]
        none = np.flatnonzero(whole < threshold)
        of = np.concatenate([begins[none], begins[group[at]]])
        yield pd.DataFrame(
            {
                "instrument_key": rows["instrument_key"].to_numpy()[of],
                "chunk": rows["chunk"].to_numpy()[of],
                "first_b": b[of],
                "low": np.concatenate([np.zeros(len(none), np.int64), np.maximum(0, threshold - sums[at])]),
                "rest": np.concatenate([whole[none], total[end[at]] - total[after]]),
                "open_b": pd.arrays.IntegerArray(np.concatenate([np.zeros(len(none), np.int64), open_b]), np.arange(len(of)) < len(none)),
            }
        )


BAR_ENTRY = "instrument_key string, chunk bigint, carry bigint, open_b bigint"


def enter_bars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The open bar with which each chunk is entered: its value and first bucket (null: none). Sorted by key, chunk, low."""
    key, chunk, first_b, carry, since = object(), None, None, 0, None
    low, fits, none = -1, None, None
    for rows in batches:
        keys, chunks, carries, opened = [], [], [], []
        columns = [rows[c].tolist() for c in ("instrument_key", "chunk", "first_b", "low", "rest")]
        for k, of, b, least, rest, at, open_ended in zip(*columns, rows["open_b"].tolist(), rows["open_b"].isna().tolist()):
            if of != chunk or k != key:
                # of the ranges that begin at or below the value the one with the highest begin, else the one that completes none
                if k != key:
                    carry, since = 0, None
                elif fits is not None:
                    carry, since = fits[0], None if fits[1] < 0 else fits[1]
                else:
                    carry, since = carry + none, first_b if since is None else since
                key, chunk, first_b = k, of, b
                low, fits, none = -1, None, None
                keys.append(k)
                chunks.append(of)
                carries.append(carry)
                opened.append(since)
            if open_ended:
                none = int(rest)
            elif low < least <= carry:
                low, fits = least, (int(rest), int(at))
        yield pd.DataFrame(
            {
                "instrument_key": pd.Series(keys, dtype=object),
                "chunk": np.array(chunks, np.int64),
                "carry": np.array(carries, np.int64),
                "open_b": pd.array(opened, dtype="Int64"),
            }
        )


def mark_bars(batches: Iterator[pd.DataFrame], threshold: int) -> Iterator[pd.DataFrame]:
    """Buckets with `bar`, the first bucket of their bar, and `done`, whether they complete it.

    Each (instrument_key, chunk) group begins with its entry row.
    """
    by = ["instrument_key", "chunk"]
    for rows in _rising(_whole(batches, by), by):
        b, n = rows["b"].to_numpy(), len(rows)
        entry = rows["is_entry"].to_numpy(dtype=bool)
        total = np.concatenate([[0], np.cumsum(np.where(entry, rows["carry"].to_numpy(), rows["paise"].to_numpy()))])
        begins = np.flatnonzero(_starts(rows, by))
        finish = np.append(begins[1:], n)
        end = np.repeat(finish, finish - begins)
        ends = bar_ends(total, end, threshold)
        following = np.minimum(ends + 1, end).tolist()
        begin, s = [], 0
        while s < n:
            begin.append(s)
            s = following[s]
        begin = np.array(begin)
        # the bar that a group is entered with begins at its `open_b`, or at the first bucket
        since = rows["open_b"].to_numpy(dtype="float64", na_value=np.nan)[begin]
        first = b[np.minimum(begin + 1, n - 1)]
        old = entry[begin]
        of = np.where(old, np.where(np.isnan(since), first, np.nan_to_num(since).astype(np.int64)), b[begin])
        bar = np.repeat(of, np.diff(np.append(begin, n)))
        done = np.zeros(n, bool)
        done[ends[begin][ends[begin] < end[begin]]] = True
        out = rows.assign(bar=bar, done=done)[~entry]
        yield out.drop(columns=["chunk", "carry", "open_b", "is_entry"])
