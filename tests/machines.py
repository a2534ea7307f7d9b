"""Runs a state machine without a stream: one group, one call a micro-batch."""

import numpy as np
import pandas as pd

BATCH = 300


class State:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Handle:
    """States and timers of one group."""

    def __init__(self):
        self.timers, self.states = set(), {}

    def getValueState(self, name, schema):
        return self.states.setdefault(name, State())

    def registerTimer(self, ms):
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.discard(ms)


class Now:
    """Values of a timer, and its information, at a watermark."""

    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs


def instants(batch: int, keys: int, odd: bool = False) -> pd.DataFrame:
    """A micro-batch of buckets, its rows in no order; the second batch lacks some keys, one key is null."""
    rng = np.random.default_rng(batch)
    frames = []
    for k in range(keys):
        if batch == 1 and k % 3 == 0:
            continue
        b = np.sort(rng.choice(BATCH, 30, replace=False)) + batch * BATCH + 1
        part = pd.DataFrame({"b": b, **{c: rng.integers(1, 200, 30) for c in ("paise", "vol", "n", "buy", "sell")}})
        if odd and k == 5:
            part["paise"] = part["paise"].where(part.index < 20)
        part["first_price"], part["last_price"] = b / 2, b / 3
        part["first_oi"], part["last_oi"], part["last_ms"] = b * 3, b * 5, b * 500 - 7
        frames.append(part.assign(instrument_key=f"k{k}" if k else None))
    return pd.concat(frames).sample(frac=1, random_state=batch)


def played(machine, batches, timers: bool = False, step_ms: int = 500, key: str = "instrument_key"):
    """All that a group's calls give, and how many calls there were; the watermark is a batch's end."""
    machine.init(handle := Handle())
    out, calls = [], 0
    for i, rows in enumerate(batches):
        now = (i + 1) * BATCH * step_ms
        if len(rows):
            calls += 1
            out += machine.handleInputRows((0,), iter([rows.iloc[:7], rows.iloc[7:]]), Now(now))
        for timer in sorted(t for t in handle.timers if t <= now) if timers else []:
            handle.timers.discard(timer)
            calls += 1
            fired = Now(now)
            out += machine.handleExpiredTimer((0,), fired, Now(timer))
    return pd.concat(out) if out else pd.DataFrame(), calls


def ordered(rows: pd.DataFrame) -> list[str]:
    return sorted(str(tuple(None if pd.isna(v) else float(v) if isinstance(v, int | float | np.number) else str(v) for v in r)) for r in rows.itertuples(index=False))


def alone(machine, batches, key: str = "instrument_key", **settings) -> list[str]:
    """What the keys give each in a group of its own."""
    found = []
    for k in pd.concat(batches)[key].drop_duplicates():
        mine = [b[b[key].isna() if k is None else b[key] == k] for b in batches]
        found += ordered(played(machine(), mine, **settings)[0])
    return sorted(found)
