"""The kernels without Spark, against the models, over random rows and batch cuts."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st

from optionflow.operators import folds

from . import model


@pytest.fixture(autouse=True, scope="module")
def one_batch_per_call():
    old, folds.KERNEL_ROWS = folds.KERNEL_ROWS, 1
    yield
    folds.KERNEL_ROWS = old


TICK = st.tuples(st.integers(0, 30), st.integers(0, 30), st.integers(0, 5))


def cut(frame: pd.DataFrame, size: int):
    for i in range(0, len(frame), size):
        yield frame.iloc[i : i + size].reset_index(drop=True)


def tick_frame(feeds, chunk_rows):
    rows = [
        (f"k{k}", seq // chunk_rows, seq, *t) for k, feed in enumerate(feeds) for seq, t in enumerate(feed)
    ]
    return pd.DataFrame(rows, columns=["instrument_key", "chunk", "seq", "ltt", "vtt", "ltq"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(TICK, min_size=1, max_size=25), min_size=1, max_size=4), st.integers(1, 9), st.integers(1, 7))
def test_chunked_difference_equals_the_sequential_rule(feeds, chunk_rows, batch):
    ticks = tick_frame(feeds, chunk_rows)
    want = model.trades(list(zip(*[ticks[c].tolist() for c in ("instrument_key", "seq", "ltt", "vtt", "ltq")])))

    summaries = pd.concat(list(folds.summarise_chunks(cut(ticks, batch))))
    entries = pd.concat(list(folds.enter_chunks(cut(summaries, batch))))
    marked = pd.concat(
        [entries.assign(seq=0, ltq=0, is_entry=True), ticks.assign(is_entry=False)], ignore_index=True
    ).sort_values(["instrument_key", "chunk", "is_entry", "seq"], ascending=[True, True, False, True])
    out = pd.concat(list(folds.difference_volume(cut(marked[[*ticks.columns, "is_entry"]], batch))))
    out = out[out["qty"] > 0]
    assert list(zip(out["instrument_key"], out["seq"], out["qty"])) == want


def bucket_frame(rows):
    out = pd.DataFrame(sorted(rows), columns=["instrument_key", "b", "paise"])
    for c in ("vol", "n", "buy", "sell"):
        out[c] = out["paise"]
    for c in ("first_price", "last_price", "first_oi", "last_oi", "last_ms"):
        out[c] = out["b"]
    return out


@st.composite
def bucket_rows(draw):
    keys = draw(st.lists(st.sets(st.integers(0, 60), min_size=1, max_size=25), min_size=1, max_size=4))
    return [(f"k{k}", b, draw(st.integers(0, 40))) for k, bs in enumerate(keys) for b in sorted(bs)]


@settings(max_examples=300, deadline=None)
@given(bucket_rows(), st.sampled_from([1, 3, 10, None]), st.integers(1, 90), st.integers(1, 9))
def test_reset_windows_equal_the_model(rows, width, threshold, batch):
    frames = folds.reset_windows(cut(bucket_frame(rows), batch), ["instrument_key"], width, threshold)
    out = pd.concat([bucket_frame([]), *frames])
    got = list(zip(out["instrument_key"], out["b"], out["paise"], out["first_oi"]))
    assert got == model.reset_alerts(rows, width, threshold)


def bars(rows, threshold, slice_steps, batch):
    """The three passes of value bars, and how many frames the first and the last one handed on."""
    by = ["instrument_key", "chunk"]
    buckets = bucket_frame(rows).assign(chunk=lambda d: d["b"] // slice_steps)
    summaries = list(folds.summarise_bars(cut(buckets, batch), threshold))
    entries = pd.concat(folds.enter_bars(cut(pd.concat(summaries).sort_values([*by, "low"]), batch)))
    blank = entries.assign(**{c: 0 for c in buckets.columns if c not in by}, is_entry=True)
    united = pd.concat([blank, buckets.assign(carry=0, open_b=0, is_entry=False)], ignore_index=True)
    united = united.sort_values([*by, "is_entry", "b"], ascending=[True, True, False, True])
    marked = list(folds.mark_bars(cut(united, batch), threshold))
    of = pd.concat(marked).groupby(["instrument_key", "bar"]).agg(b=("b", "max"), done=("done", "max"), paise=("paise", "sum"))
    out = of[of["done"]].reset_index()
    return list(zip(out["instrument_key"], out["b"], out["paise"], out["bar"])), len(summaries), len(marked)


@settings(max_examples=300, deadline=None)
@given(bucket_rows(), st.integers(1, 90), st.sampled_from([1, 4, 15, 100]), st.integers(1, 9))
def test_value_bars_equal_the_model(rows, threshold, slice_steps, batch):
    assert bars(rows, threshold, slice_steps, batch)[0] == model.reset_alerts(rows, None, threshold)


def test_value_bars_of_many_instruments_are_found_together(monkeypatch):
    """Calls cost more than rows, so small slices share them."""
    monkeypatch.setattr(folds, "KERNEL_ROWS", 200_000)
    rows = [(f"k{i:04d}", b, (i + b) % 7) for i in range(2000) for b in range(4)]
    found, *frames = bars(rows, 10, 2, 10_000)
    assert found == model.reset_alerts(rows, None, 10)
    assert max(frames) <= 2


def test_known_feed():
    """Rejected ticks leave the state alone; an accepted one without quantity moves it."""
    ticks = [("k", 1, 10, 100, 5), ("k", 2, 9, 90, 1), ("k", 3, 10, 95, 1), ("k", 4, 11, 95, 1), ("k", 5, 12, 110, 1)]
    assert model.trades(ticks) == [("k", 1, 5), ("k", 5, 15)]
    time, volume = (np.array([0, *[t[i] for t in ticks]]) for i in (2, 3))
    taken = folds.accept(np.array([True] + [False] * 5), time, volume)
    assert taken.tolist() == [True, True, False, False, True, True]


@pytest.mark.parametrize("n", [200_000])
def test_long_stretch_of_resent_ticks_is_fast(n):
    first = np.zeros(n, dtype=bool)
    first[0] = True
    taken = folds.accept(first, np.full(n, 7), np.full(n, 9))
    assert taken.sum() == 1
