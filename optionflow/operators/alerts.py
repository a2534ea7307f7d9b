"""Window alerts over buckets: sliding, reset-on-alert and value bars."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, Window as W, functions as F

from ..workspace import spread
from . import folds

# Check instants per time slice of the sliding window (4 hours of half seconds).
SLICE = 28_800

ALERT_COLUMNS = (
    "instrument_key string, b bigint, paise bigint, vol bigint, n bigint, first_price double, "
    "last_price double, first_oi bigint, last_oi bigint, last_ms bigint, buy bigint, sell bigint"
)


def reset_alerts(buckets: DataFrame, width: int | None, threshold_paise: int, slice_steps: int = SLICE) -> DataFrame:
    """Windows of the last `width` check instants, emptied whenever they alert.

    `width=None` never expires trades: value bars. Value only grows when a trade arrives, so
    only trade buckets can alert. An instrument has at most two buckets per second of
    history whatever its tick volume. Its history is cut where that changes nothing, so tasks do not grow with it.
    """
    if width is None:
        return value_bars(buckets, threshold_paise, slice_steps)
    columns = [c.split()[0] for c in ALERT_COLUMNS.split(", ")]
    fold = partial(folds.reset_windows, by=["instrument_key", "stretch"], width=width, threshold=threshold_paise)
    return (
        spread(stretches(buckets.select(*columns), width, slice_steps), "instrument_key", "stretch")
        .sortWithinPartitions("instrument_key", "stretch", "b")
        .mapInPandas(fold, f"{ALERT_COLUMNS}, stretch bigint")
        .drop("stretch")
    )


def stretches(buckets: DataFrame, width: int, slice_steps: int = SLICE) -> DataFrame:
    """Add `stretch`: time slices with a pause of `width` instants between them, after which a window is empty, are told apart.

    One row per instrument and slice says when it begins and ends.
    """
    of = F.floor(F.col("b") / slice_steps).cast("bigint")
    rows = buckets.withColumn("slice", of)
    key = F.struct("instrument_key").alias("key")
    ends = rows.groupBy(key, "slice").agg(F.min("b").alias("low"), F.max("b").alias("high"))
    along = W.partitionBy("key").orderBy("slice")
    rest = F.col("low") - F.lag("high").over(along) >= width
    stretch = F.max(F.when(rest, F.col("slice"))).over(along.rowsBetween(W.unboundedPreceding, 0))
    marked = ends.select("key", "slice", F.coalesce(stretch, F.min("slice").over(W.partitionBy("key"))).alias("stretch"))
    return rows.withColumn("key", key).join(marked, ["key", "slice"]).drop("key", "slice")


def value_bars(buckets: DataFrame, threshold_paise: int, slice_steps: int = SLICE) -> DataFrame:
    """Bars of value `threshold_paise` or more: windows that never expire and are emptied when they alert.

    Three passes, as for trades: time slices are reduced to what they do to the value that an open bar brings in, a scan of
    those rows gives every slice the bar it is entered with, and all slices mark their buckets' bars in parallel. Spark
    sums up each bar.
    """
    by = ["instrument_key", "chunk"]
    columns = [c.split()[0] for c in ALERT_COLUMNS.split(", ")]
    worth = F.coalesce("paise", F.lit(0)).cast("bigint")  # trades without a price have no value
    rows = buckets.select(*columns).withColumn("paise", worth).withColumn("chunk", F.floor(F.col("b") / slice_steps).cast("bigint"))
    summaries = (
        spread(rows.select(*by, "b", "paise"), *by)
        .sortWithinPartitions(*by, "b")
        .mapInPandas(partial(folds.summarise_bars, threshold=threshold_paise), folds.BAR_SUMMARY)
    )
    entries = (
        summaries.repartition("instrument_key").sortWithinPartitions(*by, "low").mapInPandas(folds.enter_bars, folds.BAR_ENTRY)
    )
    # an entry row comes before its slice's buckets; zeros, as nulls would make other numbers of the columns
    blank = {f.name: F.lit(0).cast(f.dataType) for f in rows.schema if f.name not in by}
    nothing = {c: F.lit(0).cast("bigint") for c in ("carry", "open_b")}
    united = rows.withColumns({**nothing, "is_entry": F.lit(False)}).unionByName(entries.withColumns({**blank, "is_entry": F.lit(True)}))
    marked = (
        spread(united, *by)
        .sortWithinPartitions(*by, F.desc("is_entry"), "b")
        .mapInPandas(partial(folds.mark_bars, threshold=threshold_paise), f"{ALERT_COLUMNS}, bar bigint, done boolean")
    )
    at = F.col("b")
    sums = [F.sum(c).alias(c) for c in ("paise", "vol", "n", "buy", "sell")]
    firsts = [F.min_by(c, at).alias(c) for c in ("first_price", "first_oi")]
    lasts = [F.max_by(c, at).alias(c) for c in ("last_price", "last_oi", "last_ms")]
    whole = marked.groupBy("instrument_key", "bar").agg(F.max("b").alias("b"), F.max("done").alias("done"), *sums, *firsts, *lasts)
    return whole.filter("done").select(*columns)


def sliding_alerts(
    buckets: DataFrame,
    width: int,
    threshold_paise: int,
    base_width: int | None = None,
    slice_steps: int = SLICE,
) -> DataFrame:
    """Every check instant whose last `width` instants hold value >= threshold, not reset.

    With `base_width` the volume of that longer window is added as `base_vol`. Each
    instrument is cut into time slices that carry a copy of the buckets just before them,
    and window sums are differences of two running sums, so the cost per instant does not
    grow with the window length.
    """
    reach = max(width, base_width or 0)
    own = F.floor(F.col("b") / slice_steps).cast("bigint")
    later = F.floor((F.col("b") + reach - 1) / slice_steps).cast("bigint")
    sliced = buckets.withColumn("slice", F.explode(F.sequence(own, later)))

    # A window's value only falls until the next bucket comes, so a bucket whose own instant
    # is below the threshold needs no others; the rest answer for the instants up to the
    # next bucket, at most `width` of them.
    per_slice = W.partitionBy("instrument_key", "slice").orderBy("b")
    value = F.sum("paise").over(per_slice.rangeBetween(-(width - 1), 0))
    until = F.least(F.lead("b").over(per_slice) - 1, F.col("b") + width - 1)
    grid = sliced.withColumn(
        "until", F.when(value >= threshold_paise, until).otherwise(F.col("b"))
    ).withColumn("instant", F.explode(F.sequence("b", "until")))
    here = F.col("instant") == F.col("b")
    amounts = ["paise", "vol", "n", "buy", "sell"]
    edges = ["first_price", "last_price", "first_oi", "last_oi", "last_ms"]
    grid = grid.select(
        "instrument_key",
        "slice",
        "instant",
        *[F.when(here, F.col(c)).otherwise(0).alias(c) for c in amounts],
        *[F.when(here, F.col(c)).alias(c) for c in edges],
    )

    by_instant = W.partitionBy("instrument_key", "slice").orderBy("instant")
    upto = by_instant.rangeBetween(W.unboundedPreceding, 0)
    window = by_instant.rangeBetween(-(width - 1), 0)

    def total(c: str, steps: int):
        gone = F.sum(c).over(by_instant.rangeBetween(W.unboundedPreceding, -steps))
        return F.sum(c).over(upto) - F.coalesce(gone, F.lit(0))

    out = grid.select(
        "instrument_key",
        "slice",
        F.col("instant").alias("b"),
        *[total(c, width).alias(c) for c in amounts],
        *[F.first(c, ignorenulls=True).over(window).alias(c) for c in ("first_price", "first_oi")],
        *[F.last(c, ignorenulls=True).over(upto).alias(c) for c in ("last_price", "last_oi", "last_ms")],
        *([total("vol", base_width).alias("base_vol")] if base_width else []),
    )
    return out.filter(
        (F.col("paise") >= threshold_paise) & (F.floor(F.col("b") / slice_steps) == F.col("slice"))
    ).drop("slice")


def trailing_volume(buckets: DataFrame, base_width: int, slice_steps: int = SLICE) -> DataFrame:
    """Volume of the last `base_width` check instants at each bucket."""
    own = F.floor(F.col("b") / slice_steps).cast("bigint")
    later = F.floor((F.col("b") + base_width - 1) / slice_steps).cast("bigint")
    sliced = buckets.select("instrument_key", "b", "vol", F.explode(F.sequence(own, later)).alias("slice"))
    ordered = W.partitionBy("instrument_key", "slice").orderBy("b")
    upto = F.sum("vol").over(ordered.rangeBetween(W.unboundedPreceding, 0))
    gone = F.sum("vol").over(ordered.rangeBetween(W.unboundedPreceding, -base_width))
    return (
        sliced.withColumn("base_vol", upto - F.coalesce(gone, F.lit(0)))
        .filter(own == F.col("slice"))
        .select("instrument_key", "b", "base_vol")
    )


def windowed_bursts(trades: DataFrame, window_s: float, step_ms: int, threshold_paise: int) -> DataFrame:
    """The sliding window as Spark's own time windows over `ts`; also runs on streams.

    Trades are first summed into windows of one step. Only those sums, not the trades, are
    copied into each of the overlapping long windows.
    """
    buy = F.when(F.col("side") == "BUY", F.col("qty")).otherwise(0)
    step = F.window("ts", f"{step_ms} milliseconds")
    steps = trades.groupBy("instrument_key", step.alias("step")).agg(
        F.sum("paise").alias("paise"),
        F.sum("qty").alias("vol"),
        F.count(F.lit(1)).alias("n"),
        F.sum(buy).alias("buy"),
        F.sum(F.col("qty") - buy).alias("sell"),
        *[F.min_by(c, "seq").alias(f"first_{c}") for c in ("price", "oi")],
        *[F.max_by(c, "seq").alias(f"last_{c}") for c in ("price", "oi")],
        F.max_by("ltt", "seq").alias("last_ms"),
    )
    long = F.window(F.window_time("step"), f"{int(window_s * 1000)} milliseconds", f"{step_ms} milliseconds")
    sums = [F.sum(c).alias(c) for c in ("paise", "vol", "n", "buy", "sell")]

    def edge(pick, c: str):  # of the first or last step that has one
        return pick(c, F.when(F.col(c).isNotNull(), F.col("step.start"))).alias(c)

    edges = [edge(F.min_by, c) for c in ("first_price", "first_oi")]
    edges += [edge(F.max_by, c) for c in ("last_price", "last_oi", "last_ms")]
    return steps.groupBy("instrument_key", long.alias("w")).agg(*sums, *edges).filter(F.col("paise") >= threshold_paise)
