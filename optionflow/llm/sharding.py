"""Proportional stratified interleaving: shards that all have the mixture of the whole.

The rows of each stratum are put in a seeded random order; a row's fractional rank is its
place in that order over the stratum's row count. Sorted by fractional rank, any stretch
of the table holds each stratum in proportion, so cutting the sorted table into equal
stretches gives shards that differ by at most one row in size and by about one row per
stratum in content.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .ranks import ranked, unit

RANK, SIZE, PLACE, FRACTION, MIX = "__rank", "__size", "__place", "__fraction", "__mix"
POSITION, ROWS = "__position", "__n_rows"


def free(df: DataFrame, *added: str) -> None:
    """An error if columns that are to be added are there."""
    clash = sorted({c.lower() for c in df.columns} & set(added))
    if clash:
        raise ValueError(f"column names in use: {clash}")


def interleave(
    df: DataFrame, stratum: str, identity: Sequence[Column | str], seed: int = 0, position: str = "position", n_rows: str = "n_rows"
) -> DataFrame:
    """Add `position`, from 0 without gaps: the place in the interleaved order, and `n_rows`. Columns of these names are an error.

    `identity` are columns that tell rows apart; rows equal in them are interchangeable.
    A null stratum is a stratum of its own. Each stratum's fractional ranks start at a seeded
    offset, so that many strata of one row each spread over the whole order.
    An empty table gives an empty table.
    """
    free(df, position, n_rows, RANK, SIZE, PLACE, FRACTION, MIX)
    mixed = df.withColumn(MIX, F.xxhash64(F.lit(seed), *identity))
    place = F.shiftrightunsigned(MIX, 11).cast("double") * F.lit(2.0**-53)
    order = [F.shiftrightunsigned(MIX, 11), F.col(MIX), *identity]
    rows = df.count()
    within = ranked(mixed.withColumn(PLACE, place), [stratum], F.col(PLACE), order, RANK, SIZE, rows)
    fraction = (F.col(RANK) + unit(F.lit(seed), F.lit("stratum"), F.col(stratum))) / F.col(SIZE)
    spread = within.withColumn(FRACTION, fraction)
    placed = ranked(spread, [], F.col(FRACTION), [FRACTION, MIX, *identity], position, n_rows, rows)
    return placed.drop(RANK, SIZE, PLACE, FRACTION, MIX)


def shards(df: DataFrame, stratum: str, identity: Sequence[Column | str], n: int, seed: int = 0) -> DataFrame:
    """Add `shard` (0 to n - 1) and `slot` (from 0 without gaps within a shard).

    Shard sizes differ by at most one row. Columns named like these two are an error.
    """
    free(df, "shard", "slot")
    cut = interleave(df, stratum, identity, seed, POSITION, ROWS)
    shard = F.call_function("div", F.col(POSITION) * n, F.col(ROWS))
    first = F.call_function("div", F.col("shard") * F.col(ROWS) + F.lit(n - 1), F.lit(n))
    return (
        cut.withColumn("shard", shard)
        .withColumn("slot", F.col(POSITION) - first)
        .withColumn("shard", F.col("shard").cast("int"))
        .drop(POSITION, ROWS)
    )
