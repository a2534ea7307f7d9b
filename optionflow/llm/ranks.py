"""Exact ranks of rows in an order given by a hash, also where one key holds most rows.

The hash cuts every key's rows into chunks of about `CHUNK_ROWS` rows or, on large inputs,
the square root of the row count. Chunk sizes are summed map-side, a scan of the sums gives
each chunk its first rank, and rows are only sorted within a chunk.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

CHUNK_ROWS = 500

KEY, CHUNK, BEFORE, SIZE = "__key", "__chunk", "__before", "__size"


def chunks(rows: int) -> int:
    """Number of chunks for so many rows."""
    return max(1, rows // max(CHUNK_ROWS, math.isqrt(rows)))


def unit(*columns: Column | str) -> Column:
    """A seeded hash as a number from 0 to below 1 (53 bits)."""
    bits = F.shiftrightunsigned(F.xxhash64(*columns), 11)
    return bits.cast("double") * F.lit(2.0**-53)


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    position: Column,
    order: Sequence[Column | str],
    rank: str,
    size: str | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Add `rank`, from 0 within equal `keys` (nulls are equal), and optionally the key's row count.

    `position` is a number from 0 to below 1 that does not decrease along `order` and spreads a
    key's rows about evenly. `order` decides within a chunk; rows that tie in it
    may take each other's ranks. `rows` is the row count, if it is known.
    """
    n = chunks(df.count() if rows is None else rows)
    base = df.withColumns({KEY: F.struct(F.lit(0), *keys), CHUNK: F.floor(position * F.lit(float(n)))})
    counts = base.groupBy(KEY, CHUNK).agg(F.count("*").alias(SIZE))
    along = W.partitionBy(KEY).orderBy(CHUNK)
    starts = counts.select(
        KEY,
        CHUNK,
        F.coalesce(F.sum(SIZE).over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias(BEFORE),
        *([F.sum(SIZE).over(W.partitionBy(KEY)).alias(size)] if size else []),
    )
    within = W.partitionBy(KEY, CHUNK).orderBy(*order)
    return base.join(starts, [KEY, CHUNK]).select(
        *df.columns,
        (F.col(BEFORE) + F.row_number().over(within) - 1).alias(rank),
        *([size] if size else []),
    )
