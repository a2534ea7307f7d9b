"""Running aggregates that stay parallel when one key holds most of the rows.

A plain `Window.partitionBy(key)` sends a whole key to one task. Here a key is cut into
ordered chunks: one small row per (key, chunk) is aggregated map-side, scanned per key to
give every chunk its carry-in, and joined back; the full rows are only ever windowed
within a chunk. Results equal the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

CHUNK, KEY = "__chunk", "__key"


def row_chunk(seq: Column, rows: int) -> Column:
    """Chunk of a per-key unique integer: at most `rows` rows per chunk, by construction."""
    return F.call_function("div", seq, F.lit(rows))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    sums: dict[str, Column] | None = None,
    previous: dict[str, Column] | None = None,
    constants: DataFrame | None = None,
) -> DataFrame:
    """Add inclusive running sums and previous-row values per key.

    `constants` has one row per key; its other columns are added too. They travel with the
    chunk carries, so the rows are never joined by the bare key.

    `chunk` must not decrease along `order` within a key. Values in `previous` are primitive
    and, where rows tie on the first order column, equal; then the chunk ends need no
    struct-valued aggregate, which Spark could only run by sorting.
    """
    sums, previous = sums or {}, previous or {}
    keys = list(keys)
    inputs = {f"__in_{name}": col for name, col in {**sums, **previous}.items()}
    # a struct is never null, so rows with null keys or chunks meet their carries too
    base = df.withColumns({CHUNK: F.struct(chunk.alias("at")), KEY: F.struct(F.lit(0).alias("any"), *keys), **inputs})
    partials = [F.sum(f"__in_{n}").alias(f"__sum_{n}") for n in sums]
    partials += [F.max_by(f"__in_{n}", order[0]).alias(f"__last_{n}") for n in previous]
    summary = base.groupBy(KEY, CHUNK).agg(*partials)

    per_key = W.partitionBy(KEY).orderBy(CHUNK)
    before = per_key.rowsBetween(W.unboundedPreceding, -1)
    carry = summary.select(
        KEY,
        CHUNK,
        *[F.coalesce(F.sum(f"__sum_{n}").over(before), F.lit(0)).alias(f"__carry_{n}") for n in sums],
        *[F.lag(f"__last_{n}").over(per_key).alias(f"__carry_{n}") for n in previous],
    )

    extra = [c for c in constants.columns if c not in keys] if constants is not None else []
    if extra:
        keyed = constants.select(F.struct(F.lit(0).alias("any"), *keys).alias(KEY), *extra)
        carry = carry.join(keyed, KEY)

    within = W.partitionBy(KEY, CHUNK).orderBy(*order)
    upto = within.rowsBetween(W.unboundedPreceding, 0)
    joined = base.join(carry, [KEY, CHUNK])
    return joined.select(
        *df.columns,
        *extra,
        *[(F.sum(f"__in_{n}").over(upto) + F.col(f"__carry_{n}")).alias(n) for n in sums],
        *[
            F.when(F.row_number().over(within) == 1, F.col(f"__carry_{n}"))
            .otherwise(F.lag(f"__in_{n}").over(within))
            .alias(n)
            for n in previous
        ],
    )


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """First n rows per key, numbered in `row_no`.

    The rank bound is applied before the shuffle too (window group limit), so a hot key
    sends at most n rows per map task.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("row_no", F.row_number().over(w).cast("bigint")).filter(F.col("row_no") <= n)
