"""As-of joins: each row with the last row of another table at or before its instant.

Both tables are united and the last row of the other side is carried forward. Keys are cut into chunks of time, as in
`ordered`: one row per chunk is carried over, so a key's whole history is never in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

CHUNK_MS = 4 * 3_600_000


def asof_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: str, right_at: str, columns: Sequence[str], chunk: int = CHUNK_MS
) -> DataFrame:
    """All rows of `left` with `columns` of the last row of `right` with equal keys and `right_at` <= `left_at`; null if there is none.

    Times are whole numbers, `chunk` is their width. Rows of `right` without a time are left out; of those at one instant the
    largest counts. A null key is a key; a row of `left` without a time has no match.
    """
    value = F.struct(*[F.col(c) for c in columns])
    key = F.struct(F.lit(0).alias("any"), *keys)
    nothing = F.lit(None)
    mine = left.select(key.alias("key"), F.col(left_at).alias("at"), F.lit(1).alias("kind"), F.struct(*left.columns).alias("row"))
    theirs = right.filter(F.col(right_at).isNotNull()).select(
        key.alias("key"), F.col(right_at).alias("at"), F.lit(0).alias("kind"), value.alias("value")
    )
    united = mine.withColumn("value", nothing.cast(theirs.schema["value"].dataType)).unionByName(
        theirs.withColumn("row", nothing.cast(mine.schema["row"].dataType))
    )
    # null times come first, before every row of the other side
    base = united.withColumn("chunk", F.struct(F.floor(F.col("at") / chunk).alias("of")))
    newest = F.max(F.when(F.col("kind") == 0, F.struct("at", "value"))).alias("newest")
    per_key = W.partitionBy("key").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = base.groupBy("key", "chunk").agg(newest).select("key", "chunk", F.last("newest", True).over(per_key)["value"].alias("before"))
    within = W.partitionBy("key", "chunk").orderBy("at", "kind", "value").rowsBetween(W.unboundedPreceding, 0)
    found = base.join(carried, ["key", "chunk"]).withColumn("seen", F.coalesce(F.last("value", True).over(within), "before"))
    return found.filter("kind = 1").select("row.*", *[F.col("seen")[c].alias(c) for c in columns])
