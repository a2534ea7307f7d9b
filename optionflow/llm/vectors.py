"""Vectors in tables: which take part, how tasks see them, how best lists are merged."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .store import kept

#: Numbers in a matrix of queries by rows.
MATRIX_CELLS = 1 << 22


def finite(vector: Column) -> Column:
    """True where a vector is not null and all of its components are finite numbers."""
    odd = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf")))
    )
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, width: int = 0) -> np.ndarray:
    """A column of lists as rows; shorter vectors are filled up with zeros."""
    arrays = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    rows = []
    for a in arrays:
        lengths = np.diff(a.offsets.to_numpy())
        flat = a.flatten().to_numpy(zero_copy_only=False)
        if len(lengths) and (lengths == lengths[0]).all():
            rows.append(flat.reshape(len(lengths), lengths[0]))
        else:
            wide = np.zeros((len(lengths), int(lengths.max(initial=0))), flat.dtype)
            wide[np.arange(wide.shape[1]) < lengths[:, None]] = flat
            rows.append(wide)
    width = max([width, *(r.shape[1] for r in rows)])
    if not rows:
        return np.zeros((0, width))
    return np.vstack([np.pad(r, ((0, 0), (0, width - r.shape[1]))) for r in rows])


def both(left: pa.ChunkedArray, right: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Two columns of vectors as matrices of one width."""
    a = matrix(left)
    b = matrix(right, a.shape[1])
    return (np.pad(a, ((0, 0), (0, b.shape[1] - a.shape[1]))), b)


def distinct_vectors(rows: DataFrame, ids: int) -> DataFrame:
    """(vid, v, ids): every distinct vector `v` of rows (id, v) once, with up to so many of its smallest ids; a written table.

    Equal rows are reduced before they are moved, and a vector's ids are cut to that number in every task.
    """
    place = F.row_number().over(W.partitionBy("v").orderBy("id"))
    few = rows.distinct().withColumn("place", place).filter(F.col("place") <= ids)
    lists = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return kept(lists.select(F.monotonically_increasing_id().alias("vid"), "v", "ids"))


def members(rows: DataFrame, vectors: DataFrame, number: str) -> DataFrame:
    """(query_id, number): which of the distinct vectors each row (id, v) has."""
    known = vectors.select(F.col("v").alias("__v"), F.col(number))
    return rows.distinct().join(known, F.col("v") == F.col("__v")).select(F.col("id").alias("query_id"), number)


def for_members(found: DataFrame, asking: DataFrame, k: int) -> DataFrame:
    """From (qid, vec_id, score) of distinct query vectors to the k best per query id, its own id left out.

    One id more than k per vector is enough, whichever is the asker's own. A pair counts once, with its highest score.
    """
    once = found.groupBy("qid", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(W.partitionBy("qid").orderBy(F.desc("score"), "vec_id"))
    top = once.withColumn("place", place).filter(F.col("place") <= k + 1).drop("place")
    each = asking.join(top, "qid").filter(F.col("query_id") != F.col("vec_id"))
    return best(each.select("query_id", "vec_id", "score"), k)


def slices(queries: int, rows: int) -> list[slice]:
    """Parts of a block of queries, so that a matrix of one of them and a block of rows stays small."""
    step = max(1, MATRIX_CELLS // max(1, rows))
    return [slice(a, a + step) for a in range(0, queries, step)]


def list_rows(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists, one after the other, and the row of each."""
    array = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.list_(pa.int64()))
    sizes = np.diff(array.offsets.to_numpy())
    return array.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)


def best(pairs: DataFrame, k: int) -> DataFrame:
    """The k highest scores per query, ties to the smaller vec_id; a pair counts once, with its highest score."""
    once = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
