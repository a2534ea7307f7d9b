"""Exact top-k search by inner product with a vector-approximation file.

The approximation of a vector is a cell number, one byte, per dimension. A grid over the whole table says what
a cell holds, so the cells bound a vector's inner product with a query from both sides.

1. Blocks of queries meet blocks of cells. A block hands on the vectors whose upper bound reaches the k-th best lower
   bound in the block; over all blocks, those stay that reach the k-th best lower bound of all.
2. Exact vectors are joined to the pairs that are left, highest upper bound first: to the first few of each query,
   then to those whose bound reaches the k-th best exact score. After that the k-th result is certain.

Exact vectors thus travel for survivors only. Equal vectors are searched once, with their smallest ids, on both sides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .store import drop, kept
from .vectors import distinct_vectors, finite, for_members, list_rows, matrix, members, slices

CELLS = 256
BLOCK_ROWS, MOST_ROWS = 1024, 16384

#: Vectors read first, as a multiple of k + 1.
FIRST = 2

#: Products of numbers below this, summed up, are 64-bit ones.
SMALL = 2**62


def whole(vector: Column, factor: float) -> Column:
    """Each component as floor(factor * x); an error where a long cannot hold it."""

    def one(x: Column) -> Column:
        scaled = x.cast("double") * F.lit(factor)
        fits = F.abs(scaled) < F.lit(2.0**63)
        return F.when(fits, F.floor(scaled)).otherwise(F.raise_error(F.lit("a component does not fit a long")))

    return F.transform(vector, one)


def block_rows(rows: int, tasks: int) -> int:
    """Rows per block: four blocks per task, within bounds that a task's memory sets."""
    return min(MOST_ROWS, max(BLOCK_ROWS, -(-rows // (4 * tasks))))


class Grid:
    """Equal cells between the least and the largest component of each dimension."""

    def __init__(self, low: list[int], high: list[int]) -> None:
        self.low = low
        self.width = [-(-(b - a + 1) // CELLS) for a, b in zip(low, high)]

    def cells(self, x: np.ndarray) -> np.ndarray:
        """Cell numbers of whole vectors, a row each."""
        wide = max((abs(v) for v in (*self.low, *(w * CELLS for w in self.width))), default=0)
        kind = np.int64 if wide < SMALL // 2 else object
        x = np.pad(x, ((0, 0), (0, len(self.low) - x.shape[1]))).astype(kind)
        return ((x - np.array(self.low, kind)) // np.array(self.width, kind)).astype(np.uint8)

    def bounds(self, queries: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of inner products, a row per query."""
        q, low, width = (np.array(a, np.float64) for a in (queries, self.low, self.width))
        corner = (q @ low)[:, None] + (q * width) @ cells.T.astype(np.float64)
        # rounding of the sums stays far below this
        slack = 1e-12 * (np.abs(q) @ (np.abs(low) + width * (CELLS + 1)))
        down, up = np.minimum(q, 0) @ (width - 1) - slack, np.maximum(q, 0) @ (width - 1) + slack
        return corner + down[:, None], corner + up[:, None]


def grid_of(data: DataFrame) -> Grid:
    """The grid of a table's vectors `v`; shorter ones count as filled up with zeros. Two numbers per dimension reach the driver."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = {}, {}
        for batch in batches:
            array = batch.column(0)
            sizes = np.diff(array.offsets.to_numpy())
            for size in np.unique(sizes):
                x = matrix(array.take(pa.array(np.flatnonzero(sizes == size))))
                for j, (a, b) in enumerate(zip(x.min(0).tolist(), x.max(0).tolist())):
                    low[j], high[j] = min(low.get(j, a), a), max(high.get(j, b), b)
        columns = [pa.array(list(low), pa.int32()), pa.array(list(low.values()), pa.int64()), pa.array(list(high.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["at", "low", "high"])

    found = data.select("v").mapInArrow(ends, "at int, low bigint, high bigint").groupBy("at").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    rows = sorted(tuple(r) for r in found.collect())
    least = data.agg(F.min(F.size("v"))).first()[0] or 0
    return Grid([min(a, 0) if at >= least else a for at, a, _ in rows], [max(b, 0) if at >= least else b for at, _, b in rows])


def certain(lower: np.ndarray, ids: np.ndarray, row: np.ndarray, want: int) -> np.ndarray:
    """Per query (row of `lower`): the bound that `want` different ids reach; minus infinity if there are fewer.

    `ids` are all ids of the columns, `row` the column of each.
    """
    reached = lower[:, row]
    by = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.append(True, ids[by][1:] != ids[by][:-1])) if len(ids) else np.empty(0, np.int64)
    if len(first) < want:
        return np.full(len(lower), -np.inf)
    if len(first) < len(ids):
        reached = np.maximum.reduceat(reached[:, by], first, axis=1)
    return np.partition(reached, reached.shape[1] - want, axis=1)[:, reached.shape[1] - want]


def exact(q: np.ndarray, v: np.ndarray) -> list[int]:
    """Inner products of the rows of two matrices, as whole numbers of any size."""
    largest = [max(int(m.max(initial=0)), -int(m.min(initial=0))) for m in (q, v)]
    kind = np.int64 if largest[0] * largest[1] * q.shape[1] < SMALL else object
    return [int(s) for s in (q.astype(kind) * v.astype(kind)).sum(1)]


def scored(pairs: DataFrame, queries: DataFrame, data: DataFrame) -> DataFrame:
    """(qid, ids, score) of pairs (qid, vid), on the exact vectors."""
    left = pairs.select("qid", "vid", "ids").join(queries.select("qid", F.col("v").alias("q")), "qid")
    both = left.join(data.select("vid", "v"), "vid").select("qid", "ids", "q", "v")

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, v = matrix(batch.column(2)), matrix(batch.column(3))
            width = max(q.shape[1], v.shape[1])
            q, v = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, v))
            scores = exact(q, v)
            for score, ids in zip(scores, batch.column(1)):
                if not -(2**63) <= score < 2**63:
                    raise ValueError(f"a long cannot hold the score of vec_id {ids[0].as_py()}")
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(scores, pa.int64())], names=["qid", "ids", "score"])

    return both.mapInArrow(products, "qid bigint, ids array<bigint>, score bigint")


def kth(rows: DataFrame, value: str, want: int) -> DataFrame:
    """(of, least): the value that `want` different ids of a query reach; queries with fewer ids are missing."""
    once = rows.select("qid", F.explode("ids").alias("id"), value).groupBy("qid", "id").agg(F.max(value).alias("least"))
    place = F.row_number().over(W.partitionBy("qid").orderBy(F.desc("least")))
    return once.withColumn("place", place).filter(F.col("place") <= want).filter(F.col("place") == want).select(F.col("qid").alias("of"), "least")


def reaching(pairs: DataFrame, bounds: DataFrame) -> DataFrame:
    """Pairs whose upper bound reaches their query's."""
    joined = pairs.join(bounds, F.col("qid") == F.col("of"), "left")
    return joined.filter(F.col("least").isNull() | (F.col("upper") >= F.col("least"))).drop("of", "least")


def topk(
    vectors: DataFrame, queries: DataFrame, k: int, factor: float = 256.0, id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of floor(factor * x) per query.

    Ties go to the smaller id. Rows without an id, and vectors that are null or hold null
    or non-finite components, take no part on either side. A query's own id is no candidate. Vectors of
    unequal length are compared as if filled up with zeros. A pair of ids counts once, with
    its highest score, if ids repeat. Queries without a candidate have no rows. Other columns are ignored. Components
    and scores that a long cannot hold are an error.
    """
    spark = vectors.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        good = df.filter(F.col(id).isNotNull() & finite(F.col(vector)))
        return good.select(F.col(id).cast("bigint").alias("id"), whole(F.col(vector), factor).alias("v"))

    data = distinct_vectors(usable(vectors), k + 1)
    asked = distinct_vectors(usable(queries), 1).withColumnRenamed("vid", "qid").drop("ids")
    asking = members(usable(queries), asked, "qid")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, wanted = data.count(), asked.count()
    size = block_rows(rows, tasks)
    blocks, query_blocks = max(1, -(-rows // size)), max(1, -(-wanted // size))
    grid = grid_of(data)

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = grid.cells(matrix(batch.column(2)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([c.tobytes() for c in cells], pa.binary())], names=["vid", "ids", "cells"])

    cells = data.select("vid", "ids", "v").mapInArrow(approximate, "vid bigint, ids array<bigint>, cells binary")

    def dealt(column: str, n: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = asked.withColumn("qb", dealt("qid", query_blocks)).withColumn("b", every(blocks))
    right = cells.withColumn("b", dealt("vid", blocks)).withColumn("qb", every(query_blocks))

    def bounded(asked: pa.Table, data: pa.Table) -> pa.Table:
        found = []
        if asked.num_rows and data.num_rows:
            width = len(grid.low)
            q = matrix(asked["v"])[:, :width]
            q = np.pad(q, ((0, 0), (0, width - q.shape[1])))
            known = np.frombuffer(b"".join(data["cells"].to_pylist()), np.uint8).reshape(data.num_rows, width)
            ids, row = list_rows(data["ids"])
            for part in slices(len(q), len(known)):
                lower, upper = grid.bounds(q[part], known)
                at, near = np.nonzero(upper >= certain(lower, ids, row, k + 1)[:, None])
                found.append((at + part.start, near, lower[at, near], upper[at, near]))
        at, near, lower, upper = (np.concatenate(c) for c in zip(*found)) if found else ([], [], [], [])
        return pa.table(
            {
                "qid": asked["qid"].take(pa.array(at, pa.int64())),
                "vid": data["vid"].take(pa.array(near, pa.int64())),
                "ids": data["ids"].take(pa.array(near, pa.int64())),
                "lower": pa.array(lower, pa.float64()),
                "upper": pa.array(upper, pa.float64()),
            }
        )

    met = left.groupBy("qb", "b").cogroup(right.groupBy("qb", "b"))
    pairs = kept(met.applyInArrow(bounded, "qid bigint, vid bigint, ids array<bigint>, lower double, upper double"))
    falling = F.row_number().over(W.partitionBy("qid").orderBy(F.desc("upper"), "vid"))
    left = kept(reaching(pairs, kth(pairs, "lower", k + 1)).withColumn("place", falling))
    first = kept(scored(left.filter(F.col("place") <= FIRST * (k + 1)), asked, data))
    later = reaching(left.filter(F.col("place") > FIRST * (k + 1)), kth(first, "score", k + 1))
    read = first.unionByName(scored(later, asked, data))
    result = kept(for_members(read.select("qid", F.explode("ids").alias("vec_id"), "score"), asking, k))
    drop(spark, data, asked, pairs, left, first)
    return result
