"""Approximate nearest neighbours along several shifted Hilbert curves.

Each ordering projects the unit vectors on a few random orthogonal directions, shifts them
at random, lays a grid over them and sorts the vectors by the place of their cell on the
Hilbert curve. Spark range-partitions the (ordering, key) pairs, so ranks along every curve
come from partition sizes. A query's candidates on a curve are the rows within a window
around its own rank; the windows of all curves merge, with scores computed on the
original vectors.

The window is a share of the table, since on vectors without structure the share of
candidates, not their number, decides recall. A curve's ranks are cut into blocks, and queries
travel to the blocks which their windows touch, so a task holds one block of vectors and one
block of queries, and hands on a few rows per query. Both carry their places on all curves: a pair
is scored on the first curve whose window holds it, so merging windows score no pair twice.

Equal vectors lie on the curves once, with their smallest ids: a large group of copies neither fills a
window nor hides its smallest ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from .store import drop, kept
from .vafile import block_rows
from .vectors import both, distinct_vectors, finite, for_members, list_rows, matrix, members, slices

CURVES, DIMENSIONS, BITS, SHARE = 8, 8, 6, 0.18

PAIRS = "qid bigint, vec_id bigint, score double"


def curve_place(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row's cell on the Hilbert curve over a grid of 2^bits cells per dimension.

    Skilling's transform ("Programming the Hilbert curve", 2004) on whole columns.
    """
    x = cells.astype(np.int64).T.copy()
    for bit in range(bits - 1, 0, -1):
        below = (1 << bit) - 1
        for axis in x:
            turned = (axis >> bit) & 1 == 1
            swap = np.where(turned, 0, (x[0] ^ axis) & below)
            x[0] ^= np.where(turned, below, swap)
            axis ^= swap  # all zeros for the first axis
    x[1:] = np.bitwise_xor.accumulate(x, axis=0)[1:]
    flips = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flips ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= flips
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            place = (place << 1) | ((axis >> bit) & 1)
    return place


def keys(vectors: np.ndarray, curve: int, seed: int, dimensions: int, bits: int) -> np.ndarray:
    """Curve places of vectors, for one ordering."""
    width = vectors.shape[1]
    rng = np.random.default_rng([seed, curve, width])
    axes = np.linalg.qr(rng.normal(size=(width, width)))[0][:, :dimensions]
    # a random unit vector's projection has a deviation of 1 / sqrt(width); the grid spans three, plus the shift
    spread = vectors @ axes * np.sqrt(width)
    cells = np.floor((spread + 3 + rng.random(axes.shape[1])) / 7 * (1 << bits))
    return curve_place(np.clip(cells, 0, (1 << bits) - 1), bits)


def orderings(data: DataFrame, curves: int, seed: int, dimensions: int, bits: int) -> DataFrame:
    """(vid, curve, key): a row per vector and curve."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column(1)).astype(np.float64)
            v = v / np.abs(v).max(1, initial=0, keepdims=True)
            v /= np.linalg.norm(v, axis=1, keepdims=True)
            for curve in range(curves):
                added = [pa.array(np.full(len(v), curve, np.int32)), pa.array(keys(v, curve, seed, dimensions, bits))]
                yield pa.RecordBatch.from_arrays([batch.column(0), *added], names=["vid", "curve", "key"])

    return data.select("vid", "v").mapInArrow(rows, "vid bigint, curve int, key bigint")


def placed(ordered: DataFrame, curves: int) -> DataFrame:
    """(vid, places): the rank of each vector on every curve, from 0, from the sizes of range partitions."""
    ranged = ordered.repartitionByRange("curve", "key", "vid").sortWithinPartitions("curve", "key", "vid")
    table = kept(ranged.withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()))
    sizes = table.groupBy("curve", "part").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    before = W.partitionBy("curve").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("curve", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("offset"))
    ranked = table.join(starts, ["curve", "part"]).withColumn("rank", F.col("row") + F.col("offset"))
    each = [F.max(F.when(F.col("curve") == c, F.col("rank"))) for c in range(curves)]
    found = kept(ranked.groupBy("vid").agg(F.array(*each).alias("places")))
    drop(ordered.sparkSession, table)
    return found


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    curves: int = CURVES,
    share: float = SHARE,
    dimensions: int = DIMENSIONS,
    bits: int = BITS,
    seed: int = 0,
    id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): about the k largest cosines per query, found on `curves` orderings.

    Every distinct vector lies on every curve; a query sees `share` of them on each. Rows without an id, and
    vectors that are null, zero, empty or hold null or non-finite components, take no part. A
    query's own id is no candidate, but other ids with its vector are; a pair of ids counts once if ids repeat. Vectors of
    unequal length are compared as if filled up with zeros. Ties go to the smaller id. Other columns are ignored.
    """
    v = F.col(vector)
    nonzero = F.coalesce(F.exists(v, lambda x: x.cast("double") != 0), F.lit(False))
    good = vectors.filter(F.col(id).isNotNull() & finite(v) & nonzero)
    given = good.select(F.col(id).cast("bigint").alias("id"), v.alias("v"), is_query.alias("query"))
    data = distinct_vectors(given.select("id", "v"), k + 1)
    asking = kept(members(given.filter("query").select("id", "v"), data, "vid").withColumnRenamed("vid", "qid"))
    rows, tasks = data.count(), int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = asking.select(F.col("qid").alias("vid")).distinct()
    wanted = asked.count()
    window = min(rows, max(2 * k + 1, -(-int(rows * share * 1000) // 1000)))
    size = block_rows(rows, tasks)
    salts = max(1, -(-int(wanted * (share + size / max(rows, 1))) // size))
    known = kept(data.join(placed(orderings(data, curves, seed, dimensions, bits), curves), "vid"))
    div = lambda a, b: F.call_function("div", a, F.lit(b)).cast("int")
    last = F.lit(max(0, rows - window))
    firsts = F.transform("places", lambda p: F.least(F.greatest(p - window // 2, F.lit(0)), last))
    left = (
        known.join(asked, "vid", "left_semi")
        .select(F.col("vid").alias("qid"), F.col("v").alias("v"), firsts.alias("firsts"))  # columns of its own, told apart from the other side's
        .withColumn("salt", F.pmod(F.xxhash64("qid"), F.lit(salts)).cast("int"))
        .select("*", F.posexplode("firsts").alias("curve", "first"))
        .withColumn("block", F.explode(F.sequence(div(F.col("first"), size), div(F.col("first") + window - 1, size))))
    )
    spots = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    right = (
        known.select("vid", "v", "ids", "places", F.posexplode("places").alias("curve", "at"))
        .withColumn("block", div(F.col("at"), size))
        .withColumn("salt", spots)
    )

    def pairs(asked: pa.Table, data: pa.Table) -> pa.Table:
        found = []
        if asked.num_rows and data.num_rows:
            curve = asked["curve"][0].as_py()
            q, v = (m.astype(np.float64) for m in both(asked["v"], data["v"]))
            firsts, places = matrix(asked["firsts"]), matrix(data["places"])
            q_ids = asked["qid"].to_numpy()
            ids, owner = list_rows(data["ids"])
            begin = np.searchsorted(owner, np.arange(len(v) + 1))
            for part in slices(len(q), len(v)):
                near, inside = cosines(q[part], v), in_windows(firsts[part], places, window, curve)
                for row in np.flatnonzero(inside.any(1)).tolist():
                    top = closest(near[row], inside[row], ids, begin, k + 1)
                    scores = cosine(q[part.start + row], v[top])
                    found.append((np.full(len(top), q_ids[part.start + row]), top, scores))
        if not found:
            return pa.table({"qid": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        qid, row, score = (np.concatenate(c) for c in zip(*found))
        n = begin[row + 1] - begin[row]
        each = np.repeat(begin[row] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return pa.table({"qid": np.repeat(qid, n), "vec_id": ids[each], "score": np.repeat(score, n)})

    by = ["curve", "block", "salt"]
    met = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(pairs, PAIRS)
    result = kept(for_members(met, asking, k))
    drop(vectors.sparkSession, data, asking, known)
    return result


def cosines(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cosines of all rows with all rows, but for rounding."""
    q, v = (m / np.abs(m).max(1, initial=0, keepdims=True) for m in (q, v))
    q, v = (m / np.sqrt((m * m).sum(1, keepdims=True)) for m in (q, v))
    return q @ v.T


def cosine(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cosines of one vector with some, by one formula wherever a pair is met."""
    return (v * q).sum(1) / (np.sqrt((v * v).sum(1)) * np.sqrt((q * q).sum()))


def in_windows(firsts: np.ndarray, places: np.ndarray, window: int, curve: int) -> np.ndarray:
    """Which pairs this curve's window holds and no earlier curve's does."""

    def held(c: int) -> np.ndarray:
        at = places[:, c] - firsts[:, c : c + 1]
        return (at >= 0) & (at < window)

    inside = held(curve)
    for c in range(curve):
        inside &= ~held(c)
    return inside


def closest(near: np.ndarray, inside: np.ndarray, ids: np.ndarray, begin: np.ndarray, want: int) -> np.ndarray:
    """Columns with the highest scores, as many as it takes to have `want` different ids; all that may tie with the last but for rounding."""
    columns = np.flatnonzero(inside)
    take = want
    while True:
        if take >= len(columns):
            return columns
        scores = near[columns]
        least = np.partition(scores, len(scores) - take)[len(scores) - take]
        top = columns[scores >= least - 1e-9]
        if len(np.unique(np.concatenate([ids[begin[c] : begin[c + 1]] for c in top]))) >= want:
            return top
        take *= 2
