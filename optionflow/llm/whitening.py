"""Whitening of embeddings by a covariance that exact sums of squares give.

Every component x becomes the whole number floor(256 * x). Of the distinct vectors, Spark sums up the squares of
every centred dimension and of every sum of two centred dimensions. By polarisation, a covariance is half
of what the variance of the sum is more than the two variances. All sums are whole numbers of any
size, so nothing is lost in the difference; only the d x d matrix reaches the driver, and its
eigenvectors whiten the rows in the tasks.

Values are centred on the whole number below the mean before they are squared. What is left of the mean, less than 1, is put
right in the totals: the sum of (n z - r)^2 is n^2 times the sum of z^2 less n r^2, as the z add up to r.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .store import drop, kept
from .vectors import finite, matrix

#: Bits of a part of a total that travels in a row.
PART = 32

#: Rows that a task squares at a time.
ROWS = 2048

#: Whole numbers below this are multiplied as 64-bit ones, if the sums fit too.
SMALL = 2**31


@dataclass(frozen=True)
class Model:
    """n distinct vectors with sums S; unit eigenvectors (columns) by falling eigenvalue, as far as above rounding."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def centre(self) -> list[int]:
        return [s // self.n for s in self.sums]


def whole(vector: Column, factor: float) -> Column:
    """Each component as floor(factor * x); an error where a long cannot hold it."""

    def one(x: Column) -> Column:
        scaled = x.cast("double") * F.lit(factor)
        fits = F.abs(scaled) < F.lit(2.0**63)
        return F.when(fits, F.floor(scaled)).otherwise(F.raise_error(F.lit("a component does not fit a long")))

    return F.transform(vector, one)


def rows_of(batch: pa.RecordBatch, column: int, width: int) -> Iterator[np.ndarray]:
    """The vectors of a column as matrices of at most `ROWS` rows, filled up with zeros."""
    for a in range(0, batch.num_rows, ROWS):
        yield matrix(batch.column(column).slice(a, ROWS), width)


def less(x: np.ndarray, centre: list[int]) -> np.ndarray:
    """x - centre, exact: as Python's whole numbers where 64 bits might not do."""
    largest = max([0, *map(abs, centre), *map(abs, (int(x.min(initial=0)), int(x.max(initial=0))))])
    kind = np.int64 if largest < SMALL else object
    return x.astype(kind) - np.array(centre, kind)


def squarable(z: np.ndarray, times: int) -> np.ndarray:
    """z in a type that holds the square of twice its entries, `times` of them summed up."""
    if z.dtype == object:
        return z
    largest = int(np.abs(z).max(initial=0))
    return z if 4 * largest * largest * times < 2**63 else z.astype(object)


def sums(x: np.ndarray) -> list[int]:
    return [int(s) for s in less(x, [0] * x.shape[1]).sum(0)]


def squares(x: np.ndarray, centre: list[int]) -> list[int]:
    """Sums of squares of each centred dimension, then of the sum of each two, pairs in order."""
    z = less(x, centre)
    z = squarable(z, len(z))
    found = [int(s) for s in (z * z).sum(0)]
    for i in range(z.shape[1] - 1):
        both = z[:, i + 1 :] + z[:, i : i + 1]
        found += [int(s) for s in (both * both).sum(0)]
    return found


def totals(rows: DataFrame, width: int, measure: Callable[[np.ndarray], list[int]]) -> list[int]:
    """`measure` of all vectors of a one-column table, summed up exactly: tasks add up, Spark adds 32-bit parts."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] = []
        for batch in batches:
            for x in rows_of(batch, 0, width):
                found = measure(x)
                total = [a + b for a, b in zip(total, found)] if total else found
        places, parts, values = [], [], []
        for place, value in enumerate(total):
            part = 0
            while not -(2**PART) < value < 2**PART:
                places.append(place), parts.append(part), values.append(value & (2**PART - 1))
                value, part = value >> PART, part + 1
            places.append(place), parts.append(part), values.append(value)
        columns = [pa.array(places, pa.int32()), pa.array(parts, pa.int32()), pa.array(values, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["place", "part", "value"])

    added = rows.mapInArrow(partial, "place int, part int, value bigint").groupBy("place", "part").agg(F.sum("value").alias("value"))
    result: dict[int, int] = {}
    for r in added.collect():
        result[r["place"]] = result.get(r["place"], 0) + (r["value"] << PART * r["part"])
    return [result[p] for p in sorted(result)]


def covariance(n: int, total: list[int], found: list[int]) -> np.ndarray:
    """The covariances (divisor n) from sums of the dimensions and `squares`; each is one rounded quotient of whole numbers."""
    d = len(total)
    rest = [s - n * (s // n) for s in total]
    # n^2 times the variance of each dimension and of each sum of two
    one = [n * a - r * r for a, r in zip(found, rest)]
    v = np.zeros((d, d))
    at = d
    for i in range(d):
        v[i, i] = one[i] / n**2
        for j in range(i + 1, d):
            two = n * found[at] - (rest[i] + rest[j]) ** 2
            v[i, j] = v[j, i] = (two - one[i] - one[j]) / (2 * n**2)
            at += 1
    return v


def usable(df: DataFrame, vector: str) -> DataFrame:
    return df.filter(finite(F.col(vector)))


def fit(df: DataFrame, vector: str = "embedding", factor: float = 256.0) -> tuple[Model | None, DataFrame]:
    """A model of the distinct vectors of floor(factor * x), and those vectors as a written table (`store.drop` removes it).

    Vectors that are null or hold null or non-finite components take no part; shorter ones are filled up
    with zeros. None if no vector is left or all are empty.
    """
    good = usable(df, vector)
    width = good.agg(F.max(F.size(vector))).first()[0] or 0
    x = whole(F.col(vector), factor)
    filled = F.concat(x, F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size(vector)))
    distinct = kept(good.select(filled.alias("x")).distinct())
    n = distinct.count()
    if not n or not width:
        return None, distinct
    total = totals(distinct, width, sums)
    centre = [s // n for s in total]
    v = covariance(n, total, totals(distinct, width, lambda x: squares(x, centre)))
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    real = values > max(values[0], 0.0) * width * np.finfo(float).eps
    return Model(n, tuple(total), values[real], np.ascontiguousarray(vectors[:, real]), float(np.trace(v))), distinct


def whitened(x: np.ndarray, model: Model, k: int) -> np.ndarray:
    """Centred rows on the first k components, each divided by its standard deviation."""
    rest = np.array([s % model.n / model.n for s in model.sums])
    z = less(x, model.centre).astype(np.float64) - rest
    return z @ model.vectors[:, :k] / np.sqrt(model.values[:k])


def deviations(x: np.ndarray, model: Model) -> list[int | None]:
    """The sum of (n x - S)^2 of each row; None where a long cannot hold it."""
    z = less(x, model.centre)
    largest = int(np.abs(z).max(initial=0)) + 1
    kind = z.dtype if z.dtype == object or x.shape[1] * (model.n * largest) ** 2 < 2**63 else object
    y = z.astype(kind) * model.n - np.array([s % model.n for s in model.sums], kind)
    return [int(s) if s < 2**63 else None for s in (y * y).sum(1)]


def identity_error(distinct: DataFrame, model: Model, k: int) -> float:
    """The largest absolute entry of the whitened vectors' covariance less the identity, measured on all of them."""
    width, size = len(model.sums), min(k, len(model.values))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for x in rows_of(batch, 0, width):
                w = whitened(x, model, size)
                total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(size * size), pa.int32()), pa.array(total.ravel())], names=["place", "value"])

    added = distinct.mapInArrow(partial, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    total = np.zeros(size * size)
    for r in added.collect():
        total[r["place"]] = r["value"]
    return float(np.abs(total.reshape(size, size) / model.n - np.eye(size)).max(initial=0.0))


def project(
    df: DataFrame, model: Model | None, k: int = 4, vector: str = "embedding", factor: float = 256.0, keep: list[str] | None = None
) -> DataFrame:
    """The columns `keep` (all, if None) of every usable row, with `deviation` and an array `whitened` of up to k components.

    Rows whose vector is null or holds null or non-finite components are left out; repeated rows and null
    ids stay. Components beyond the model's width count as none, missing ones as zero. There are fewer than k
    components if fewer have a variance above rounding, and no rows without a model. Columns named
    like the added ones are an error.
    """
    keep = df.columns if keep is None else keep
    added = [("deviation", T.LongType(), pa.int64()), ("whitened", T.ArrayType(T.DoubleType()), pa.list_(pa.float64()))]
    clash = sorted({c.lower() for c in keep} & {n for n, _, _ in added})
    if clash:
        raise ValueError(f"column names in use: {clash}")
    schema = T.StructType([*df.select(*keep).schema.fields, *(T.StructField(n, t) for n, t, _ in added)])
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    at, width, names = len(keep), len(model.sums), [*keep, *(n for n, _, _ in added)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far, flat, size = [], [], min(k, len(model.values))
            for x in rows_of(batch, at, width):
                far += deviations(x[:, :width], model)
                flat.append(whitened(x[:, :width], model, size).ravel())
            offsets = pa.array(np.arange(batch.num_rows + 1) * size, pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(flat) if flat else np.empty(0)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(far, pa.int64()), lists], names=names)

    x = whole(F.col(vector), factor)
    return usable(df, vector).select(*keep, x.alias("__x")).mapInArrow(rows, schema)


def whiten(df: DataFrame, k: int = 4, id: str = "vec_id", vector: str = "embedding", factor: float = 256.0) -> DataFrame:
    """A row per usable vector and component up to k: id, component (from 1), n, deviation, whitened, explained, identity_error.

    The model is that of `fit` on the same table. `explained` is the eigenvalue's share of the trace.
    Where all vectors are equal no component has a variance, so there are no rows.
    """
    model, distinct = fit(df, vector, factor)
    found = project(df, model, k, vector, factor, [id])
    size = min(k, len(model.values)) if model else 0
    error = identity_error(distinct, model, k) if size else 0.0
    drop(df.sparkSession, distinct)
    share = F.array(*[F.lit(float(e / model.trace)) for e in model.values[:size]]) if size else F.array().cast("array<double>")
    each = found.select(id, "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        id,
        (F.col("at") + 1).alias("component"),
        F.lit(model.n if model else 0).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        share[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
