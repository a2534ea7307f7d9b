"""Poisson replication: sources mixed to target weights by repeating and leaving out documents.

A source of n documents that should make up the share w of a mixture of N documents has the
mean repetition rate r = w * N / n. Each document draws its count from a Poisson
distribution with mean r by inverting it at a number hashed from seed, id and text, so the
draw needs no coordination, is the same on every run and has the right mean for any rate.
A rate above `PART_MEAN` is split into equal parts with a draw each (sums of independent
Poisson draws are Poisson), which keeps the inversion tables short and spreads the copies of
a much repeated document over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .ranks import ranked
from .sharding import free
from .store import kept

PART_MEAN = 16.0
#: Terms of the inversion table beyond which the rest of a distribution with mean 16 is below 2^-53.
TERMS = 80

HEX = 13


def hashed(*columns: Column) -> Column:
    """MD5 of the columns joined by |, nulls as the word null."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("null")) for c in columns]).cast("binary"))


def hash_unit(digest: Column) -> Column:
    """The first 52 bits of a hex digest as a number from 0 to below 1."""
    return F.conv(F.substring(digest, 1, HEX), 16, 10).cast("bigint").cast("double") * F.lit(2.0 ** (-4 * HEX))


def tempered(docs: DataFrame, exponent: float, epochs: float = 1.0, key: str = "source") -> DataFrame:
    """Rates (key, rate) for weights in proportion to n ** exponent; the mixture is `epochs` tables long."""
    counts = docs.groupBy(key).agg(F.count("*").cast("double").alias("n"))
    counts = counts.withColumn("share", F.pow("n", F.lit(float(exponent))))
    shares, rows = (counts.agg(F.sum(c)).scalar() for c in ("share", "n"))
    return counts.select(key, (F.col("share") / shares * rows * F.lit(float(epochs)) / F.col("n")).alias("rate"))


def weighted(docs: DataFrame, weights: dict[str, float], epochs: float = 1.0, key: str = "source") -> DataFrame:
    """Rates for given weights; a source without a weight has rate 0."""
    spark = docs.sparkSession
    total = sum(weights.values())
    given = spark.createDataFrame([(k, float(w) / total) for k, w in weights.items()], f"{key} string, share double")
    counts = docs.groupBy(key).agg(F.count("*").alias("n"))
    rows = counts.agg(F.sum("n")).scalar()
    return counts.join(given, key).select(key, (F.col("share") * rows * F.lit(float(epochs)) / F.col("n")).alias("rate"))


def thresholds(mean: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... of a Poisson distribution, up to `TERMS`."""
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("sum"), F.array(F.exp(-mean)).alias("all"))

    def add(acc: Column, i: Column) -> Column:
        p = acc["p"] * mean / i
        return F.struct(p.alias("p"), (acc["sum"] + p).alias("sum"), F.concat(acc["all"], F.array(acc["sum"] + p)).alias("all"))

    steps = F.sequence(F.lit(1), F.lit(TERMS)).cast("array<double>")
    return F.aggregate(steps, start, add, lambda acc: acc["all"])


def replicate(docs: DataFrame, rates: DataFrame, seed: int = 0, id: str = "doc_id", text: str = "text", key: str = "source") -> DataFrame:
    """One row per copy of a document, with `part`, `copy` (from 1 within a part) and `shuffle_key`.

    Rows with equal id and text have equal draws. Null ids and texts draw like any other value;
    a null source is a source. A document of a source that `rates` does not hold is left out, and
    so is one whose count is 0. An empty table gives an empty one. Names of other columns
    must not be `part`, `copy` or `shuffle_key`.
    """
    free(docs, "part", "copy", "shuffle_key", "__source", "__parts", "__cdf", "__body", "__u", "__count")
    parts = F.greatest(F.ceil(F.col("rate") / F.lit(PART_MEAN)), F.lit(1))
    table = kept(
        rates.filter(F.col("rate") > 0).select(
            F.col(key).alias("__source"), parts.alias("__parts"), thresholds(F.col("rate") / parts).alias("__cdf")
        )
    )
    drawn = docs.join(table, F.col(key).eqNullSafe(F.col("__source")))
    # a digest of the text stands for it in the hashes of its copies
    body = F.coalesce(F.md5(F.col(text).cast("binary")), F.lit("null"))
    parts_of = F.explode(F.sequence(F.lit(1), F.col("__parts").cast("int")))
    drawn = drawn.withColumn("__body", body).withColumn("part", parts_of)
    u = hash_unit(hashed(F.lit(seed), F.col(id), F.col("__body"), F.col("part")))
    drawn = drawn.withColumn("__u", u)
    count = F.size(F.filter("__cdf", lambda p: p <= F.col("__u")))
    drawn = drawn.withColumn("__count", count).filter(F.col("__count") > 0)
    copies = drawn.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__count"))))
    mixed = copies.withColumn(
        "shuffle_key", hashed(F.lit(seed), F.lit("order"), F.col(id), F.col("__body"), F.col("part"), F.col("copy"))
    )
    return mixed.drop("__source", "__parts", "__cdf", "__body", "__u", "__count")


def shuffled(copies: DataFrame) -> DataFrame:
    """Copies dealt out at random over all partitions, each in a random order."""
    return copies.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def positions(copies: DataFrame) -> DataFrame:
    """Add `position`, from 0 without gaps: the place in the global random order. A column of that name is an error."""
    free(copies, "position")
    return ranked(copies, [], hash_unit(F.col("shuffle_key")), ["shuffle_key"], "position")
