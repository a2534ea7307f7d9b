"""One large JSON array, read by many tasks.

Spark splits the file at closing braces, whatever they close. Whether a piece begins inside a string, and how deep, follows from
running sums over the pieces before it: a string is open after an odd number of quotes, and what a piece adds to the
depth is known for either case. An element ends at a brace that brings the depth back to that of the array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators import ordered
from ..workspace import settled

#: Pieces per chunk of the running sums.
CHUNK_BITS = 16


def _nesting(parts: Column) -> Column:
    """Opening less closing brackets of texts outside strings."""
    text = F.array_join(parts, "")
    return (F.length(F.translate(text, "}]", "")) - F.length(F.translate(text, "{[", ""))).cast("bigint")


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The file cut at every closing brace: text, place, quotes and what it adds to the depth if it begins outside or inside a string."""
    read = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )
    # an escaped character is neither a quote nor a bracket; a piece never begins with one, as braces end pieces
    sections = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')
    return read.select(
        "*",
        ((F.size(sections) - 1) % 2).cast("bigint").alias("odd"),
        _nesting(F.filter(sections, lambda x, i: i % 2 == 0)).alias("outside"),
        _nesting(F.filter(sections, lambda x, i: i % 2 == 1)).alias("inside"),
    )


def elements(spark: SparkSession, path: str) -> DataFrame:
    """(file, seq, value): the array's objects as text, numbered in file order from 0."""
    cut = settled(pieces(spark, path))
    place = ["block", "id"]
    chunk = F.struct("block", F.shiftright("id", CHUNK_BITS))

    def running(df: DataFrame, **sums: Column) -> DataFrame:
        return ordered.running(df, ["file"], place, chunk, sums=sums)

    quoted = running(cut.drop("value"), quotes=F.col("odd"))
    within = (F.col("quotes") - F.col("odd")) % 2 == 1
    closes = F.when(F.col("quotes") % 2 == 0, 1).otherwise(0)  # whether the brace behind the piece is one
    step = F.when(within, F.col("inside")).otherwise(F.col("outside")) - closes
    deep = running(quoted.select("file", *place, step.alias("step"), closes.alias("closes")), depth=F.col("step"))
    last = F.when((F.col("depth") == 1) & (F.col("closes") == 1), 1).otherwise(0)
    numbered = running(deep.select("file", *place, last.alias("last")), ended=F.col("last"))
    of = numbered.select("file", *place, (F.col("ended") - F.col("last")).alias("seq"), "last")
    parts = cut.select("file", *place, "value").join(of, ["file", *place])
    whole = parts.groupBy("file", "seq").agg(
        F.sort_array(F.collect_list(F.struct(*place, "value"))).alias("parts"), F.max("last").alias("ended")
    )
    text = F.concat(F.array_join(F.transform("parts", lambda p: p["value"]), "}"), F.lit("}"))
    return whole.filter("ended = 1").select("file", "seq", F.regexp_replace(text, r"^\s*[\[,]\s*", "").alias("value"))


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The objects of a JSON array, with `seq`, their number in file order. Other elements of the array are left out."""
    found = elements(spark, path).select("seq", F.from_json("value", schema).alias("e"))
    return found.select("e.*", "seq")
