"""Registered queries of the subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import hilbert, language, lexical, licenses, mixing, ngram_join, packing, repeats, secrets, sharding, vafile, warc, whitening
from .store import kept

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SHARDS = 24


@query
def op2_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.coalesce(F.col("text"), F.lit(""))
    sizes = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.octet_length(body) + 8).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    dealt = sharding.shards(sizes, "source", ["doc_id", "text_crc32", "size"], SHARDS)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )


@query
def op3_poisson_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    copies = mixing.replicate(docs, mixing.tempered(docs, 0.7), seed=3).drop("text")
    return mixing.positions(kept(copies)).select("doc_id", "source", "part", "copy", "position")


@query
def op4_confirmed_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.drop("clean_text")


@query
def op9_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, records = warc.archive(table(spark, sf_dir, "pages"), blocks=False)
    return records.select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"
    )


def every_50th(df: DataFrame) -> DataFrame:
    """The stated query set of the searches."""
    return df.filter(F.col("vec_id") % 50 == 0)


@query
def op1_va_file_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vafile.topk(vectors, every_50th(vectors), k=5)


@query
def op5_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op10_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op7_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, ~language.held_out(F.col("doc_id")))
    labelled = language.predict(docs, model, keep=["doc_id"])
    return labelled.select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), "lang_spans"
    )


@query
def op8_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"])


@query
def op6_ngram_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.link_components(table(spark, sf_dir, "documents"), n=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op11_suffix_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.deduplicate(table(spark, sf_dir, "documents"), keep=[], texts=False)


@query
def op12_polarised_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_mask_grouped_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)
