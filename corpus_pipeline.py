"""From raw documents to packed training sequences.

Every stage reads what the one before it has written; all but the last return the columns of
`documents`.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from optionflow.llm import language, mixing, ngram_join, packing, secrets
from optionflow.llm.store import drop, kept

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A text stays if this share of its words has its language, and if this share of its letters stands in 3-grams that
#: some language was learned with: scripts that were not learned and random letters do not.
LEAST_SHARE, LEAST_KNOWN = 0.3, 0.5

#: Words per shingle and similarity, in percent, from which documents are near duplicates.
NEAR_WORDS, NEAR_PERCENT = 5, 80

#: Text that packing works on at a time.
PACKING_BYTES = 2_000_000

#: What stands for a secret; weights of sources are in proportion to this power of their row counts.
SECRET, TEMPER = "[secret]", 0.7


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters, those that no language holds `LEAST_SHARE` of and those of fewer known 3-grams than
    `LEAST_KNOWN`; fills in a missing lang. Columns named like those of `language.predict` are an error."""
    model = language.fit(docs, F.lit(True))
    labelled = language.predict(docs, model)
    known = (F.col("lang_score") >= LEAST_SHARE) & (F.col("lang_known") >= LEAST_KNOWN)
    held = labelled.filter((F.col("lang_pred") != language.NONE) & known)
    return held.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every group that n-gram links hold together."""
    return ngram_join.one_each(docs, NEAR_WORDS, NEAR_PERCENT)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts a mark in the place of every secret. Keeps all documents. Columns named like those of `secrets.scan` are an error."""
    clean = secrets.scan(docs, mark=SECRET).withColumn("text", F.col("clean_text"))
    return clean.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and leaves out documents so that sources have their target weights; shuffles the copies."""
    copies = mixing.replicate(docs, mixing.tempered(docs, TEMPER), seed=3)
    return mixing.shuffled(copies).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs token ids; a row per piece."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"], step_bytes=PACKING_BYTES, across_tasks=False)


STAGES: list[tuple[str, Stage]] = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secret_stage),
    ("mixture", mixture_stage),
    ("packing", packing_stage),
]

#: SQL expresses neither the language model nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        after = kept(stage(spark, docs, sf_dir))
        if number:
            drop(spark, docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
