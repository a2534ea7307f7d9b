"""Ranked lexical search by groups of documents that match the same terms of an item.

A task holds a block of documents as one bitmap position per document and term. For an item, the
documents of the block are grouped by their presence mask: bit t is set where the document holds the
item's term t. No document of a group can score more than the sum, over the mask's terms, of the term's
best score in the block. Groups are read by falling bound, and reading ends when no bound that is left
reaches the k-th best score so far, which a task carries from block to block. So each task hands on
at most k rows per item, and Spark merges those.

The corpus is read as text once: what is kept of a document are its length and, of the terms
that items ask for, its counts. Items are taken in groups of at most `GROUP_BYTES` of text, so what
tasks are sent does not grow with the number of items.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .store import drop, kept
from .texts import portions

#: Text of items that are asked for together; documents and term counts in a block.
GROUP_BYTES, BLOCK_DOCS, BLOCK_COUNTS = 1 << 22, 1 << 15, 1 << 21

#: Documents that are scored at first, as a multiple of k.
FIRST = 4

#: Digits, letters and all bytes of letters beyond ASCII make terms; capital ASCII letters are lowered.
LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


def item_terms(items: DataFrame, id: str, text: str) -> DataFrame:
    """(item, term): the distinct terms of each item; rows of one id are one item."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(t))) for part in portions(batch.column(1)) for t in part]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], names=["item", "terms"])

    read = items.select(F.col(id).cast("bigint").alias("item"), F.col(text).cast("binary").alias("text"))
    return read.mapInArrow(rows, "item bigint, terms array<binary>").select("item", F.explode("terms").alias("term")).distinct()


def counted(docs: DataFrame, vocabulary: dict[bytes, int], id: str, text: str) -> DataFrame:
    """(doc, n, terms, counts) of every document with a term: its length and the counts of the vocabulary's terms in it."""
    size = max(1, len(vocabulary))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, sizes, found, counts = [], [], [], []
            for part in portions(batch.column(1)):
                words = [terms(t) for t in part]
                length = np.array([len(w) for w in words], np.int64)
                term = np.fromiter(map(vocabulary.get, chain.from_iterable(words), repeat(-1)), np.int64, int(length.sum()))
                del words
                doc = np.repeat(np.arange(len(length)), length)[term >= 0]
                both, count = np.unique(doc * size + term[term >= 0], return_counts=True)
                lengths.append(length)
                sizes.append(np.bincount(both // size, minlength=len(length)))
                found.append(both % size)
                counts.append(count)
            if not lengths:
                continue
            length, offsets = np.concatenate(lengths), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            lists = [
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(x), pa.int32())) for x in (found, counts)
            ]
            made = pa.RecordBatch.from_arrays([batch.column(0), pa.array(length), *lists], names=["doc", "n", "terms", "counts"])
            yield made.filter(pa.array(length > 0))

    read = docs.select(F.col(id).cast("bigint").alias("doc"), F.col(text).cast("binary").alias("text"))
    return read.mapInArrow(rows, "doc bigint, n bigint, terms array<int>, counts array<int>")


class Block:
    """Documents with, for each term, the places of those that hold it and what it adds there before its weight."""

    def __init__(self, ids: np.ndarray, nulls: np.ndarray, n: np.ndarray, sizes: np.ndarray, term: np.ndarray, count: np.ndarray, docs: int, length: int):
        self.ids, self.nulls = ids, nulls
        m = 50 + 50 * n * docs // length
        place = np.repeat(np.arange(len(n)), sizes)
        value = 1_000_000_000 * count // (1000 * count + 20 * m[place])
        order = np.argsort(term, kind="stable")
        self.terms, self.starts = np.unique(term[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(term))
        self.places, self.values = place[order], value[order]
        self.most = np.maximum.reduceat(self.values, self.starts) if len(term) else np.empty(0, np.int64)

    def of(self, term: np.ndarray, weight: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Places and scores of each of an item's terms that the block has, and the terms' best scores."""
        at = np.searchsorted(self.terms, term)
        here = (at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == term) & (weight > 0) if len(self.terms) else at < 0
        at, w = at[here], weight[here]
        spans = list(zip(self.starts[at].tolist(), self.ends[at].tolist()))
        return [self.places[a:b] for a, b in spans], [self.values[a:b] * x for (a, b), x in zip(spans, w)], self.most[at] * w


def masks(places: list[np.ndarray], docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents that hold a term, the distinct masks over the terms (rows of 64-bit words), and each document's mask."""
    bits = np.zeros((docs, max(1, -(-len(places) // 64))), np.uint64)
    for t, p in enumerate(places):
        bits[p, t // 64] |= np.uint64(1 << t % 64)
    held = np.flatnonzero(bits.any(1))
    if bits.shape[1] == 1:
        distinct, which = np.unique(bits[held, 0], return_inverse=True)
        return held, distinct[:, None], which
    distinct, which = np.unique(bits[held], axis=0, return_inverse=True)
    return held, distinct, which.ravel()


def order(scores: np.ndarray, nulls: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The k best: highest score first, then the smaller id, null ids last."""
    return np.lexsort((ids, nulls, -scores))[:k]


Best = tuple[np.ndarray, np.ndarray, np.ndarray]  # scores, whether ids are null, ids


def better(best: Best, block: Block, term: np.ndarray, weight: np.ndarray, k: int) -> Best:
    """The k best of `best` and the block's documents for an item of these terms."""
    places, scores, most = block.of(term, weight)
    least = best[0][k - 1] if len(best[0]) >= k else 1
    if int(most.sum()) < least:
        return best
    held, distinct, which = masks(places, len(block.ids))
    bound = np.zeros(len(distinct), np.int64)
    for t, b in enumerate(most.tolist()):
        bound += ((distinct[:, t // 64] >> np.uint64(t % 64)) & np.uint64(1)).astype(np.int64) * b
    members = np.bincount(which, minlength=len(distinct))
    falling = np.argsort(-bound, kind="stable")
    behind = np.cumsum(members[falling])
    done, read = 0, 0
    while done < len(falling) and bound[falling[done]] >= least:
        # as many groups as double the documents read, of those that can still matter
        stop = int(np.searchsorted(behind, read + max(FIRST * k, read))) + 1
        stop = min(stop, done + int((bound[falling[done:]] >= least).sum()))
        taken = np.zeros(len(distinct), bool)
        taken[falling[done:stop]] = True
        docs = held[taken[which]]
        score = np.zeros(len(docs), np.int64)
        for p, s in zip(places, scores):
            at = np.minimum(np.searchsorted(p, docs), len(p) - 1)
            score += np.where(p[at] == docs, s[at], 0)
        docs, score = docs[score >= least], score[score >= least]
        merged = tuple(np.concatenate(x) for x in zip(best, (score, block.nulls[docs], block.ids[docs])))
        top = order(*merged, k)
        best = tuple(x[top] for x in merged)
        least = best[0][k - 1] if len(best[0]) >= k else 1
        done, read = stop, int(behind[stop - 1])
    return best


def blocks(batches: Iterator[pa.RecordBatch], docs: int, length: int) -> Iterator[Block]:
    held: list[tuple[np.ndarray, ...]] = []
    rows = counts = 0

    def block() -> Block:
        return Block(*(np.concatenate(x) for x in zip(*held)), docs, length)

    for batch in batches:
        for a in range(0, batch.num_rows, BLOCK_DOCS):
            b = batch.slice(a, BLOCK_DOCS)
            doc, found, count = b.column(0), b.column(2), b.column(3)
            held.append(
                (
                    doc.fill_null(0).to_numpy(zero_copy_only=False),
                    doc.is_null().to_numpy(zero_copy_only=False),
                    b.column(1).to_numpy(zero_copy_only=False),
                    np.diff(found.offsets.to_numpy()),
                    found.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                    count.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                )
            )
            rows, counts = rows + b.num_rows, counts + len(held[-1][4])
            if rows >= BLOCK_DOCS or counts >= BLOCK_COUNTS:
                yield block()
                held, rows, counts = [], 0, 0
    if held:
        yield block()


def ranked(found: DataFrame, k: int) -> DataFrame:
    along = W.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(along)).filter(F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score")


def best_of(docs: DataFrame, asked: list[tuple[int | None, list[bytes]]], k: int, id: str, text: str) -> DataFrame:
    """The best k rows of each task for each of these items."""
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, found in asked for t in found}))}
    table = kept(counted(docs, vocabulary, id, text))
    total = table.agg(F.count("*").alias("docs"), F.sum("n").alias("length")).first()
    n, length = total["docs"], total["length"] or 1
    holding = {r["term"]: r["count"] for r in table.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
    weights = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for t, df in holding.items()}
    items = []
    for item, found in asked:
        term = np.array(sorted(i for i in map(vocabulary.get, found) if i in weights), np.int64)
        items.append((item, term, np.array([weights[i] for i in term.tolist()], np.int64)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = (np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64))
        best: list[Best] = [none] * len(items)
        for block in blocks(batches, n, length):
            best = [better(b, block, term, weight, k) for b, (_, term, weight) in zip(best, items)]
        which = [item for b, (item, _, _) in zip(best, items) for _ in range(len(b[0]))]
        score, nulls, ids = (np.concatenate(x) for x in zip(none, *best))
        columns = [pa.array(which, pa.int64()), pa.array(ids, pa.int64(), mask=nulls), pa.array(score, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["item_id", "doc_id", "score"])

    found = kept(ranked(table.mapInArrow(rows, "item_id bigint, doc_id bigint, score bigint"), k))
    drop(docs.sparkSession, table)
    return found


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, id: str = "doc_id", item: str = "item_id", text: str = "text", group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring documents per item with a score above 0.

    Equal scores go by ascending doc_id, null ids last. A null or empty text has no terms: such a document
    counts nowhere, such an item has no rows. Rows of documents with one id are documents of their own; rows
    of items with one id (null too) are one item of all their terms. Other columns are ignored. An empty table on
    either side gives no rows.
    """
    asked = kept(item_terms(items, item, text))
    size = asked.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    groups = -(-size // group_bytes)
    found = None
    for g in range(groups):
        mine = asked.filter(F.pmod(F.xxhash64("item"), F.lit(groups)) == g)
        lists = [(r["item"], [bytes(t) for t in r["terms"]]) for r in mine.groupBy("item").agg(F.collect_list("term").alias("terms")).collect()]
        if lists:
            some = best_of(docs, lists, k, id, text)
            found = some if found is None else found.unionAll(some)
    drop(docs.sparkSession, asked)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return found.select("item_id", "rank", "doc_id", "score")
