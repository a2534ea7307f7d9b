import math
import re
from collections import Counter

import numpy as np
import pytest

from optionflow.llm import lexical, queries

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k):
    """(item, rank, doc, score) by scoring every document for every item."""
    held = [(i, Counter(t), len(t)) for i, text in docs if (t := terms(text))]
    n, length = len(held), sum(x for _, _, x in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    rows = []
    for item, wanted in asked.items():
        found = []
        for doc, count, size in held:
            m = 100 - 50 + (50 * size * n) // length
            score = 0
            for t in wanted & set(count):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * count[t]) // (1000 * count[t] + 20 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        rows += [(item, r + 1, doc, -score) for r, (score, _, _, doc) in enumerate(sorted(found, key=lambda x: x[:3])[:k])]
    return sorted(rows, key=str)


def made():
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(60)] + ["Été", "ÀB", "a1b2", "straße"]
    docs = []
    for i in range(400):
        size = int(rng.integers(1, 40))
        docs.append((i, " ".join(words[int(j)] for j in (rng.zipf(1.4, size) - 1) % len(words))))
    docs += [(500 + i, docs[3][1]) for i in range(150)] + [(3, docs[3][1])] * 2 + [(None, docs[3][1]), (None, "W1 w2")]
    docs += [(700, None), (701, ""), (702, "... !?"), (703, "w5 " * 50_000), (704, "W1,w2;w3\x00w4\x7fw6")]
    items = [(i, " ".join(words[int(j)] for j in rng.integers(0, len(words), 6))) for i in range(25)]
    items += [(30, None), (31, ""), (32, "unheard of"), (33, "w1 W1 w1"), (5, "w9 w10"), (None, "w7"), (34, " ".join(words) + " " + " ".join(f"q{i}" for i in range(90)))]
    return docs, items


def tables(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1.0, "x") for i, t in docs], "doc_id bigint, text string, score double, item_id string")
    return d, spark.createDataFrame([(i, t, 2) for i, t in items], "item_id bigint, text string, rank int")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("k", [1, 7, 50])
def test_search_equals_scoring_everything(spark, k):
    docs, items = made()
    d, i = tables(spark, docs, items)
    assert rows(lexical.search(d, i, k)) == brute(docs, items, k)


def test_search_in_small_blocks_and_groups(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 32)
    monkeypatch.setattr(lexical, "FIRST", 1)
    docs, items = made()
    d, i = tables(spark, docs, items)
    assert rows(lexical.search(d.repartition(3), i, 5, group_bytes=400)) == brute(docs, items, 5)


def test_query_equals_scoring_everything(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert rows(queries.op13_mask_grouped_search(spark, SF)) == brute(docs, items, 50)


def test_empty_tables(spark):
    docs, items = tables(spark, [], [])
    full_docs, full_items = tables(spark, [(1, "w1"), (2, None)], [(1, "w1")])
    for d, i in ((docs, items), (docs, full_items), (full_docs, items)):
        got = lexical.search(d, i)
        assert got.count() == 0 and got.columns == ["item_id", "rank", "doc_id", "score"]
    # with one document every weight is floor(1000 ln(4 / 3))
    assert [tuple(r) for r in lexical.search(full_docs, full_items).collect()] == [(1, 1, 1, 287 * (10**9 // (1000 + 20 * 100)))]


def test_few_groups_are_read():
    rng = np.random.default_rng(7)
    n = 20_000
    term = np.concatenate([np.full(int(p * n), t) for t, p in enumerate((0.5, 0.3, 0.1, 0.01))])
    place = np.concatenate([np.sort(rng.permutation(n)[: int(p * n)]) for p in (0.5, 0.3, 0.1, 0.01)])
    by_doc = np.lexsort((term, place))
    sizes = np.bincount(place, minlength=n)
    block = lexical.Block(np.arange(n), np.zeros(n, bool), np.full(n, 9), sizes, term[by_doc], np.ones(len(term), np.int64), n, 9 * n)
    weight = np.array([500, 1000, 2000, 4000])
    seen = []

    def counting(*a):
        seen.append(len(a[0]))
        return order(*a)

    order, lexical.order = lexical.order, counting
    try:
        none = (np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64))
        best = lexical.better(none, block, np.arange(4), weight, 10)
    finally:
        lexical.order = order
    dense = np.zeros(n, np.int64)
    for t in range(4):
        dense[place[term == t]] += weight[t] * block.values[0]
    assert best[2].tolist() == np.lexsort((np.arange(n), -dense))[:10].tolist() and sum(seen) < n / 20
