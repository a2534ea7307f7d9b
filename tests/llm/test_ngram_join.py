import random
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from optionflow.llm import ngram_join
from optionflow.llm.components import components
from optionflow.llm.shingles import Shingles


def shingle_set(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def brute(rows, n, percent):
    """component id per row number, over (id, text) rows."""
    sets = [shingle_set(t, n) for _, t in rows]
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                group[root(i)] = root(j)
    least = defaultdict(list)
    for k, (id, _) in enumerate(rows):
        if id is not None:
            least[root(k)].append(id)
    return [(id, len(sets[k]), min(least[root(k)], default=None)) for k, (id, _) in enumerate(rows)]


def corpus(seed):
    """Unrelated texts, exact copies, near copies at about the threshold, and a passage that many share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(30)]
    texts = []
    for _ in range(25):
        texts.append(" ".join(word() for _ in range(rng.randrange(1, 80))))
    for _ in range(12):
        texts.append(" ".join([*(word() for _ in range(rng.randrange(0, 12))), *passage, *(word() for _ in range(rng.randrange(0, 12)))]))
    for size in (3, 20, 120):
        base = [word() for _ in range(size)]
        for _ in range(20):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + size // 25)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(rng.choice([" ", "\n", "\t "]).join(copy).upper() if rng.random() < 0.3 else " ".join(copy))
    texts += ["", None, "  \n ", "one", "one", "One\x0bTWO", "é\x85é É", "é\x85é é"]
    rng.shuffle(texts)
    rows = [(k * 3 + 1, t) for k, t in enumerate(texts)]
    return [*rows, (None, "null id"), (None, texts[0]), (rows[5][0], rows[5][1]), (rows[6][0], rows[6][1])]


@pytest.mark.parametrize("n, percent, seed", [(4, 85, 1), (5, 80, 2)])
def test_components_equal_brute_force(spark, n, percent, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, fp string")
    got = ngram_join.link_components(df, n, percent).select("doc_id", "n_shingles", "component_id")
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(brute(rows, n, percent), key=key)


def test_long_lists_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SHORT_LIST", 3)
    monkeypatch.setattr(ngram_join, "CHUNK_SETS", 5)
    rows = corpus(3)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = ngram_join.link_components(df, 4, 85).select("doc_id", "n_shingles", "component_id")
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(brute(rows, 4, 85), key=key)


def test_one_of_each_group_stays(spark):
    rows = corpus(4)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, root string")
    got = ngram_join.one_each(df, 5, 80)
    assert got.columns == df.columns
    want = {c for id, _, c in brute(rows, 5, 80) if c is not None}
    ids = [r.doc_id for r in got.collect()]
    assert set(ids) - {None} == want and len([i for i in ids if i is not None]) == len(want)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert ngram_join.link_components(df).count() == 0 and ngram_join.one_each(df).count() == 0


def test_prefix_and_sketch_never_lose_a_link():
    rng = np.random.default_rng(0)
    rule = ngram_join.Rule(85)
    for _ in range(300):
        common = int(rng.integers(1, 200))
        a_only, b_only = (int(x) for x in rng.integers(0, 20, 2))
        x = rng.integers(0, 2**63, common + a_only + b_only).astype(np.uint64)
        a, b = x[: common + a_only], np.concatenate([x[:common], x[common + a_only :]])
        if not rule.linked(common, len(a), len(b)):
            continue
        assert set(np.sort(a)[: rule.prefix(len(a))]) & set(np.sort(b)[: rule.prefix(len(b))])
        assert ngram_join.apart(ngram_join.odd_sketch(a), ngram_join.odd_sketch(b)) <= a_only + b_only
        assert a_only + b_only <= rule.may_differ(np.int64(len(a)), np.int64(len(b)))


def test_counters_travel_in_few_bytes_and_come_back():
    rng = np.random.default_rng(0)
    counts = rng.poisson(0.2, 1 << 16).astype(np.uint32)
    counts[rng.integers(0, 1 << 16, 50)] = [256, 65535] * 25
    data = ngram_join.packed(counts)
    assert (ngram_join.unpacked(data) == counts).all() and len(data) < (1 << 16) / 8
    for counts in (np.zeros(1 << 14, np.uint32), np.full(1 << 14, 300, np.uint32)):
        assert (ngram_join.unpacked(ngram_join.packed(counts)) == counts).all()


def test_ranks_rise_with_counts_and_tell_tokens_that_are_alone(spark):
    words = [f"w{k} x{k} y{k} z{k}" for k in range(300)]
    often = "o p q r"
    rows = [(k, w) for k, w in enumerate(words)] + [(1000 + k, often) for k in range(200)] + [(2000, words[0])]
    texts = spark.createDataFrame(rows, "id bigint, text string").withColumn("text", F.col("text").cast("binary"))
    ranks = ngram_join.frequency_classes(texts, 4)
    shift = np.uint64(64 - (len(ranks) - 1).bit_length())
    rank = lambda t: int(ranks[Shingles(4).of([t.encode()])[0] >> shift][0])
    assert rank(often) >= ngram_join.FREQUENT > rank(words[0]) > ngram_join.ALONE
    assert sum(rank(w) == ngram_join.ALONE for w in words[1:]) > 250  # but for a few that share a counter


def test_few_rows_are_moved_beside_the_wanted(spark):
    df, wanted = spark.range(100_000), spark.range(0, 100_000, 50).withColumnRenamed("id", "m")
    near = ngram_join.likely(df, F.col("id"), wanted, F.col("m"), 2000).cache()
    assert near.join(wanted, F.col("id") == F.col("m")).count() == 2000
    assert near.count() < 2000 + 3000


TOKEN = 2**62 + 1  # no float is equal


def test_a_list_whose_candidates_are_known_is_done():
    rule, rng = ngram_join.Rule(85), np.random.default_rng(1)
    shared = rng.integers(0, 2**63, 40).astype(np.uint64)

    def row(tokens):
        short = np.unique((tokens & np.uint64(0xFFFF)).astype("<u2"))
        more = (len(short).to_bytes(4, "little") + short.tobytes()) * 2
        return {"token": TOKEN, "fp": int(tokens.sum() >> np.uint64(1)), "size": len(tokens), "odd": ngram_join.odd_sketch(tokens), "more": more}

    def near(k):
        return [row(np.concatenate([shared, rng.integers(0, 2**63, 2).astype(np.uint64)])) for _ in range(k)]

    def far(k):
        return [row(np.concatenate([shared, rng.integers(0, 2**63, 200).astype(np.uint64)])) for _ in range(k)]

    look = ngram_join.closest_within(rule, 4)
    found = look(pd.DataFrame(near(5) + far(30)))
    assert found["token"].isna().all() and len(found) == 10  # all pairs of five
    found = look(pd.DataFrame(near(8) + far(30)))
    pairs = found[found["token"].isna()]
    assert found["token"].dropna().tolist() == [TOKEN] and pairs.groupby("a").size().max() == 4 and (pairs["b"] < pairs["a"]).all()
    assert not len(look(pd.DataFrame(far(30))))


def test_the_farthest_of_a_large_group_is_found_in_a_later_round(spark):
    """A set that is among the closest few of no other, in lists of which only some candidates are known."""
    rng = random.Random(6)
    base = [f"w{k}" for k in range(300)]
    rows = [(k, " ".join([*base, f"end{k}"])) for k in range(1, 60)]
    for k in range(60, 70):
        edge = list(base)
        for at in rng.sample(range(20, 280), 5):
            edge[at] = f"new{k}{at}"
        rows.append((k, " ".join(edge)))
    got = ngram_join.link_components(spark.createDataFrame(rows, "doc_id bigint, text string"), 4, 85)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == sorted(brute(rows, 4, 85))


def test_shingles_of_portions_do_not_mix():
    one = Shingles(4)
    alone = [one.of([t])[0].tolist() for t in (b"a b c d e", b"", b"A b", b"a b c d e f")]
    assert [s.tolist() for s in one.of([b"a b c d e", b"", b"A b", b"a b c d e f"])] == alone
    assert [len(s) for s in alone] == [2, 0, 1, 3]


def test_components_of_chains_stars_and_nothing(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
