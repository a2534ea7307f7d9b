import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from optionflow.llm import queries, repeats, suffixes

SF = "/root/testdata/sf0.001"


def brute(rows, least):
    """(id, n_bytes, n_removed, n_spans, sha256) per row, by looking up every string of every document."""
    smallest = {}
    for i, text in rows:
        body = (text or "").encode()
        if i is not None:
            for a in range(len(body) - least + 1):
                s = body[a : a + least]
                smallest[s] = min(smallest.get(s, i), i)
    found = []
    for i, text in rows:
        body = (text or "").encode()
        gone = np.zeros(len(body) + 1, bool)
        if i is not None:
            for a in range(len(body) - least + 1):
                if smallest[body[a : a + least]] < i:
                    gone[a : a + least] = True
        left = bytes(b for b, g in zip(body, gone) if not g)
        spans = int((gone[:-1] & ~gone[1:]).sum())
        found.append((i, len(body), len(body) - len(left), spans, hashlib.sha256(left).hexdigest()))
    return sorted(found, key=str)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in df.collect()), key=str)


def made():
    rng = np.random.default_rng(8)

    def prose(n):
        return "".join(rng.choice(list("abcdefg é\n"), n))

    passage, line = prose(90), prose(52)
    rows = [(i, prose(int(rng.integers(0, 200)))) for i in range(40)]
    rows += [(100 + i, prose(30) + passage + prose(int(rng.integers(0, 40)))) for i in range(60)]
    rows += [(200 + i, rows[45][1]) for i in range(30)] + [(300, line + prose(3) + line), (301, line), (302, line[:49]), (303, line[1:51])]
    rows += [(400, "ab" * 4000), (401, "x" + "ba" * 100), (402, " " * 500), (403, " " * 60), (404, "\0" * 70), (405, "\0" * 55)]
    rows += [(500, None), (501, ""), (45, passage), (45, rows[45][1]), (None, passage), (None, rows[45][1]), (600, prose(60_000)), (-1, line + passage)]
    rows.append((601, rows[-2][1][100:50_000]))
    return rows


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1.5, "x") for i, t in rows], "doc_id bigint, text string, portion double, bucket string")


def test_every_byte_equals_brute_force(spark):
    rows = made()
    assert rows_of(repeats.deduplicate(table(spark, rows))) == brute(rows, 50)


@pytest.mark.parametrize("least", [1, 3, 20, 64])
def test_other_lengths(spark, least):
    rows = [(i, t and t[:300]) for i, t in made()[::2]]
    assert rows_of(repeats.deduplicate(table(spark, rows), least)) == brute(rows, least)


def test_small_portions_buckets_and_hot_anchors(spark, monkeypatch):
    for name, value in (("PORTION", 700), ("ANCHOR_BUCKET", 3000), ("STRETCH_BUCKET", 2000), ("SORTED", 500), ("HOT", 3), ("MOST_WINDOWS", 7)):
        monkeypatch.setattr(repeats, name, value)
    rows = made()
    assert rows_of(repeats.deduplicate(table(spark, rows).repartition(5))) == brute(rows, 50)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert rows_of(queries.op11_suffix_intervals(spark, SF)) == brute(rows, 50)


def test_texts_and_columns_travel(spark):
    rows = [(2, "z" * 10 + "q" * 60, 1.5, "two"), (1, "q" * 55, None, "one"), (3, None, 2.5, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, portion double, kept string")
    got = {r.doc_id: r for r in repeats.deduplicate(df).collect()}
    assert bytes(got[2].kept_text) == b"z" * 10 and got[2].removed_spans == [[10, 70]] and (got[2].portion, got[2].kept) == (1.5, "two")
    assert bytes(got[1].kept_text) == b"q" * 55 and got[1].removed_spans == [] and (got[3].n_bytes, got[3].kept) == (0, None)
    with pytest.raises(ValueError, match="n_bytes"):
        repeats.deduplicate(df.withColumnRenamed("kept", "N_Bytes"))


def test_empty_table(spark):
    assert repeats.deduplicate(table(spark, [])).count() == 0
    nulls = table(spark, [(None, None), (1, None)])
    assert rows_of(repeats.deduplicate(nulls)) == brute([(None, None), (1, None)], 50)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", min_size=0, max_size=30), min_size=1, max_size=6), st.integers(1, 12))
def test_borders_are_where_prefixes_differ(texts, least):
    symbols, _ = suffixes.joined([t.encode() for t in texts])
    n = len(symbols)
    order = suffixes.suffix_order(symbols, least)
    prefix = [tuple(symbols[(i + j) % n] for j in range(least)) for i in order]
    assert sorted(order) == list(range(n)) and prefix == sorted(prefix)
    border = suffixes.borders(symbols[order - 1], least)
    assert border.tolist() == [True, *(a != b for a, b in zip(prefix, prefix[1:]))]


def test_hashes_and_minima():
    body = np.frombuffer(b"abcabcabcxabcabcabc", np.uint8)
    for width in (1, 2, 3, 7, 9, 19, 20):
        h = repeats.hashes(body, width)
        assert len(h) == max(0, len(body) - width + 1)
        seen = {}
        for i, x in enumerate(h.tolist()):
            assert seen.setdefault(body[i : i + width].tobytes(), x) == x
        assert len(set(seen.values())) == len(seen)
    values = np.array([5, 3, 9, 1, 7, 8, 2], np.uint64)
    for width in range(1, 8):
        assert repeats.smallest(values, width).tolist() == [min(values[i : i + width]) for i in range(8 - width)]
