import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from optionflow.llm import packing
from optionflow.llm.packing import END, Tokens, cut_to_powers, pack, step_groups

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)

ODD = [
    "", None, " \n", "Foo, bar! É È ÀÉÎ naïve über", "don't we'll 'S'T x's,", "áé H̱ ẖ K İ Σας ΑΣ",
    "<|endoftext|> a<|startoftext|>b x <|endoftext|>,", "1234 12,5 a1b2  x y​z \x1c\x85q", "日本語 текст שלום \U0001f600👨‍👩‍👧", "x" * 5000,
    "ß ẞ ŉ ǅ ĳ ſ ƻ ǀa", "foo|bar (baz) \"quoted\",; ...", "word " * 9000,
]


def ids_of(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, END]


def test_ids_equal_those_of_the_whole_text():
    tokens = Tokens(open(PATH, encoding="utf-8").read())
    for texts in (ODD, ODD[::-1], ODD):
        ids, lengths = tokens.of([(t or "").encode() for t in texts], END)
        assert ids.tolist() == [i for t in texts for i in ids_of(t)]
        assert lengths.tolist() == [len(ids_of(t)) for t in texts]


TOKENS = Tokens(open(PATH, encoding="utf-8").read())


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]) | st.sampled_from("aAé, .'sÍ̇\n<|"), max_size=60))
def test_ids_of_any_text(text):
    assert TOKENS.of([text.encode()], END)[0].tolist() == ids_of(text)


def test_a_worker_goes_on_with_the_words_of_its_stage():
    spec = open(PATH, encoding="utf-8").read()
    first = packing.tokens_of(spec, 7)
    first.of([b"foo bar, foo"], END)
    again = packing.tokens_of(spec, 7)
    assert again is first and len(again.words) == 2
    assert again.of([b"bar, Foo baz"], END)[0].tolist() == ids_of("bar, Foo baz")
    assert packing.tokens_of(spec, 8) is not first
    assert len(packing.KNOWN) == 1


def held(windows):
    found = {}
    for size, pieces in windows:
        assert sum(n for _, _, n in pieces) == size and all(n > 0 for _, _, n in pieces)
        for doc, start, n in pieces:
            for i in range(start, start + n):
                assert (doc, i) not in found
                found[doc, i] = True
    return found


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 700), max_size=30))
def test_windows_hold_every_id_once_without_padding(lengths):
    windows = pack(lengths, (8, 16, 32, 64))
    assert set(held(windows)) == {(d, i) for d, n in enumerate(lengths) for i in range(n)}
    assert all(size & (size - 1) == 0 and size <= 64 for size, _ in windows)
    # at most one window a power is shorter than the shortest tier
    small = [size for size, _ in windows if size < 8]
    assert len(small) == len(set(small))


def test_powers_of_a_tail():
    assert [s for s, _ in cut_to_powers([(0, 0, 9), (1, 5, 4)])] == [8, 4, 1]


def test_step_groups_are_balanced():
    sizes = [2048] * 33 + [1024] * 10 + [256] * 7
    groups = step_groups(sizes, 8192)
    loads = np.bincount(groups, weights=sizes)
    assert loads.max() - loads.min() <= 1024 and len(loads) == -(-sum(sizes) // 8192)


def check(rows, got, key):
    """Every document's ids lie in exactly one piece each; sequences are gapless and full."""
    texts = dict(rows)
    seen, places = {}, {}
    for r in got:
        ids = np.array(ids_of(texts[r[key]]), "<u4")
        body = ids[r.start : r.start + r.length]
        assert len(body) == r.length and r.doc_tokens == len(ids) and zlib.crc32(body.tobytes()) == r.ids_crc32
        seen.setdefault(r[key], []).append((r.start, r.length))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length, r.window))
    assert set(seen) == set(texts)
    for id, pieces in seen.items():
        at = 0
        for start, n in sorted(pieces):
            assert start == at
            at += n
        assert at == len(ids_of(texts[id]))
    for pieces in places.values():
        at = 0
        for offset, n, _ in sorted(pieces):
            assert offset == at
            at += n
        assert at == pieces[0][2] <= 2048 and at & (at - 1) == 0


def test_packing_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_TOKENS", 3000)
    rows = [(k, t) for k, t in enumerate(ODD)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, offset_ string").repartition(2)
    check(rows, packing.packed(df, PATH).collect(), "doc_id")
    assert packing.packed(df.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        packing.packed(df.withColumnRenamed("offset_", "offset"), PATH)


def test_repeated_rows_and_null_ids_and_ids_on_request(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "d")], "doc_id bigint, text string").coalesce(1)
    got = packing.packed(df, PATH, keep=["doc_id"], ids=True).collect()
    assert sum(r.length for r in got) == 2 * len(ids_of("a b c")) + len(ids_of("d"))
    for r in got:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32


def test_op8_round_trip(spark):
    from optionflow.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(rows, QUERIES["op8_hierarchical_packing"](spark, sf).collect(), "doc_id")
