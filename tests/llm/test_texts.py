from hypothesis import given, settings, strategies as st

from optionflow.llm import texts


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"ab", b"a\0", b"\0", b"abcdefgh", b"abcdefghi", b"x" * 16, b"x" * 17, b"x" * 40, b"\xc3\xa9", b"A,", b" ", b"\t", b"\x0b\x0c\r\n", b"\x85", b"\x1c"]), max_size=12).map(b"".join), max_size=5), st.booleans())
def test_words_equal_splitting(portion, again):
    words = texts.Words()
    for _ in range(1 + again):
        before = len(words)
        counts, numbers, new = words.in_texts(portion)
        split = [t.split() for t in portion]
        flat = [w for s in split for w in s]
        assert counts.tolist() == [len(s) for s in split]
        assert [list(words)[i] for i in numbers.tolist()] == flat
        assert list(words)[before:] == new and set(words) == set(flat)


def test_words_of_one_key_are_told_apart(monkeypatch):
    monkeypatch.setattr(texts, "MULTIPLIERS", (texts.np.uint64(0),) * 3)
    words = texts.Words()
    _, numbers, _ = words.in_texts([b"b a c a b", b"c b"])
    assert [list(words)[i] for i in numbers.tolist()] == b"b a c a b c b".split()


def test_short_words_are_held_as_numbers():
    words = texts.Words()
    portion = [b" ".join(b"w%d" % i for i in range(20_000)), b"x" * 17 + b" w5"]
    for _ in range(2):
        counts, numbers, _ = words.in_texts(portion)
        assert counts.tolist() == [20_000, 2]
    assert list(words.long) == [b"x" * 17] and len(words) == 20_001
    spelled = list(words)
    assert [spelled[i] for i in numbers.tolist()] == [w for t in portion for w in t.split()]
    # a word takes a few numbers, not an object
    assert sum(a.nbytes for a in (words.low, words.high, words.size, words.slots)) < 40 * len(words)


def test_work_gives_its_memory_back(monkeypatch):
    given = []
    monkeypatch.setattr(texts, "give_back", lambda: given.append(True))
    rows = texts.thrifty(lambda found: (x + 1 for x in found))
    assert list(rows(iter([1, 2]))) == [2, 3] and len(given) == 1
