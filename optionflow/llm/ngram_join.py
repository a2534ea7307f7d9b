"""Similarity join on word n-grams with prefix filters under several global token orders.

Two sets with a Jaccard similarity of t or more share a token among the first
|x| - ceil(t |x|) + 1 of each, whatever order all tokens are put in. Every order gives such a
filter, and a pair from a short list has to pass all of them. The first order puts frequent tokens last, so that
its inverted lists are short: frequencies come from a sketch of fixed size over the whole
corpus, and ties are broken by a hash. The other orders break the ties by other hashes. A pair must
also pass an odd sketch, a short one in long lists: the parities of its tokens' hashes differ in no more places
than the two sets may differ in tokens. None of these filters can lose a link.

What is wanted is the component of every document, so not every link has to be verified. Equal
sets are one from the start. In the first round every set is verified against the most similar
of the candidates before it. In each further round it is verified against the most similar ones in
other components that it was not compared with, `FEW` at first and `MORE` times as many each round, until no set
has any. So a group of m near copies costs a few times m verified pairs, not m^2 / 2.

Inverted lists of tokens that the sketch calls frequent, and other long ones, are cut into
chunks of bounded size; tasks compare a chunk, or in further rounds two, in memory. A list of one chunk
whose sets all have few candidates is done after the first round.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .components import components
from .shingles import Shingles, fingerprint, mix
from .store import drop, kept
from .texts import portions, thrifty

#: The frequency sketch has a counter for about so many tokens, between two bounds; counters that travel in a row.
TOKENS_PER_COUNTER, LEAST_SKETCH, MOST_SKETCH, SKETCH_ROW = 8, 14, 24, 1 << 16

#: Ranks of tokens by their counter: `ALONE` has no other, those from `FREQUENT` on are above the usual load, with `STEPS` per power of two.
ALONE, FREQUENT, STEPS = 0, 128, 4

#: Text that a task works on at a time.
STEP_BYTES = 2_000_000

#: Bits of an odd sketch per token, and its bounds. Orders beside the first one.
ODD_BITS, LEAST_ODD, MOST_ODD, MORE_ORDERS = 4, 512, 1 << 16, 2

#: Bits of the bitmap that finds the texts to verify, per set in question, and its bounds.
FIND_BITS, LEAST_FIND, MOST_FIND = 16, 12, 26

#: Lists up to this length give pairs; longer ones are compared in chunks of about so many sets.
SHORT_LIST, CHUNK_SETS = 32, 1024

#: Candidates that a set puts up in the second round, and in later ones as a multiple of those of the round before.
FEW, MORE = 4, 16


class Rule:
    """Whole-number arithmetic of the condition 100 * intersection >= percent * union."""

    def __init__(self, percent: int) -> None:
        self.percent = percent

    def prefix(self, size: int) -> int:
        return size + (-self.percent * size // 100) + 1 if size else 0

    def linked(self, common: np.ndarray | int, a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray | bool:
        return 100 * common >= self.percent * (a + b - common)

    def may_differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Most tokens that are in one of the sets only: common >= percent (a + b) / (100 + percent)."""
        return (a + b) - 2 * -(-self.percent * (a + b) // (100 + self.percent))


def text_key() -> list:
    """Columns that find a text again: its id, null-safe, and its hash."""
    return [F.col("id"), F.xxhash64("text").alias("body")]


# --- the frequency sketch -------------------------------------------------------------


def frequency_classes(texts: DataFrame, n: int) -> np.ndarray:
    """For each counter of the sketch the rank of its tokens: `ALONE` up to 1, from `FREQUENT` on above the usual load.

    A token's count is at most its counter's, so a token below `FREQUENT` has a bounded list, and one that is
    `ALONE` is in one text. What comes to the driver is the sketch: at most 2^MOST_SKETCH counters. Its size only
    decides how well the first order tells frequent tokens.
    """
    words = (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6
    bits = min(MOST_SKETCH, max(LEAST_SKETCH, (words // TOKENS_PER_COUNTER).bit_length()))
    most = np.iinfo(np.uint16).max

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, shingles = np.zeros(1 << bits, np.uint32), Shingles(n)
        for batch in batches:
            for part in portions(batch.column(0), STEP_BYTES):
                # repeats within a text count too: the sketch only tells which tokens are frequent
                places, times = np.unique(shingles.repeated(part) >> np.uint64(64 - bits), return_counts=True)
                counts[places.astype(np.int64)] += times.astype(np.uint32)
        yield from rows(dict(enumerate(counts.reshape(-1, min(SKETCH_ROW, 1 << bits)))))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = unpacked(data)
                sums[number] = sums[number] + part if number in sums else part
        yield from rows(sums)

    def rows(parts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        # a counter that is full stays far above the usual load
        for number, part in parts.items():
            if part.any():
                data = packed(np.minimum(part, most))
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([data])], names=["number", "counts"])

    ddl = "number int, counts binary"
    total = texts.select("text").mapInArrow(thrifty(count), ddl).repartition("number").mapInArrow(thrifty(add), ddl)
    counts = np.zeros((max(1, (1 << bits) // SKETCH_ROW), min(SKETCH_ROW, 1 << bits)), np.uint16)
    for row in total.collect():
        counts[row["number"]] = unpacked(row["counts"])
    counts = counts.reshape(-1)
    load = float(counts.mean())
    usual = min(load + 4 * load**0.5 + 2, most - 1)
    ranks = np.full(len(counts), ALONE, np.uint8)
    usually, above = (counts > 1) & (counts <= usual), counts > usual
    ranks[usually] = 1 + (counts[usually] * ((FREQUENT - 2) / usual)).astype(np.uint8)
    ranks[above] = FREQUENT + (STEPS * np.log2(counts[above] / usual)).astype(np.uint8)
    return ranks


def packed(counts: np.ndarray) -> bytes:
    """Counters below 2^16, a whole number of bytes of them: a bit for each that is not 0, then what these have above 1."""
    there = counts > 0
    more = counts[there] - 1
    parts = (np.packbits(there), (more & 255).astype(np.uint8), (more >> 8).astype(np.uint8))
    # most bits and bytes are far from even but in no order, so coding them by frequency does nearly all there is to do
    coder = zlib.compressobj(1, zlib.DEFLATED, zlib.MAX_WBITS, zlib.DEF_MEM_LEVEL, zlib.Z_RLE)
    return len(there).to_bytes(4, "little") + coder.compress(b"".join(p.tobytes() for p in parts)) + coder.flush()


def unpacked(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:4], "little")
    plain = np.frombuffer(zlib.decompress(data[4:]), np.uint8)
    there = np.unpackbits(plain[: size // 8]).astype(bool)
    low, high = plain[size // 8 :].reshape(2, -1).astype(np.uint32)
    counts = np.zeros(size, np.uint32)
    counts[there] = 1 + low + 256 * high
    return counts


# --- what is kept of every set --------------------------------------------------------


def records(texts: DataFrame, n: int, rule: Rule, classes: np.ndarray) -> DataFrame:
    """A row per text: id, body, size, fp, and for the first text of each set in its task what the filters need."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        shingles = Shingles(n)
        for batch in batches:
            out: list[list] = [[] for _ in kinds]
            for part in portions(batch.column(2), STEP_BYTES):
                for tokens in shingles.of(part):
                    fp = fingerprint(tokens) if len(tokens) else None
                    if fp is None or fp in seen:
                        cells = (len(tokens), fp, False, None, None, None, None, None)
                    else:
                        seen.add(fp)
                        cells = (len(tokens), fp, True, *filters(tokens))
                    for column, cell in zip(out, cells):
                        column.append(cell)
            columns = [batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(out, kinds))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    def filters(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes, bytes, bytes]:
        p = rule.prefix(len(tokens))
        rank = classes[tokens >> shift]
        # the first order is the finest; the others only put frequent tokens last, so that they differ from it
        coarse = np.where(rank < FREQUENT, 0, 1 + (rank - FREQUENT) // STEPS)
        orders = []
        for order in range(1 + MORE_ORDERS):
            late = (coarse if order else rank).astype(np.uint64) << np.uint64(56)
            place = late | (mix(tokens, order) >> np.uint64(8))
            orders.append(np.argpartition(place, p - 1)[:p] if p < len(tokens) else np.arange(len(tokens)))
        first, rest = orders[0], orders[1:]
        rare = tokens[first][(rank[first] > ALONE) & (rank[first] < FREQUENT)].view(np.int64)
        frequent = tokens[first][rank[first] >= FREQUENT].view(np.int64)
        short = [np.unique((mix(tokens[o], 10) & np.uint64(0xFFFF)).astype("<u2")) for o in rest]
        more = b"".join(len(s).to_bytes(4, "little") + s.tobytes() for s in short)
        odd = odd_sketch(tokens)
        brief = folded(np.frombuffer(odd, np.uint64), LEAST_ODD // 64).tobytes()
        return rare, frequent, brief, odd, more

    shift = np.uint64(64 - (len(classes) - 1).bit_length())
    names = ["id", "body", "size", "fp", "first", "rare", "frequent", "brief", "odd", "more"]
    ids = pa.list_(pa.int64())
    kinds = (pa.int64(), pa.int64(), pa.bool_(), ids, ids, pa.binary(), pa.binary(), pa.binary())
    ddl = (
        "id bigint, body bigint, size bigint, fp bigint, first boolean, rare array<bigint>, frequent array<bigint>, "
        "brief binary, odd binary, more binary"
    )
    return texts.select(*text_key(), "text").mapInArrow(thrifty(rows), ddl)


def odd_sketch(tokens: np.ndarray) -> bytes:
    """Parities of the numbers of tokens that hash to each bit (Mitzenmacher, Pagh and Pham, 2014).

    A sketch of twice the size folds to this one by exclusive or of its halves.
    """
    bits = min(MOST_ODD, max(LEAST_ODD, 1 << (ODD_BITS * len(tokens) - 1).bit_length()))
    places = (mix(tokens, 20) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8)).tobytes()


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """Sketches (a row each) brought down to so many 64-bit words."""
    while sketch.shape[-1] > words:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def apart(a: bytes, b: bytes) -> int:
    """Bits in which two odd sketches differ: at most the number of tokens that only one set has."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    words = min(len(x), len(y))
    return int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum(dtype=np.int64))


def orders_of(more: bytes) -> list[np.ndarray]:
    """The 16-bit prefixes under the other orders."""
    found, at = [], 0
    while at < len(more):
        size = int.from_bytes(more[at : at + 4], "little")
        found.append(np.frombuffer(more, "<u2", size, at + 4))
        at += 4 + 2 * size
    return found


def share_all(a: list[np.ndarray], b: list[np.ndarray]) -> bool:
    """Whether two sets share a prefix token under each of the other orders (as far as 16 bits tell)."""
    for x, y in zip(a, b):
        x, y = (x, y) if len(x) <= len(y) else (y, x)
        at = np.searchsorted(y, x)
        if not (y[np.minimum(at, len(y) - 1)] == x).any():
            return False
    return True


class Members:
    """Sets of one chunk, with their outlines."""

    def __init__(self, f: pd.DataFrame) -> None:
        self.fp = f["fp"].to_numpy(np.int64)
        self.size = f["size"].to_numpy(np.int64)
        self.odd = [np.frombuffer(o, np.uint64) for o in f["odd"]]
        self.root = f["root"].to_numpy(np.int64) if "root" in f else None
        self.words = np.array([len(o) for o in self.odd], np.int64)
        # sketches of one length as rows of a matrix, by length; `row` is a set's row in its matrix
        self.tables, self.row = {}, np.empty(len(f), np.int64)
        for length in np.unique(self.words):
            here = np.flatnonzero(self.words == length)
            self.tables[int(length)] = np.stack([self.odd[i] for i in here])
            self.row[here] = np.arange(len(here))

    def candidates(self, other: Members, rule: Rule) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each set, the places and differences of those in `other` with a smaller fingerprint that pass the sketch."""
        for i in range(len(self.fp)):
            asked = other.fp < self.fp[i]
            if self.root is not None:
                asked &= other.root != self.root[i]
            near = np.flatnonzero(asked)
            if not len(near):
                continue
            allowed = rule.may_differ(self.size[i], other.size[near])
            close = np.abs(other.size[near] - self.size[i]) <= allowed
            near, allowed = near[close], allowed[close]
            differ = np.empty(len(near), np.int64)
            for length, table in other.tables.items():
                here = other.words[near] == length
                if here.any():
                    words = min(length, len(self.odd[i]))
                    rows = folded(table[other.row[near[here]]], words) ^ folded(self.odd[i], words)
                    differ[here] = np.bitwise_count(rows).sum(1, dtype=np.int64)
            passed = differ <= allowed
            if passed.any():
                yield i, near[passed], differ[passed]


def closest_across(rule: Rule, limit: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Of two chunks of a list: each set's closest candidates, up to `limit`, in other components and not in its `past`."""

    def across(f: pd.DataFrame) -> pd.DataFrame:
        x, y = int(f["x"].iloc[0]), int(f["y"].iloc[0])
        parts = [f[f["chunk"] == c] for c in ((x,) if x == y else (x, y))]
        sets = [Members(p) for p in parts]
        past = [[() if p is None else p for p in part["past"]] for part in parts]
        rows = []
        for mine, looked, other in [(sets[0], past[0], sets[-1])] + ([(sets[1], past[1], sets[0])] if x != y else []):
            for i, near, differ in mine.candidates(other, rule):
                if len(looked[i]):
                    new = ~np.isin(other.fp[near], looked[i])
                    near, differ = near[new], differ[new]
                if len(near) > limit:
                    best = np.lexsort((other.fp[near], differ))[:limit]
                    near, differ = near[best], differ[best]
                rows.append((np.full(len(near), mine.fp[i]), other.fp[near], differ))
        return frame(rows)

    return across


def closest_within(rule: Rule, limit: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Of a chunk of a list: each set's closest candidates, up to `limit`. If a set has more, a row (token) says so."""

    def within(f: pd.DataFrame) -> pd.DataFrame:
        m = Members(f)
        rows, more = [], False
        for i, near, differ in m.candidates(m, rule):
            if len(near) > limit:
                best = np.lexsort((m.fp[near], differ))[:limit]
                near, differ, more = near[best], differ[best], True
            rows.append((np.full(len(near), m.fp[i]), m.fp[near], differ))
        pairs = frame(rows)
        last = np.arange(len(pairs) + more) >= len(pairs)
        # tokens need all 64 bits, so nulls may not turn them into floats
        found = {c: pd.arrays.IntegerArray(np.resize(np.append(pairs[c].to_numpy(), 0), len(last)), last.copy()) for c in pairs}
        found["token"] = pd.arrays.IntegerArray(np.full(len(last), f["token"].iloc[0], np.int64), ~last)
        return pd.DataFrame(found)

    return within


PAIRS = "a bigint, b bigint, apart bigint"  # b < a


def frame(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pd.DataFrame:
    columns = [np.concatenate(c) for c in zip(*rows)] if rows else [np.empty(0, np.int64)] * 3
    return pd.DataFrame(dict(zip(("a", "b", "apart"), columns))).astype(np.int64)


# --- inverted lists ---------------------------------------------------------------------


def rare_lists(kept_records: DataFrame) -> DataFrame:
    """Pairs (a, b) from short lists of rare tokens, and rows (token, a) of the longer ones.

    A rare token's list is bounded by the sketch, and it is streamed: a task holds `SHORT_LIST` sets of it.
    """
    postings = kept_records.select("fp", F.explode("rare").alias("token"))
    sorted_postings = postings.repartition("token").sortWithinPartitions("token", "fp")

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, long, pairs = None, [], False, set()
        for batch in batches:
            tokens = batch.column(0).to_numpy()
            fps = batch.column(1).to_numpy()
            members: list[tuple[int, int]] = []
            # only places where a token repeats, or ends a list that does, need a look
            same = tokens[1:] == tokens[:-1]
            look = np.concatenate([[True], same]) | np.concatenate([same, [True]])
            for token, fp in zip(tokens[look].tolist(), fps[look].tolist()):
                if token != last:
                    pairs.update(pairs_of(held))
                    last, held, long = token, [], False
                if held and held[-1] == fp:
                    continue
                if long:
                    members.append((token, fp))
                    held = [fp]
                    continue
                held.append(fp)
                if len(held) > SHORT_LIST:
                    members += [(token, x) for x in held]
                    held, long = [fp], True
            if long:
                held = held[-1:]
            yield out(members, pairs if len(pairs) > 100_000 else set())
            pairs = set() if len(pairs) > 100_000 else pairs
        if not long:
            pairs.update(pairs_of(held))
        yield out([], pairs)

    def pairs_of(held: list[int]) -> list[tuple[int, int]]:
        return [(x, y) for k, x in enumerate(held) for y in held[:k]]

    def out(members: list[tuple[int, int]], pairs: set[tuple[int, int]]) -> pa.RecordBatch:
        token = [t for t, _ in members] + [None] * len(pairs)
        a = [x for _, x in members] + [x for x, _ in pairs]
        b = [None] * len(members) + [y for _, y in pairs]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (token, a, b)], names=["token", "a", "b"])

    return sorted_postings.select("token", "fp").mapInArrow(thrifty(lists), "token bigint, a bigint, b bigint")


def long_lists(kept_records: DataFrame, rare: DataFrame) -> DataFrame:
    """(token, fp, chunks): lists of frequent tokens with more than one set, and long ones of rare tokens."""
    frequent = kept_records.select(F.explode("frequent").alias("token"), "fp").distinct()
    members = frequent.unionByName(rare.filter("token is not null").select("token", F.col("a").alias("fp")))
    counts = members.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1")
    counts = counts.select(F.col("token").alias("t"), F.ceil(F.col("n") / CHUNK_SETS).cast("int").alias("chunks"))
    return members.join(counts, F.col("token") == F.col("t")).select("token", "fp", "chunks")


# --- verification -----------------------------------------------------------------------


def likely(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column, count: int) -> DataFrame:
    """Rows of `df` whose key may be among the wanted ones: all that are, and few others.

    The keys' hashes mark a bitmap of bounded size, which is therefore broadcast; it keeps most
    rows from being moved by the exact join that has to follow. A key marks three bits of one word.
    """
    bits = min(MOST_FIND, max(LEAST_FIND, (FIND_BITS * count).bit_length()))

    def place(key: Column) -> tuple[Column, Column]:
        hash, one = F.xxhash64(key), F.lit(1).cast("bigint")
        marks = [F.call_function("shiftleft", one, F.shiftright(hash, 6 * k).bitwiseAND(63).cast("int")) for k in range(3)]
        return F.shiftrightunsigned(hash, 70 - bits), marks[0].bitwiseOR(marks[1]).bitwiseOR(marks[2])

    word, marks = place(wanted_key)
    bitmap = wanted.groupBy(word.alias("__word")).agg(F.bit_or(marks).alias("__bits"))
    word, marks = place(key)
    marked = df.withColumn("__at", word).join(F.broadcast(bitmap), F.col("__at") == F.col("__word"))
    return marked.filter(F.col("__bits").bitwiseAND(marks) == marks).drop("__at", "__word", "__bits")


def bodies_of(sets: DataFrame, kept_records: DataFrame, texts: DataFrame) -> DataFrame:
    """(fp, text): one text for each of the sets."""
    known = kept_records.filter("first").groupBy("fp").agg(F.min(F.struct("body", "id")).alias("key"))
    wanted = known.join(sets.select(F.col("fp").alias("m")), F.col("fp") == F.col("m"), "left_semi")
    wanted = kept(wanted.select("fp", F.col("key.id").alias("of"), F.col("key.body").alias("of_body")))
    keyed = likely(texts.select(*text_key(), "text"), F.col("body"), wanted, F.col("of_body"), wanted.count())
    found = keyed.join(wanted, (F.col("body") == F.col("of_body")) & F.col("id").eqNullSafe(F.col("of")))
    return kept(found.select("fp", "text").dropDuplicates(["fp"]))


def marks_of(sets: DataFrame, kept_records: DataFrame) -> DataFrame:
    """(fp, size, odd, more): what the filters need, a row for each of the sets."""
    known = kept_records.filter("first").select("fp", "size", "odd", "more")
    near = likely(known, F.col("fp"), sets, F.col("m"), sets.count())
    return kept(near.join(sets, F.col("fp") == F.col("m"), "left_semi").dropDuplicates(["fp"]))


def outlines(marks: DataFrame) -> DataFrame:
    """(fp, size, odd) with sketches of about a bit per token, which still tell sets apart that have a passage in common.

    A set is sent to each of its lists, so what is sent is kept short.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            short = [folded(np.frombuffer(o, np.uint64), max(LEAST_ODD, 1 << (n - 1).bit_length()) // 64).tobytes() for n, o in sketches]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(short, pa.binary())], names=["fp", "size", "odd"])

    return marks.select("fp", "size", "odd").mapInArrow(thrifty(rows), "fp bigint, size bigint, odd binary")


def verified(pairs: DataFrame, bodies: DataFrame, n: int, rule: Rule) -> DataFrame:
    """Pairs (a, b) whose sets link, by the whole texts; only texts that may be of a pair are moved."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("m")).distinct()
    bodies = likely(bodies, F.col("fp"), ends, F.col("m"), ends.count())
    left = pairs.join(bodies.select(F.col("fp").alias("fa"), F.col("text").alias("text_a")), F.col("a") == F.col("fa"))
    both = left.join(bodies.select(F.col("fp").alias("fb"), F.col("text").alias("text_b")), F.col("b") == F.col("fb"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(n)
        for batch in batches:
            good: list[bool] = []
            for part in portions(batch.column(2), STEP_BYTES):
                other = batch.column(3).slice(len(good), len(part)).to_pylist()
                for x, y in zip(shingles.of(part), shingles.of(other)):
                    good.append(bool(rule.linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return kept(both.select("a", "b", "text_a", "text_b").mapInArrow(thrifty(check), "a bigint, b bigint"))


# --- the join ---------------------------------------------------------------------------


def link_components(docs: DataFrame, n: int = 4, percent: int = 85, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: id, `body` (the hash of its text), `n_shingles` and `fp` (its set's size and fingerprint),
    `root` (the smallest fingerprint reachable by links) and `component_id` (the smallest id reachable).

    Documents with equal sets are linked. A document without words, or with a null text, is linked with
    nothing: its fp is null and it is its own component. A null id is never a component id, unless no document of a
    component has one. Repeated rows each have a row. Other columns are ignored. An empty table gives no rows.
    """
    rule = Rule(percent)
    texts = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).cast("binary").alias("text"))
    classes = frequency_classes(texts, n)
    known = kept(records(texts, n, rule, classes))
    rare = kept(rare_lists(known))
    long = kept(long_lists(known, rare))
    short_pairs = rare.filter("token is null").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    # a short sketch rules out most pairs; the rest of what the filters need is moved for few sets
    shortest = known.filter("first").groupBy("fp").agg(F.first("size").alias("size"), F.first("brief").alias("brief"))
    hopeful = kept(passing_brief(short_pairs, kept(shortest), rule))
    in_pairs = hopeful.select(F.explode(F.array("a", "b")).alias("m"))
    marks = marks_of(kept(in_pairs.unionByName(long.select(F.col("fp").alias("m"))).distinct()), known)

    chunked = long.withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))

    def marked(members: DataFrame) -> DataFrame:
        return members.join(outline.withColumnRenamed("fp", "mark"), F.col("fp") == F.col("mark")).drop("mark")

    in_long = long.select(F.col("fp").alias("m")).distinct()
    outline = kept(outlines(marks.join(in_long, F.col("fp") == F.col("m"), "left_semi")))

    # a list of one chunk whose sets have few candidates is done when these are known; only the others are looked at again
    looked = kept(marked(chunked).groupBy("token", "chunk").applyInPandas(closest_within(rule, FEW), f"{PAIRS}, token bigint"))
    in_lists = looked.filter("token is null").select("a", "b", "apart")
    candidates = kept(filtered(hopeful, marks, rule).unionByName(in_lists).groupBy("a", "b").agg(F.min("apart").alias("apart")))
    more = looked.filter("token is not null").select(F.col("token").alias("t")).distinct()
    unfinished = kept(chunked.join(more, F.col("token") == F.col("t"), "left").filter("chunks > 1 or t is not null").drop("t"))
    drop(docs.sparkSession, rare, hopeful, long, looked, marks)
    nearest = kept(candidates.groupBy("a").agg(F.min_by("b", F.struct("apart", "b")).alias("b")))
    ends = candidates.select(F.explode(F.array("a", "b")).alias("fp"))
    bodies = bodies_of(ends.unionByName(unfinished.select("fp")).distinct(), known, texts)
    links = verified(nearest, bodies, n, rule)
    roots = kept(components(links))

    # further rounds: of its candidates in other components, every set puts up the most similar ones that were not looked
    # at, `FEW`, then `MORE` times as many each round; what links joins components, until no candidate is left
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    tried, limit = nearest, FEW
    while True:
        split = with_roots(with_roots(candidates, roots, "a"), roots, "b").filter("root_a <> root_b").select("a", "b", "apart")
        split = split.join(tried.select("a", "b"), ["a", "b"], "left_anti")
        rooted = with_roots(unfinished, roots, "fp").withColumnRenamed("root_fp", "root")
        divided = rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
        divided = divided.select(F.col("token").alias("t"))
        still = kept(rooted.join(divided, F.col("token") == F.col("t"), "left_semi"))
        open_lists = marked(still)
        past = tried.groupBy(F.col("a").alias("of")).agg(F.collect_set("b").alias("past"))
        open_lists = open_lists.join(past, F.col("fp") == F.col("of"), "left").drop("of")
        # chunks x <= y meet in (token, x, y): a chunk goes to all pairs that hold it
        meets = open_lists.withColumn("other", F.explode(every)).select(
            "*", F.least("chunk", "other").alias("x"), F.greatest("chunk", "other").alias("y")
        )
        open_pairs = meets.groupBy("token", "x", "y").applyInPandas(closest_across(rule, limit), PAIRS)
        found = split.unionByName(open_pairs).groupBy("a", "b").agg(F.min("apart").alias("apart"))
        place = F.row_number().over(W.partitionBy("a").orderBy("apart", "b"))
        again = kept(found.withColumn("place", place).filter(F.col("place") <= limit).select("a", "b"))
        drop(docs.sparkSession, still)
        if not again.limit(1).count():
            drop(docs.sparkSession, again)
            break
        links = links.unionByName(verified(again, bodies, n, rule))
        roots, tried, limit = kept(components(links)), tried.select("a", "b").unionByName(again), MORE * limit

    drop(docs.sparkSession, unfinished, outline, candidates, tried, bodies)

    rows = with_roots(known.select("id", "body", "size", "fp"), roots, "fp")
    least = rows.filter("fp is not null").groupBy(F.col("root_fp").alias("r")).agg(F.min("id").alias("least"))
    named = rows.join(least, F.col("root_fp") == F.col("r"), "left")
    return named.select(
        F.col("id").alias(id),
        "body",
        F.col("size").alias("n_shingles"),
        "fp",
        F.col("root_fp").alias("root"),
        F.coalesce("least", "id").alias("component_id"),
    )


def one_each(docs: DataFrame, n: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the smallest id of each component, and every document without words; all columns.

    Of rows with that id and the same text one stays, whichever.
    """
    found = link_components(docs, n, percent, id, text)
    last = F.struct(F.col(id).isNull().alias("none"), F.col(id).alias("id"), "body")
    winners = found.filter("fp is not null").groupBy("root").agg(F.min(last).alias("first"))
    winners = winners.select(F.col("first.id").alias("id"), F.col("first.body").alias("body"), F.lit(True).alias("worded"))
    bare = found.filter("fp is null").select(F.col(id).alias("id"), "body", F.lit(False).alias("worded")).distinct()
    stays = winners.unionByName(bare)

    def row_keys(key: Column, body: Column) -> dict[str, Column]:
        return {"__id": F.xxhash64(key.isNull(), key), "__body": body}

    # the id as it is decides; its hash is a key without nulls
    chosen = stays.withColumns(row_keys(F.col("id"), F.col("body"))).select("__id", "__body", "worded")
    keyed = docs.withColumns(row_keys(F.col(id).cast("bigint"), F.xxhash64(F.col(text).cast("binary"))))
    matched = keyed.join(chosen, ["__id", "__body"])
    alike = W.partitionBy("__id", "__body").orderBy("__id")
    return matched.withColumn("__n", F.row_number().over(alike)).filter(~F.col("worded") | (F.col("__n") == 1)).select(*docs.columns)


def with_roots(df: DataFrame, roots: DataFrame, column: str) -> DataFrame:
    """Add `root_<column>`: the component of a set, itself if it has no link."""
    named = roots.select(F.col("node").alias("__node"), F.col("root").alias("__root"))
    joined = df.join(named, F.col(column) == F.col("__node"), "left")
    return joined.withColumn(f"root_{column}", F.coalesce("__root", column)).drop("__node", "__root")


def passing_brief(pairs: DataFrame, brief: DataFrame, rule: Rule) -> DataFrame:
    """Pairs that pass the length filter and the shortest odd sketch."""

    def side(end: str) -> DataFrame:
        return brief.select(*[F.col(c).alias(f"{c}_{end}") for c in ("fp", "size", "brief")])

    met = pairs.join(side("a"), F.col("a") == F.col("fp_a")).join(side("b"), F.col("b") == F.col("fp_b"))

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sizes = [batch.column(c).to_numpy() for c in (2, 4)]
                sketch = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in (3, 5)]
                differ = np.bitwise_count(sketch[0] ^ sketch[1]).sum(1, dtype=np.int64)
                keep = np.maximum(differ, np.abs(sizes[0] - sizes[1])) <= rule.may_differ(*sizes)
                yield batch.select([0, 1]).filter(pa.array(keep))

    return met.select("a", "b", "size_a", "brief_a", "size_b", "brief_b").mapInArrow(thrifty(passed), "a bigint, b bigint")


def filtered(pairs: DataFrame, marks: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b, apart) that pass the length filter, the odd sketch and the other orders."""

    def side(end: str) -> DataFrame:
        return marks.select(*[F.col(c).alias(f"{c}_{end}") for c in ("fp", "size", "odd", "more")])

    met = pairs.join(side("a"), F.col("a") == F.col("fp_a")).join(side("b"), F.col("b") == F.col("fp_b"))

    def passed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if not len(f):
                continue
            differ = np.array([apart(x, y) for x, y in zip(f["odd_a"], f["odd_b"])], np.int64)
            keep = differ <= rule.may_differ(f["size_a"].to_numpy(), f["size_b"].to_numpy())
            f = f.assign(apart=differ)[keep]
            keep = [share_all(orders_of(x), orders_of(y)) for x, y in zip(f["more_a"], f["more_b"])]
            yield f.loc[np.array(keep, bool), ["a", "b", "apart"]]

    return met.drop("fp_a", "fp_b").mapInPandas(thrifty(passed), PAIRS)
