"""Hierarchical packing of documents into windows of several lengths.

A document is cut into full windows of the longest length; its rest is routed to the tier
of the shortest window that holds it. Rests are packed tier by tier, longest first: each opens a
window, whose gap takes the longest pieces that fit from what is left, which are of shorter tiers,
and at last a cut piece. The only window that can stay open, at the end of a chunk of documents, is
cut to windows of powers of two. So no token is padding. The windows of a chunk are dealt to
step groups of nearly equal token counts.

Each task packs its own documents, in chunks of bounded size: nothing is shuffled, and what a
task holds does not grow with the table.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, types as T

from .texts import PORTION_BYTES, Words, portions, thrifty

TIERS = (256, 512, 1024, 2048)
END = 1

#: Tokens that are packed together; tokens of a step group.
CHUNK_TOKENS, STEP_TOKENS = 1 << 21, 1 << 16

#: Words whose ids a worker remembers.
REMEMBERED = 600_000

# A line of letters whose composed and lower-case forms are settled, then punctuation that is a token run of its own; or another line.
PLAIN = re.compile(r"^(?:([a-zß-öø-ɏ]+)([,.;:!?|\"()]*)|.+)$", re.M)


def byte_letters() -> dict[int, str]:
    """The character by which a byte-level vocabulary writes each byte: itself if it is printable, else the next from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Tokens:
    """Token ids of texts, word by word: a word is tokenized once, whatever the texts repeat.

    Exact for tokenizers that never let a token span white space. Words of settled letters skip normalization
    and pattern matching, which leave them as they are.
    """

    def __init__(self, spec: str) -> None:
        import json

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core; threads each hold memory
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_str(spec)
        plain = json.loads(spec) | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}}
        self.suffix = plain["model"].get("end_of_word_suffix") or ""
        self.plain = Tokenizer.from_str(json.dumps(plain)) if self.suffix else None
        # white space between words stays
        self.letters = np.array([0x20 if b == 0x20 else ord(c) for b, c in sorted(byte_letters().items())], "<u4")
        vocabulary = self.full.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, id in vocabulary.items():
            self.ends[id] = bool(self.suffix) and token.endswith(self.suffix)
        self.clear()

    def clear(self) -> None:
        """Forget all words. Part 0 is the empty one; that numbered k by `parts` is k + 1."""
        self.words, self.parts = Words(), Words()
        self.ids, self.starts, self.sizes = np.empty(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64)
        # each word is two parts: its letters and what follows them, or all of it and nothing
        self.first, self.second = np.empty(0, np.int32), np.empty(0, np.int32)

    def learn(self, words: list[bytes]) -> None:
        """Parts of words that are new, and ids of the parts that are; all words at once, a line each."""
        lines = b"\n".join(words).decode("utf-8", "replace")
        first, second, plain, other = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [], []
        if self.plain is not None:
            letters, marks = zip(*PLAIN.findall(lines.lower()))
            first, plain = self.parted(letters)
            second, other = self.parted(marks)
        odd = np.flatnonzero(first == 0)
        if len(odd):
            lines = lines.split("\n")
            first[odd], new = self.parted([lines[i] for i in odd.tolist()])
            other += new
        self.first, self.second = (np.concatenate([a, b.astype(np.int32)]) for a, b in ((self.first, first), (self.second, second)))
        # new parts are numbered on, the plain ones first
        chunks, sizes = [self.ids], []
        for a in range(0, len(plain), 10_000):
            spelled = self.letters[np.frombuffer(b" ".join(plain[a : a + 10_000]), np.uint8)].tobytes().decode("utf-32-le")
            ids = np.array(self.plain.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, np.uint32)
            chunks.append(ids)
            sizes.append(np.diff(np.flatnonzero(self.ends[ids]), prepend=-1))
        for a in range(0, len(other), 2_000):
            some = [c.decode() for c in other[a : a + 2_000]]
            for found in self.full.encode_batch_fast(some, add_special_tokens=False):
                chunks.append(np.array(found.ids, np.uint32))
                sizes.append(np.array([len(chunks[-1])]))
        if sizes:
            self.sizes = np.concatenate([self.sizes, *sizes])
            self.starts = np.cumsum(self.sizes) - self.sizes
            self.ids = np.concatenate(chunks)

    def parted(self, texts: Sequence[str]) -> tuple[np.ndarray, list[bytes]]:
        """The numbers of parts, which hold no white space, and the parts that are new."""
        counts, found, new = self.parts.in_texts([" ".join(texts).encode()])
        numbers = np.zeros(len(texts), np.int64)
        numbers[np.fromiter(map(bool, texts), bool, len(texts))] = 1 + found
        return numbers, new

    def of(self, texts: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, `end` after each, and the number of each text's ids."""
        if len(self.words) > REMEMBERED:
            self.clear()
        counts, word, new = self.words.in_texts(texts)
        if new:
            self.learn(new)
        second = self.second[word]
        part = np.empty(2 * len(word), np.int32)
        part[::2], part[1::2] = self.first[word], second
        part = part[part > 0]
        both = np.repeat(np.repeat(np.arange(len(counts), dtype=np.int32), counts), 1 + (second > 0))
        sizes = self.sizes[part]
        total, behind = int(sizes.sum()), np.cumsum(sizes, dtype=np.int64)
        through = np.concatenate([[0], behind])[np.concatenate([[0], np.cumsum(np.bincount(both, minlength=len(counts)))])]
        lengths = np.diff(through) + 1
        ids = np.full(total + len(counts), end, np.uint32)
        # a part's ids come from where it starts, and go behind one end id for each earlier text
        step = np.arange(total, dtype=np.int32)
        source = step + np.repeat((self.starts[part] - (behind - sizes)).astype(np.int32), sizes)
        step += np.repeat(both, sizes)
        ids[step] = self.ids[source]
        return ids, lengths


#: What a worker process knows, by specification and stage: of one stage at a time.
KNOWN: dict[tuple[str, int], Tokens] = {}


def tokens_of(spec: str, stage: int) -> Tokens:
    """One for a worker process and stage: the worker's next task of the stage goes on with the words that are known."""
    if (spec, stage) not in KNOWN:
        KNOWN.clear()
        KNOWN[spec, stage] = Tokens(spec)
    return KNOWN[spec, stage]


Piece = tuple[int, int, int]  # document, first id, number of ids


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[Piece]]]:
    """Windows (length, pieces) that hold every id of documents of these lengths; pieces fill their windows."""
    longest = tiers[-1]
    windows: list[tuple[int, list[Piece]]] = []
    rests: list[Piece] = []
    for doc, n in enumerate(lengths):
        whole = n // longest
        windows += [(longest, [(doc, k * longest, longest)]) for k in range(whole)]
        if n % longest:
            rests.append((doc, whole * longest, n % longest))
    left = sorted((size, doc, start) for doc, start, size in rests)
    while left:
        size, doc, start = left.pop()
        tier = next(t for t in tiers if t >= size)
        pieces, gap = [(doc, start, size)], tier - size
        while gap and left:
            at = bisect_right(left, (gap, len(lengths), 0)) - 1
            if at >= 0:
                size, doc, start = left.pop(at)
                pieces.append((doc, start, size))
                gap -= size
            else:
                size, doc, start = left.pop(0)
                pieces.append((doc, start, gap))
                insort(left, (size - gap, doc, start + gap))
                gap = 0
        windows += [(tier, pieces)] if not gap else cut_to_powers(pieces)
    return windows


def cut_to_powers(pieces: list[Piece]) -> list[tuple[int, list[Piece]]]:
    """The same ids in windows of descending powers of two."""
    total = sum(n for _, _, n in pieces)
    windows, queue = [], list(reversed(pieces))
    for power in range(total.bit_length() - 1, -1, -1):
        room, held = total & (1 << power), []
        while room:
            doc, start, n = queue.pop()
            take = min(n, room)
            held.append((doc, start, take))
            room -= take
            if take < n:
                queue.append((doc, start + take, n - take))
        if held:
            windows.append((1 << power, held))
    return windows


def step_groups(windows: list[int], tokens: int) -> list[int]:
    """A step group for each window, by descending length to the group with the fewest tokens."""
    groups = max(1, -(-sum(windows) // tokens))
    loads = [(0, g) for g in range(groups)]
    group = [0] * len(windows)
    for i in sorted(range(len(windows)), key=lambda i: -windows[i]):
        load, g = heapq.heappop(loads)
        group[i] = g
        heapq.heappush(loads, (load + windows[i], g))
    return group


ADDED = (
    ("start", T.LongType(), pa.int64()),
    ("length", T.LongType(), pa.int64()),
    ("ids_crc32", T.LongType(), pa.int64()),
    ("doc_tokens", T.LongType(), pa.int64()),
    ("sequence_id", T.LongType(), pa.int64()),
    ("offset", T.LongType(), pa.int64()),
    ("window", T.IntegerType(), pa.int32()),
    ("step_group", T.LongType(), pa.int64()),
)
IDS = ("ids", T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))


def packed(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    keep: list[str] | None = None,
    tiers: tuple[int, ...] = TIERS,
    ids: bool = False,
    step_bytes: int = PORTION_BYTES,
    across_tasks: bool = True,
) -> DataFrame:
    """A row per piece: the columns `keep` of its document (all, if None), where it lies, and its ids if asked.

    `step_bytes` of text are tokenized at a time: less takes less memory and more time. With
    `across_tasks` a worker holds the words it knows until its next task of the stage. `tokenizer` is the path of a tokenizer file, read by the driver. A document's ids are those of its text, without special
    ones, and the end id; a null text is empty. Sequence ids and step groups carry the task's
    partition number, so they are unique in the result. Repeated rows are packed one by one. An empty
    table gives no rows. Columns named like the added ones are an error.
    """
    if sorted(tiers) != list(tiers) or any(t < 1 or t & (t - 1) for t in tiers):
        raise ValueError("window lengths are ascending powers of two")
    keep = docs.columns if keep is None else keep
    added = [*ADDED, IDS] if ids else list(ADDED)
    clash = sorted({c.lower() for c in keep} & {n for n, _, _ in added})
    if clash:
        raise ValueError(f"column names in use: {clash}")
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    width, names = len(keep), [*keep, *(n for n, _, _ in added)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = None
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 36
        sequences = groups = waiting = 0
        held: list[pa.RecordBatch] = []  # batches that the waiting documents come from
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # ids, lengths, places in those batches

        def flush() -> pa.RecordBatch:
            nonlocal sequences, groups, waiting
            lengths = np.concatenate([n for _, n, _ in parts])
            all_ids = np.concatenate([i for i, _, _ in parts])
            places = np.concatenate([p for _, _, p in parts])
            first = (np.cumsum(lengths) - lengths).tolist()
            windows = pack(lengths.tolist(), tiers)
            group = step_groups([w for w, _ in windows], STEP_TOKENS)
            doc, cells = [], [[] for _ in added]
            for number, (window, pieces) in enumerate(windows):
                offset = 0
                for d, start, n in pieces:
                    body = all_ids[first[d] + start : first[d] + start + n]
                    row = (
                        start, n, zlib.crc32(body.astype("<u4").tobytes()), int(lengths[d]), base + sequences + number, offset, window,
                        base + groups + group[number], *([body.astype(np.int32)] if ids else []),
                    )
                    doc.append(d)
                    offset += n
                    for column, cell in zip(cells, row):
                        column.append(cell)
            sequences += len(windows)
            groups += max(group, default=-1) + 1
            keys = pa.Table.from_batches(held).combine_chunks().take(pa.array(places[doc], pa.int64()))
            arrays = [pa.concat_arrays(c.chunks) for c in keys.columns]
            waiting = 0
            parts.clear()
            return pa.RecordBatch.from_arrays([*arrays, *(pa.array(c, t) for c, (_, _, t) in zip(cells, added))], names=names)

        for batch in batches:
            tokens = tokens or (tokens_of(spec, context.stageId() if context else 0) if across_tasks else Tokens(spec))
            held = [*held, batch.select(list(range(width)))] if waiting else [batch.select(list(range(width)))]
            place = sum(b.num_rows for b in held[:-1])
            for part in portions(batch.column(width), step_bytes):
                body, lengths = tokens.of(part, END)
                parts.append((body, lengths, np.arange(place, place + len(part))))
                place += len(part)
                waiting += len(body)
                if waiting >= CHUNK_TOKENS:
                    yield flush()
                    place -= sum(b.num_rows for b in held[:-1])
                    held = held[-1:]
        if waiting:
            yield flush()

    schema = T.StructType([*docs.select(*keep).schema.fields, *(T.StructField(n, t) for n, t, _ in added)])
    return docs.select(*keep, docs[text].cast("binary").alias("__text")).mapInArrow(thrifty(rows), schema)
