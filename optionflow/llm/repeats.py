"""Removal of byte strings that stand in a document with a smaller id too.

Every window of `least` bytes has an anchor: the smallest hash of the `ANCHOR`-byte strings within it. Equal windows have
equal anchors, and neighbouring windows mostly share theirs, so a text has about one anchor for half as many bytes as
a window has anchors to choose from. The steps:

1. Texts are written as portions of a few megabytes. Each portion sends its distinct anchors, a few bytes of hash
   each, to buckets; a bucket tells the portions which of their anchors other documents have too.
2. Stretches of windows with such an anchor go to the anchor's bucket, each distinct one of a portion once. A bucket sorts the
   suffixes of its stretches, and the interval search of `suffixes` finds which share `least` bytes, hence the
   smallest id that holds each window. The places whose id is larger go back to the portions.
3. Portions cut these places out.

An anchor of more than `HOT` documents would make a large bucket: most of these documents have the same bytes around it, but
some may not. Its windows go one by one to the buckets of their own hashes; a portion sends equal ones once. So a group of
copies costs a bucket one stretch per portion. Hashes only decide who meets; bytes decide what is equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from .store import drop, kept
from .suffixes import least_of_equals
from .texts import portions

#: Bytes of a string whose hash can be an anchor; windows of a stretch at most.
ANCHOR, MOST_WINDOWS = 20, 64

#: Text in a portion; text whose anchors go to a bucket; text of stretches in a bucket and in one suffix sort.
PORTION, ANCHOR_BUCKET, STRETCH_BUCKET, SORTED = 4_000_000, 64_000_000, 4_000_000, 1_000_000

#: Documents up to which an anchor's stretches go to one bucket.
HOT = 5000

#: Hashes have so many bits more than the corpus has bytes by their number: few anchors meet by chance.
SPARE_BITS = 6

ODD, MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
WORD = 2**64


def hashes(body: np.ndarray, width: int) -> np.ndarray:
    """A hash of every `width` bytes in a row."""
    if len(body) < width:
        return np.empty(0, np.uint64)
    letters = np.array([((b + 1) * ODD % WORD ^ (b + 1) * MIX % WORD) for b in range(256)], np.uint64)
    some, span, factor = letters[body], 1, ODD
    found, have = None, 0
    rest = width
    while rest:
        if rest & 1:
            if found is None:
                found, have = some, span
            else:
                # the part found so far stands behind this one
                n = len(body) - have - span + 1
                found = some[:n] * np.uint64(pow(ODD, have, WORD)) + found[span : span + n]
                have += span
        rest >>= 1
        if rest:
            some = some[:-span] * np.uint64(factor) + some[span:]
            factor = factor * factor % WORD
            span *= 2
    found = found ^ found >> np.uint64(31)
    found = found * np.uint64(MIX)
    return found ^ found >> np.uint64(29)


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every `width` values in a row."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span :]) if span < width else values


def runs(body: np.ndarray, sizes: np.ndarray, usable: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, anchor and document of every stretch.

    `sizes` are those of the documents one after the other, `usable` says which take part.
    """
    width = min(ANCHOR, least)
    ends = np.cumsum(sizes)
    anchor = smallest(hashes(body, width), least - width + 1) if len(body) >= least else np.empty(0, np.uint64)
    doc = np.flatnonzero((sizes >= least) & usable)
    count = sizes[doc] - least + 1
    start = ends[doc] - sizes[doc]
    total = int(count.sum())
    if not total:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, np.uint64), none
    window = np.arange(total) + np.repeat(start - (np.cumsum(count) - count), count)
    anchor = anchor[window]
    head = np.zeros(total, bool)
    head[np.cumsum(count) - count] = True
    head[1:] |= anchor[1:] != anchor[:-1]
    first = np.flatnonzero(head)
    length = np.diff(np.append(first, total))
    pieces = -(-length // MOST_WINDOWS)
    if len(pieces) and pieces.max() > 1:
        nth = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        length = np.minimum(np.repeat(length, pieces) - nth * MOST_WINDOWS, MOST_WINDOWS)
        first = np.repeat(first, pieces) + nth * MOST_WINDOWS
    which = np.searchsorted(np.cumsum(count), first, side="right")
    return window[first], length, anchor[first], doc[which]


def cut_bytes(values: np.ndarray, size: int) -> bytes:
    """The low `size` bytes of each value."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def uncut(data: bytes, size: int) -> np.ndarray:
    wide = np.zeros((len(data) // size, 8), np.uint8)
    wide[:, :size] = np.frombuffer(data, np.uint8).reshape(-1, size)
    return wide.view("<u8").ravel()


def read(row: dict) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Text, document sizes, ids, and which ids are given, of a portion."""
    body = zstandard.ZstdDecompressor().decompress(row["body"]) if row["body"] else b""
    given = np.array([i is not None for i in row["ids"]], bool)
    return body, np.array(row["sizes"], np.int64), np.array([i or 0 for i in row["ids"]], np.int64), given


def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of batches, one in memory at a time."""
    for batch in batches:
        for a in range(batch.num_rows):
            yield batch.slice(a, 1).to_pylist()[0]


def in_portions(docs: DataFrame, id: str, text: str, keep: list[str]) -> DataFrame:
    """(portion, ids, sizes, body, kept): the documents in written rows of a few megabytes, texts compressed."""
    width = len(keep)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        for batch in batches:
            place = 0
            for part in portions(batch.column(width + 1), PORTION):
                here = batch.take(pa.array(range(place, place + len(part)), pa.int64()))
                place += len(part)
                structs = pa.StructArray.from_arrays(
                    [*here.columns[:width], here.column(width)], names=[*(f"c{i}" for i in range(width)), "id"]
                )
                body = zstandard.ZstdCompressor(level=1).compress(b"".join(part))
                columns = [
                    pa.array([number], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), here.column(width)),
                    pa.array([[len(t) for t in part]], pa.list_(pa.int64())),
                    pa.array([body], pa.binary()),
                    pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), structs),
                ]
                number += 1
                yield pa.RecordBatch.from_arrays(columns, names=["portion", "ids", "sizes", "body", "kept"])

    fields = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.select(*keep).schema.fields)]
    schema = T.StructType(
        [
            T.StructField("portion", T.LongType()),
            T.StructField("ids", T.ArrayType(T.LongType())),
            T.StructField("sizes", T.ArrayType(T.LongType())),
            T.StructField("body", T.BinaryType()),
            T.StructField("kept", T.ArrayType(T.StructType([*fields, T.StructField("id", T.LongType())]))),
        ]
    )
    asked = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(keep)], docs[id].cast("bigint").alias("id"), docs[text].cast("binary").alias("text"))
    return kept(asked.mapInArrow(rows, schema))


def shared_anchors(portioned: DataFrame, least: int, buckets: int, size: int) -> DataFrame:
    """(portion, anchors, single, volume): which of a portion's anchors (their low `size` bytes) several documents have, and
    whether so many that windows go one by one; `volume` is about the text that the portion will send."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in one_by_one(batches):
            body, sizes, _, given = read(row)
            _, _, anchor, doc = runs(np.frombuffer(body, np.uint8), sizes, given, least)
            anchor = anchor & np.uint64(2 ** (8 * size) - 1)
            by = np.lexsort((doc, anchor))
            anchor, doc = anchor[by], doc[by]
            once = np.ones(len(anchor), bool)
            once[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
            anchor, count = np.unique(anchor[once], return_counts=True)
            bucket = (anchor % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            anchor, count, bucket = anchor[by], count[by].astype("<u4"), bucket[by]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            firsts = [0, *cuts.tolist()] if len(bucket) else []
            spans = list(zip(firsts, [*cuts.tolist(), len(bucket)]))
            columns = [
                pa.array(bucket[firsts], pa.int32()),
                pa.array([row["portion"]] * len(spans), pa.int64()),
                pa.array([cut_bytes(anchor[a:b], size) for a, b in spans], pa.binary()),
                pa.array([count[a:b].tobytes() for a, b in spans], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "portion", "anchors", "counts"])

    def met(table: pa.Table) -> pa.Table:
        found = [uncut(a, size) for a in table["anchors"].to_pylist()]
        lengths = np.array([len(a) for a in found], np.int64)
        owner = np.repeat(np.arange(len(found)), lengths)
        anchor = np.concatenate(found)
        count = np.concatenate([np.frombuffer(c, "<u4") for c in table["counts"].to_pylist()]).astype(np.int64)
        by = np.argsort(anchor)
        anchor, owner, count = anchor[by], owner[by], count[by]
        first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        total = np.repeat(np.add.reduceat(count, first), np.diff(np.append(first, len(anchor))))
        many = total > 1
        anchor, owner, count, single = anchor[many], owner[many], count[many], total[many] > HOT
        by = np.argsort(owner, kind="stable")
        anchor, owner, count, single = anchor[by], owner[by], count[by], single[by]
        ends = np.cumsum(np.bincount(owner, minlength=len(found)))
        # a stretch is about half as long again as a window
        text = np.cumsum(np.append(0, count * np.where(single, least * 2, least + least // 2)))
        spans = [(int(a), int(b), p) for a, b, p in zip(np.append(0, ends[:-1]), ends, table["portion"].to_pylist()) if b > a]
        columns = [
            pa.array([p for _, _, p in spans], pa.int64()),
            pa.array([cut_bytes(anchor[a:b], size) for a, b, _ in spans], pa.binary()),
            pa.array([single[a:b].astype(np.uint8).tobytes() for a, b, _ in spans], pa.binary()),
            pa.array([int(text[b] - text[a]) for a, b, _ in spans], pa.int64()),
        ]
        return pa.Table.from_arrays(columns, names=["portion", "anchors", "single", "volume"])

    sends = portioned.select("portion", "ids", "sizes", "body").mapInArrow(sent, "bucket int, portion bigint, anchors binary, counts binary")
    return sends.groupBy("bucket").applyInArrow(met, "portion bigint, anchors binary, single binary, volume bigint")


def packed_stretches(texts: list[bytes], occurrences: list[list[tuple[int, int]]]) -> bytes:
    """Distinct stretches with the (place, id) of each occurrence, compressed."""
    sizes = np.array([len(t) for t in texts], "<u4")
    counts = np.array([len(o) for o in occurrences], "<u4")
    both = np.array([x for o in occurrences for x in o], "<i8").reshape(-1, 2)
    parts = [np.array([len(texts)], "<u4").tobytes(), sizes.tobytes(), counts.tobytes(), both[:, 0].astype("<u4").tobytes(), np.ascontiguousarray(both[:, 1]).tobytes(), *texts]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpacked_stretches(data: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Texts, number of occurrences of each, places and ids of all occurrences."""
    data = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(data, "<u4", 1)[0])
    sizes = np.frombuffer(data, "<u4", n, 4).astype(np.int64)
    counts = np.frombuffer(data, "<u4", n, 4 + 4 * n).astype(np.int64)
    total, at = int(counts.sum()), 4 + 8 * n
    places = np.frombuffer(data, "<u4", total, at).astype(np.int64)
    ids = np.frombuffer(data, "<i8", total, at + 4 * total)
    at += 12 * total
    ends = (at + np.cumsum(sizes)).tolist()
    return [data[a:b] for a, b in zip([at, *ends], ends)], counts, places, ids


def stretches(portioned: DataFrame, shared: DataFrame, least: int, buckets: int, size: int) -> DataFrame:
    """(bucket, portion, stretches): what each portion sends to each bucket."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in one_by_one(batches):
            body, sizes, ids, given = read(row)
            array = np.frombuffer(body, np.uint8)
            first, length, anchor, doc = runs(array, sizes, given, least)
            known = np.concatenate([uncut(s["anchors"], size) for s in row["shared"]])
            single = np.concatenate([np.frombuffer(s["single"], np.uint8) for s in row["shared"]])
            by = np.argsort(known)
            known, single = known[by], single[by]
            anchor = anchor & np.uint64(2 ** (8 * size) - 1)
            at = np.minimum(np.searchsorted(known, anchor), len(known) - 1)
            on = known[at] == anchor
            alone = on & (single[at] > 0)
            on &= ~alone
            starts, counts, keys, docs = first[on], length[on], anchor[on], doc[on]
            if alone.any():
                some, n = first[alone], length[alone]
                each = np.repeat(some - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                starts, counts = np.concatenate([starts, each]), np.concatenate([counts, np.ones(len(each), np.int64)])
                keys = np.concatenate([keys, hashes(array, least)[each]])
                docs = np.concatenate([docs, np.repeat(doc[alone], n)])
            bucket = (keys % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            held: dict[bytes, list[tuple[int, int]]] = {}
            found, last = [], -1

            def flush() -> None:
                if held:
                    found.append((last, packed_stretches(list(held), list(held.values()))))
                    held.clear()

            for b, a, end, i in zip(
                bucket[by].tolist(), starts[by].tolist(), (starts + counts + least - 1)[by].tolist(), ids[docs[by]].tolist()
            ):
                if b != last:
                    flush()
                    last = b
                text = body[a:end]
                at_text = held.get(text)
                if at_text is None:
                    held[text] = [(a, i)]
                else:
                    at_text.append((a, i))
            flush()
            columns = [
                pa.array([b for b, _ in found], pa.int32()),
                pa.array([row["portion"]] * len(found), pa.int64()),
                pa.array([s for _, s in found], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "portion", "stretches"])

    lists = shared.groupBy("portion").agg(F.collect_list(F.struct("anchors", "single")).alias("shared"))
    asked = portioned.select("portion", "ids", "sizes", "body").join(lists, "portion")
    return asked.mapInArrow(rows, "bucket int, portion bigint, stretches binary")


def smallest_ids(texts: list[bytes], values: np.ndarray, least: int) -> list[np.ndarray]:
    """`least_of_equals`, in sorts of bounded size: stretches whose first windows have other anchors share no window."""
    if sum(map(len, texts)) <= SORTED:
        return least_of_equals(texts, values, least)
    width = min(ANCHOR, least)
    sizes = np.array([len(t) for t in texts], np.int64)
    anchor = smallest(hashes(np.frombuffer(b"".join(texts), np.uint8), width), least - width + 1)[np.cumsum(sizes) - sizes]
    by = np.argsort(anchor, kind="stable")
    behind, key = np.cumsum(sizes[by]), anchor[by]
    found: list[np.ndarray] = [values[:0]] * len(texts)
    begin = 0
    while begin < len(by):
        end = max(int(np.searchsorted(behind, (behind[begin - 1] if begin else 0) + SORTED, side="right")), begin + 1)
        end = int(np.searchsorted(key, key[end - 1], side="right"))
        some = by[begin:end].tolist()
        for i, x in zip(some, least_of_equals([texts[i] for i in some], values[by[begin:end]], least)):
            found[i] = x
        begin = end
    return found


def repeated(sent: DataFrame, least: int) -> DataFrame:
    """(portion, starts, ends): places of a portion whose bytes start in a document with a smaller id too."""

    def solved(table: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {}
        which, places, ids, owner = [], [], [], []
        for row, data in enumerate(table["stretches"]):
            texts, counts, place, id = unpacked_stretches(data.as_py())
            which.append(np.repeat(np.array([number.setdefault(t, len(number)) for t in texts], np.int64), counts))
            places.append(place), ids.append(id), owner.append(np.full(len(place), row))
        which, places, ids, owner = (np.concatenate(x) for x in (which, places, ids, owner))
        value = np.full(len(number), np.iinfo(np.int64).max)
        np.minimum.at(value, which, ids)
        found = smallest_ids(list(number), value, least)
        sizes = np.array([len(x) for x in found], np.int64)
        flat, start = np.concatenate(found), np.cumsum(sizes) - sizes
        low = np.array([x.min() for x in found])
        some = low[which] < ids
        which, places, ids, owner = which[some], places[some], ids[some], owner[some]
        # all windows of these occurrences, in order of portion and place
        n = sizes[which]
        each = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        hit = flat[np.repeat(start[which], n) + each] < np.repeat(ids, n)
        place, portion = (np.repeat(places, n) + each)[hit], np.repeat(owner, n)[hit]
        by = np.lexsort((place, portion))
        place, portion = place[by], portion[by]
        new = np.ones(len(place), bool)
        new[1:] = (portion[1:] != portion[:-1]) | (place[1:] > place[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(place)) - 1
        begin, end, of = place[first], place[last] + least, portion[first] if len(first) else portion
        cuts = np.searchsorted(of, np.arange(table.num_rows + 1)).tolist()
        spans = [(a, b, p) for a, b, p in zip(cuts, cuts[1:], table["portion"].to_pylist()) if b > a]
        columns = [
            pa.array([p for _, _, p in spans], pa.int64()),
            pa.array([begin[a:b].astype("<i8").tobytes() for a, b, _ in spans], pa.binary()),
            pa.array([end[a:b].astype("<i8").tobytes() for a, b, _ in spans], pa.binary()),
        ]
        return pa.Table.from_arrays(columns, names=["portion", "starts", "ends"])

    return sent.groupBy("bucket").applyInArrow(solved, "portion bigint, starts binary, ends binary")


def removed(portioned: DataFrame, cuts: DataFrame, docs: DataFrame, keep: list[str], id: str, text: bool) -> DataFrame:
    """Per document: what is cut out, and what is left."""
    width = len(keep)
    plain = [("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept_sha256", T.StringType())]
    if text:
        plain += [("kept_text", T.BinaryType()), ("removed_spans", T.ArrayType(T.ArrayType(T.LongType())))]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(batch.num_rows):
                one = batch.slice(a, 1)
                row = one.select(["ids", "sizes", "body", "cuts"]).to_pylist()[0]
                body, sizes, _, _ = read(row)
                ends = np.cumsum(sizes)
                change = np.zeros(len(body) + 1, np.int32)
                for cut in row["cuts"] or ():
                    np.add.at(change, np.frombuffer(cut["starts"], "<i8"), 1)
                    np.add.at(change, np.frombuffer(cut["ends"], "<i8"), -1)
                gone = np.cumsum(change[:-1]) > 0
                array, cells = np.frombuffer(body, np.uint8), [[] for _ in plain]
                for begin, end in zip((ends - sizes).tolist(), ends.tolist()):
                    out = gone[begin:end]
                    edge = np.flatnonzero(np.diff(out, prepend=False, append=False))
                    left = array[begin:end][~out].tobytes() if len(edge) else body[begin:end]
                    values = [end - begin, end - begin - len(left), len(edge) // 2, hashlib.sha256(left).hexdigest()]
                    values += [left, edge.reshape(-1, 2).tolist()] if text else []
                    for column, cell in zip(cells, values):
                        column.append(cell)
                structs = pa.concat_arrays([one.column("kept")]).flatten()
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.list_(pa.int64()))]
                columns = [*(structs.field(i) for i in (width, *range(width))), *(pa.array(c, k) for c, k in zip(cells, kinds))]
                yield pa.RecordBatch.from_arrays(columns, names=schema_names)

    schema = T.StructType(
        [T.StructField(id, T.LongType()), *docs.select(*keep).schema.fields, *(T.StructField(n, t) for n, t in plain)]
    )
    schema_names = schema.fieldNames()
    lists = cuts.groupBy("portion").agg(F.collect_list(F.struct("starts", "ends")).alias("cuts"))
    return portioned.join(lists, "portion", "left").mapInArrow(rows, schema)


def deduplicate(
    docs: DataFrame, least: int = 50, id: str = "doc_id", text: str = "text", keep: list[str] | None = None, texts: bool = True
) -> DataFrame:
    """A row per document: id, the columns `keep` (all others, if None), n_bytes, n_removed, n_spans, kept_sha256, and with
    `texts` what is left (kept_text, as bytes) and the removed [start, end) byte spans.

    A byte goes if a string of `least` bytes around it also starts in a document with a smaller id, in the input as it
    is. A null text is empty. A document without an id takes no part: it loses nothing, and nothing goes because of it. Rows
    with one id are no smaller than each other, so they keep what only they share. Repeats within a
    document stay. An empty table gives an empty one. Columns named like the added ones are an error.
    """
    if least < 1:
        raise ValueError("strings have at least one byte")
    keep = [c for c in docs.columns if c not in (id, text)] if keep is None else keep
    added = {"n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "removed_spans"}
    clash = sorted({c.lower() for c in keep} & (added | {id.lower()}))
    if clash:
        raise ValueError(f"column names in use: {clash}")
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    portioned = in_portions(docs, id, text, keep)
    total = portioned.select(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()[0] or 0
    size = min(8, -(-(total.bit_length() + SPARE_BITS) // 8))
    shared = kept(shared_anchors(portioned, least, max(tasks, -(-total // ANCHOR_BUCKET)), size))
    volume = shared.agg(F.sum("volume")).first()[0] or 0
    sent = stretches(portioned, shared, least, max(tasks, -(-volume // STRETCH_BUCKET)), size)
    cuts = kept(repeated(sent, least))
    drop(spark, shared)
    return removed(portioned, cuts, docs, keep, id, texts)
