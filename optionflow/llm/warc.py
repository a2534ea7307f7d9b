"""WARC archives: written one gzip member per record, read by a splittable scan.

Writing. Spark's text sink writes a string's bytes as they are, so a member cast to string
lands unchanged in the file; the sink's line separator is an empty gzip member, which every
gzip reader skips. The files are plain multi-member gzip on whatever storage Spark writes to.

Reading. Spark's text source cuts files into byte ranges. With the gzip magic as its line
separator a task scans its range for the magic and owns what starts inside it. A stretch
between two magics is only a candidate: compressed bytes can hold the magic too. So a
stretch with a valid gzip header starts a member that takes further stretches: until it has
inflated to a WARC version line it is undecided, then accepted, and whole once it inflates to
its end; when it is refuted, the next stretch is tried. Stretches before
the first accepted member of a range are the end of a member of an earlier range; the few
members cut that way, or undecided at the end of a range, are put together in a second step.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .store import kept, shared_folder

# Fixed values of the gzip format (RFC 1952) and of WARC 1.1.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
RECORD = b"WARC/1."  # what every record starts with
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"

LATIN = "ISO-8859-1"

# Hadoop picks a file's codec by the last suffix, in the order of reversed names, that comes before the name. One
# that never occurs, just before .warc.gz, hides the gzip codec from such files, so they are split and read as they are.
AS_THEY_ARE = {
    "io.compression.codecs": "org.apache.hadoop.io.compress.PassthroughCodec",
    "io.compress.passthrough.extension": ".varc.gz",
    "org.apache.hadoop.shaded.io.compress.passthrough.extension": ".varc.gz",  # its name in the shaded client
}
GZIP = 31  # zlib's window bits for a gzip wrapper


def member(data: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, GZIP)
    return pack.compress(data) + pack.flush()


EMPTY = member(b"")


def field(value: object) -> str:
    """A header value: control characters, which could end the field, as percent codes."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", str(value))


def record(kind: str, id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record. A revisit has no block; its payload length stands in an extension field."""
    block = b"" if kind == "revisit" else payload
    head = [f"WARC-Type: {kind}"]
    if id is not None:
        head.append(f"WARC-Record-ID: <urn:page:{id}>")
    if url is not None:
        head.append(f"WARC-Target-URI: {field(url)}")
    head += [
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if kind == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    return VERSION + CRLF + "\r\n".join(head).encode() + CRLF + CRLF + block + CRLF + CRLF


def parsed(data: bytes) -> dict | None:
    """Header fields (lower-case names) and block of a record; None if it isn't a whole one."""
    head, blank, rest = data.partition(CRLF + CRLF)
    lines = head.split(CRLF)
    if not blank or not lines[0].startswith(RECORD):
        return None
    fields = {}
    for line in lines[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    size = fields.get("content-length", "")
    if not size.isdigit() or rest[int(size) :] != CRLF + CRLF:
        return None
    return fields | {"block": rest[: int(size)]}


def page_number(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


# --- writing ---------------------------------------------------------------------------


def dispositions(pages: DataFrame) -> DataFrame:
    """Add `digest_hex`, `record_type` and `refers_to`.

    Among rows of equal payload (null counts as empty) those with the largest page_id are
    responses and the others revisit it. A row without page_id is a revisit, unless no row
    of its payload has one: then all are responses. The largest id per payload is found by a
    map-side aggregate, so copies of one page do not meet in a task before they are joined,
    and adaptive execution can split that join.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    hashed = pages.withColumn("digest_hex", F.sha1(body))
    last = hashed.groupBy(F.col("digest_hex").alias("__digest")).agg(F.max("page_id").alias("__last"))
    joined = hashed.join(last, F.col("digest_hex") == F.col("__digest"))
    response = F.col("__last").isNull() | F.coalesce(F.col("page_id") == F.col("__last"), F.lit(False))
    return joined.select(
        *pages.columns,
        "digest_hex",
        F.when(response, "response").otherwise("revisit").alias("record_type"),
        F.when(~response, F.col("__last")).alias("refers_to"),
    )


def write(pages: DataFrame, folder: str) -> None:
    """Write `page_id`, `url`, `html` of pages with dispositions as archives below a folder."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for id, url, html, hexed, kind, refers in zip(*(c.to_pylist() for c in batch.columns)):
                digest = base64.b32encode(bytes.fromhex(hexed)).decode()
                out.append(member(record(kind, id, url, html or b"", digest, refers)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    columns = ["page_id", "url", F.col("html").cast("binary"), "digest_hex", "record_type", "refers_to"]
    packed = pages.select(*columns).mapInArrow(members, "member binary")
    packed.select(F.col("member").cast("string")).write.option("encoding", LATIN).option(
        "lineSep", EMPTY.decode("latin-1")
    ).text(folder)


# --- reading ---------------------------------------------------------------------------


class Member:
    """A gzip member that is put together from stretches; `sure` once it has inflated to a WARC version line."""

    def __init__(self) -> None:
        self.inflate, self.data, self.head, self.sure = zlib.decompressobj(GZIP), [], b"", False

    def add(self, stretch: bytes) -> bool:
        """Add magic + stretch; True once the member is whole. zlib.error if it is damaged or holds no WARC record.

        The magic can come before the first byte that is inflated, so it can take several stretches to be sure.
        """
        rest = MAGIC + stretch
        if not self.sure:
            self.head += self.inflate.decompress(rest, len(RECORD) - len(self.head))
            if not RECORD.startswith(self.head) or (self.inflate.eof and self.head != RECORD):
                raise zlib.error("no WARC record")
            if self.head != RECORD:
                return False
            self.sure, self.data, rest = True, [self.head], self.inflate.unconsumed_tail
        self.data.append(self.inflate.decompress(rest))
        return self.inflate.eof

    def bytes(self) -> bytes:
        return b"".join(self.data)


class Walk:
    """Members from stretches that follow each other.

    `held` are the stretches since the start of the member that is not whole yet, `synced` is whether
    a start was certain so far.
    """

    def __init__(self, synced: bool = False) -> None:
        self.member, self.held, self.synced = None, [], synced

    def add(self, *stretches: bytes) -> Iterator[tuple[bool, bytes]]:
        """(True, data) of each member that is now whole, (False, stretch) of each stretch at which none starts.

        When a member is refuted or damaged, the next one is looked for from its second stretch on.
        """
        todo = list(reversed(stretches))
        while todo:
            stretch = todo.pop()
            if self.member is None:
                if MAGIC + stretch == EMPTY:
                    self.synced = True
                    continue
                self.member = Member()
            self.held.append(stretch)
            try:
                whole, refuted = self.member.add(stretch), False
            except zlib.error:
                whole, refuted = False, True
            self.synced |= self.member.sure
            if whole or refuted:
                member, held = self.member, self.held
                self.member, self.held = None, []
                if refuted:
                    todo += reversed(held[1:])
                yield (False, held[0]) if refuted else (True, member.bytes())

    def end(self) -> Iterator[tuple[bool, bytes]]:
        """What is left when no stretch follows: an unfinished member is none, but others can start within it."""
        while self.held:
            first, *others = self.held
            self.member, self.held = None, []
            yield False, first
            yield from self.add(*others)


FIELDS = (
    ("path", "string", pa.string()),
    ("record_id", "bigint", pa.int64()),
    ("record_type", "string", pa.string()),
    ("refers_to", "bigint", pa.int64()),
    ("url", "string", pa.string()),
    ("payload_digest", "string", pa.string()),
    ("payload_bytes", "bigint", pa.int64()),
    ("intact", "boolean", pa.bool_()),
)
BLOCK = (("block", "binary", pa.binary()),)
PIECE = (("start", "bigint", pa.int64()), ("kind", "string", pa.string()), ("place", "bigint", pa.int64()), ("piece", "binary", pa.binary()))
Fields = tuple[tuple[str, str, pa.DataType], ...]


def ddl(fields: Fields) -> str:
    return ", ".join(f"{name} {kind}" for name, kind, _ in fields)


def arrays(rows: list[dict], fields: Fields) -> dict[str, pa.Array]:
    return {name: pa.array([r.get(name) for r in rows], kind) for name, _, kind in fields}


def record_row(path: str, data: bytes) -> dict | None:
    """A record's fields; `intact` is whether length and digest of a stored payload are as its header says."""
    got = parsed(data)
    if got is None:
        return None
    block, length = got["block"], got.get("x-payload-length", "")
    size = int(length) if length.isdigit() else len(block)
    digest = got.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = got.get("warc-type")
    stored = base64.b32encode(hashlib.sha1(block).digest()).decode()
    return {
        "path": path,
        "record_id": page_number(got.get("warc-record-id")),
        "record_type": kind,
        "refers_to": page_number(got.get("warc-refers-to")),
        "url": got.get("warc-target-uri"),
        "payload_digest": digest,
        "payload_bytes": size,
        "intact": kind == "revisit" or (len(block) == size and stored == digest),
        "block": block,
    }


def split_scan(spark: SparkSession, folder: str, blocks: bool) -> DataFrame:
    """Records that one byte range holds whole (kind `member`), and the pieces of those that are cut.

    A cut member has its pieces in its own range as `open` and in the next ones as `tail`. A range without a
    certain start can end with stretches that may start a member or belong to an earlier one: these are `maybe`.
    """
    stretches = (
        spark.read.options(**AS_THEY_ARE)
        .option("encoding", LATIN)
        .option("lineSep", MAGIC.decode("latin-1"))
        .text(folder)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("start"),
            F.col("value").cast("binary").alias("stretch"),
        )
    )
    fields = FIELDS + BLOCK * blocks + PIECE

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the rows of a byte range come in order; a task can have several ranges
        at, walk, place = None, Walk(), 0

        def left() -> list[dict]:
            kind = "open" if walk.synced else "maybe"
            return [{"path": at[0], "start": at[1], "kind": kind, "place": k, "piece": p} for k, p in enumerate(walk.held)]

        for batch in batches:
            out = []
            for path, start, stretch in zip(*(c.to_pylist() for c in batch.columns)):
                if (path, start) != at:
                    out += left()
                    at, walk, place = (path, start), Walk(start == 0), 0
                    if start == 0:
                        continue  # what stands before the first magic
                for whole, data in walk.add(stretch):
                    if whole:
                        if got := record_row(path, data):
                            out.append(got | {"start": start, "kind": "member", "place": 0})
                    elif not walk.synced:
                        out.append({"path": path, "start": start, "kind": "tail", "place": place, "piece": data})
                        place += 1
            yield pa.RecordBatch.from_pydict(arrays(out, fields))
        yield pa.RecordBatch.from_pydict(arrays(left(), fields))

    return stretches.mapInArrow(scan, ddl(fields))


def read(spark: SparkSession, folder: str, blocks: bool = True) -> DataFrame:
    """The records of all archives below a folder, with their blocks or without.

    Damaged members are left out, and so are members without a WARC record. Without
    blocks the scan's few columns are kept in the shared folder, so the archives are
    scanned once; with blocks they are scanned a second time for the cut members.
    """
    found = split_scan(spark, folder, blocks)
    found = found if blocks else kept(found)
    fields = FIELDS + BLOCK * blocks

    def sewn(cut: pa.Table) -> pa.Table:
        path, found, walk = cut["path"][0].as_py(), [], Walk()
        pieces = cut.select(["start", "kind", "place", "piece"]).to_pylist()
        for p in sorted(pieces, key=lambda p: (p["start"], p["kind"] != "tail", p["place"])):
            found += walk.add(p["piece"])
        found += walk.end()
        rows = [record_row(path, data) for whole, data in found if whole]
        return pa.table(arrays([r for r in rows if r], fields))

    whole = found.filter(F.col("kind") == "member").select(*[name for name, _, _ in fields])
    pieces = kept(found.filter(F.col("kind") != "member").select("path", *[name for name, _, _ in PIECE]))
    cut = chained(pieces).groupBy("path", "chain").applyInArrow(sewn, ddl(fields))
    return whole.unionByName(cut)


def chained(pieces: DataFrame) -> DataFrame:
    """Add `chain`: the byte range in which the member that a piece may belong to was opened.

    A range with a certain start opens a chain, which its tail and the ranges up to the next such one go on. So a
    file gives many small groups, however long it is; one row per range says where its chain began.
    """
    ranges = pieces.groupBy("path", "start").agg(F.max(F.col("kind") == "open").alias("opens"))
    before = W.partitionBy("path").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    earlier = F.last(F.when(F.col("opens"), F.col("start")), ignorenulls=True).over(before)
    chains = ranges.select("path", "start", F.coalesce(earlier, F.lit(-1)).alias("earlier"))
    of = F.when(F.col("kind") == "open", F.col("start")).otherwise(F.col("earlier"))
    return pieces.join(chains, ["path", "start"]).withColumn("chain", of).drop("earlier")


def archive(pages: DataFrame, folder: str | None = None, blocks: bool = True) -> tuple[str, DataFrame]:
    """Write pages as archives; the folder, and the records read back from it.

    `pages` has page_id, url and html; other columns are not archived. Null html is an empty payload,
    a null url has no field, a null page_id no record id.
    """
    folder = folder or shared_folder(pages.sparkSession)
    write(dispositions(pages.select("page_id", "url", "html")), folder)
    return folder, read(pages.sparkSession, folder, blocks)
