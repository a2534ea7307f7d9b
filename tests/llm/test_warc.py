import base64
import glob
import gzip
import hashlib
import zlib
from collections import Counter

import pytest

from checks.compare import compare
from optionflow.llm import warc
from optionflow.llm.oracles import ORACLES
from optionflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@pytest.fixture()
def small_ranges(spark):
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set(key, old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def stored(data):
    """A member whose bytes stand in the file as they are."""
    pack = zlib.compressobj(0, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def archive(tmp_path, payloads, pack=stored, damage=None):
    members = [pack(warc.record("response", k, f"http://x/{k}", p, digest(p), None)) for k, p in enumerate(payloads)]
    if damage is not None:
        members[damage] = members[damage][:20] + b"\xff" * 30 + members[damage][50:]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(members))
    return str(tmp_path)


def found(spark, folder, blocks=True):
    rows = warc.read(spark, folder, blocks).collect()
    return sorted((r.record_id, bytes(r.block) if blocks else None, r.intact) for r in rows)


def test_magic_inside_members_and_members_across_ranges(spark, tmp_path, small_ranges):
    payloads = [(warc.MAGIC + bytes([k]) * 50 + warc.EMPTY + b"WARC/1.1\r\n") * 3 * (k + 1) for k in range(12)]
    payloads.append(warc.MAGIC * 3000)
    payloads.append(stored(warc.record("response", 99, None, b"inner", digest(b"inner"), None)) * 2)
    payloads += [b"", b"\x1f\x8b", b"z" * 5000]
    for blocks in (True, False):
        got = found(spark, archive(tmp_path, payloads), blocks)
        want = [(k, p if blocks else None, True) for k, p in enumerate(payloads)]
        assert [g[0] for g in got] == [w[0] for w in want] and got == want


# members as `member` packs them (level 6), with the magic at byte 34, 32 and 61, before anything is inflated
EARLY = (
    "H4sIAAAAAAAAA02O3WqDQBSE7wXfwRfYZlfXNW6TgmiJ6R+LCJHeHdezWkhVdAPN29cWCYG5GGbmgzklRbphD8x1Tosj5XVE6U04j0M/4xoWqIepIcdMervL1MsRWpTR"
    "09pmYBeExREllC0qKZX/+lwHCq7nARqSfbU4W+nNHTAZ+K9lIfKDrxKefxxKofgxfwnfK/WcVolSrlPdwDfsW9tJL9y6Tjr0Fnu7HrX4Yzed/T4/erqDaUa7v1hD7nb3"
    "rOsYn+mIhhwBtBACjAHgEfKY1rXRsdCBgUDXgmHMGlY3AgRumwBo+Ef/AgUm2xQsAQAA",
    "H4sIAAAAAAAAA02O3U6DQBSE70l4B14AC1FAdqvJCpUfiwjdtJRE40pXIKyAsNVSE59dNERN5uJkZr6T2aDYmqknqihsxkvGQ0uB1NG+beqeTmZMs6bbyZ4NpPm+q0FL"
    "cgqMyym1CR8R1TQUWVFHYUUBP0qnwh0ZWEN2sl3mtOdA6guiAid10coxbm5XxtrTLG0dh4G+cFN8ZvnLq9ORTX7BJa1zXgBJ10XBampOaz4N5fTAZwV/YVDKCtL1lF/s"
    "+bN8/tf7z4oCyh6DgYUImJb9BM0wKhH0MtOfJ6/4Hb6VW1Zdf7DomFR4COG9P3xqThm4Drajij0sthh9f/kCLEm1NzQBAAA=",
    "H4sIAAAAAAAAA02OUUuEQBzE3wW/gx/AbZW8rM2y0Lgzz8M8Y+Webrnb3EB3xf0LeVCfPTukgnkYZuYHQx+LCLsXrmnQyaFy7Dixeq47JTWfw4IfVH9ESUysYOgl6VjN"
    "iX8/tzGDCXFvfAc57qTScchZu3mQs7FR7Iji95prIJYWzCU0L6mfLbMqWXkvq5JWl9TfFs/JJrp6LfMdNY3qF1xzWYMglrcwjUhJ4BLmo8A/AAtom1vrIFivOdwN8Iau"
    "/3b/WdNYPOFoneI9PmWZjpaj9pSN7KC1H8LPJg2UYNsTHcKQpl/t/gf4BmrK+14fAQAA",
)


def test_magic_in_the_first_compressed_bytes(spark, tmp_path, small_ranges):
    early = [base64.b64decode(m) for m in EARLY]
    assert all(0 < m.find(warc.MAGIC, 3) < 70 and b"\nWARC-Record-ID: <urn:page:7>" in gzip.decompress(m) for m in early)
    blocks = [warc.parsed(gzip.decompress(m))["block"] for m in early]
    name = early[0][:3] + b"\x08" + early[0][4:10] + b"n" + warc.MAGIC * 2 + b"\x00" + early[0][10:]  # also in a header field
    time = early[1][:4] + warc.MAGIC + early[1][7:]
    assert gzip.decompress(name) == gzip.decompress(early[0]) and gzip.decompress(time) == gzip.decompress(early[1])
    # the ranges end at every few bytes before, in and behind the members
    for shift in range(0, 1000, 37):
        filler = stored(warc.record("response", 1, None, b"x" * (300 + shift), digest(b"x" * (300 + shift)), None))
        (tmp_path / f"{shift}.warc.gz").write_bytes(filler + b"".join([*early, name, time, *early]) + filler)
    for cut in range(0, 80, 4):
        size = 1000 - cut - len(stored(warc.record("response", 1, None, b"x" * 500, digest(b"x" * 500), None))) + 500
        filler = stored(warc.record("response", 1, None, b"x" * size, digest(b"x" * size), None))
        assert len(filler) == 1000 - cut
        (tmp_path / f"cut{cut}.warc.gz").write_bytes(filler + early[2])
    want = Counter({blocks[0]: 3 * 28, blocks[1]: 3 * 28, blocks[2]: 2 * 28 + 20})
    for with_blocks in (True, False):
        got = warc.read(spark, str(tmp_path), with_blocks).collect()
        assert len(got) == 28 * 10 + 20 * 2 and all(r.intact for r in got)
        assert Counter(r.record_id for r in got) == {1: 2 * 28 + 20, 7: want.total()}
    assert Counter(bytes(r.block) for r in warc.read(spark, str(tmp_path)).collect() if r.record_id == 7) == want


def test_refuted_starts_do_not_hide_members(spark, tmp_path, small_ranges):
    # after junk, a header whose name has no end: undecided until the members behind it are tried
    members = [warc.member(warc.record("response", k, None, b"p%d" % k, digest(b"p%d" % k), None)) for k in range(9)]
    unsure = warc.MAGIC + b"\x08" + b"\x01" * 30
    (tmp_path / "a.warc.gz").write_bytes(members[0] + unsure + b"".join(members[1:5]) + unsure + b"".join(members[5:]))
    assert [g[0] for g in found(spark, str(tmp_path))] == list(range(9))


def test_damaged_and_foreign_members_are_left_out(spark, tmp_path, small_ranges):
    payloads = [bytes([65 + k]) * 700 for k in range(20)]
    folder = archive(tmp_path, payloads, damage=7)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(b"no record") + gzip.compress(b"WARC/1.1\r\nbroken"))
    (tmp_path / "c.warc.gz").write_bytes(b"junk " * 400)
    (tmp_path / "d.warc.gz").write_bytes(b"")
    assert [g[0] for g in found(spark, folder)] == [k for k in range(20) if k != 7]


def test_round_trip_of_odd_pages(spark, tmp_path, small_ranges):
    rows = [
        (1, "http://a", "same"), (5, "http://b", "same"), (3, None, "same"), (None, "http://n", "same"),
        (7, "u\r\nX-Field: 1", ""), (8, "é", None), (9, "http://c", "é" * 3000), (10, "x", "twice"), (10, "x", "twice"), (None, "m", "alone"),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, record_type string")
    pages = df.drop("record_type")
    folder, records = warc.archive(pages, str(tmp_path / "out"))
    got = sorted(records.collect(), key=lambda r: (r.record_id or 0, r.payload_digest))
    assert all(r.intact for r in got) and len(got) == len(rows)
    kinds = {(r.record_id, r.payload_bytes): (r.record_type, r.refers_to) for r in got}
    assert kinds[5, 4] == ("response", None) and kinds[1, 4] == kinds[3, 4] == kinds[None, 4] == ("revisit", 5)
    assert kinds[7, 0] == ("revisit", 8) and kinds[8, 0] == ("response", None) and kinds[10, 5] == ("response", None)
    assert kinds[None, 5] == ("response", None) and {r.payload_digest for r in got} == {digest((h or "").encode()) for _, _, h in rows}
    texts = {r.record_id: bytes(r.block).decode() for r in got if r.record_type == "response"}
    assert texts[9] == "é" * 3000 and next(r.url for r in got if r.record_id == 7) == "u%0D%0AX-Field: 1"
    # any gzip reader can read the files
    whole = b"".join(gzip.open(f).read() for f in glob.glob(f"{folder}/part-*"))
    assert whole.count(b"WARC/1.1\r\n") == len(rows)


def test_clashing_columns_and_no_pages(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "h", "x", "y")], "page_id bigint, url string, html string, record_type string, refers_to string")
    _, records = warc.archive(df, str(tmp_path / "a"))
    assert [r.record_type for r in records.collect()] == ["response"]
    _, none = warc.archive(df.limit(0), str(tmp_path / "b"), blocks=False)
    assert none.count() == 0


def test_op9_equals_sql(spark):
    ok, note = compare(spark, "op9", QUERIES["op9_warc_roundtrip"], ORACLES["op9_warc_roundtrip"], SF)
    assert ok, note
