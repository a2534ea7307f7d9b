"""Secret scans with structural confirmation.

Patterns find assignments, access key ids and hex runs. Runs that look like base64, hex or a
signed token are decoded, and reported only if the bytes parse as what they would have to be:
a private key in DER whose nested lengths add up, an OpenSSH key blob, or a token whose
header and claims are JSON objects.

All positions are code points, ends exclusive.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from .texts import thrifty

# The base patterns. Letters of the key words in either case, ASCII only.
ASSIGN = re.compile(
    r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
ASSIGN_MIN, ACCESS_MIN = 6, 20

#: Kinds in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "der", "openssh", "jwt")

# No pattern goes over a stretch of text twice: runs begin where no character of theirs stands before, and give nothing back.
PEM_LINE = re.compile(r"-----(BEGIN|END) ((?:[A-Z]{1,20} )?PRIVATE KEY)-----")
PEM_HEADERS = re.compile(r"\s*+((?:[A-Za-z][A-Za-z0-9-]*+:[^\n]*+\n[ \t]*+)++)")
PEM_BODY = re.compile(r"[A-Za-z0-9+/=\s]++")
# An RFC 1421 header that names the cipher of the body.
ENCRYPTED = re.compile(r"^[ \t]*+DEK-Info:[ \t]*+[A-Z0-9-]++,[ \t]*+(?:[0-9A-Fa-f]{16}|[0-9A-Fa-f]{32})[ \t\r]*+$", re.M)
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}+={0,2}")
# Lines of one width, but the last one, as encoders wrap them.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/])([A-Za-z0-9+/]{60,80}+(?:\r?\n[A-Za-z0-9+/]{60,80}+)*+)(?:\r?\n[A-Za-z0-9+/]{1,80}+)?={0,2}")
HEX_BYTES = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){24,}+")
JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{2,}+\.[A-Za-z0-9_-]*+")

SEQUENCE, INTEGER, OCTETS, OID = 0x30, 0x02, 0x04, 0x06
# Object identifiers in DER. 1.2.840.113549.1.5 (PKCS#5) and 1.2.840.113549.1.12.1 (PKCS#12)
PBE = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
RSA_ID = bytes.fromhex("2a864886f70d010101")  # 1.2.840.113549.1.1.1
DSA_ID = bytes.fromhex("2a8648ce380401")  # 1.2.840.10040.4.1
EC_ID = bytes.fromhex("2a8648ce3d0201")  # 1.2.840.10045.2.1
SCALAR_SIZES = (20, 24, 28, 32, 48, 66)
EDWARDS_IDS = {bytes.fromhex("2b656e"): 32, bytes.fromhex("2b6570"): 32, bytes.fromhex("2b656f"): 56, bytes.fromhex("2b6571"): 57}  # 1.3.101.110 to 113


def unbase64(run: str) -> bytes | None:
    """Bytes of a run in either base64 alphabet, padding optional; None if it can't be one."""
    body = re.sub(r"\s+", "", run).rstrip("=").translate(str.maketrans("-_", "+/"))
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, content start and content end of the DER element at `at`, if it fits before `end`."""
    if at + 2 > end:
        return None
    tag, length, start = data[at], data[at + 1], at + 2
    if length & 0x80:
        size = length & 0x7F
        if not 1 <= size <= 4 or start + size > end or data[start] == 0:
            return None
        length, start = int.from_bytes(data[start : start + size], "big"), start + size
        if length < 0x80:
            return None
    return (tag, start, start + length) if start + length <= end else None


def children(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """Elements that fill the range exactly, or None."""
    found = []
    while start < end:
        item = element(data, start, end)
        if item is None:
            return None
        found.append(item)
        start = item[2]
    return found


def is_cipher(data: bytes, algorithm: list[tuple[int, int, int]]) -> bool:
    """An algorithm of password-based encryption: its OID, in the arcs of PKCS#5 or PKCS#12, and parameters."""
    tag, start, end = algorithm[0]
    return tag == OID and data[start:end].startswith(PBE) and algorithm[1][0] == SEQUENCE


def is_dsa(version: int, p: int, q: int, g: int, y: int, x: int) -> bool:
    """Sizes and laws of a DSA key: q divides p - 1, g generates, y is g to the power of x."""
    if version != 0 or not 512 <= p.bit_length() <= 4096 or not 160 <= q.bit_length() <= 256 or (p - 1) % q:
        return False
    return 1 < g < p and 0 < x < q and pow(g, x, p) == y


def numbers(data: bytes, parts: list[tuple[int, int, int]]) -> list[int]:
    return [int.from_bytes(data[a:b], "big") for _, a, b in parts]


def is_rsa(version: int, n: int, e: int, d: int, p: int, q: int, *rest: int) -> bool:
    """Sizes and laws of an RSA key: a modulus of 512 bits or more that is the product of its two primes, and exponents within it."""
    return version in (0, 1) and 512 <= n.bit_length() <= 16384 and 1 < e < n and 1 < d < n and min(p, q) > 1 and p * q == n


def is_rsa_sequence(data: bytes, start: int, end: int) -> bool:
    parts = children(data, start, end)
    if not parts or len(parts) < 9 or any(t != INTEGER for t, _, _ in parts[:9]):
        return False
    return is_rsa(*numbers(data, parts[:9]))


def is_ec_sequence(data: bytes, start: int, end: int, named: bool) -> bool:
    """SEC 1: version 1, a scalar of a curve's length, then tagged parameters; without them and a known curve, a usual length."""
    parts = children(data, start, end)
    if not parts or len(parts) < 2 or [t for t, _, _ in parts[:2]] != [INTEGER, OCTETS] or numbers(data, parts[:1]) != [1]:
        return False
    size = parts[1][2] - parts[1][1]
    tagged = [t for t, _, _ in parts[2:]]
    if not 16 <= size <= 72 or any(t not in (0xA0, 0xA1) for t in tagged):
        return False
    curve = [children(data, a, b) for t, a, b in parts[2:] if t == 0xA0]
    if curve:
        return bool(curve[0]) and curve[0][0][0] in (OID, SEQUENCE)
    return named or size in SCALAR_SIZES


def is_private(data: bytes, algorithm: list[tuple[int, int, int]], start: int, end: int) -> bool:
    """The octets of a PKCS#8 key, as its algorithm has them."""
    oid = data[algorithm[0][1] : algorithm[0][2]]
    inner = element(data, start, end)
    if inner is None or inner[2] != end:
        return False
    tag, a, b = inner
    if oid == RSA_ID:
        return tag == SEQUENCE and is_rsa_sequence(data, a, b)
    if oid == EC_ID:
        return tag == SEQUENCE and is_ec_sequence(data, a, b, named=len(algorithm) > 1)
    if oid in EDWARDS_IDS:
        return tag == OCTETS and b - a == EDWARDS_IDS[oid]
    if oid == DSA_ID:
        group = children(data, *algorithm[1][1:]) if len(algorithm) > 1 and algorithm[1][0] == SEQUENCE else None
        if tag != INTEGER or not group or [t for t, _, _ in group] != [INTEGER] * 3:
            return False
        p, q, g = numbers(data, group)
        x = int.from_bytes(data[a:b], "big")
        return 512 <= p.bit_length() <= 4096 and 160 <= q.bit_length() <= 256 and (p - 1) % q == 0 and 1 < g < p and 0 < x < q
    # of an algorithm that is not known here, at least one whole element of some size
    return tag in (SEQUENCE, INTEGER, OCTETS) and b - a >= 16


def is_der_key(data: bytes) -> bool:
    """PKCS#1, DSA, PKCS#8 (also encrypted) or SEC 1 private key: one outer sequence of exactly the data, well formed inside."""
    outer = element(data, 0, len(data))
    if outer is None or outer[0] != SEQUENCE or outer[2] != len(data):
        return False
    parts = children(data, outer[1], outer[2])
    if not parts or len(parts) < 2:
        return False
    tags = [p[0] for p in parts]
    if tags == [SEQUENCE, OCTETS]:  # encrypted: the algorithm with its parameters, then the cipher text
        algorithm = children(data, parts[0][1], parts[0][2])
        return bool(algorithm) and len(algorithm) == 2 and is_cipher(data, algorithm) and parts[1][2] - parts[1][1] >= 16
    if parts[0][0] != INTEGER or parts[0][2] - parts[0][1] != 1:
        return False
    if tags == [INTEGER] * 6:
        return is_dsa(*numbers(data, parts))
    if tags[1] == INTEGER:
        return is_rsa_sequence(data, outer[1], outer[2])
    if tags[1] == SEQUENCE and len(tags) > 2 and tags[2] == OCTETS:
        algorithm = children(data, parts[1][1], parts[1][2])
        return bool(algorithm) and algorithm[0][0] == OID and is_private(data, algorithm, parts[2][1], parts[2][2])
    return is_ec_sequence(data, outer[1], outer[2], named=False)


OPENSSH = b"openssh-key-v1\0"


def is_openssh_key(data: bytes) -> bool:
    """Magic, cipher, KDF name and options, key count, public keys and the private part, each by its length."""
    if not data.startswith(OPENSSH):
        return False
    at, fields = len(OPENSSH), 0
    while fields < 3:
        size = int.from_bytes(data[at : at + 4], "big")
        at, fields = at + 4 + size, fields + 1
        if at + 4 > len(data):
            return False
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    for _ in range(min(keys, 16)):
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4 + size
        if at + 4 > len(data):
            return False
    private = int.from_bytes(data[at : at + 4], "big")
    return 1 <= keys <= 16 and at + 4 + private == len(data)


def is_token(run: str) -> bool:
    """Header with an algorithm and claims, both JSON objects."""
    head, claims, _ = run.split(".")
    try:
        header = json.loads(unbase64(head) or b"")
        body = json.loads(unbase64(claims) or b"")
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(body, dict)


def key_kind(data: bytes | None) -> str | None:
    if data is None:
        return None
    return "der" if is_der_key(data) else "openssh" if is_openssh_key(data) else None


def encrypted_kind(headers: str | None, data: bytes | None) -> str | None:
    """Kind of a PEM body that its headers call encrypted: DER as whole cipher blocks."""
    return "der" if headers and data and ENCRYPTED.search(headers) and len(data) >= 16 and len(data) % 8 == 0 else None


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the three base patterns, failing matches dropped."""
    found = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    found += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return found


def pem_blocks(text: str) -> Iterator[tuple[int, int, str | None, str]]:
    """Start, end, headers and body of every BEGIN line with its END line, if nothing but headers and base64 stands between."""
    begin = None
    for m in PEM_LINE.finditer(text):
        if m[1] == "BEGIN":
            begin = m
        elif begin is not None:
            if begin[2] == m[2]:
                headers = PEM_HEADERS.match(text, begin.end(), m.start())
                start = headers.end() if headers else begin.end()
                body = PEM_BODY.match(text, start, m.start())
                if body and body.end() == m.start():
                    yield begin.start(), m.end(), headers[1] if headers else None, body[0]
            begin = None


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    """Encoded keys and tokens whose decoded bytes parse. Takes time in proportion to the text, whatever it holds."""
    found = [(*m.span(), "jwt") for m in JWT.finditer(text) if is_token(m[0])] if "eyJ" in text else []
    if "PRIVATE KEY-----" in text:
        for a, b, headers, body in pem_blocks(text):
            data = unbase64(body)
            if kind := key_kind(data) or encrypted_kind(headers, data):
                found.append((a, b, kind))
    taken = sorted((a, b) for a, b, _ in found)

    def confirm(pattern: re.Pattern, first: tuple[str, ...], decode: Callable[[str], bytes | None]) -> None:
        nonlocal taken
        more, at = [], 0
        for m in pattern.finditer(text):
            a, b = m.span()
            while at < len(taken) and taken[at][1] < b:
                at += 1
            inside = at < len(taken) and taken[at][0] <= a and b <= taken[at][1]
            if inside or not text[a : a + 2].lower().startswith(first):
                continue
            if kind := key_kind(decode(m[0])):
                more.append((a, b, kind))
            elif pattern.groups and m.end(1) < b and (kind := key_kind(decode(m[1]))):
                more.append((a, m.end(1), kind))  # what follows the lines is not part of the key
        found.extend(more)
        taken = sorted([*taken, *((a, b) for a, b, _ in more)])

    # DER starts with byte 0x30 (M, or 30 in hex), the OpenSSH magic with "b3Bl" (6f)
    confirm(WRAPPED, ("m", "b"), unbase64)
    confirm(BASE64, ("m", "b"), unbase64)
    confirm(HEX_BYTES, ("30", "6f"), bytes.fromhex)
    return found


def order(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def redacted(text: str, spans: list[tuple[int, int, str]], mark: str) -> str:
    """The text with every stretch of spans that overlap or touch replaced by one mark."""
    out, last = [], 0
    for a, b, _ in spans:
        if a > last or not out:
            out += [text[last:a], mark]
        last = max(last, b)
    return "".join([*out, text[last:]])


#: What `scan` adds to a table.
ADDED = (
    ("n_assign", pa.int64()),
    ("n_access", pa.int64()),
    ("n_hex", pa.int64()),
    ("n_confirmed", pa.int64()),
    ("base_sha256", pa.string()),
    ("spans", pa.string()),
    ("clean_text", pa.string()),
)


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None, mark: str | None = None) -> DataFrame:
    """The columns `keep` (all, if None) and what was found in `text`.

    `base_sha256` digests the base spans, `spans` lists all spans. With a `mark`, `clean_text` is the text with
    every span replaced by it (null for a null text); else it is null. A null or empty text
    has no spans; bytes that are not UTF-8 count as U+FFFD. A scan takes time in proportion to the text. Repeated rows are scanned one by one. Columns named like the added ones
    are an error. An empty table gives an empty one.
    """
    keep = docs.columns if keep is None else keep
    clash = sorted({c.lower() for c in keep} & {n for n, _ in ADDED})
    if clash:
        raise ValueError(f"column names in use: {clash}")
    width = len(keep)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in ADDED]
            for data in batch.column(width).to_pylist():
                value = None if data is None else data.decode("utf-8", "replace")
                body = value or ""
                base = order(base_spans(body))
                extra = confirmed_spans(body)
                spans = order(base + extra)
                kinds = [k for _, _, k in base]
                clean = redacted(value, spans, mark) if mark is not None and value is not None else None
                row = (
                    *(kinds.count(k) for k in KINDS[:3]),
                    len(extra),
                    hashlib.sha256(joined(base).encode()).hexdigest(),
                    joined(spans),
                    clean,
                )
                for column, cell in zip(out, row):
                    column.append(cell)
            columns = [*batch.columns[:width], *(pa.array(c, t) for c, (_, t) in zip(out, ADDED))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [*keep, *(n for n, _ in ADDED)]
    added = [T.StructField(n, T.LongType() if t == pa.int64() else T.StringType()) for n, t in ADDED]
    schema = T.StructType([*docs.select(*keep).schema.fields, *added])
    body = docs[text].cast("binary").alias("__text")
    return docs.select(*keep, body).mapInArrow(thrifty(rows), schema)
