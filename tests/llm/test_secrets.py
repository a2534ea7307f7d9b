import base64
import hashlib
import json
import re
import time

from optionflow.llm import secrets
from optionflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def der(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 | (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + body


def whole(n):
    return der(2, n.to_bytes(n.bit_length() // 8 + 1, "big"))


def rsa_key(change=0):
    p, q = (1 << 300) + 157, (1 << 280) + 95
    numbers = (0, p * q + change, 65537, (1 << 555) + 3, p, q, 5, 7, 11)
    return der(0x30, b"".join(whole(n) for n in numbers))


def ec_key():
    return der(0x30, der(2, b"\x01") + der(4, b"k" * 32))


def pkcs8():
    return der(0x30, der(2, b"\x00") + der(0x30, der(6, b"\x2a\x86\x48")) + der(4, rsa_key()))


def ssh_key():
    field = lambda b: len(b).to_bytes(4, "big") + b
    return b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(b"p" * 51) + field(b"s" * 90)


def jwt(head={"alg": "HS256"}, claims={"sub": "a"}):  # noqa: B006
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    return f"{part(head)}.{part(claims)}.c2lnbmF0dXJl"


def plain_base(text):
    """The base patterns word by word."""
    found = []
    for m in re.finditer(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.A):
        if len(m[2]) >= 6:
            found.append((m.start(), m.end(), "assign"))
    for kind, pattern, least in (("access", r"AKIA[A-Z0-9]+", 20), ("hex", r"[0-9a-f]+", 24)):
        found += [(m.start(), m.end(), kind) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    found.sort(key=lambda s: (s[0], ("assign", "access", "hex").index(s[2])))
    return ",".join(f"{k}:{a}:{b}" for a, b, k in found)


def kinds(text):
    return [k for _, _, k in secrets.confirmed_spans(text)]


def dsa_key(change=0):
    q, x = (1 << 159) + 7, 12345678901234567890
    p = q * (1 << 400) + 1
    numbers = (0, p, q, 3, pow(3, x, p) + change, x)
    return der(0x30, b"".join(der(2, n.to_bytes(n.bit_length() // 8 + 1, "big")) for n in numbers))


def encrypted_pkcs8(oid="2a864886f70d01050d"):
    return der(0x30, der(0x30, der(6, bytes.fromhex(oid)) + der(0x30, der(4, b"salt" * 4))) + der(4, b"c" * 64))


def pem(label, data, headers="", end="\n"):
    body = base64.encodebytes(data).decode().replace("\n", end)
    return f"-----BEGIN {label}-----{end}{headers}{body}-----END {label}-----"


def test_dsa_and_encrypted_keys():
    for data in (dsa_key(), encrypted_pkcs8()):
        assert kinds(f"key {base64.b64encode(data).decode()} end") == kinds(f"x {data.hex()} y") == ["der"]
    for data in (dsa_key(1), der(0x30, b"".join(der(2, bytes([k])) for k in range(6))), encrypted_pkcs8("2a8648ce3d0201")):
        assert kinds(f"key {base64.b64encode(data).decode()} end") == []
    for end in ("\n", "\r\n"):
        assert kinds(pem("ENCRYPTED PRIVATE KEY", encrypted_pkcs8(), end=end)) == kinds(pem("DSA PRIVATE KEY", dsa_key(), end=end)) == ["der"]
        sealed = f"Proc-Type: 4,ENCRYPTED{end}DEK-Info: AES-128-CBC,{'0A' * 16}{end}{end}"
        text = pem("RSA PRIVATE KEY", b"\x99" * 128, sealed, end)
        assert secrets.confirmed_spans(f"a {text} b") == [(2, 2 + len(text), "der")]
        assert kinds(pem("RSA PRIVATE KEY", rsa_key(), f"Comment: mine{end}{end}", end)) == ["der"]
        assert kinds(pem("RSA PRIVATE KEY", b"\x99" * 128, f"Comment: mine{end}{end}", end)) == []
    assert kinds("-----BEGIN RSA PRIVATE KEY-----" + "\n a: b" * 20_000 + " \n" * 20_000) == []


def test_keys_are_reported_only_if_they_parse():
    for data, kind in ((rsa_key(), "der"), (pkcs8(), "der"), (ec_key() + b"", "der"), (ssh_key(), "openssh")):
        run = base64.b64encode(data).decode()
        assert kinds(f"é key {run} end") == [kind]
        assert kinds(f"x {data.hex()} y") == [kind]
        assert kinds(base64.b64encode(data[:-3]).decode()) == []
    lines = re.sub("(.{64})", r"\1\n", base64.b64encode(pkcs8()).decode())
    assert kinds(f"-----BEGIN PRIVATE KEY-----\n{lines}\n-----END PRIVATE KEY-----") == ["der"]
    assert kinds("-----BEGIN PRIVATE KEY-----\n" + "A" * 64 + "\n-----END PRIVATE KEY-----") == []
    assert kinds("M" * 80) == [] and kinds("30" * 40) == []


def test_numbers_have_to_make_a_key():
    for data in (rsa_key(1), der(0x30, b"".join(whole(k << 600) for k in range(9))), der(0x30, b"".join(whole(k) for k in (0, 15, 3, 5, 3, 5, 1, 1, 1)))):
        assert kinds(f"key {base64.b64encode(data).decode()} end") == kinds(f"x {data.hex()} y") == []
    bare = der(0x30, der(2, b"\x01") + der(4, b"k" * 31))
    named = der(0x30, der(2, b"\x01") + der(4, b"k" * 31) + der(0xA0, der(6, b"\x2b\x81\x04\x00\x0a")))
    assert kinds(base64.b64encode(bare).decode()) == [] and kinds(base64.b64encode(named).decode()) == ["der"]


def test_inner_keys_are_opened():
    def wrapped(oid, inner, *parameters):
        return der(0x30, der(2, b"\x00") + der(0x30, der(6, bytes.fromhex(oid)) + b"".join(parameters)) + der(4, inner))

    q = (1 << 159) + 7
    group = der(0x30, whole(q * (1 << 400) + 1) + whole(q) + whole(3))
    good = [
        wrapped("2a864886f70d010101", rsa_key(), der(5, b"")), wrapped("2b6570", der(4, b"s" * 32)), wrapped("2a8648ce380401", whole(12345), group),
        wrapped("2a8648ce3d0201", der(0x30, der(2, b"\x01") + der(4, b"k" * 31)), der(6, b"\x2b\x81\x04\x00\x0a")),
    ]
    bad = [
        wrapped("2a864886f70d010101", rsa_key(1), der(5, b"")), wrapped("2b6570", der(4, b"s" * 31)), wrapped("2a8648ce380401", whole(q), group),
        wrapped("2a8648ce3d0201", der(0x30, der(2, b"\x02") + der(4, b"k" * 32))), wrapped("2a864886f70d010101", b"x" * 90), wrapped("2b81", b"x" * 90),
    ]
    assert [kinds(base64.b64encode(k).decode()) for k in good] == [["der"]] * len(good)
    assert [kinds(base64.b64encode(k).decode()) for k in bad] == [[]] * len(bad)


def test_wrapped_lines_outside_armour():
    run = base64.b64encode(pkcs8()).decode()
    for end in ("\n", "\r\n"):
        lines = re.sub("(.{64})", rf"\1{end}", run).strip()
        assert secrets.confirmed_spans(f"key: {lines} end") == [(5, 5 + len(lines), "der")]
    assert kinds(re.sub("(.{64})", "\\1\n", base64.b64encode(b"\x30" * 200).decode())) == []


def test_two_megabytes_of_anything_are_scanned_at_once():
    n = 2_000_000
    begin = "-----BEGIN PRIVATE KEY-----"
    texts = [
        "eyJ" * (n // 3), "eyJ." * (n // 4), "eyJabcdefgh." * (n // 12), f"{begin}X" + " " * n, f"{begin}\n" * (n // 28), f"{begin}a: b\n" * (n // 33),
        f"{begin}" + "a: b\n" * (n // 5), f"-----BEGIN {'A' * n}", "-" * n, "-----BEGIN " * (n // 11), "A" * n, "Mab/" * (n // 4), ("M" * 64 + "\n") * (n // 65),
        "30" * (n // 2), "password" * (n // 8), "password" + " " * n, "token=" * (n // 6), "AKIA" * (n // 4), "f" * n, f"{jwt()} " * (n // 70), "MAAA" * 20 + " " * n,
        (base64.b64encode(ssh_key()).decode() + " ") * (n // 350),
    ]
    for text in texts:
        begun = time.process_time()
        secrets.base_spans(text), secrets.confirmed_spans(text)
        assert time.process_time() - begun < 2, text[:40]


def test_bytes_that_are_not_utf8(spark):
    df = spark.sql("select 1L as doc_id, cast(unhex('ff746f6b656e3d616263646566c3') as string) as text")
    (row,) = secrets.scan(df, keep=["doc_id"], mark="#").collect()
    assert row.spans == "assign:1:13" and row.clean_text == "\ufffd#\ufffd"


def test_tokens_need_header_and_claims():
    assert kinds(f"bearer {jwt()}") == ["jwt"]
    assert kinds(jwt(head={"typ": "JWT"})) == [] and kinds(jwt(claims=[1])) == []
    assert kinds("eyJhbGciOiJ9.eyJh.x") == []


def test_base_spans_equal_the_patterns():
    cases = [
        "", "token=abcdef", "password=token: abcdefgh", "PassWord : 'a.b/c+d'", "api_key=12345", "apikey = \"123456\"",
        "ſecret=abcdefgh toKen=abcdefgh", "AKIA" + "A" * 15, "AKIA" + "A" * 16, "xAKIAAKIA" + "Z" * 20 + "é", "f" * 23, "é" + "f" * 24 + "F",
        "secret=" + "ab" * 400, "token=token=abcdefgh", "hash 0123456789abcdef0123456789abcdef",
    ]
    for text in cases:
        assert secrets.joined(secrets.order(secrets.base_spans(text))) == plain_base(text), text


def test_scan_of_odd_rows(spark):
    secret = f"{jwt()} token=abcdefgh"
    rows = [(1, secret, "x"), (1, secret, "x"), (None, None, None), (2, "", "y"), (3, "é " * 200_000 + "token=abcdefgh", "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = secrets.scan(df, mark="<>").collect()
    assert [(r.doc_id, r.text, r.source) for r in got] == rows
    assert got[0].clean_text == "<> <>" and got[0].n_confirmed == 1 and got[0] == got[1]
    assert got[2].clean_text is None and got[2].spans == "" and got[3].clean_text == ""
    assert got[4].spans == "assign:400000:400014"
    assert secrets.scan(df.limit(0)).count() == 0


def test_redaction_joins_spans_that_overlap():
    assert secrets.redacted("abcdefgh", [(1, 3, "hex"), (2, 4, "hex"), (6, 7, "hex")], "#") == "a#ef#h"
    assert secrets.redacted("ab", [(0, 2, "hex")], "#") == "#" and secrets.redacted("ab", [], "#") == "ab"


def test_op4_equals_the_patterns_on_whole_texts(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op4_confirmed_secrets"](spark, SF).collect():
        want = plain_base(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(want.count(k + ":") for k in ("assign", "access", "hex"))
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
