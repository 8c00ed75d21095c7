"""Secret scans: base spans against the plain patterns, structures against keys and tokens put together here."""

import base64
import hashlib
import json
import random
import re
import time

import pytest

from millrace.llm import secret_scan
from millrace.llm.secret_scan import digest, find_secrets, key_form, spans_of

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)


def base_spans(text):
    """The base kinds by their definition."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda x: (x[1], secret_scan.KINDS.index(x[0])))


def der(tag, body):
    size = len(body)
    if size < 128:
        return bytes([tag, size]) + body
    length = size.to_bytes((size.bit_length() + 7) // 8, "big")
    return bytes([tag, 0x80 | len(length)]) + length + body


def noise(n, seed=1):
    return b"\x01" + random.Random(seed).randbytes(n - 1)


def number(n):
    return der(2, noise(n, n))


RSA = der(0x30, der(2, b"\0") + b"".join(number(n) for n in (128, 3, 128, 64, 64, 64, 64, 64)))
DSA = der(0x30, der(2, b"\0") + b"".join(number(n) for n in (128, 20, 128, 128, 20)))
CURVE = der(6, bytes([0x2A, 0x86, 0x48, 0xCE, 0x3D, 3, 1, 7]))
EC = der(0x30, der(2, b"\1") + der(4, noise(32)) + der(0xA0, CURVE) + der(0xA1, der(3, noise(66))))
PKCS8 = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2b\x65\x70")) + der(4, der(4, noise(32))))
SEALED = der(0x30, der(0x30, CURVE + der(0x30, der(4, noise(8)))) + der(4, noise(64)))
PUBLIC = der(0x30, der(0x30, CURVE) + der(3, noise(66)))


def field(raw):
    return len(raw).to_bytes(4, "big") + raw


OPENSSH = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(noise(51)) + field(noise(136))
FORMS = {"rsa": RSA, "dsa": DSA, "ec": EC, "pkcs8": PKCS8, "pkcs8-encrypted": SEALED, "openssh": OPENSSH}


def b64(raw):
    return base64.b64encode(raw).decode()


def part(value):
    raw = value if isinstance(value, bytes) else json.dumps(value).encode()
    return base64.urlsafe_b64encode(raw).decode().rstrip("=")


def pem(raw, label="", newline="\n"):
    text = b64(raw)
    lines = [text[i : i + 64] for i in range(0, len(text), 64)]
    return newline.join([f"-----BEGIN {label}PRIVATE KEY-----", *lines, f"-----END {label}PRIVATE KEY-----"])


JWT = f"{part({'alg': 'HS256', 'typ': 'JWT'})}.{part({'sub': 'a'})}.{part(noise(32))}"
JWE = f"{part({'alg': 'dir', 'enc': 'A128GCM'})}..{part(noise(12))}.{part(noise(40))}.{part(noise(16))}"


@pytest.mark.parametrize("form", FORMS)
def test_keys_are_parsed_to_their_ends(form):
    raw = FORMS[form]
    assert key_form(raw) == form
    assert key_form(raw + b"\0") is None and key_form(raw[:-1]) is None
    # A length inside that does not nest, and contents of another shape.
    at = 17 if form == "openssh" else 2 if raw[1] < 128 else 2 + (raw[1] & 0x7F)
    assert key_form(raw[: at + 1] + bytes([raw[at + 1] ^ 0x40]) + raw[at + 2 :]) is None
    for text in (b64(raw), base64.urlsafe_b64encode(raw).decode().rstrip("="), raw.hex(), raw.hex().upper()):
        found = [s for s in spans_of(f"a key: {text} .") if s[0] == "key"]
        assert found == [("key", 7, 7 + len(text), form)]
    for newline in ("\n", "\r\n", "\\n"):
        text = pem(raw, "SOME ", newline)
        assert [s for s in spans_of("x " + text) if s[0] in ("pem", "key")] == [("pem", 2, 2 + len(text), form)]


def test_what_only_looks_like_a_key_is_not_reported():
    for raw in (PUBLIC, noise(200), der(0x30, noise(100)), der(0x30, der(2, b"\0") * 4), b"\x30\x84" + b"\xff" * 90):
        assert key_form(raw) is None
        for text in (b64(raw), raw.hex(), pem(raw)):
            assert not [s for s in spans_of(text) if s[0] not in secret_scan.BASE]
    begin, end = "-----BEGIN PRIVATE KEY-----", "-----END PRIVATE KEY-----"
    for text in (begin, end, begin + end, end + begin, f"{begin}\nnot base64!\n{end}", pem(RSA).replace("END ", "END RSA ")):
        assert not [s for s in spans_of(text) if s[0] == "pem"]


def test_keys_within_keys_and_many_marks():
    assert key_form(pem(EC).encode()) == "armoured ec"
    assert [s[0] for s in spans_of(b64(pem(EC).encode()))] == ["key"]
    locked = pem(noise(64)).replace("KEY-----\n", "KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00\n\n", 1)
    assert [s[3] for s in spans_of(locked)] == ["encrypted"]
    text = "-----BEGIN PRIVATE KEY-----\n" * 3 + pem(EC) + " " + b64(RSA) + "\n" + pem(PKCS8)
    assert [(s[0], s[3]) for s in spans_of(text)] == [("pem", "ec"), ("key", "rsa"), ("pem", "pkcs8")]


def test_signed_tokens_by_header_and_parts():
    for text in (JWT, JWE):
        for before, after in (("", ""), ("Bearer ", "."), ("a.b.", ".c"), ('"', '"')):
            found = [s for s in spans_of(before + text + after) if s[0] == "jwt"]
            assert [s[1:3] for s in found] == [(len(before), len(before) + len(text))]
    head, claims, sign = JWT.split(".")
    for wrong in (
        f"{part({'typ': 'JWT'})}.{claims}.{sign}", f"{part([1])}.{claims}.{sign}", f"{head}.{part([1])}.{sign}",
        f"{head}.{claims}", f"{head}.{claims}.", f"{head}.{sign}.{claims}", f"{head[:-1]}.{claims}.{sign}",
        f"{part(b'{' + b'[' * 100_000)}.{claims}.{sign}", "eyJ.eyJ.eyJ", JWE.rpartition(".")[0],
    ):
        assert not [s for s in spans_of(wrong) if s[0] == "jwt"], wrong
    none = f"{part({'alg': 'none'})}.{claims}."
    assert [s[3] for s in spans_of(none)] == ["none"]


def test_base_spans_equal_the_plain_patterns(hard_rows):
    rng = random.Random(3)
    bits = ["password", "PassWD", "se", "cret", "token", "api_key", "APIKEY", '"', "'", " ", "  ", ":", "=", "abc", "deadbeef" * 4,
            "AKIA", "AKIAABCDEFGHIJKL", "0123456789abcdef" * 2, "é", "ſ", "K", "x/y+z_.-=", "\n"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(1, 30))) for _ in range(4000)]
    texts += [t or "" for _, t in hard_rows]
    for text in texts:
        assert [s[:3] for s in spans_of(text) if s[0] in secret_scan.BASE] == base_spans(text)


def test_long_texts_take_linear_time():
    for text in ("token " * 300_000, "token" + " " * 1_500_000, "eyJ" * 600_000, "eyJ." * 500_000, "MII" * 600_000,
                 "30" * 900_000, "-----BEGIN PRIVATE KEY-----" * 60_000, "a" * 31 * 50_000):
        start = time.perf_counter()
        spans_of(text)
        assert time.perf_counter() - start < 10, text[:20]


def test_find_secrets_on_hard_rows(spark, hard_docs, hard_rows, no_docs):
    extra = [(900, f"password={'x' * 9} {JWT} " + pem(RSA)), (900, f"password={'x' * 9} {JWT} " + pem(RSA)), (None, "AKIA" + "Z" * 12)]
    docs = hard_docs.select("doc_id", "text", "score", "kept").union(
        spark.createDataFrame([(*r, 0, 0) for r in extra], "doc_id long, text string, score int, kept int")
    )
    rows = hard_rows + extra
    found = find_secrets(docs)
    texts = sorted((str(r.doc_id), sorted((s.kind, s.start, s.end, s.form) for s in r.spans)) for r in found.collect())
    assert texts == sorted((str(i), sorted((a, b, c, d) for a, b, c, d in spans_of(t or ""))) for i, t in rows)
    by_id = {r.doc_id: r for r in digest(found).collect()}
    whole = by_id[900]
    assert (whole.n_assign, whole.n_access, whole.n_hex) == (1, 0, 0)
    assert whole.base_sha256 == hashlib.sha256(b"assign:0:18").hexdigest()
    assert [x.split(":")[0] for x in whole.spans.split(",")] == ["assign", "jwt", "pem"]
    assert by_id[4].base_sha256 == hashlib.sha256(b"").hexdigest() and by_id[4].spans == ""
    assert find_secrets(no_docs).count() == 0


def test_query_equals_the_base_patterns(spark):
    from millrace.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op11_secret_scan"].run(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[0] == k for s in spans) for k in secret_scan.BASE]
