"""Secret scans: plain patterns, and encoded keys and tokens that are reported once their structure holds.

Base spans are matches of three patterns: assignments to names of secrets, access key ids and long hex runs.
Further candidates are decoded first and parsed:

* ``pem``: an armoured private key, from its begin to its end mark, whose body decodes to a key,
* ``key``: a base64 (either alphabet) or hex run outside of those that decodes to a key, or to an armoured key,
* ``jwt``: a signed or encrypted token whose header is a JSON object that names its algorithm, and whose
  other parts decode, the claims of a signed one to a JSON object.

A key is a sequence of type, length and value whose lengths nest exactly and whose members are those of an RSA,
DSA, EC, PKCS#8 or encrypted PKCS#8 private key, or an OpenSSH private key whose counted fields end with the
data. Public keys, certificates and encoded data that is no key are not reported. Whole texts are read, in
time linear in their length.

Null and empty texts have no spans. Repeated rows are scanned each; rows that share a ``doc_id`` stay apart.
Of the input only ``doc_id`` and ``text`` are read, other columns may have any name. An empty table gives no
rows. Starts and ends count code points; spans of one kind do not overlap, those of different kinds may.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.ship import ship_package

#: All kinds in order; the first three are base kinds.
KINDS = ("assign", "access", "hex", "pem", "key", "jwt")
BASE = KINDS[:3]
SPANS = "array<struct<kind:string,start:bigint,end:bigint,form:string>>"
SPAN_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("form", pa.string())])
)

#: Letters in either case are spelled out: ignoring case makes the search slower by half.
ASSIGN = re.compile(
    r"(?:[pP][aA][sS][sS](?:[wW][oO][rR][dD]|[wW][dD])|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"|[aA][pP][iI]_?[kK][eE][yY])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGNED = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
MARK = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]*)PRIVATE KEY-----")
#: What encoded keys begin with: a sequence, OpenSSH's magic or an armour's dashes. The shortest key has 48 bytes.
ENCODED = re.compile(
    r"(?<![A-Za-z0-9+/_-])(?:M[A-Za-z0-9+/_-]|b3BlbnNzaC1rZXktdjEA|LS0tLS1CRUdJTi)[A-Za-z0-9+/_-]{44,}={0,2}"
)
ENCODED_HEX = re.compile(r"(?<![0-9A-Fa-f])(?:30|6[fF]70656[eE]|2[dD]{2}2[dD])[0-9A-Fa-f]{86,}")
#: A first part that decodes to an opening brace, and parts after points.
PARTS = re.compile(r"(?<![A-Za-z0-9_-])e[w-z0-9_-][A-Za-z0-9_-]*\.[A-Za-z0-9_.-]+")
OPENSSH = b"openssh-key-v1\x00"

INTEGER, OCTETS, OID, SEQUENCE, FIRST_TAG, SECOND_TAG = 0x02, 0x04, 0x06, 0x30, 0xA0, 0xA1


def members(raw: bytes, start: int, end: int, most: int = 16) -> list[tuple[int, int, int]] | None:
    """Tag, start and end of the values that fill ``raw[start:end]`` exactly; None if their lengths do not."""
    found = []
    while start < end:
        if len(found) == most or end - start < 2:
            return None
        tag, length = raw[start], raw[start + 1]
        start += 2
        if length >= 0x80:
            size = length & 0x7F
            if not 1 <= size <= 4 or end - start < size:
                return None
            length = int.from_bytes(raw[start : start + size], "big")
            start += size
        if length > end - start:
            return None
        found.append((tag, start, start + length))
        start += length
    return found


def _private(raw: bytes, start: int, end: int) -> str | None:
    """The kind of private key that a sequence with these contents is."""
    parts = members(raw, start, end)
    if not parts:
        return None
    tags = [tag for tag, _, _ in parts]
    if tags[:2] == [SEQUENCE, OCTETS] and len(parts) == 2:
        scheme = members(raw, *parts[0][1:])
        return "pkcs8-encrypted" if scheme and scheme[0][0] == OID and parts[1][1] < parts[1][2] else None
    if tags[0] != INTEGER or parts[0][2] - parts[0][1] != 1:
        return None
    version = raw[parts[0][1]]
    if tags[1:3] == [SEQUENCE, OCTETS] and version in (0, 1):
        scheme, inner = members(raw, *parts[1][1:]), members(raw, *parts[2][1:])
        whole = bool(inner) and len(inner) == 1 and inner[0][0] in (SEQUENCE, INTEGER, OCTETS)
        return "pkcs8" if scheme and scheme[0][0] == OID and whole else None
    if tags[1:2] == [OCTETS] and version == 1 and set(tags[2:]) <= {FIRST_TAG, SECOND_TAG}:
        return "ec" if parts[1][2] - parts[1][1] >= 16 else None
    if set(tags) == {INTEGER} and all(a < b for _, a, b in parts):
        return {(9, 0): "rsa", (6, 0): "dsa"}.get((len(parts), version))
    return "rsa" if version == 1 and tags == [INTEGER] * 9 + [SEQUENCE] else None


def _counted(raw: bytes, at: int) -> int | None:
    """Where a field ends that begins with its length in four bytes."""
    end = at + 4 + int.from_bytes(raw[at : at + 4], "big")
    return end if at + 4 <= len(raw) and end <= len(raw) else None


def _openssh(raw: bytes) -> str | None:
    at: int | None = len(OPENSSH)
    for _ in range(3):
        at = _counted(raw, at)
        if at is None:
            return None
    keys = int.from_bytes(raw[at : at + 4], "big")
    at += 4
    if not 1 <= keys <= 16:
        return None
    for _ in range(keys + 1):
        at = _counted(raw, at)
        if at is None:
            return None
    return "openssh" if at == len(raw) else None


def key_form(raw: bytes) -> str | None:
    """The kind of private key that these bytes are, if they are one."""
    if raw.startswith(OPENSSH):
        return _openssh(raw)
    whole = members(raw, 0, len(raw), 1)
    if whole and whole[0][0] == SEQUENCE:
        return _private(raw, *whole[0][1:])
    if raw.startswith(b"-----BEGIN "):
        found = list(armoured(raw.decode("latin-1")))
        return f"armoured {found[0][2]}" if found else None
    return None


def from_base64(text: str) -> bytes | None:
    """The bytes of base64 text in either alphabet, with or without padding."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except ValueError:
        return None


def armoured(text: str) -> Iterator[tuple[int, int, str]]:
    """Start, end and kind of each armoured private key whose body is one."""
    opened: re.Match | None = None
    for mark in MARK.finditer(text):
        if mark[1] == "BEGIN":
            opened = mark
            continue
        if opened is not None and opened[2] == mark[2]:
            body = text[opened.end() : mark.start()].replace("\\r", "\n").replace("\\n", "\n")
            lines = [line.strip() for line in body.splitlines()]
            heads = [line for line in lines if ":" in line]
            raw = from_base64("".join(line for line in lines if ":" not in line))
            if raw and any("ENCRYPTED" in line for line in heads):
                form = "encrypted" if len(raw) >= 48 and len(raw) % 8 == 0 else None
            else:
                form = key_form(raw) if raw and not raw.startswith(b"-") else None
            if form:
                yield opened.start(), mark.end(), form
        opened = None


def _object(part: str) -> dict | None:
    raw = from_base64(part)
    try:
        value = json.loads(raw) if raw else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def tokens(text: str) -> Iterator[tuple[int, int, str]]:
    """Start, end and algorithm of each signed or encrypted token."""
    for run in PARTS.finditer(text):
        parts = run[0].split(".")
        at, k = run.start(), 0
        while k < len(parts):
            size = 1
            header = _object(parts[k]) if parts[k][:1] == "e" else None
            if header and isinstance(header.get("alg"), str):
                wanted = 5 if isinstance(header.get("enc"), str) else 3
                rest = parts[k + 1 : k + wanted]
                if len(rest) == wanted - 1 and all(x == "" or from_base64(x) is not None for x in rest):
                    whole = bool(rest[2] and rest[3]) if wanted == 5 else _object(rest[0]) is not None
                    whole = whole and (wanted == 5 or bool(rest[1]) or header["alg"].lower() == "none")
                    if whole:
                        size = wanted
                        yield at, at + len(".".join(parts[k : k + size])), header["alg"]
            at += len(".".join(parts[k : k + size])) + 1
            k += size


def spans_of(text: str) -> list[tuple[str, int, int, str | None]]:
    """All spans of a text, by start and then kind."""
    found = [("assign", *m.span(), None) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGNED]
    found += [("access", *m.span(), None) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span(), None) for m in HEX.finditer(text)]
    keys = list(armoured(text))
    found += [("pem", *key) for key in keys]
    encoded = [(m.span(), from_base64(m[0])) for m in ENCODED.finditer(text)]
    encoded += [(m.span(), bytes.fromhex(m[0])) for m in ENCODED_HEX.finditer(text) if len(m[0]) % 2 == 0]
    last, inside = 0, iter([*keys, (len(text) + 1, len(text) + 1, "")])
    armour = next(inside)
    for (start, end), raw in sorted(encoded, key=lambda x: (x[0][0], -x[0][1])):
        while armour[1] <= start:
            armour = next(inside)
        form = key_form(raw) if raw and start >= last and end <= armour[0] else None
        if form:
            found.append(("key", start, end, form))
            last = end
    found += [("jwt", *token) for token in tokens(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id`` and ``spans`` in order of start, each with its kind, start, end and, where
    a structure was parsed, the kind of key or the algorithm of the token."""

    def run(batches: Iterator) -> Iterator:
        from millrace.llm.secret_scan import SPAN_TYPE, spans_of

        names = ["kind", "start", "end", "form"]
        for batch in batches:
            texts = batch.column("text")
            spans = [[dict(zip(names, s)) for s in spans_of(x.as_py() or "")] for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, SPAN_TYPE)], names=["doc_id", "spans"])

    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, f"doc_id bigint, spans {SPANS}")


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of ``find_secrets``: ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` over the
    base spans, and all ``spans`` as text."""

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in BASE]
    sha = F.sha2(listed(of(*BASE)).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, sha, listed(F.col("spans")).alias("spans"))
