"""Secret scans: patterns, and candidates that are confirmed by their structure.

Patterns find assignments, access keys and long hex numbers. Beyond them, runs of
base64 or hex are decoded and parsed: a private key must be a sequence whose nested
lengths fill it exactly, an OpenSSH key a chain of counted strings behind its magic, a
signed token a header that names its algorithm before a payload. What does not parse
is not reported.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldledger.llm.common import slices, text_or_empty
from fieldledger.llm.registry import query, reach, table

#: Fixed patterns of the base kinds, and the least length of a value.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_VALUE, ACCESS_LENGTH = 12, 18
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: All kinds, in the order in which spans at one place are listed.
BASE = ["assign", "access", "hex"]
KINDS = [*BASE, "private_key", "openssh_key", "signed_token"]

_ARMOUR = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----((?:[^-]|-(?!----))*+)-----END [A-Z0-9 ]*PRIVATE KEY-----")
#: Tokens begin where a run of their characters does, so that a run is read once.
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]*+")
#: Line ends, also those that are written as escapes, as in JSON and environment files.
_LINE_END = re.compile(r"(?:\\r|\\n|[\r\n])+")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
_LONG_HEX = re.compile(r"[0-9A-Fa-f]{64,}")
_MAGIC = b"openssh-key-v1\0"

_INTEGER, _OCTETS, _OBJECT, _SEQUENCE = 0x02, 0x04, 0x06, 0x30

Span = tuple[str, int, int]


def _decoded(text: str) -> bytes | None:
    """The bytes of base64, of either alphabet, with or without padding."""
    plain = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _items(raw: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents of the items that fill `raw` exactly, else None."""
    out, at = [], 0
    while at < len(raw):
        if at + 2 > len(raw):
            return None
        tag, size, at = raw[at], raw[at + 1], at + 2
        if size >= 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(raw) or raw[at] == 0:
                return None
            size, at = int.from_bytes(raw[at : at + width]), at + width
            if size < 0x80:
                return None
        if at + size > len(raw):
            return None
        out.append((tag, raw[at : at + size]))
        at += size
    return out


def _is_algorithm(raw: bytes) -> bool:
    inner = _items(raw)
    return bool(inner) and inner[0][0] == _OBJECT and len(inner[0][1]) >= 3


def is_private_key(raw: bytes) -> bool:
    """Whether `raw` is the binary form of a private key."""
    outer = _items(raw) if raw[:1] == b"\x30" else None
    if not outer or len(outer) != 1:
        return False
    inner = _items(outer[0][1])
    if not inner:
        return False
    tags = [tag for tag, _ in inner]
    if tags[:2] == [_SEQUENCE, _OCTETS] and len(tags) == 2:  # an encrypted key
        return _is_algorithm(inner[0][1]) and len(inner[1][1]) >= 32
    if tags[0] != _INTEGER or len(inner[0][1]) != 1:
        return False
    version = inner[0][1][0]
    if version <= 1 and len(tags) >= 9 and set(tags[:9]) == {_INTEGER}:  # RSA
        return len(inner[1][1]) >= 32
    if version == 0 and len(tags) == 6 and set(tags) == {_INTEGER}:  # DSA
        return len(inner[1][1]) >= 32
    if version <= 1 and tags[1:3] == [_SEQUENCE, _OCTETS]:  # any kind, with its algorithm
        return _is_algorithm(inner[1][1]) and len(inner[2][1]) >= 16
    return version == 1 and tags[1] == _OCTETS and len(inner[1][1]) >= 16  # elliptic curve


def is_openssh_key(raw: bytes) -> bool:
    """Whether `raw` is an OpenSSH private key: counted strings that fill it."""
    if not raw.startswith(_MAGIC):
        return False
    at = len(_MAGIC)

    def word() -> int | None:
        nonlocal at
        at += 4
        return int.from_bytes(raw[at - 4 : at]) if at <= len(raw) else None

    def string() -> bytes | None:
        nonlocal at
        size = word()
        if size is None or at + size > len(raw):
            return None
        at += size
        return raw[at - size : at]

    if any(string() is None for _ in range(3)):
        return False
    keys = word()
    if keys is None or not 1 <= keys <= 16:
        return False
    return all(string() for _ in range(keys + 1)) and at == len(raw)


def is_signed_token(text: str) -> bool:
    """Whether the first parts of `text` are a token's header, with an algorithm, and payload."""
    try:
        header, payload = (json.loads(_decoded(x) or b"") for x in text.split(".")[:2])
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(payload, dict)


def _key_kind(raw: bytes | None) -> str | None:
    if not raw:
        return None
    return "private_key" if is_private_key(raw) else "openssh_key" if is_openssh_key(raw) else None


def _armoured_kind(body: str) -> str | None:
    """The kind of key between armour marks, whatever header lines stand before it.

    A key that its headers call encrypted is cipher blocks of a named cipher.
    """
    lines = _LINE_END.split(body.replace("\\/", "/"))
    heads = [x.split(":", 1) for x in lines if ":" in x]
    raw = _decoded("".join("".join(x.split()) for x in lines if ":" not in x))
    told = {name.strip(): value.strip() for name, value in heads}
    if "ENCRYPTED" in told.get("Proc-Type", "") and "," in told.get("DEK-Info", ""):
        return "private_key" if raw and len(raw) >= 64 and len(raw) % 8 == 0 else None
    return _key_kind(raw)


def base_spans(text: str) -> list[Span]:
    """Spans of the three base kinds; matches that are too short are dropped."""
    out: list[Span] = []
    small = text.lower()
    if any(w in small for w in WORDS):
        found = (m for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE)
        out += [("assign", *m.span()) for m in found]
    if "AKIA" in text:
        found = (m for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH)
        out += [("access", *m.span()) for m in found]
    return out + [("hex", *m.span()) for m in HEX.finditer(text)]


def confirmed_spans(text: str) -> list[Span]:
    """Spans that decode to a key or a signed token."""
    out: list[Span] = []
    if "PRIVATE KEY-----" in text:
        for m in _ARMOUR.finditer(text):
            if kind := _armoured_kind(m[1]):
                out.append((kind, *m.span()))
    taken = [(a, b) for _, a, b in out]

    def free(m: re.Match) -> bool:
        return all(m.end() <= a or b <= m.start() for a, b in taken)

    for m in _BASE64.finditer(text):
        if free(m) and (kind := _key_kind(_decoded(m[0]))):
            out.append((kind, *m.span()))
    for m in _LONG_HEX.finditer(text):
        if free(m) and len(m[0]) % 2 == 0 and (kind := _key_kind(bytes.fromhex(m[0]))):
            out.append((kind, *m.span()))
    if "." in text:
        out += [("signed_token", *m.span()) for m in _TOKEN.finditer(text) if is_signed_token(m[0])]
    return out


def listed(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        base = [base_spans(t) for t in batch.column("text").to_pylist()]
        more = [confirmed_spans(t) for t in batch.column("text").to_pylist()]
        columns = [
            batch.column("doc"),
            pa.array([[s[0] for s in b + m] for b, m in zip(base, more, strict=True)], pa.list_(pa.string())),
            pa.array([listed(b) for b in base], pa.string()),
            pa.array([listed(b + m) for b, m in zip(base, more, strict=True)], pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "kinds", "base", "spans"])


def secret_spans(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, kinds, base, spans.

    Spans are kind:start:end in code points, by start and then kind, joined by commas;
    `base` has those of the base kinds. A null text is an empty one, with no spans.
    Repeated rows are scanned each for itself; an empty table gives an empty result; other
    columns are not read. A text of any length is scanned whole, in time that grows in
    proportion to it.
    """
    reach(docs.sparkSession)
    slim = docs.select(F.col(doc).alias("doc"), text_or_empty(text).alias("text"))
    kind = slim.schema["doc"].dataType.simpleString()
    return slim.mapInArrow(_scan, f"doc_id {kind}, kinds array<string>, base string, spans string")


@query("op8_secret_scan")
def op8_secret_scan(spark, folder):
    found = secret_spans(table(spark, folder, "documents"))
    others = [F.size("kinds") - F.size(F.array_remove("kinds", n)) for n in BASE]
    counts = [c.cast("long").alias(f"n_{n}") for n, c in zip(BASE, others, strict=True)]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")
