"""Secret scan: pattern matches and structurally confirmed encoded secrets, as spans in code points.

Three kinds come from patterns alone: ``assign`` (a value given to a password, secret, token or key name),
``access`` (cloud access key ids) and ``hex`` (long hexadecimal runs). Three more need confirmation: candidates in
base64 or hexadecimal are decoded and parsed. ``jwt`` is a signed token whose header and claims are JSON objects and
whose header names an algorithm; ``der`` is a private key whose nested DER lengths add up to the end and whose
members are those of PKCS#1, PKCS#8 or SEC1; ``openssh`` is a private key in OpenSSH's format of nested
length-prefixed fields.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ship

KINDS = ("assign", "access", "hex", "jwt", "der", "openssh")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")                      # runs are maximal, so this equals taking runs and testing them
TOKEN = re.compile(r"eyJ[A-Za-z0-9_-]*\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
DOTTED = re.compile(r"(?<![A-Za-z0-9_-])(?=([A-Za-z0-9_-]{14,}\.[A-Za-z0-9_-]{3,}\.[A-Za-z0-9_-]*))")    # the shortest header has 14
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*)PRIVATE KEY-----([A-Za-z0-9+/=\s]+)-----END \1PRIVATE KEY-----", re.ASCII)
# What wraps a key's lines: line breaks as such or escaped, with quotes and signs of joined strings, indents and quote marks.
BREAK = re.compile(r"""(?<!\\)\\++(?:[nrt]|(?=/))|["'](?>[\x20\t]*)(?:[+.,\\](?>[\x20\t]*))?[\r\n]+(?>[\x20\t]*)(?:[+.](?>[\x20\t]*))?["']|"""
                   r"""(?<![\x20\t])[\x20\t]+(?=[\r\n])|\\?[\r\n]+[\x20\t>|#*]*""")
# Where a key can begin in joined text: DER's tag 0x30 or the magic of OpenSSH, in base64 and in hexadecimal.
KEY64 = re.compile(r"M(?=[A-P][A-Za-z0-9+/_-]{10})|b3BlbnNzaC1rZXktdjEA")
KEY16 = re.compile(r"30(?=(?:[0-7].|81..|82.{4}|83.{6}|84.{8})02010[01])|6f70656e7373682d6b65792d763100", re.IGNORECASE)
IN64 = re.compile(r"[A-Za-z0-9+/_-]+")
IN16 = {"lower": re.compile(r"[0-9a-f]+"), "upper": re.compile(r"[0-9A-F]+"), "mixed": re.compile(r"[0-9a-fA-F]+")}

OPENSSH = b"openssh-key-v1\0"
SEQUENCE, INTEGER, OCTETS, OID = 0x30, 0x02, 0x04, 0x06


def decode64(text: str) -> bytes | None:
    """Bytes of a base64 string in either alphabet, padded or not; None if it isn't one."""
    body = "".join(text.split()).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def members(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of the DER elements that fill ``data`` exactly; None if the lengths don't add up."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size >= 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            size, at = int.from_bytes(data[at:at + n], "big"), at + n
            if size < 0x80:
                return None                             # DER takes the short form
        if at + size > len(data):
            return None
        out.append((tag, data[at:at + size]))
        at += size
    return out


def is_private_key(data: bytes) -> bool:
    """One DER sequence with the members of a PKCS#1, PKCS#8 or SEC1 private key, lengths nested right."""
    outer = members(data) if len(data) >= 32 and data[0] == SEQUENCE else None
    if not outer or len(outer) != 1:
        return False
    inside = members(outer[0][1]) or []
    tags = [t for t, _ in inside]
    if len(inside) >= 2 and tags[0] == INTEGER and len(inside[0][1]) == 1:
        version = inside[0][1][0]
        if version <= 1 and tags[:9] == [INTEGER] * 9:
            return True
        if version <= 1 and tags[1:3] == [SEQUENCE, OCTETS]:
            algorithm = members(inside[1][1])
            return bool(algorithm) and algorithm[0][0] == OID
        if version == 1 and tags[1] == OCTETS and len(inside) > 2:
            return 16 <= len(inside[1][1]) <= 66 and set(tags[2:]) <= {0xA0, 0xA1}
    return False


def is_openssh(data: bytes) -> bool:
    """Magic, cipher, kdf, kdf options, number of keys, public keys, private block: lengths must fit."""
    if not data.startswith(OPENSSH):
        return False
    at, fields = len(OPENSSH), []
    for step in ("cipher", "kdf", "options", "number", "public", "private"):
        if at + 4 > len(data):
            return False
        n, at = int.from_bytes(data[at:at + 4], "big"), at + 4
        if step == "number":
            if n != 1:
                return False
            continue
        if at + n > len(data):
            return False
        fields.append(data[at:at + n])
        at += n
    return fields[0].isascii() and len(fields[0]) > 0 and len(fields[-1]) >= 8 and len(data) - at < 3


def is_signed_token(text: str) -> bool:
    parts = []
    for segment in text.split(".")[:2]:
        raw = decode64(segment)
        try:
            parts.append(json.loads(raw) if raw is not None else None)
        except (ValueError, RecursionError):
            return False
    return all(isinstance(p, dict) for p in parts) and isinstance(parts[0].get("alg"), str) and (
        len(text.split(".")[2]) >= 16 or parts[0]["alg"].lower() == "none")


def _key_kind(data: bytes | None) -> str | None:
    return None if not data else "der" if is_private_key(data) else "openssh" if is_openssh(data) else None


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern matches, leftmost and non-overlapping within a kind."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    return out + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


class Joined:
    """A text without what wraps lines, and where its characters were."""

    def __init__(self, text: str):
        parts, self.at, self.cut, last, length = [], [0], [0], 0, 0
        for m in BREAK.finditer(text):
            parts.append(text[last:m.start()])
            length, last = length + m.start() - last, m.end()
            self.at.append(length)
            self.cut.append(last - length)              # characters left out up to here
        self.text = "".join(parts) + text[last:]

    def place(self, i: int) -> int:
        return i + self.cut[bisect_right(self.at, i) - 1]

    def span(self, start: int, end: int) -> tuple[int, int]:
        return self.place(start), self.place(end - 1) + 1

    def adjacent(self, i: int) -> bool:
        """Nothing was left out before the character at i."""
        return self.place(i) == self.place(i - 1) + 1


def _bytes64(text: str, start: int, a: int, b: int) -> bytes | None:
    """Bytes a to b of the base64 string that begins at start."""
    first, last = start + a // 3 * 4, start + (8 * b + 5) // 6
    part = text[first:last]
    if len(part) < last - first or not IN64.fullmatch(part):
        return None
    data = decode64(part)
    return data[a % 3:a % 3 + b - a] if data is not None else None


def _bytes16(text: str, start: int, a: int, b: int) -> bytes | None:
    part = text[start + 2 * a:start + 2 * b]
    return bytes.fromhex(part) if len(part) == 2 * (b - a) and IN16["mixed"].fullmatch(part) else None


def key_size(read: Callable[[int, int], bytes | None]) -> int | None:
    """Length of the key whose first bytes look like a DER private key or OpenSSH's format, by its own length fields."""
    if read(0, len(OPENSSH)) == OPENSSH:
        at = len(OPENSSH)
        for step in ("cipher", "kdf", "options", "number", "public", "private"):
            n = read(at, at + 4)
            if n is None:
                return None
            at += 4 + (int.from_bytes(n, "big") if step != "number" else 0)
        return at
    head = read(0, 2)
    if head is None or head[0] != SEQUENCE:
        return None
    size, at = head[1], 2
    if size >= 0x80:
        n = size & 0x7F
        long = read(2, 2 + n) if 1 <= n <= 4 else None
        if long is None:
            return None
        size, at = int.from_bytes(long, "big"), 2 + n
    version = read(at, at + 3)
    return at + size if version in (b"\x02\x01\x00", b"\x02\x01\x01") else None


def _keys(joined: Joined) -> Iterator[tuple[int, int, str]]:
    """(start, end, kind) of the keys in base64 or hexadecimal, wrapped or not; no more of their letters follow in the line."""
    text = joined.text
    for begin, read, digits in ((KEY64, _bytes64, 6), (KEY16, _bytes16, 4)):
        done = 0
        for m in begin.finditer(text):
            start = m.start()
            if start < done:
                continue
            size = key_size(lambda a, b: read(text, start, a, b))
            if not size:
                continue
            # OpenSSH's format may be followed by up to two bytes
            for more in range(3 if m[0] not in ("M", "30") else 1):
                end = start + (8 * (size + more) + digits - 1) // digits
                kind = _key_kind(read(text, start, 0, size + more)) if end <= len(text) else None
                if not kind:
                    break
                if digits == 6:
                    while end < len(text) and text[end] == "=" and (end - start) % 4:
                        end += 1
                    over = IN64.match(text, end) if text[end - 1] != "=" else None
                else:
                    key = text[start:end]
                    over = IN16["lower" if key == key.lower() else "upper" if key == key.upper() else "mixed"].match(text, end)
                    over = over if over and len(over[0]) > 1 and joined.adjacent(end + 1) else None      # an odd digit may follow
                if not over or not joined.adjacent(end):
                    yield *joined.span(start, end), kind
                    done = end
                    break


def _tokens(text: str) -> list[tuple[int, int, str]]:
    """Signed tokens: whole segments, and what begins as JSON objects mostly do within a segment."""
    if text.count(".") < 2:
        return []
    found = {m.start(1): m[1] for m in DOTTED.finditer(text)}
    if "eyJ" in text:
        found |= {m.start(): m[0] for m in TOKEN.finditer(text)}
    out, done = [], 0
    for start, token in sorted(found.items()):
        if start >= done and is_signed_token(token):
            done = start + len(token)
            out.append((start, done, "jwt"))
    return out


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of what decodes and parses as a key or signed token. Keys are looked for in the text with
    wrapped lines joined and escaped line breaks undone; their spans are those of the text as it is."""
    out, taken = _tokens(text), []
    joined = Joined(text)
    if "PRIVATE KEY-----" in joined.text:
        for m in PEM.finditer(joined.text):
            if kind := _key_kind(decode64(m[2])):
                taken.append(joined.span(m.start(), m.end()))
                out.append((*taken[-1], kind))
    return out + [key for key in _keys(joined) if not any(a <= key[0] < b for a, b in taken)]


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


def _scan_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text in batch.column("text"):
            text = text.as_py()
            base = base_spans(text)
            count = [sum(s[2] == k for s in base) for k in KINDS[:3]]
            out.append((*count, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(base + confirmed_spans(text))))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id")] + [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 5, types)],
                                         ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_assign, n_access, n_hex, base_sha256 (digest of the pattern spans), spans (all of them).

    Spans are ``kind:start:end`` in code points, end exclusive, by start, then kind in the order of KINDS, joined by
    commas. Null texts are empty and have none. Null and repeated ids are carried. An empty table gives no row;
    other columns are ignored.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(_scan_rows, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string") \
        .withColumnRenamed("doc_id", id_col)
