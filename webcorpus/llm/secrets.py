"""Secrets in texts, by pattern and by structural confirmation.

Three base kinds are patterns: assignments, access keys and long hex runs. The other kinds are
confirmed before they are reported: long base64 or hex runs are decoded and must parse as a key
encoding whose nested lengths fill it exactly, or as a signed token whose header names an algorithm.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a whole run, as the plain + would find it
KINDS = ("assign", "access", "hex", "pem", "der", "ssh", "token")

_PEM = re.compile(r"-----BEGIN (?P<label>[A-Z0-9 ]{1,40})-----(?P<body>[A-Za-z0-9+/=\s]+)-----END (?P=label)-----")
_RUN = re.compile(r"[A-Za-z0-9+/_-]{24,}={0,2}")
_HEX_RUN = re.compile(r"[0-9A-Fa-f]{48,}")
# Tried at the start of each run of its letters alone, so that long runs cost their length; ahead
# of the place, so that a name and a dot before a token don't take its header for themselves.
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(?=([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*))")
# What a text must hold for any pattern to match, for a vectorised first look.
_LOOK = r"(?i)passw(or)?d|secret|token|api_?key|AKIA|[0-9a-f]{32}|-----BEGIN |[A-Za-z0-9+/_-]{24}|[A-Za-z0-9_-]{8}\.[A-Za-z0-9_-]{2,}\."

Span = tuple[int, int, str]


def _decode(text: str) -> bytes | None:
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_fields(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the DER values that fill a range exactly; None where lengths don't fit."""
    found = []
    while start < end:
        if end - start < 2:
            return None
        tag, size, at = data[start], data[start + 1], start + 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > end:
                return None
            size, at = int.from_bytes(data[at : at + width], "big"), at + width
            if size < 0x80 or size < 1 << 8 * (width - 1):
                return None  # not the shortest form
        if at + size > end:
            return None
        found.append((tag, at, at + size))
        start = at + size
    return found


def is_der_key(data: bytes) -> bool:
    """A sequence that fills the data, of two or more values, nested lengths right, with a number,
    an algorithm or a key string inside."""
    outer = der_fields(data, 0, len(data))
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    inner = der_fields(data, outer[0][1], outer[0][2])
    if not inner or len(inner) < 2 or inner[0][0] not in (0x02, 0x30):
        return False
    for tag, start, end in inner:
        if tag == 0x30 and der_fields(data, start, end) is None:
            return False
    numbers = [e - s for tag, s, e in inner if tag == 0x02]
    strings = [e - s for tag, s, e in inner if tag in (0x03, 0x04)]
    return len(numbers) >= 2 and max(numbers) >= 16 or bool(strings) and max(strings) >= 16


def is_ssh_key(data: bytes) -> bool:
    """Length-prefixed fields that fill the data, the first one naming a key type."""
    if data.startswith(b"openssh-key-v1\0"):
        return True
    fields, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return False
        fields.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return len(fields) >= 2 and bool(re.fullmatch(rb"(ssh-|ecdsa-|sk-)[a-z0-9@.-]+", fields[0]))


def is_token(header: str, payload: str) -> bool:
    for part, need in ((header, "alg"), (payload, None)):
        data = _decode(part)
        try:
            value = json.loads(data) if data else None
        except (ValueError, RecursionError):
            return False
        if not isinstance(value, dict) or need is not None and not isinstance(value.get(need), str):
            return False
    return True


def base_spans(text: str) -> list[Span]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


class Covered:
    """Spans that don't overlap, and whether a place is inside one."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def add(self, start: int, end: int) -> None:
        at = bisect.bisect(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)

    def holds(self, place: int) -> bool:
        at = bisect.bisect(self.starts, place)
        return at > 0 and place < self.ends[at - 1]


def confirmed_spans(text: str) -> list[Span]:
    found: list[Span] = []
    covered = Covered()
    for m in _PEM.finditer(text):
        data = _decode(re.sub(r"\s", "", m["body"]))
        if data and ("PRIVATE" in m["label"] or "KEY" in m["label"]) and (is_der_key(data) or is_ssh_key(data)):
            found.append((m.start(), m.end(), "pem"))
            covered.add(m.start(), m.end())
    for m in _TOKEN.finditer(text):
        if not covered.holds(m.start()) and is_token(m[1], m[2]):
            found.append((m.start(), m.end(3), "token"))
            covered.add(m.start(), m.end(3))
    for m in _HEX_RUN.finditer(text):
        if not covered.holds(m.start()) and len(m[0]) % 2 == 0 and is_der_key(bytes.fromhex(m[0])):
            found.append((m.start(), m.end(), "der"))
            covered.add(m.start(), m.end())
    for m in _RUN.finditer(text):
        if covered.holds(m.start()):
            continue
        data = _decode(m[0])
        if data and is_ssh_key(data):
            found.append((m.start(), m.end(), "ssh"))
        elif data and is_der_key(data):
            found.append((m.start(), m.end(), "der"))
    return found


def spans_of(text: str) -> list[Span]:
    """All spans by start, then kind."""
    return sorted(base_spans(text) + confirmed_spans(text), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        texts = pc.fill_null(batch.column("text"), "")
        look = pc.match_substring_regex(texts, _LOOK).to_pylist()
        spans = [
            [{"kind": k, "start": s, "end": e} for s, e, k in spans_of(texts[i].as_py())] if look[i] else []
            for i in range(len(texts))
        ]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, shape)], ["doc_id", "spans"])


def find_secrets(documents: DataFrame) -> DataFrame:
    """(doc_id, spans): every secret of every row of documents (doc_id, text, ...).

    spans are kind, start and end in code points, end exclusive, by start and then kind. NULL and
    empty texts have none; each row is scanned by itself, so repeated rows and NULL ids give a
    row each. Other columns are not read.
    """
    return documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        _scan, "doc_id bigint, spans array<struct<kind:string,start:bigint,`end`:bigint>>"
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts and joined spans of find_secrets."""
    joined = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


def _redact(mark: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at)
            look = pc.match_substring_regex(pc.fill_null(texts, ""), _LOOK).to_pylist()
            out = texts.to_pylist()
            for i in [i for i, hit in enumerate(look) if hit]:
                text, pieces, done = out[i], [], 0
                for start, end, _ in spans_of(text):
                    if end > done:
                        if start >= done:
                            pieces += [text[done:start], mark]
                        done = end
                out[i] = "".join(pieces) + text[done:]
            yield batch.set_column(at, "text", pa.array(out, pa.string()))

    return run


def redact_secrets(documents: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns, with every secret in text replaced by the mark; overlapping
    secrets are one."""
    return documents.mapInArrow(_redact(mark), documents.schema)
