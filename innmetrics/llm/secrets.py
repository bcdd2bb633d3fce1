"""Secret scans: patterns for the plain kinds, structural confirmation for encoded ones.

A pattern alone finds assignments, access keys and hex strings. Key files and signed
tokens are reported only when their bytes parse: a PEM or bare base64 or hex candidate
must decode to nested DER whose lengths add up or to a length-prefixed key blob, and a
token needs a header in JSON that names its algorithm and a payload that decodes.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innmetrics.llm.common import arrow_pass

#: In the order in which kinds are listed where spans start together.
KINDS = ("assign", "access", "hex", "pem", "token", "key64", "keyhex")
BASE_KINDS = KINDS[:3]

_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_LONG_HEX = re.compile(r"[0-9a-f]{16,}")
_PEM_MARK = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)")
_KEY64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
#: Base64 over several lines, whose ends may be spelled \\n as in source code and JSON.
_WRAPPED64 = re.compile(
    r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{40,}(?:\r?\n|(?:\\r)?\\n)[ \t]*)+[A-Za-z0-9+/_-]+={0,2}"
)
_SPELLED_END = re.compile(r"(?:\\r)?\\n")
_KEYHEX = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{2}){32,}(?![0-9A-Za-z])|(?<![0-9A-Za-z])(?:[0-9A-F]{2}){32,}(?![0-9A-Za-z])")

# Names that open the blobs of SSH keys.
_SSH_NAMES = (
    b"ssh-rsa",
    b"ssh-dss",
    b"ssh-ed25519",
    b"ecdsa-sha2-nistp256",
    b"ecdsa-sha2-nistp384",
    b"ecdsa-sha2-nistp521",
)
_SSH_MAGIC = b"openssh-key-v1\x00"

Span = tuple[int, int, str]


def decoded64(text: str) -> bytes | None:
    """Bytes of standard or URL-safe base64 with or without padding; None if it is neither."""
    body = re.sub(r"\s+", "", _SPELLED_END.sub("", text)).rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_fields(raw: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the values that fill raw[start:end]; None if lengths disagree."""
    fields = []
    while start < end:
        if end - start < 2:
            return None
        tag, size, start = raw[start], raw[start + 1], start + 2
        if size >= 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or start + n > end:
                return None
            size = int.from_bytes(raw[start : start + n], "big")
            start += n
        if start + size > end:
            return None
        fields.append((tag, start, start + size))
        start += size
    return fields


def is_der_key(raw: bytes) -> bool:
    """One SEQUENCE over all bytes that holds a small version number and key material
    (at least 16 bytes in integers, octet or bit strings, possibly nested)."""
    outer = der_fields(raw, 0, len(raw))
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    inner = der_fields(raw, *outer[0][1:])
    if not inner or len(inner) < 2:
        return False
    version = inner[0][0] == 0x02 and inner[0][2] - inner[0][1] == 1 and raw[inner[0][1]] <= 3
    public = inner[0][0] == 0x30 and der_fields(raw, *inner[0][1:]) is not None and inner[1][0] == 0x03
    material = sum(end - start for tag, start, end in inner if tag in (0x02, 0x03, 0x04, 0x30))
    return (version or public) and material >= 16


def is_ssh_key(raw: bytes) -> bool:
    """A length-prefixed key blob, or a private key file of that form, whose nested
    lengths stay within the bytes."""
    start = len(_SSH_MAGIC) if raw.startswith(_SSH_MAGIC) else 0
    fields = 0
    first = None
    while start + 4 <= len(raw):
        size = int.from_bytes(raw[start : start + 4], "big")
        if start + 4 + size > len(raw):
            break
        first = raw[start + 4 : start + 4 + size] if first is None else first
        start, fields = start + 4 + size, fields + 1
    if raw.startswith(_SSH_MAGIC):
        return fields >= 3
    return first in _SSH_NAMES and fields >= 2 and start == len(raw)


def is_key(raw: bytes | None) -> bool:
    """DER, an SSH blob, or the text of a PEM file, which may itself have been encoded."""
    if raw is None:
        return False
    if b"-----BEGIN" in raw:
        return bool(pem_spans(raw.decode("ascii", errors="replace")))
    return is_der_key(raw) or is_ssh_key(raw)


def is_token(header: str, payload: str, signature: str) -> bool:
    try:
        head, body = (json.loads(decoded64(part) or b"") for part in (header, payload))
    except ValueError:
        return False
    return (
        isinstance(head, dict)
        and isinstance(head.get("alg"), str)
        and isinstance(body, dict)
        and decoded64(signature) is not None
    )


def is_pem(body: str) -> bool:
    """Encrypted keys carry header lines before the base64; their bytes can't be parsed
    further, so decoding is all that is asked of them."""
    lines = [line.strip() for line in _SPELLED_END.sub("\n", body).strip().splitlines()]
    plain = [line for line in lines if ":" not in line]
    raw = decoded64("".join(plain))
    if raw is None or len(raw) < 16:
        return False
    return len(plain) < len(lines) or is_key(raw)


def pem_spans(text: str) -> list[Span]:
    """A BEGIN line and the END line of the same name, if that is the next such line, with
    what parses between them: one look at every mark, however many have no end."""
    spans, begin = [], None
    for mark in _PEM_MARK.finditer(text):
        if mark[1] == "BEGIN":
            begin = mark
        elif begin is not None:
            if begin[2] == mark[2] and is_pem(text[begin.end() : mark.start()]):
                spans.append((begin.start(), mark.end(), "pem"))
            begin = None
    return spans


def base_spans(text: str) -> list[Span]:
    spans = []
    if "=" in text or ":" in text:
        spans += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        spans += [(*m.span(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    spans += [(*m.span(), "hex") for m in _LONG_HEX.finditer(text)]
    return spans


def confirmed_spans(text: str) -> list[Span]:
    """Encoded secrets whose structure parses; one inside a PEM block or token isn't
    reported again."""
    spans: list[Span] = []
    if "-----BEGIN" in text:
        spans += pem_spans(text)
    if "eyJ" in text:
        spans += [(*m.span(), "token") for m in _TOKEN.finditer(text) if is_token(*m.groups())]
    encoded = (("key64", _WRAPPED64, decoded64), ("key64", _KEY64, decoded64), ("keyhex", _KEYHEX, bytes.fromhex))
    for kind, pattern, decode in encoded:
        starts, reach = _taken(spans)
        for m in pattern.finditer(text):
            before = bisect_right(starts, m.start())
            inside = before > 0 and m.end() <= reach[before - 1]
            if not inside and is_key(decode(m[0])):
                spans.append((*m.span(), kind))
    return spans


def _taken(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts in order, and how far the spans up to each of them reach."""
    ordered = sorted(spans)
    return [start for start, *_ in ordered], list(accumulate((end for _, end, _ in ordered), max))


def listed(spans: list[Span]) -> str:
    spans = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the plain kinds, base_spans and spans (``kind:start:end`` in code
    points, end exclusive, comma-joined) and n_confirmed.

    Reads doc_id and text; other columns are ignored. A null or empty text has no spans.
    Repeated rows give repeated results; an empty table gives none.
    """

    def step(ids, texts):
        rows = []
        for doc_id, text in zip(ids, texts):
            base = base_spans(text) if text else []
            more = confirmed_spans(text) if text else []
            counts = [sum(kind == k for *_, kind in base) for k in BASE_KINDS]
            rows.append((doc_id, *counts, listed(base), listed(base + more), len(more)))
        return list(zip(*rows))

    return arrow_pass(
        docs,
        ["doc_id", "text"],
        "doc_id BIGINT, n_assign BIGINT, n_access BIGINT, n_hex BIGINT, base_spans STRING, spans STRING, "
        "n_confirmed BIGINT",
        step,
    )


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The rows with every span found in ``text`` replaced by ``mark``; spans that
    overlap are replaced together. All columns are kept; n_chars follows the text."""

    def clean(text: str | None) -> str | None:
        spans = sorted(base_spans(text) + confirmed_spans(text)) if text else []
        if not spans:
            return text
        parts, end = [], 0
        for start, stop, _ in spans:
            if start >= end:
                parts += [text[end:start], mark]
            end = max(end, stop)
        return "".join([*parts, text[end:]])

    @F.pandas_udf("string")
    def cleaned(texts):
        return texts.map(clean, na_action="ignore")

    changed = docs.withColumn("text", cleaned("text"))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast("bigint"))
    return changed.select(*docs.columns)


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
