"""Secret scans with structural confirmation.

Patterns find assignments, access key ids and long hex runs. Beyond them, candidates in
base64 or hex are decoded and reported only when what they decode to has the structure of a
secret: a private key whose nested lengths add up, an OpenSSH private key, a PEM
block with such a body, a signed token whose header and claims are JSON, or an assignment in
decoded text.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame

from orebed.llm.common import change_rows, per_text

#: Kinds in the order in which spans of the same start are listed.
KINDS = ("assign", "access", "hex", "token", "pem", "key", "encoded")

_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_either = lambda word: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
_ASSIGN = re.compile(
    "(" + "|".join(map(_either, ("password", "passwd", "secret", "token"))) + "|" + _either("api") + "_?" + _either("key")
    + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(ey[A-Za-z0-9_-]{6,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)(?![A-Za-z0-9_-])")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}?)PRIVATE KEY-----((?:[^-]++|-(?!----))*+)-----END \1PRIVATE KEY-----")
_HEADER = re.compile(r"(?:Proc-Type|DEK-Info)[ \t]*:[ \t]*\S+")
# The shortest assignment has 14 bytes: 19 characters in base64, 28 in hex.
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{19,}={0,2}")
_LONG_HEX = re.compile(r"[0-9A-Fa-f]{28,}")
#: Runs that follow each other line by line; line ends may be written out, as in a JSON string.
_BREAK = r"[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t]*"
_LINES = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:" + _BREAK + r"[A-Za-z0-9+/_-]++={0,2})+")
_LINE = re.compile(r"(?:^|" + _BREAK + r")([A-Za-z0-9+/_-]+={0,2})")

#: Shortest line of a wrapped candidate.
_LEAST_LINE = 16

#: Deepest nesting that a key encoding is followed into.
_DEPTH = 8


def base_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Assignments, access key ids and hex runs, leftmost and non-overlapping per kind."""
    lower = text.lower()
    if any(name in lower for name in _NAMES):
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= 8:
                yield "assign", m.start(), m.end()
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            yield "access", m.start(), m.end()
    for m in _HEX.finditer(text):
        yield "hex", m.start(), m.end()


def from_base64(text: str) -> bytes | None:
    """Decoded bytes of standard or URL-safe base64 with or without padding, or None."""
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _der(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """``tag, start, end`` of the elements that fill ``data[start:end]`` exactly, or None."""
    out, at = [], start
    while at < end:
        if end - at < 2:
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or end - at < n or data[at] == 0:
                return None
            size, at = int.from_bytes(data[at : at + n], "big"), at + n
            if size < 0x80:
                return None
        if size > end - at:
            return None
        out.append((tag, at, at + size))
        at += size
    return out


def _nested(data: bytes, start: int, end: int, depth: int = 0) -> bool:
    """All constructed elements within are filled exactly by their own elements."""
    found = _der(data, start, end)
    if not found or depth > _DEPTH:
        return False
    return all(not tag & 0x20 or a == b or _nested(data, a, b, depth + 1) for tag, a, b in found)


def is_der_key(data: bytes) -> bool:
    """A private key in DER: one sequence over all bytes whose nested lengths add up and that
    starts with a small version, followed by a key's fields (PKCS #1, SEC 1, PKCS #8), or
    an encrypted PKCS #8 key."""
    if len(data) < 32 or data[0] != 0x30:
        return False
    outer = _der(data, 0, len(data))
    if not outer or len(outer) != 1 or not _nested(data, 0, len(data)):
        return False
    fields = _der(data, outer[0][1], outer[0][2])
    tags = [t for t, _, _ in fields]
    if tags[:2] == [0x30, 0x04] and len(tags) == 2:
        inner = _der(data, fields[0][1], fields[0][2])
        return bool(inner) and inner[0][0] == 0x06
    if tags[:1] != [0x02] or fields[0][2] - fields[0][1] != 1 or data[fields[0][1]] > 1:
        return False
    if tags[1:3] == [0x30, 0x04]:
        inner = _der(data, fields[1][1], fields[1][2])
        return bool(inner) and inner[0][0] == 0x06
    return tags[1:2] == [0x04] or len(tags) >= 6 and set(tags[1:6]) == {0x02}


def is_openssh_key(data: bytes) -> bool:
    """An OpenSSH private key: its magic, then strings whose lengths fill the rest."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at, n = len(magic), 0
    while at + 4 <= len(data):
        size = int.from_bytes(data[at : at + 4], "big")
        if n == 3:  # the number of keys
            if not 1 <= size <= 16:
                return False
            size = 0
        if size > len(data) - at - 4:
            return False
        at, n = at + 4 + size, n + 1
    return n >= 6 and at == len(data)


def is_token(head: str, body: str, signature: str) -> bool:
    """A signed token: header and claims are JSON objects, the header names an algorithm, and a
    signature follows unless the algorithm is none."""
    try:
        header, claims = (json.loads(from_base64(x) or b"") for x in (head, body))
    except (ValueError, RecursionError):
        return False
    if not isinstance(header, dict) or not isinstance(claims, dict) or not isinstance(header.get("alg"), str):
        return False
    raw = from_base64(signature)
    return header["alg"].lower() == "none" or raw is not None and len(raw) >= 16


def _assigns(data: bytes) -> bool:
    """Printable text with an assignment of a secret."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return False
    return (text.isprintable() or all(c.isprintable() or c in "\r\n\t" for c in text)) and any(
        k == "assign" for k, _, _ in base_spans(text)
    )


def confirmed_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Candidates confirmed by what they decode to."""
    if "." in text:
        for m in _TOKEN.finditer(text):
            if is_token(*m.groups()):
                yield "token", m.start(), m.end()
    if "-----BEGIN" in text:
        for m in _PEM.finditer(text):
            # Line ends may be written out, as in a JSON string.
            body = m[2].replace("\\r", "").replace("\\n", "\n")
            # Headers may share a line with the rest, where line ends have become spaces.
            lines = [x for x in _HEADER.sub("", body).split("\n") if ":" not in x]
            data = from_base64("".join("".join(lines).split()))
            locked = "ENCRYPTED" in m[1] or "ENCRYPTED" in m[2]
            if data and (is_der_key(data) or is_openssh_key(data) or locked and len(data) >= 32):
                yield "pem", m.start(), m.end()
    for m in _BASE64.finditer(text):
        kind = _kind(from_base64(m[0]))
        if kind:
            yield kind, m.start(), m.end()
    for m in _LONG_HEX.finditer(text):
        kind = _kind(_from_hex(m[0]))
        if kind:
            yield kind, m.start(), m.end()
    yield from _wrapped_spans(text)


def _from_hex(text: str) -> bytes | None:
    try:
        return bytes.fromhex(text)
    except ValueError:
        return None


def _wrapped_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Candidates over several lines of one length, and a last line that may be shorter."""
    for m in _LINES.finditer(text):
        lines = [(x[1], m.start() + x.start(1), m.start() + x.end(1)) for x in _LINE.finditer(m[0])]
        i = 0
        while i < len(lines):
            width, j = len(lines[i][0]), i + 1
            while j < len(lines) and len(lines[j][0]) == width and lines[j - 1][0][-1] != "=":
                j += 1
            ends = [j]
            if j < len(lines) and len(lines[j][0]) < width and lines[j - 1][0][-1] != "=":
                ends = [j + 1, j]  # what is shorter may also be the next word
            for end in ends if width >= _LEAST_LINE else []:
                run = "".join(x for x, _, _ in lines[i:end])
                kind = (_kind(from_base64(run)) or _kind(_from_hex(run))) if end > i + 1 else None
                if kind:
                    yield kind, lines[i][1], lines[end - 1][2]
                    j = end
                    break
            i = j


def _kind(data: bytes | None) -> str | None:
    if not data:
        return None
    if data[0] == 0x30 and is_der_key(data) or is_openssh_key(data):
        return "key"
    return "encoded" if _assigns(data) else None


def listed(found) -> list[tuple[str, int, int]]:
    """Spans once each, by start, then kind, then end."""
    return sorted(set(found), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(found: list[tuple[str, int, int]]) -> str:
    """``kind:start:end`` joined by commas."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``documents``: ``id_col, base, spans``, both as ``kind:start:end``
    joined by commas, in code points with the end exclusive.

    ``base`` are the spans of the plain patterns, ``spans`` these and the confirmed ones. Null and
    empty texts have none (an empty string); repeated rows each get their row; every
    text is read whole.
    """

    def make():
        def score(texts):
            base, every = [], []
            for text in texts:
                text = (text or b"").decode(errors="replace")
                plain = listed(base_spans(text))
                base.append(written(plain))
                every.append(written(listed([*plain, *confirmed_spans(text)])))
            return base, every

        return score

    return per_text(documents, [id_col], text_col, ["base string", "spans string"], make)


def masked(text: bytes | None, mask: str) -> bytes | None:
    """The text with every span, overlapping ones as one, replaced by ``mask``."""
    if not text:
        return text
    plain = text.decode(errors="replace")
    found = listed([*base_spans(plain), *confirmed_spans(plain)])
    if not found:
        return text
    out, at, until = [], 0, -1
    for _, a, b in found:
        if a < until:
            until = max(until, b)
        else:
            if until >= 0:
                at = until
            out += [plain[at:a], mask]
            until = b
    return "".join([*out, plain[until:]]).encode()


def mask_secrets(
    documents: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", mask: str = "[SECRET]"
) -> DataFrame:
    """All rows and columns of ``documents``, with the spans found replaced by ``mask`` and
    the length of changed texts put right. Texts without a secret stay as they are."""

    def make():
        return lambda texts: ([True] * len(texts), [masked(t, mask) for t in texts])

    return change_rows(documents, text_col, make, length_col)
