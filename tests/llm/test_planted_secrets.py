"""Secrets of random sizes planted between words and look-alikes: exactly the planted ones are confirmed."""

from __future__ import annotations

import base64
import json
import random

import pytest

from orebed.llm import secret_scan

WORDS = "the river über house walks 12 (of) café, tree; 日本 «sea» end.".split()


def der(tag: int, body: bytes) -> bytes:
    size = len(body)
    if size < 0x80:
        return bytes([tag, size]) + body
    length = size.to_bytes((size.bit_length() + 7) // 8, "big")
    return bytes([tag, 0x80 | len(length)]) + length + body


def der_key(r: random.Random) -> bytes:
    """A PKCS #1, PKCS #8, SEC 1 or encrypted PKCS #8 key with random numbers."""
    number = lambda n: der(0x02, bytes([r.randrange(1, 128)]) + r.randbytes(n))
    name = der(0x30, der(0x06, r.randbytes(r.randrange(3, 9))) + r.choice([b"", b"\x05\x00", der(0x30, number(4))]))
    version = bytes([0x02, 1, r.randrange(2)])
    size = r.choice([32, 48, 130, 300])
    return der(0x30, r.choice([
        version + b"".join(number(r.choice([20, 64, 130])) for _ in range(r.randrange(5, 9))),
        version + name + der(0x04, r.randbytes(size)),
        version + der(0x04, r.randbytes(size)),
        name + der(0x04, r.randbytes(size)),
    ]))


def url_safe(data: bytes) -> str:
    return base64.urlsafe_b64encode(data).decode().rstrip("=")


def token(r: random.Random, header: dict) -> str:
    claims = {"sub": str(r.randrange(10**6)), "name": r.choice(WORDS), "n": [r.random(), {}]}
    return ".".join(map(url_safe, (json.dumps(header).encode(), json.dumps(claims).encode(), r.randbytes(r.choice([16, 32, 64])))))


def assignment(r: random.Random) -> bytes:
    value = "".join(r.choices("abcXYZ019+/_.=-", k=r.randrange(8, 30)))
    name = r.choice(["password", "Passwd", "SECRET", "token", "api_key", "apikey"])
    return f"{r.choice(['', 'db: ', 'é '])}{name}{r.choice([':', '=', ' = ', chr(34) + ': ' + chr(34)])}{value}".encode()


def written(r: random.Random, data: bytes) -> str:
    code = base64.b64encode(data).decode()
    return r.choice([code, code.rstrip("="), url_safe(data), data.hex(), data.hex().upper()])


def planted(r: random.Random) -> tuple[str | None, str]:
    """A secret with its kind, or something like one with none."""
    key, what = der_key(r), r.randrange(9)
    if what == 0:
        return "key", written(r, key)
    if what == 1:
        return "encoded", written(r, assignment(r))
    if what == 2:
        return "token", token(r, {"typ": "JWT", "alg": r.choice(["HS256", "RS512", "none"])})
    if what == 3:  # lengths that do not add up
        return None, written(r, r.choice([key[:-1], key + b"\0", b"\x31" + key[1:]]))
    if what == 4:  # the names without a value that is long enough, or not text
        return None, written(r, r.choice([b"password=short1 and no more of it", b"\xff\xfe" + assignment(r)]))
    if what == 5:  # a header without an algorithm, or one part only
        return None, r.choice([token(r, {"typ": "JWT"}), token(r, {"alg": 5}), url_safe(b'{"alg": "HS256"}') + ".e30.short"])
    if what == 6:
        return None, written(r, b"\x00" + r.randbytes(r.randrange(20, 90)))
    return None, r.choice(WORDS)


@pytest.mark.parametrize("seed", range(4))
def test_planted_secrets_alone_are_confirmed(spark, seed):
    r, rows, expected, kinds = random.Random(seed), [], {}, set()
    for i in range(150):
        text, spans = "", set()
        for _ in range(r.randrange(12)):
            kind, body = planted(r)
            text += r.choice(WORDS) + " "
            if kind:
                spans.add((kind, len(text), len(text) + len(body)))
                kinds.add(kind)
            text += body + r.choice([" ", ", ", " é ", ' "'])
        rows.append((i, text))
        expected[i] = spans
    found = secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows) and kinds == {"key", "encoded", "token"}
    for row in found:
        base = set(row["base"].split(",")) - {""}
        spans = [s.split(":") for s in row["spans"].split(",") if s and s not in base]
        assert {(k, int(a), int(b)) for k, a, b in spans} == expected[row["doc_id"]]
        assert base <= set(row["spans"].split(","))
