from __future__ import annotations

import hashlib
import random
import re

import pytest

from stockflow.llm import secrets
from stockflow.llm.dfa import compile_dfa, longest
from tests.llm.rows import ODD, documents

SCANNER = secrets.Scanner(secrets.RULES)
PIECES = [
    "password", "PassWD", "secret", "token", "api_key", "APIKEY", '"', "'", " ", "=", ":", "AKIA", "ABCD0123",
    "0123456789abcdef", "deadbeef" * 4, "ghp_", "a" * 20, "AIza", "eyJ", ".", "xoxb-", "-----BEGIN ", "RSA ",
    "PRIVATE KEY-----", "é", "\n", "bearer", "sk_live_", "_", "-", "F" * 12, "\U0001f600", "\x00", "ſecret", "Key",
]


def plain(text: str | None) -> list[tuple[int, int, int]]:
    """(start, rule, end) in code points by Python's own regular expressions."""
    found = []
    for number, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.decode() if rule.kind != "hex" else "[0-9a-f]+"
        for m in re.finditer(pattern, text or "", re.ASCII):
            head = re.match(rule.head.decode(), m[0], re.ASCII).end() if rule.head else 0
            if len(m[0]) - head >= rule.least:
                found.append((m.start(), number, m.end()))
    return sorted(found)


def line(spans) -> str:
    return ",".join(f"{secrets.RULES[k].kind}:{a}:{b}" for a, k, b in spans)


def texts(n: int) -> list[str]:
    rng = random.Random(4)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_scanner_finds_what_regular_expressions_find():
    for text in texts(3000):
        data = text.encode()
        got = [(len(data[:a].decode()), k, len(data[:b].decode())) for a, k, b in SCANNER.find(data)]
        assert got == plain(text), text


def test_long_runs():
    for text in ("f" * 100_000, "token=" + "x" * 100_000, "token=" * 20_000, "AKIA" * 20_000):
        data = text.encode()
        assert SCANNER.find(data) == plain(text)


@pytest.mark.parametrize("pattern", [b"a{2,4}b?", b"(?i:x|yz)+[^a-c\\s]", b"\\d+(ab|a)*", b".[\\w-]\\S", b"(a|ab)(c|bcd)?"])
def test_automata_agree_with_regular_expressions_on_ends(pattern):
    rng = random.Random(3)
    one = compile_dfa([pattern])
    for _ in range(500):
        data = bytes(rng.choice(b"aabbcdxXyYzZ0189 -\n\xc3") for _ in range(rng.randrange(12)))
        ends = [e for e in range(len(data) + 1) if re.fullmatch(pattern, data[:e])]
        assert longest(one, data, 0) == max(ends, default=-1)


def test_unsupported_expressions_are_refused():
    for pattern in (b"^a", b"(?=a)b", b"a*"):
        with pytest.raises(ValueError):
            compile_dfa([pattern])


def test_minimal():
    assert len(compile_dfa([b"abc|abd|ab[ef]"]).table) == 5
    assert len(compile_dfa([b"(a|b)*abb"], anywhere=False).table) <= 5


def test_digests_and_rows(spark):
    rows = [*ODD, *[(100 + i, t) for i, t in enumerate(texts(200))], (100, texts(1)[0])]
    docs = documents(spark, rows, "spans")
    got = sorted(map(tuple, secrets.digests(docs).collect()), key=str)
    want = []
    for i, t in rows:
        found = plain(t)
        base = [f for f in found if f[1] < 3]
        counts = [sum(f[1] == k for f in base) for k in range(3)]
        want.append((i, *counts, hashlib.sha256(line(base).encode()).hexdigest(), line(found)))
    assert got == sorted(want, key=str)
    assert sorted(secrets.scan(docs).columns) == sorted(docs.columns)
    assert secrets.digests(documents(spark, [])).collect() == [] == secrets.masked(documents(spark, [])).collect()


def test_masked(spark):
    rows = [(1, "é token = 0123456789abcdef0123456789abcdef0 end AKIA" + "Z" * 12), (2, None), (3, "clean"), (4, "f" * 32)]
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in secrets.masked(documents(spark, rows)).collect()}
    assert got[1] == ("é <assign> end <access>", 23)
    assert got[2] == (None, None) and got[3] == ("clean", 5) and got[4] == ("<hex>", 5)
