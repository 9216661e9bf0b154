"""Secret scans: every rule in one automaton, one pass over the bytes of each text."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.dfa import compile_dfa, longest, starts
from stockflow.llm.store import annotate


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a regular expression over bytes without anchors or look-around.

    A match counts if it has ``least`` bytes or more after the longest match of ``head`` at its
    beginning; one that has fewer is dropped, and the search goes on behind it.
    """

    kind: str
    pattern: bytes
    least: int = 0
    head: bytes | None = None


_ASSIGN = rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""

#: The base rules in their order. A run of hex digits below 32 can neither match nor
#: hide a match, so that length stands in the expression; a short value of an assignment can hide one.
BASE = (
    Rule("assign", _ASSIGN + rb"[A-Za-z0-9+/_.=-]+", 8, _ASSIGN),
    Rule("access", rb"AKIA[A-Z0-9]+", 16),
    Rule("hex", rb"[0-9a-f]{32,}", 32),
)

#: Published formats of tokens and keys.
ADDED = (
    Rule("github", rb"gh[opsur]_[A-Za-z0-9]+", 40),
    Rule("google", rb"AIza[A-Za-z0-9_-]+", 39),
    Rule("slack", rb"xox[abeprs]-[A-Za-z0-9-]+", 20),
    Rule("stripe", rb"[rs]k_live_[A-Za-z0-9]+", 24),
    Rule("jwt", rb"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("pem", rb"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("bearer", rb"(?i:bearer) +[A-Za-z0-9+/_.=~-]+", 20, rb"(?i:bearer) +"),
)

RULES = BASE + ADDED


class Scanner:
    """All rules compiled: where matches can begin, by one automaton, and where each rule's end."""

    def __init__(self, rules: Sequence[Rule]):
        if len(rules) > 60:
            raise ValueError("at most 60 rules an automaton")
        self.rules = tuple(rules)
        self.begins = compile_dfa([r.pattern for r in rules], anywhere=True, backward=True)
        self.ends = [compile_dfa([r.pattern]) for r in rules]
        self.heads = [compile_dfa([r.head]) if r.head else None for r in rules]

    def find(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes, by start, then rule; per rule leftmost, longest, apart."""
        found = []
        done = [0] * len(self.rules)
        for place, bits in reversed(starts(self.begins, data)):
            while bits:
                number = (bits & -bits).bit_length() - 1
                bits &= bits - 1
                if place < done[number]:
                    continue
                end = done[number] = longest(self.ends[number], data, place)
                head = self.heads[number]
                begin = longest(head, data, place) if head else place
                if end - begin >= self.rules[number].least:
                    found.append((place, number, end))
        return found


def _code_points(data: bytes, places: np.ndarray) -> np.ndarray:
    """Byte places as numbers of code points."""
    first = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80, out=first[1:])
    return first[places]


_SPAN = "array<struct<kind: string, start: long, end: long>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _spans(texts: pa.Array, scanner: Scanner) -> pa.Array:
    sizes, starts_, numbers, ends_ = [0], [], [], []
    for text in texts:
        data = text.as_buffer().to_pybytes() if text.is_valid else b""
        found = scanner.find(data)
        sizes.append(sizes[-1] + len(found))
        if found:
            at = np.array(found, dtype=np.int64)
            starts_.append(_code_points(data, at[:, 0]))
            ends_.append(_code_points(data, at[:, 2]))
            numbers.append(at[:, 1])
    names = pa.array([r.kind for r in scanner.rules], pa.string())
    join = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
    kind = names.take(pa.array(join(numbers)))
    rows = pa.StructArray.from_arrays([kind, pa.array(join(starts_)), pa.array(join(ends_))], ["kind", "start", "end"])
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), rows).cast(_ARROW)


def _found(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    scanner = Scanner(rules)
    return annotate(docs, docs.columns, f"spans {_SPAN}", lambda texts: {"spans": _spans(texts, scanner)})


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` with ``spans``: kind, start and end of every secret in ``text``.

    Places count code points, the end is exclusive; spans come by start, then in the order of the
    rules, and those of different kinds may overlap. An automaton of all reversed expressions reads
    each text once from its end and marks where a rule can begin; the marked places alone are
    followed to their longest end. Null and empty texts have no spans; null and repeated ids are
    rows like others; an empty table gives no rows; a column ``spans`` of ``docs`` is replaced.
    """
    found = _found(docs, rules)
    return found.select(*[F.col(f"row.`{c}`") for c in docs.columns if c != "spans"], "spans")


def masked(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` with every span's text replaced by its kind in angle brackets.

    Of overlapping spans the first to begin names the whole stretch. Other columns and rows without
    a span are unchanged, but for ``n_chars``, which follows the text.
    """
    found = _found(docs, rules)
    merge = """aggregate(spans, CAST(array() AS array<struct<kind: string, start: long, end: long>>), (done, s) ->
      CASE WHEN size(done) = 0 OR element_at(done, -1).end <= s.start THEN array_append(done, s)
      ELSE array_append(slice(done, 1, size(done) - 1), named_struct('kind', element_at(done, -1).kind,
        'start', element_at(done, -1).start, 'end', greatest(element_at(done, -1).end, s.end))) END)"""
    parts = """concat(
      array_join(transform(whole, (s, i) -> concat(substring(row.text,
        cast(if(i = 0, 0, whole[greatest(i - 1, 0)].end) + 1 AS int),
        cast(s.start - if(i = 0, 0, whole[greatest(i - 1, 0)].end) AS int)), '<', s.kind, '>')), ''),
      substring(row.text, cast(element_at(whole, -1).end + 1 AS int)))"""
    cut = found.withColumn("whole", F.expr(merge)).withColumn("cut", F.expr(f"IF(size(whole) > 0, {parts}, row.text)"))
    columns = []
    for name, kind in docs.dtypes:
        old = F.col(f"row.`{name}`")
        new = {"text": F.col("cut"), "n_chars": F.when(F.size("spans") > 0, F.length("cut").cast(kind)).otherwise(old)}
        columns.append(new.get(name, old).alias(name))
    return cut.select(*columns)


def digests(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans (as text) of every document."""
    found = _found(docs, rules).select(F.col("row.doc_id").alias("doc_id"), F.col("spans").alias("found"))
    kinds = [r.kind for r in BASE]
    listed = ", ".join(f"'{k}'" for k in kinds)
    line = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(found, s -> s.kind = '{k}')) AS long)").alias(f"n_{k}") for k in kinds],
        F.expr(f"sha2({line.format(f'filter(found, s -> s.kind IN ({listed}))')}, 256)").alias("base_sha256"),
        F.expr(line.format("found")).alias("spans"),
    )
