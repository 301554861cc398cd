"""Secrets in source and configuration text: fixed shapes, and literals assigned to sensitive names.

Besides three fixed patterns, every document that mentions a sensitive stem is lexed into name-literal pairs
(``name = "x"``, ``name: x``, ``"name" => 'x'``, ``name: str = "a" + other``). Names bound to literals are
constants of the document, so a literal also counts when it reaches a sensitive name by way of others or as
part of a concatenation. A literal is reported when sensitivity of the name times quality of the literal
reaches a threshold.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import prepare

KINDS = ("assign", "access", "hex", "named")

ASSIGN = re.compile(
    r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs of 24 or more are the runs that count.
HEX = re.compile(r"[0-9a-f]{24,}")

# How telling a part of a name is, by itself or after the part before it.
PARTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "credential": 0.8,
    "credentials": 0.8, "bearer": 0.8, "apikey": 1.0, "api key": 1.0, "access key": 0.9, "private key": 1.0,
    "secret key": 1.0, "auth key": 0.9, "encryption key": 0.9, "signing key": 0.9, "client secret": 1.0, "pass": 0.6,
    "auth": 0.5, "key": 0.4,
}
STEM = re.compile(r"pass|pwd|secret|token|cred|bearer|key|auth")
PLACEHOLDER = re.compile(
    r"(?i)^(?:x{3,}|\*{3,}|\.{3,}|change_?me|example|sample|dummy|placeholder|your[_-].*|none|null|true|false|undefined|todo|.*\$\{.*|.*\{\{.*|<.*>?|%.*%?|(?:os\.|process\.)?(?:env|getenv)\b.*)$"
)
REPORTED = 0.5
# From so many pieces on a literal counts once in a concatenation, so that constants made of constants stay bounded.
REPEATED = 64

_TERM = r"""(?:"(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'|`[^`\n]*+`|[^\s"'`,;(){}\[\]<>+]++)"""
# A name starts where no name character stands before it, so no position is tried twice.
PAIR = re.compile(
    r"""(?<![A-Za-z0-9_.\-])(["']?)([A-Za-z_][A-Za-z0-9_.\-]*+)\1[\x20\t]*+"""
    r"""(?::[\x20\t]*+[A-Za-z_][A-Za-z0-9_.]*+[\x20\t]*+(?==))?"""
    r"""(?:=>|:=|[:=])(?!=)[\x20\t]*+(""" + _TERM + r"""(?:[\x20\t]*+\+[\x20\t]*+""" + _TERM + r""")*+)"""
)
TERM = re.compile(_TERM)
NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.\-]*")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

Span = tuple[str, int, int]


def sensitivity(name: str) -> float:
    """0 to 1: how much a name speaks for a secret; its last word counts most."""
    words = [w.lower() for w in _WORDS.findall(name)]
    best = 0.0
    for i, word in enumerate(words):
        weight = max(PARTS.get(word, 0.0), PARTS.get(f"{words[i - 1]} {word}", 0.0) if i else 0.0)
        best = max(best, weight if i == len(words) - 1 else 0.6 * weight)
    return best


def quality(literal: str) -> float:
    """0 to 1: how much a literal looks like a key rather than a word, a placeholder or prose."""
    if len(literal) < 6 or PLACEHOLDER.match(literal) or any(c.isspace() for c in literal):
        return 0.0
    n = len(literal)
    bits = -sum(k / n * math.log2(k / n) for k in Counter(literal).values())
    kinds = sum(any(f(c) for c in literal) for f in (str.isdigit, str.isupper, str.islower)) + (not literal.isalnum())
    return min(1.0, bits / 4.0) * (0.55 if kinds == 1 else 0.85 if kinds == 2 else 1.0)


def named_literals(text: str) -> list[tuple[int, int]]:
    """Places of literals that reach a sensitive name, directly, through constants or in a concatenation."""
    constants: dict[str, list[tuple[int, int]]] = {}
    found: set[tuple[int, int]] = set()
    for pair in PAIR.finditer(text):
        name, pieces = pair[2], []
        for term in TERM.finditer(text, pair.start(3), pair.end(3)):
            quoted = term[0][0] in "\"'`"
            if not quoted and term[0] in constants:
                pieces += constants[term[0]]
            elif quoted:
                pieces.append((term.start() + 1, term.end() - 1))
            elif not (pair[3].count("+") and NAME.fullmatch(term[0])):
                pieces.append(term.span())
        if len(pieces) > REPEATED:
            pieces = list(dict.fromkeys(pieces))
        constants[name] = pieces
        weight = sensitivity(name)
        if weight:
            # A literal split by concatenation is judged as a whole.
            if weight * quality("".join(text[a:b] for a, b in pieces)) >= REPORTED:
                found.update((a, b) for a, b in pieces if b > a)
    return sorted(found)


def secrets_of(text: str | None) -> list[Span]:
    """(kind, start, end) in code points, by start and then kind; a null text has none."""
    if not text:
        return []
    spans: list[Span] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    if ("=" in text or ":" in text) and STEM.search(low):
        spans += [("named", a, b) for a, b in named_literals(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [[{"kind": k, "start": a, "end": b} for k, a, b in secrets_of(t)] for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPANS)], names=["doc_id", "spans"])


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, spans array<struct<kind, start, end>>.

    Spans are ordered by start and then kind (assign, access, hex, named); ends are exclusive, units are code
    points of the whole text. Null and empty texts have no spans, a null doc_id stays null, repeated rows are
    scanned each. One pass over the rows, no shuffle. Other columns are not read.
    """
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _scan, "doc_id long, spans array<struct<kind: string, start: long, end: long>>"
    )


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
