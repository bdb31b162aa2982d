"""Secrets by assignment-aware lexing (operator 8).

Three patterns give the base findings. Beside them, source and configuration syntax is read as pairs of a
name and what is assigned to it: quoted or bare literals, names of constants, and sums of these. Constants
are followed to the literals they stand for, and a literal is scored by the names it reaches and by its own
look. What scores high and lies in no base finding is added as kind ``literal``.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portdelta.llm.staging import small_batches
from portdelta.llm.text import slices
from portdelta.ship import by_value

KINDS = ("assign", "access", "hex", "literal")

_BASE_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_BASE_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_BASE_HEX = re.compile(r"[0-9a-f]{24,}")
_HINTS = ("passw", "secret", "token", "api")

_TARGET = re.compile(
    r"""(?<![A-Za-z0-9_.-])(?P<name>[A-Za-z_][A-Za-z0-9_.-]*+)["'\]]{0,2}[ \t]*(?::[ \t]*[A-Za-z_][\w.\[\]]*[ \t]*(?==))?(?::=|=>|=(?![=~>])|:(?![:/=]))[ \t]*""",
    re.ASCII,
)
_QUOTED = re.compile(r'''(?P<q>"""|\'\'\'|["'`])(?P<body>(?:(?!(?P=q))[^\\]|\\.)*+)(?P=q)''', re.DOTALL)
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*+(?![A-Za-z0-9_/+=-])", re.ASCII)
_BARE = re.compile(r"""[^\s"'`,;(){}\[\]<>]+""")
_PLUS = re.compile(r"[ \t]*(?:\+|\\?\r?\n[ \t]*\+)[ \t]*")
_NAME_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_FILLER = re.compile(r"(?i)^(?:x+|\*+|\.+|<.*|\$[({].*|%.*%|\{\{.*|(?:your|my|example|changeme|placeholder|dummy|sample|todo|none|null|true|false|test)\b.*)$")

# How strongly a word in a name points to a secret.
NAME_WEIGHTS = {
    "password": 1.0,
    "passwd": 1.0,
    "passphrase": 1.0,
    "pwd": 1.0,
    "secret": 1.0,
    "apikey": 1.0,
    "credential": 0.9,
    "credentials": 0.9,
    "token": 0.9,
    "pass": 0.7,
    "auth": 0.5,
    "private": 0.5,
    "api": 0.5,
    "access": 0.5,
    "key": 0.5,
    "signing": 0.5,
    "encryption": 0.5,
}


@dataclass(frozen=True)
class Found:
    kind: str
    start: int
    end: int
    name: str
    score: float


@dataclass(frozen=True)
class _Term:
    """Part of what is assigned: a literal with its place, or a name to follow."""

    text: str
    start: int
    end: int
    is_name: bool


def base_spans(text: str) -> list[Found]:
    """Leftmost matches of each pattern that do not overlap; short ones are dropped after matching."""
    out = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        out += [Found("assign", m.start(), m.end(), m[1].lower(), 1.0) for m in _BASE_ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [Found("access", *m.span(), "", 1.0) for m in _BASE_ACCESS.finditer(text)]
    out += [Found("hex", *m.span(), "", 1.0) for m in _BASE_HEX.finditer(text)]
    return out


def pairs(text: str) -> list[tuple[str, list[_Term]]]:
    """Names and the terms assigned to them, in the order of the text."""
    out = []
    for m in _TARGET.finditer(text):
        terms, at = [], m.end()
        while True:
            quoted = _QUOTED.match(text, at)
            word = None if quoted else _NAME.match(text, at)
            bare = None if quoted or word else _BARE.match(text, at)
            if quoted:
                terms.append(_Term(quoted["body"], *quoted.span("body"), False))
            elif word:
                terms.append(_Term(word[0], *word.span(), True))
            elif bare:
                terms.append(_Term(bare[0], *bare.span(), False))
            else:
                break
            at = (quoted or word or bare).end()
            plus = _PLUS.match(text, at)
            if not plus:
                break
            at = plus.end()
        if terms:
            out.append((m["name"], terms))
    return out


def name_score(name: str) -> float:
    return min(1.0, sum(NAME_WEIGHTS.get(w.lower(), 0.0) for w in set(_NAME_WORDS.findall(name))))


def literal_score(value: str) -> float:
    """0 to 1: filler and prose score low, long mixed strings high."""
    if len(value) < 6 or _FILLER.match(value) or re.search(r"\s", value):
        return 0.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, entropy / 3.5) * (0.7 + 0.15 * min(kinds - 1, 2))


class _Bindings:
    """What names stand for, in the order of the text.

    A name means its last assignment before the place it is used, or the first one after it if there is none
    before. An assignment that only repeats another name stands for that one, however long the chain is, and a
    literal counts once however often it is added; a name that leads back to itself ends there.
    """

    def __init__(self, said: list[tuple[str, list[_Term]]]) -> None:
        self.said = said
        self.places: dict[str, list[int]] = {}
        for i, (name, _) in enumerate(said):
            self.places.setdefault(name, []).append(i)
        self.stands: dict[int, int | None] = {}
        self.found: dict[int, list[_Term]] = {}

    def meant(self, term: _Term, at: int) -> int | None:
        places = self.places.get(term.text, [])
        k = bisect_left(places, at)
        if k:
            return places[k - 1]
        later = places[k : k + 2]
        return next((i for i in later if i != at), None)

    def origin(self, at: int | None) -> int | None:
        """The assignment at the end of a chain of plain names."""
        path: list[int] = []
        met: set[int] = set()
        while at is not None and at not in self.stands:
            if at in met:
                at = None
                break
            path.append(at)
            met.add(at)
            terms = self.said[at][1]
            onward = self.meant(terms[0], at) if len(terms) == 1 and terms[0].is_name else None
            if onward is None:
                self.stands[at] = at
                break
            at = onward
        end = None if at is None else self.stands[at]
        for i in path:
            self.stands[i] = end
        return end

    def literals(self, at: int) -> list[_Term]:
        start = self.origin(at)
        if start is None:
            return []
        if start not in self.found:
            out: dict[tuple[int, int], _Term] = {}
            seen, stack = {start}, [(start, iter(self.said[start][1]))]
            while stack:
                i, terms = stack[-1]
                term = next(terms, None)
                if term is None:
                    stack.pop()
                elif not term.is_name or self._is_bare(term, i):
                    out.setdefault((term.start, term.end), term)
                else:
                    onward = self.origin(self.meant(term, i))
                    if onward is not None and onward not in seen:
                        seen.add(onward)
                        stack.append((onward, iter(self.said[onward][1])))
            self.found[start] = list(out.values())
        return self.found[start]

    def _is_bare(self, term: _Term, at: int) -> bool:
        """A word that is no name of the text, alone and with a digit: a literal without quotes."""
        return term.text not in self.places and len(self.said[at][1]) == 1 and re.search(r"\d", term.text) is not None


def literal_spans(text: str, least: float = 0.45) -> list[Found]:
    """Literals that reach a sensitive name, scored by name and look."""
    if "=" not in text and ":" not in text:
        return []
    said = pairs(text)
    weights = [name_score(n) for n, _ in said]
    if not any(weights):
        return []
    bindings, looks = _Bindings(said), {}
    best: dict[tuple[int, int], Found] = {}
    for i, ((name, _), weight) in enumerate(zip(said, weights)):
        if not weight:
            continue
        parts, start = bindings.literals(i), bindings.origin(i)
        if start not in looks:
            looks[start] = literal_score("".join(p.text for p in parts))
        score = round(weight * looks[start], 6)
        if score < least:
            continue
        for p in parts:
            old = best.get((p.start, p.end))
            if p.text and (old is None or score > old.score):
                best[p.start, p.end] = Found("literal", p.start, p.end, name, score)
    return list(best.values())


def find_secrets(text: str) -> list[Found]:
    base = base_spans(text)
    more = [f for f in literal_spans(text) if not any(b.start <= f.start and f.end <= b.end for b in base)]
    return sorted(base + more, key=lambda f: (f.start, KINDS.index(f.kind), f.end))


_SPANS = "array<struct<kind string, start int, end int, name string, score double>>"


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("name", pa.string()), ("score", pa.float64())])
    for batch in batches:
        for part in slices(batch):
            found = [[vars(f) for f in find_secrets(t or "")] for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.list_(span))], names=["doc_id", "spans"])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, spans`` for every row of ``docs (doc_id, text, ...)``; a span has kind, start, end, name, score.

    Spans are code points of the whole text, end excluded, by start and then by kind in the order of
    ``KINDS``. A null text is an empty one and has none. A null doc_id stays null, repeated rows give
    repeated results, other columns are ignored. Names are followed in the order of the text (see ``_Bindings``),
    without recursion, so chains of any length and constants that double line by line end quickly.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scan, f"doc_id long, spans {_SPANS}")


by_value(__name__)
