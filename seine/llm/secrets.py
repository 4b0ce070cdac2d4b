"""Secret scans through a trigram index.

Each rule's regular expression gives a Boolean query over trigrams that every match must
hold. A block of texts is indexed (postings of the trigrams that any query names, over the
lower-cased UTF-8 bytes), the queries intersect and unite postings, and only candidates meet
the expression. A rule whose expression has no mandatory trigram scans every whole text.
"""

from __future__ import annotations

import re
import re._constants as sre
import re._parser as sre_parser
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import map_arrow


class Rule(NamedTuple):
    """Matches of ``pattern`` of which ``group`` has at least ``least`` characters, from left to right."""

    kind: str
    pattern: str
    flags: int = 0
    group: int = 0
    least: int = 0


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 0, 20),
    # Runs are maximal either way, so asking for 24 at once finds what [0-9a-f]+ of 24 or more does.
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
)
RULES = BASE + MORE
SPANS = "array<struct<kind:string,start:int,end:int>>"
#: Strings that a part of an expression may stand for before it counts as unknown.
MOST_STRINGS = 64
#: Copies of a repeated part that are looked at.
MOST_COPIES = 8
ANY = ("and", ())


def _parts(query) -> tuple:
    return query[1] if query[0] == "and" else (query,)


def _all(*parts):
    flat = tuple(dict.fromkeys(x for p in parts for x in _parts(p)))
    return flat[0] if len(flat) == 1 else ("and", flat)


def _either(parts):
    """One of the parts; those that ask for more than another are left out."""
    parts = list(dict.fromkeys(parts))
    asked = [frozenset(_parts(p)) for p in parts]
    parts = tuple(p for p, own in zip(parts, asked, strict=True) if not any(x < own for x in asked))
    return ANY if ANY in parts or not parts else parts[0] if len(parts) == 1 else ("or", parts)


def _grams(strings):
    """What holds if one of the strings stands in the text."""
    return _either([_all(*(("gram", s[i : i + 3]) for i in range(len(s) - 2))) for s in sorted(strings)])


class Part(NamedTuple):
    """What is known of the matches of a part of an expression, all bytes with ASCII letters folded.

    ``exact``: all strings that it matches, or None if they are too many or unknown; then each
    match starts with one of ``heads``, ends with one of ``tails``, and its text holds ``query``.
    """

    exact: frozenset[bytes] | None
    heads: frozenset[bytes] = frozenset([b""])
    tails: frozenset[bytes] = frozenset([b""])
    query: tuple = ANY


EMPTY = Part(frozenset([b""]))
UNKNOWN = Part(None)


def _cut(strings: frozenset[bytes], end: bool) -> frozenset[bytes]:
    """At most two bytes of each string's start or end, fewer if there are still too many."""
    for n in (2, 1):
        if len(out := frozenset(s[-n:] if end else s[:n] for s in strings)) <= MOST_STRINGS:
            return out
    return frozenset([b""])


def _opened(part: Part) -> Part:
    """Without ``exact``: its trigrams go to the query."""
    if part.exact is None:
        return part
    return Part(None, _cut(part.exact, False), _cut(part.exact, True), _all(part.query, _grams(part.exact)))


def _then(a: Part, b: Part) -> Part:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= MOST_STRINGS:
        return Part(frozenset(x + y for x in a.exact for y in b.exact))
    if a.exact is not None and b.exact is not None:
        a = _opened(a)
    product = lambda xs, ys: frozenset(x + y for x in xs for y in ys) if len(xs) * len(ys) <= MOST_STRINGS**2 else frozenset([b""])
    heads = product(a.exact, b.heads) if a.exact is not None else a.heads
    tails = product(a.tails, b.exact) if b.exact is not None else b.tails
    between = product(a.exact if a.exact is not None else a.tails, b.exact if b.exact is not None else b.heads)
    own = [_grams(x.exact) for x in (a, b) if x.exact is not None]
    query = _all(a.query, b.query, _grams(heads), _grams(tails), _grams(between), *own)
    return Part(None, _cut(heads, False), _cut(tails, True), query)


def _or(parts: list[Part]) -> Part:
    if all(x.exact is not None for x in parts) and len(union := frozenset().union(*(x.exact for x in parts))) <= MOST_STRINGS:
        return Part(union)
    parts = [_opened(x) for x in parts]
    heads, tails = frozenset().union(*(x.heads for x in parts)), frozenset().union(*(x.tails for x in parts))
    return Part(None, _cut(heads, False), _cut(tails, True), _either([x.query for x in parts]))


@cache
def _cases(char: str, flags: int) -> frozenset[bytes] | None:
    """What a character may stand for, folded; None if that isn't known."""
    if not flags & re.IGNORECASE or (char.isascii() and not char.isalpha()):
        return frozenset([char.encode().lower()])
    if not char.isascii():
        return None
    beyond = "" if flags & re.ASCII else _beyond_ascii()
    return frozenset([char.lower().encode(), *(x.encode() for x in beyond if re.fullmatch(char, x, re.IGNORECASE))])


@cache
def _beyond_ascii() -> str:
    """Characters outside ASCII that a letter matches where case is ignored."""
    return "".join(re.findall("[a-z]", "".join(chr(x) for x in range(128, 0x110000) if not 0xD800 <= x < 0xE000), re.IGNORECASE))


def _class(items, flags: int) -> Part:
    """A class of few characters; else one character that may be any."""
    out: set[bytes] = set()
    for op, arg in items:
        some = [arg] if op is sre.LITERAL else range(arg[0], arg[1] + 1) if op is sre.RANGE and arg[1] - arg[0] < 16 else None
        if some is None or None in (cases := [_cases(chr(x), flags) for x in some]):
            return UNKNOWN
        out = out.union(*cases)
    return Part(frozenset(out)) if len(out) <= 16 else UNKNOWN


def _repeated(inner: Part, low: int, high: int) -> Part:
    if low == 0:
        return _or([EMPTY, inner]) if high == 1 else UNKNOWN
    some = EMPTY
    for _ in range(min(low, MOST_COPIES)):
        some = _then(some, inner)
    if low == high <= MOST_COPIES:
        return some
    return _opened(some)  # starts with these copies and ends with as many, whatever stands between


def _sequence(nodes, flags: int) -> Part:
    out = EMPTY
    for op, arg in nodes:
        if op is sre.LITERAL:
            cases = _cases(chr(arg), flags)
            part = UNKNOWN if cases is None else Part(cases)
        elif op is sre.IN:
            part = _class(arg, flags)
        elif op is sre.SUBPATTERN:
            part = _sequence(arg[3], (flags | arg[1]) & ~arg[2])
        elif op is sre.ATOMIC_GROUP:
            part = _sequence(arg, flags)
        elif op is sre.BRANCH:
            part = _or([_sequence(x, flags) for x in arg[1]])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            part = _repeated(_sequence(arg[2], flags), arg[0], arg[1])
        elif op in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
            continue  # of no width; what an assertion asks for beside that is left out
        else:
            part = UNKNOWN
        out = _then(out, part)
    return out


def trigram_query(pattern: str, flags: int = 0):
    """The expression's mandatory trigrams as ("gram", bytes), ("and", parts) or ("or", parts); ANY if none.

    Every part of the expression gets the strings that it matches or, where these are unknown or
    many, those that its matches start and end with and a query; parts that follow on each other
    join what is known at the place where they meet. ASCII letters are folded, as in the index.
    """
    nodes = sre_parser.parse(pattern, flags)
    return _opened(_sequence(nodes, nodes.state.flags)).query


def grams_of(query) -> set[bytes]:
    return {query[1]} if query[0] == "gram" else {g for part in query[1] for g in grams_of(part)}


class TrigramIndex:
    """Postings of chosen trigrams over one block of texts."""

    FOLD = np.array([x + 32 if 65 <= x <= 90 else x for x in range(256)], "u1")

    def __init__(self, grams: set[bytes]):
        self.grams = sorted(grams)
        self.slot = np.zeros(1 << 24, "u2" if len(self.grams) < 1 << 16 else "u4")
        for k, g in enumerate(self.grams):
            self.slot[g[0] << 16 | g[1] << 8 | g[2]] = k + 1

    def postings(self, data: np.ndarray, offsets: np.ndarray) -> dict[bytes, np.ndarray]:
        """Per trigram, which texts hold it; text k is data[offsets[k]:offsets[k + 1]]."""
        n = len(offsets) - 1
        out = {g: np.zeros(n, bool) for g in self.grams}
        low = self.FOLD[data[offsets[0] : offsets[-1]]].astype("i4")
        if len(low) < 3:
            return out
        slots = self.slot[low[:-2] << 16 | low[1:-1] << 8 | low[2:]]
        at = np.flatnonzero(slots)
        ends = offsets - offsets[0]
        text = np.searchsorted(ends, at, "right") - 1
        inside = at + 3 <= ends[text + 1]
        for k, g in enumerate(self.grams):
            out[g][text[inside & (slots[at] == k + 1)]] = True
        return out


def candidates(query, postings: dict[bytes, np.ndarray], n: int) -> np.ndarray:
    if query[0] == "gram":
        return postings[query[1]]
    out = np.full(n, query[0] == "and")
    for part in query[1]:
        out = out & candidates(part, postings, n) if query[0] == "and" else out | candidates(part, postings, n)
    return out


class Scanner:
    """Spans of all rules in a block of texts."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, re.compile(r.pattern, r.flags), trigram_query(r.pattern, r.flags)) for r in rules]
        self.index = TrigramIndex(set().union(*(grams_of(q) for _, _, q in self.rules)))

    def spans(self, column: pa.Array, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        if not texts:
            return []
        offsets = np.frombuffer(column.buffers()[1], "i8" if pa.types.is_large_string(column.type) else "i4")[column.offset : column.offset + len(column) + 1].astype("i8")
        data = np.frombuffer(column.buffers()[2], "u1") if column.buffers()[2] else np.zeros(0, "u1")
        postings = self.index.postings(data, offsets)
        for k, (rule, pattern, query) in enumerate(self.rules):
            for i in np.flatnonzero(candidates(query, postings, len(texts))).tolist():
                found[i] += [(m.start(), k, m.end()) for m in pattern.finditer(texts[i]) if m.end(rule.group) - m.start(rule.group) >= rule.least]
        return [[(self.rules[k][0].kind, a, b) for a, k, b in sorted(x)] for x in found]


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each stretch of overlapping spans replaced by the kind that starts it."""
    out, at, k = [], 0, 0
    while k < len(spans):
        kind, start, end = spans[k]
        k += 1
        while k < len(spans) and spans[k][1] < end:
            end, k = max(end, spans[k][2]), k + 1
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def find_secrets(docs: DataFrame, keep: list[str], text_col: str = "text", rules: tuple[Rule, ...] = RULES, redacted: bool = False) -> DataFrame:
    """_kept (the ``keep`` columns, whatever their names), ``secret_spans`` (kind, start, end in code points; by start, then rule) and, if asked, ``redacted_text``.

    A null text is an empty one without spans (its redacted text stays null); null or repeated
    keys are passed on; an empty table gives no rows; columns outside ``keep`` are not read.
    """
    rows = docs.select(F.struct(*keep).alias("_kept"), F.col(text_col).alias("_text"))
    schema = ", ".join([f"_kept {rows.schema['_kept'].dataType.simpleString()}", f"secret_spans {SPANS}", *["redacted_text string"] * redacted])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            column = batch.column(1)
            raw = column.to_pylist()
            texts = [x or "" for x in raw]
            spans = scanner.spans(column, texts)
            out = [batch.column(0), pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in x] for x in spans], kind)]
            if redacted:
                out.append(pa.array([x and redact(x, s) for x, s in zip(raw, spans, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(out, names=["_kept", "secret_spans", *["redacted_text"] * redacted])

    return map_arrow(rows, scan, schema)
