"""Byte-level BPE encoding and decoding with pre-tokenisation by an associative scan.

The split pattern is a small automaton once each code point knows its class and what follows
it. Every symbol is then a function from states to states; functions compose associatively,
and the few compositions that can arise form a finite monoid with a multiplication table. A
blocked scan over that table gives the state at every code point in array operations, and a
token starts wherever (state before, symbol) says so. No regular expression runs. Slices go
to a pair merger that remembers words; their offsets come back for decoding.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import cache
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import map_arrow
from .word_tokens import Memory

#: Symbols: a code point's class, with what the pattern looks ahead for.
LETTER, NUMBER, OTHER, SHORT, LONG, GAP, SPACE_LAST, WHITE_LAST, END = range(9)
#: States: within letters, digits, other signs; after a blank that joins what follows; within
#: white space; one or two letters before a contraction ends; at a place where a token starts.
IN_L, IN_N, IN_O, JOINS, IN_W, ONE, TWO, FRESH = range(8)
SCAN_BLOCK = 256
#: White space outside the general categories Z*.
CONTROL_SPACES = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x85)


def _moves() -> np.ndarray:
    """Next state by symbol and state."""
    to = np.empty((9, 8), "u1")
    to[LETTER] = IN_L
    to[LETTER, TWO], to[LETTER, ONE] = ONE, FRESH
    to[NUMBER], to[OTHER], to[GAP], to[SPACE_LAST], to[WHITE_LAST], to[END] = IN_N, IN_O, IN_W, JOINS, FRESH, FRESH
    to[SHORT], to[LONG] = ONE, TWO
    to[SHORT, [IN_O, JOINS]] = to[LONG, [IN_O, JOINS]] = IN_O
    return to


def _starts() -> np.ndarray:
    """Whether a token starts, by symbol and the state before."""
    starts = np.ones((9, 8), bool)
    starts[LETTER, [IN_L, JOINS, ONE, TWO]] = starts[NUMBER, [IN_N, JOINS]] = starts[GAP, IN_W] = False
    for x in (OTHER, SHORT, LONG):
        starts[x, [IN_O, JOINS]] = False
    return starts


@cache
def _monoid() -> tuple[np.ndarray, np.ndarray]:
    """The product table of all compositions of the symbols' functions, and their action on states.

    Elements 0 to 8 are the symbols themselves; ``product[a, b]`` is a, then b.
    """
    elements = [tuple(int(x) for x in f) for f in _moves()]
    known = {}
    for k, f in enumerate(elements):
        known.setdefault(f, k)
    k = 0
    while k < len(elements):
        for g in elements[:9]:
            if (h := tuple(g[x] for x in elements[k])) not in known:
                known[h] = len(elements)
                elements.append(h)
        k += 1
    product = np.array([[known[tuple(g[x] for x in f)] for g in elements] for f in elements], "i2")
    return product, np.array(elements, "u1")


@cache
def code_point_classes() -> np.ndarray:
    """0 other, 1 letter, 2 number, 3 the blank, 4 other white space, by code point; 5 is the mark after a text.

    Python, the regex library and the tiktoken library each carry their own Unicode version.
    Where the first two disagree (letters and digits of late versions), the third is asked.
    """
    import regex

    points = np.array([*range(0xD800), *range(0xE000, 0x110000)])
    older, newer = np.zeros(0x110001, "u1"), np.zeros(0x110001, "u1")
    kinds = {"L": 1, "N": 2, "Z": 4}
    older[points] = [kinds.get(category(chr(x))[0], 0) for x in points.tolist()]
    every = "".join(map(chr, points.tolist()))
    for kind, pattern in ((1, r"\p{L}+"), (2, r"\p{N}+"), (4, r"\p{Z}+")):
        for m in regex.finditer(pattern, every):
            newer[points[m.start() : m.end()]] = kind
    for x in np.flatnonzero(older != newer).tolist():
        older[x] = _asked(chr(x))
    older[list(CONTROL_SPACES)] = 4
    older[0x20], older[0x110000] = 3, 5
    return older


@cache
def _probe():
    """An encoding that merges a, 1 or ! with any next byte, so it shows whether the two share a slice."""
    import tiktoken
    from public_tokenizers import PATTERN

    pairs = [bytes([x]) for x in range(256)] + [bytes([a, b]) for a in b"a1!" for b in range(256)]
    return tiktoken.Encoding("probe", pat_str=PATTERN, mergeable_ranks={x: k for k, x in enumerate(pairs)}, special_tokens={})


def _asked(point: str) -> int:
    shares = [len(_probe().encode_ordinary(a + point)) < 1 + len(point.encode()) for a in "a1!"]
    return 1 if shares[0] else 2 if shares[1] else 0 if shares[2] else 4


def scan(symbols: np.ndarray) -> np.ndarray:
    """The state before every symbol, from FRESH before the first."""
    product, act = _monoid()
    n = len(symbols)
    if n == 0:
        return np.zeros(0, "u1")
    blocks = -(-n // SCAN_BLOCK)
    table = np.full(blocks * SCAN_BLOCK, END, "i2")
    table[:n] = symbols
    table = np.ascontiguousarray(table.reshape(blocks, SCAN_BLOCK).T)
    flat, width = product.ravel(), product.shape[1]
    for j in range(1, SCAN_BLOCK):  # compositions within all blocks at once
        table[j] = flat[table[j - 1].astype("i4") * width + table[j]]
    entry = np.empty(blocks, "u1")  # then through the blocks' own compositions
    state = FRESH
    for k, f in enumerate(table[-1].tolist()):
        entry[k] = state
        state = act[f, state]
    after = act[table, entry[None, :]].T.ravel()
    before = np.empty(n, "u1")
    before[0] = FRESH
    before[1:] = after[: n - 1]
    return before


def slice_starts(codes: np.ndarray) -> np.ndarray:
    """Where tokens start in an array of code points with 0x110000 after each text; such marks count as starts."""
    kind = code_point_classes()[codes]
    ahead = np.append(kind[1:], 5)
    white = (kind == 3) | (kind == 4)
    goes_on = (ahead == 3) | (ahead == 4) | (ahead == 5)
    symbols = np.array([OTHER, LETTER, NUMBER, SPACE_LAST, WHITE_LAST, END], "u1")[kind]
    symbols[white & goes_on] = GAP
    for i in np.flatnonzero(codes == 0x27):
        a, b = (int(codes[j]) if j < len(codes) else 0 for j in (i + 1, i + 2))
        if a < 128 and chr(a) in "stmd":
            symbols[i] = SHORT
        elif a < 128 and b < 128 and chr(a) + chr(b) in ("re", "ve", "ll"):
            symbols[i] = LONG
    return np.flatnonzero(_starts()[symbols, scan(symbols)])


class Merger:
    """Ids of a slice by ranks, remembered as their bytes and as decimal text."""

    def __init__(self, path: str, remember: int = 300_000, longest: int = 48):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.memory = Memory(lambda piece: np.array(self.ids(piece.encode()), "<u4").tobytes(), remember, longest)

    def ids(self, piece: bytes) -> list[int]:
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        return self._long(piece) if len(piece) > 64 else self._short(piece)

    def _short(self, piece: bytes) -> list[int]:
        """Rescans the pairs for the lowest rank after each merge."""
        get, none = self.ranks.get, 1 << 60
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while pairs:
            low = min(pairs)
            if low == none:
                break
            i = pairs.index(low)
            parts[i : i + 2] = [joined := parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(joined + parts[i + 1], none)
            if i:
                pairs[i - 1] = get(parts[i - 1] + joined, none)
        return [self.ranks[x] for x in parts]

    def _long(self, piece: bytes) -> list[int]:
        """The same by a heap over a linked list, for slices of any length."""
        n = len(piece)
        end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := self.ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or (j := after[i]) >= n or end[j] != stop:
                continue
            end[i], after[i], alive[j] = stop, after[j], False
            if after[i] < n:
                before[after[i]] = i
                if (r := self.ranks.get(piece[i : end[after[i]]])) is not None:
                    heapq.heappush(heap, (r, i, end[after[i]]))
            if (k := before[i]) >= 0 and (r := self.ranks.get(piece[k:stop])) is not None:
                heapq.heappush(heap, (r, k, stop))
        return [self.ranks[piece[i : end[i]]] for i in range(n) if alive[i]]

    def encode(self, texts: list[str]) -> Iterator[tuple[list[bytes], np.ndarray]]:
        """Per text, its slices' ids (little-endian unsigned 32-bit) and where the slices start, in code points."""
        self.memory.age()
        joined = "\0".join([*texts, ""])
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4").copy()
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        codes[ends] = 0x110000
        starts = slice_starts(codes)
        bounds = starts.tolist()
        stops = np.searchsorted(starts, ends).tolist()
        lo, first, remembered = 0, 0, self.memory.__getitem__
        for text_end, hi in zip(ends.tolist(), stops, strict=True):
            own = bounds[lo : hi + 1]
            yield [remembered(joined[a:b]) for a, b in zip(own, own[1:], strict=False)], starts[lo:hi] - first
            lo, first = hi + 1, text_end + 1

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


@cache
def shared_merger(path: str) -> Merger:
    """One merger for all tasks of a worker, so that it keeps what it remembers."""
    return Merger(path)


def _batches(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` characters; a longer text stands alone."""
    lo, held = 0, 0
    for k, t in enumerate(texts):
        if held and held + len(t) > most:
            yield lo, k
            lo, held = k, 0
        held += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def encode_decode(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text", chars: int = 1 << 20) -> DataFrame:
    """doc_id, ids (array), offsets of slices (array, code points) and the decoded bytes of every text.

    A null text is an empty one and has no ids; null and repeated ids are passed on; an empty
    table gives no rows; other columns are not read.
    """

    def run(merger: Merger, doc_ids: list, texts: list[str]) -> pa.RecordBatch:
        ids, offsets, decoded = [], [], []
        for pieces, starts in merger.encode(texts):
            own = np.frombuffer(b"".join(pieces), "<u4")
            ids.append(own.astype("i4"))
            offsets.append(starts.astype("i4"))
            decoded.append(merger.decode(own))
        return pa.RecordBatch.from_pydict({"doc_id": pa.array(doc_ids, pa.int64()), "ids": pa.array(ids, pa.list_(pa.int32())), "offsets": pa.array(offsets, pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.binary())})

    return _per_batch(docs, ranks, id_col, text_col, chars, run, "doc_id long, ids array<int>, offsets array<int>, decoded binary")


def encode_digest(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text", chars: int = 1 << 20) -> DataFrame:
    """As encode_decode, but digests in the place of ids and bytes: n_tokens, ids_sha256, decoded_sha256."""

    def run(merger: Merger, doc_ids: list, texts: list[str]) -> pa.RecordBatch:
        counts, ids_sha, decoded_sha = [], [], []
        for pieces, _ in merger.encode(texts):
            ids = np.frombuffer(b"".join(pieces), "<u4")
            counts.append(len(ids))
            ids_sha.append(hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest())
            decoded_sha.append(hashlib.sha256(merger.decode(ids)).hexdigest())
        return pa.RecordBatch.from_pydict({"doc_id": pa.array(doc_ids, pa.int64()), "n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(decoded_sha, pa.string())})

    return _per_batch(docs, ranks, id_col, text_col, chars, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _per_batch(docs: DataFrame, ranks: str, id_col: str, text_col: str, chars: int, run, schema: str) -> DataFrame:
    def all_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = shared_merger(ranks)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for lo, hi in _batches(texts, chars):
                yield run(merger, doc_ids[lo:hi], texts[lo:hi])

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), all_batches, schema)
