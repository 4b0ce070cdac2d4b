"""Exact removal of repeated strings of so many bytes or words, by suffix arrays over shards.

A text is a row of units: its UTF-8 bytes, or 31-bit hashes of its words, so that a passage
repeats whatever its words' lengths and the white space between them. A suffix array over
everything would sort units that repeat nowhere. Every window of ``length`` units has an
anchor, its k-gram of least hash, so equal windows have equal anchors at equal places. Anchors that occur once are done with. An anchor's context, the units of all
windows that have it, settles at once if another document holds the same context. What is left
are contexts that share an anchor with others without being equal: they go to a shard by their
anchor, and a shard puts aside contexts that share clearly less than a window, sorts the others' suffixes by Larsson-Sadakane refinement in numpy, takes common
prefixes by Kasai's rule (only where the preceding units differ is a prefix compared; elsewhere
it is one less than at the place before), and marks windows whose neighbour shares ``length``
units. An anchor with very many different contexts is dealt over several shards; each then
hands on its distinct windows as sorted digests, cut by binary search at the same bounds, and
one task a bound merges them.

All passes key on a digest of the text, so copies of a text cost one row, and windows are
judged on the input alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import map_arrow
from .shared import drop, text_digest, written

#: Units of an anchor: of bytes and of words.
GRAM = {"u1": 64, "<u4": 12}
#: Units by which strings are shorter than a window when contexts are looked through for likely ones.
STEP = {"u1": 16, "<u4": 2}
#: Units that one round of array operations takes; longer texts go in overlapping parts.
CHUNK = 1 << 17
SHARD = 1 << 19
#: Bytes whose words are hashed at once.
SLAB = 1 << 18
#: Different contexts of one anchor that a shard takes; more are dealt over several.
SHARD_CONTEXTS = 1024
BASE = 0x9E3779B97F4A7C15 | 1
BASE2 = 0xD6E8FEB86659FD93 | 1
POSITION = np.uint64((1 << 24) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.cumprod(np.concatenate([np.ones(1, "u8"), np.full(n, base, "u8")]))
    down = np.cumprod(np.concatenate([np.ones(1, "u8"), np.full(n, pow(base, -1, 1 << 64), "u8")]))
    return up, down


class Hashes:
    """Hashes of any slices of some units, by prefix sums of a polynomial modulo 2^64."""

    def __init__(self, data: np.ndarray, base: int = BASE):
        self.up, self.down = _powers(1 << max(16, int(len(data)).bit_length()), base)
        self.sums = np.concatenate([np.zeros(1, "u8"), np.cumsum((data.astype("u8") + np.uint64(1)) * self.up[: len(data)], dtype="u8")])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[ends] - self.sums[starts]) * self.down[starts])


def word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of UTF-8 bytes: runs without ASCII white space."""
    word = (data != 32) & ((data < 9) | (data > 13))
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    edge = np.concatenate([[0] if len(data) and word[0] else [], edge, [len(data)] if len(data) and word[-1] else []]).astype("i8")
    return edge[::2], edge[1::2]


def word_codes(data: np.ndarray) -> np.ndarray:
    """A 31-bit hash of each word; a text of any length is hashed slab by slab."""
    starts, ends = word_places(data)
    out, at = np.zeros(len(starts), "<u4"), 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + SLAB, "right")))
        lo = starts[at]
        with np.errstate(over="ignore"):
            out[at:to] = Hashes(data[lo : ends[to - 1]]).of(starts[at:to] - lo, ends[at:to] - lo) >> np.uint64(33)
        at = to
    return out


def units_of(text: str | None, kind: str) -> np.ndarray:
    """A text's bytes (kind u1) or its words' hashes (<u4)."""
    data = np.frombuffer((text or "").encode(), "u1")
    return data if kind == "u1" else word_codes(data)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo("u8").max, "u8")
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(parts: list[np.ndarray], length: int) -> tuple[np.ndarray, ...]:
    """For each anchor of the parts: its part, first window in it, number of windows, k-gram hash, context hash, times.

    Where a text repeats itself over and over, anchors with one context follow on each other;
    they are one entry, with their number.
    """
    data = np.concatenate(parts)
    width = min(GRAM[data.dtype.str.lstrip("|")], length)
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    with np.errstate(over="ignore"):
        hashes = Hashes(data)
        at = np.arange(len(data) - width + 1)
        grams = hashes.of(at, at + width)
        least = sliding_least((grams & ~POSITION) | at.astype("u8"), length - width + 1) & POSITION
        part = np.repeat(np.arange(len(parts)), np.diff(bounds))[: len(least)]
        inside = np.flatnonzero(np.arange(len(least)) + length <= bounds[part + 1])
        anchor = least[inside].astype("i8")
        first = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(part[inside]) != 0)]))
        start, count = inside[first], np.diff(np.concatenate([first, [len(inside)]]))
        gram, context = grams[anchor[first]], hashes.of(start, start + count - 1 + length)
    same = (gram[1:] == gram[:-1]) & (context[1:] == context[:-1]) & (start[1:] == start[:-1] + count[:-1]) & (part[start[1:]] == part[start[:-1]])
    head = np.flatnonzero(np.concatenate([[True], ~same]))
    times = np.diff(np.concatenate([head, [len(start)]]))
    start, count = start[head], np.add.reduceat(count, head) if len(head) else count
    return part[start], start - bounds[part[start]], count, gram[head], context[head], times


def find_anchors(texts: DataFrame, length: int, kind: str) -> DataFrame:
    """A row for each anchor of each row's ``text``: anchor, context, td, first, windows, times."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(parts: list[np.ndarray], of: list[tuple[bytes, int]]) -> pa.RecordBatch:
            part, first, windows, gram, context, times = anchors(parts, length)
            offset = np.array([x for _, x in of])
            return pa.RecordBatch.from_pydict({"anchor": pa.array(gram.view("i8")), "context": pa.array(context.view("i8")), "td": pa.array([x for x, _ in of], pa.binary()).take(pa.array(part)), "first": pa.array(first + offset[part]), "windows": pa.array(windows.astype("i4")), "times": pa.array(times.astype("i8"))})

        parts, of, held = [], [], 0
        for batch in batches:
            for td, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = units_of(text.as_py(), kind)
                for lo in range(0, max(1, len(data) - length + 1), CHUNK):
                    own = data[lo : lo + CHUNK + length - 1]
                    if len(own) < length:
                        continue
                    if held and held + len(own) > CHUNK:
                        yield found(parts, of)
                        parts, of, held = [], [], 0
                    parts.append(own)
                    of.append((td, lo))
                    held += len(own)
        if parts:
            yield found(parts, of)

    return map_arrow(texts.select("td", "text"), scan, "anchor long, context long, td binary, first long, windows int, times long")


def suffix_array(data: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Suffixes of each piece (``stop``: its end, for every place) in order; a piece's end sorts first, ends by place.

    Larsson-Sadakane: sorted by seven bytes or two words, then only groups
    that still tie are refined by the rank of what follows the part already compared, which
    doubles each time.
    """
    n, bits = len(data), 8 * data.itemsize
    left = stop - np.arange(n)
    padded = np.concatenate([data, np.zeros(8, data.dtype)]).astype("u8")
    # Seven units of 8 bits and 8 bits for the end, or two of 31 and 2.
    key, h, width, spare = (np.zeros(n, "u8"), 7, 8, 8) if bits == 8 else (np.zeros(n, "u8"), 2, 31, 2)
    for k in range(h):
        key = key << np.uint64(width) | np.where(left > k, padded[k : k + n], 0).astype("u8")
    key = key << np.uint64(spare) | np.minimum(left, h + 1).astype("u8")
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, "i8")
    active = np.arange(n)
    key = key[order]
    settled = left[order] <= h
    while True:
        edge = np.concatenate([[True], (key[1:] != key[:-1]) | settled[1:]])
        start = active[np.maximum.accumulate(np.where(edge, np.arange(len(active)), 0))]
        rank[order[active]] = start
        alone = edge & np.concatenate([edge[1:], [True]])
        active = active[~alone]
        if not len(active):
            return order
        at = order[active]
        key = rank[at].astype("u8") << np.uint64(32) | rank[at + h].astype("u8")
        by = np.argsort(key)
        order[active] = at[by]
        key, settled, h = key[by], np.zeros(len(active), bool), 2 * h


def common_prefixes(data: np.ndarray, stop: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For every place, the units its suffix shares with the one before it in order (by place, not by rank)."""
    n, bits = len(data), 8 * data.itemsize
    per = 64 // bits
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    starts = np.zeros(n + 1, bool)
    starts[0] = True
    starts[stop] = True
    place = np.arange(n)
    has = before >= 0
    fresh = ~has | starts[:n]
    some = np.flatnonzero(~fresh)
    fresh[some] = starts[before[some]] | (data[some - 1] != data[before[some] - 1])
    padded = np.concatenate([data, np.zeros(8, data.dtype)]).astype("u8")
    words = np.zeros(n + 1, "u8")
    for k in range(per):
        words[:n] |= padded[k : k + n] << np.uint64(bits * k)
    out = np.zeros(n, "i8")
    i = place[fresh & has]
    j = before[i]
    most, same = np.minimum(stop[i] - i, stop[j] - j), np.zeros(len(i), "i8")
    while len(i):
        differ = words[i + same] ^ words[j + same]
        more = np.where(differ == 0, per, np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)).astype("i8") // bits)
        same = np.minimum(same + more, most)
        done = (more < per) | (same >= most)
        out[i[done]] = same[done]
        i, j, most, same = i[~done], j[~done], most[~done], same[~done]
    source = np.maximum.accumulate(np.where(fresh, place, 0))
    return np.maximum(out[source] - (place - source), 0)


def repeated_windows(pieces: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which places of the joined pieces start a window that starts elsewhere too; suffixes in order; prefixes by rank."""
    data = np.concatenate(pieces)
    sizes = [len(p) for p in pieces]
    stop = np.repeat(np.cumsum(sizes), sizes)
    order = suffix_array(data, stop)
    by_rank = common_prefixes(data, stop, order)[order]
    with_next = np.concatenate([by_rank[1:], [0]])
    again = np.zeros(len(data), bool)
    again[order] = np.maximum(by_rank, with_next) >= length
    return again, order, by_rank


def alike(pieces: list[np.ndarray], anchor: list[int], length: int) -> np.ndarray:
    """Which contexts share all but a few units of a window with another context of their anchor; the rest need no array.

    Equal windows have their anchor at the same place, so it is enough to compare strings that
    start at given distances before the anchor, some units shorter than a window and as many apart.
    """
    data = np.concatenate(pieces)
    kind = data.dtype.str.lstrip("|")
    width, step = min(GRAM[kind], length), min(STEP[kind], max(1, length // 8))
    sizes = np.array([len(p) for p in pieces])
    start, count = np.cumsum(sizes) - sizes, sizes - (length - 1)
    hashes, at = Hashes(data), np.arange(len(data) - width + 1)
    keys = np.concatenate([(hashes.of(at, at + width) & ~POSITION) | at.astype("u8"), np.full(1, np.iinfo("u8").max, "u8")])
    folded = count > length - width + 1  # several occurrences of an anchor: its contexts are all compared
    last = np.minimum(count, length - width + 1) - 1
    place = (np.minimum.reduceat(keys, np.stack([start + last, start + length - width + 1], 1).ravel())[::2] & POSITION).astype("i8") - start
    before = np.arange(0, length - width + 1, step)
    from_ = place[:, None] - before
    ok = (from_ >= 0) & (np.maximum(from_ - step + 1, 0) <= np.minimum(from_, count[:, None] - 1))
    row, which = np.nonzero(ok)
    first = (start[:, None] + from_)[ok]
    group = np.array(anchor, "i8").view("u8")
    value = _mixed(_mixed(hashes.of(first, first + length - step) + group[row] * np.uint64(BASE2)) + which.astype("u8"))
    _, number, times = np.unique(value, return_inverse=True, return_counts=True)
    out = np.isin(group, group[folded])
    out[row[times[number] > 1]] = True
    return out


def _runs(flags: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype("i1")))
    return [{"lo": int(a), "hi": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]


RUNS = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
SHARDED = "anchor long, context long, runs array<struct<lo:int,hi:int>>, bound int, digests binary, others binary, contexts binary, places binary"


def search_shards(contexts: DataFrame, length: int, kind: str) -> DataFrame:
    """Runs of repeated windows of each context, and for dealt anchors the distinct windows' digests by bound."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shard(rows: list[tuple]) -> pa.RecordBatch:
            bodies = [np.frombuffer(x[3], kind) for x in rows]
            with np.errstate(over="ignore"):
                use = alike(bodies, [x[0] for x in rows], length) | np.array([x[5] > 1 for x in rows])
            rows, bodies = [x for x, u in zip(rows, use, strict=True) if u], [x for x, u in zip(bodies, use, strict=True) if u]
            return searched(rows, bodies) if rows else None

        def searched(rows: list[tuple], bodies: list[np.ndarray]) -> pa.RecordBatch:
            again, order, shared = repeated_windows(bodies, length)
            out: list[tuple] = []
            lo = 0
            for (anchor, context, _, _, single, _), body in zip(rows, bodies, strict=True):
                if single and (runs := _runs(again[lo : lo + len(body) - length + 1])):
                    out.append((anchor, context, runs, None, None, None, None, None))
                lo += len(body)
            dealt = np.array([x[5] for x in rows])
            if (dealt > 1).any():
                with np.errstate(over="ignore"):
                    out += distinct(rows, bodies, order, shared, dealt)
            kinds = (pa.int64(), pa.int64(), RUNS, pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
            columns = list(zip(*out, strict=True)) or [()] * 8
            return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], names=["anchor", "context", "runs", "bound", "digests", "others", "contexts", "places"])

        def distinct(rows, bodies, order, shared, dealt) -> Iterator[tuple]:
            """One window of each class of equal ones, per dealt anchor, sorted by digest and cut at the bounds."""
            data = np.concatenate(bodies)
            ends = np.cumsum([len(b) for b in bodies])
            first = order[(shared < length)]
            row = np.searchsorted(ends, first, "right")
            keep = (first + length <= ends[row]) & (dealt[row] > 1)
            first, row = first[keep], row[keep]
            one, two = (Hashes(data, base).of(first, first + length) for base in (BASE, BASE2))
            anchor = np.array([x[0] for x in rows])
            context = np.array([x[1] for x in rows])
            place = first - np.concatenate([[0], ends[:-1]])[row]
            for a in np.unique(anchor[row]).tolist():
                mine = np.flatnonzero(anchor[row] == a)
                mine = mine[np.argsort(one[mine])]
                n = int(dealt[row[mine[0]]])
                cuts = np.searchsorted(one[mine], np.array([k * ((1 << 64) // n) for k in range(1, n)], "u8"))
                for bound, own in enumerate(np.split(mine, cuts)):
                    if len(own):
                        yield a, None, None, bound, one[own].tobytes(), two[own].tobytes(), context[row[own]].astype("i8").tobytes(), place[own].astype("i4").tobytes()

        rows, held, last = [], 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                size = len(row[3]) // np.dtype(kind).itemsize
                if rows and (held + size > SHARD and row[:1] + row[2:3] != last):
                    if found := shard(rows):
                        yield found
                    rows, held = [], 0
                rows.append(row)
                held, last = held + size, row[:1] + row[2:3]
        if rows and (found := shard(rows)):
            yield found

    dealt = contexts.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt", "context")
    return map_arrow(dealt.select("anchor", "context", "salt", "body", "single", "salts"), search, SHARDED)


def merge_shards(shards: DataFrame) -> DataFrame:
    """Windows of dealt anchors that several shards hold: anchor, context, runs."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged(anchor: int, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
            one, two = (np.concatenate([np.frombuffer(p[k], "u8") for p in parts]) for k in (0, 1))
            context, place = np.concatenate([np.frombuffer(p[2], "i8") for p in parts]), np.concatenate([np.frombuffer(p[3], "i4") for p in parts])
            by = np.lexsort((two, one))
            one, two = one[by], two[by]
            same = (one[1:] == one[:-1]) & (two[1:] == two[:-1])
            again = by[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
            for c in np.unique(context[again]).tolist():
                flags = np.zeros(int(place[again][context[again] == c].max()) + 1, bool)
                flags[place[again][context[again] == c]] = True
                yield pa.RecordBatch.from_pydict({"anchor": pa.array([anchor], pa.int64()), "context": pa.array([c], pa.int64()), "runs": pa.array([_runs(flags)], RUNS)})

        parts, last = [], None
        for batch in batches:
            for anchor, bound, *own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if parts and (anchor, bound) != last:
                    yield from merged(last[0], parts)
                    parts = []
                parts.append(own)
                last = anchor, bound
        if parts:
            yield from merged(last[0], parts)

    rows = shards.where("bound is not null").select("anchor", "bound", "digests", "others", "contexts", "places").repartition("anchor", "bound").sortWithinPartitions("anchor", "bound")
    return map_arrow(rows, merge, "anchor long, context long, runs array<struct<lo:int,hi:int>>")


def coded(texts: DataFrame) -> DataFrame:
    """(td, text) to (td, units), the hashes of its words."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array((units_of(x.as_py(), "<u4").tobytes() for x in batch.column(1)), pa.binary())], names=["td", "units"])

    return map_arrow(texts.select("td", "text"), code, "td binary, units binary")


def repeated_spans(docs: DataFrame, text_col: str, length: int, kind: str) -> DataFrame:
    """td, start, end (in units; they may overlap) of every text's stretches of repeated windows, as a written table."""
    texts = docs.select(text_digest(F.col(text_col)).alias("td"), F.col(text_col).alias("text")).where(F.octet_length("text") >= (length if kind == "u1" else 2 * length - 1))
    found = written(find_anchors(texts, length, kind), "anchors")
    again = found.groupBy("anchor").agg(F.sum("times").alias("n")).where("n > 1").select("anchor")
    # Copies of a text fold into one row with their number.
    places = written(found.join(again, "anchor", "left_semi").groupBy("anchor", "context", "td", "first", "windows").agg(F.sum("times").alias("n")), "places")
    drop(found)
    kinds = places.groupBy("anchor", "context").agg(F.sum("n").alias("n"), F.min(F.struct("td", "first", "windows")).alias("at"))
    kinds = written(kinds, "contexts")
    groups = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.count_if(F.col("n") == 1).alias("singles")).where("kinds > 1 and singles > 0")
    salts = F.ceil(F.col("kinds") / F.lit(SHARD_CONTEXTS)).cast("int")
    open_ = kinds.join(groups.select("anchor", salts.alias("salts")), "anchor").select("anchor", "context", "at.*", (F.col("n") == 1).alias("single"), "salts", F.pmod(F.xxhash64("context"), F.col("salts")).cast("int").alias("salt"))
    distinct = texts.groupBy("td").agg(F.first("text").alias("text"))
    if kind == "u1":
        units = distinct.select("td", F.col("text").cast("binary").alias("units"))
    else:
        units = coded(distinct.join(open_.select("td").distinct().hint("merge"), "td", "left_semi"))
    width = np.dtype(kind).itemsize
    body = F.substring(F.col("units"), (width * F.col("first") + 1).cast("int"), (width * (F.col("windows") + (length - 1))).cast("int"))
    contexts = open_.join(units.hint("merge"), "td").select("anchor", "context", "salt", body.alias("body"), "single", "salts")
    shards = written(search_shards(contexts, length, kind), "shards")
    runs = shards.where("runs is not null").select("anchor", "context", "runs").union(merge_shards(shards))

    whole = places.join(kinds.where("n > 1").select("anchor", "context"), ["anchor", "context"]).select("td", F.col("first").alias("start"), (F.col("first") + F.col("windows") + (length - 1)).alias("end"))
    partial = kinds.where("n = 1").join(runs, ["anchor", "context"]).select("at.td", "at.first", F.explode("runs").alias("r")).select("td", (F.col("first") + F.col("r.lo")).alias("start"), (F.col("first") + F.col("r.hi") + (length - 1)).alias("end"))
    spans = written(whole.union(partial), "spans")
    drop(places, kinds, shards)
    return spans


def joined_spans(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Sorted stretches with those that overlap or touch made one."""
    out: list[list[int]] = []
    for start, end in spans:
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def without(data: bytes, spans: list[list[int]]) -> bytes:
    edges = [0, *(x for s in spans for x in s), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def remove_repeats(docs: DataFrame, keep: list[str], text_col: str = "text", length: int = 400, words: int = 0, texts: bool = False) -> DataFrame:
    """_kept (the ``keep`` columns, whatever their names), n_bytes and what was asked for.

    ``length``: n_removed, n_spans, kept_sha256, removed (spans in bytes). Each byte within a
    string of so many bytes that also starts anywhere else goes, all occurrences alike.
    ``words``: n_passage_words, n_passages, passages (spans in bytes). Each word within a
    passage of so many words that also starts anywhere else goes, with the white space between
    such words; words are runs without ASCII white space. ``texts``: kept_text, without the
    passages if ``words`` is given, else without the strings, where it leaves out characters of
    which bytes went. Either length may be 0 for none.

    A null text is an empty one; shorter texts stay whole; null or repeated keys are rows as any
    other, and a repeated row repeats its text. An empty table gives no rows; columns outside
    ``keep`` are not read. Both removals judge the input, not what the other left.
    """
    asked = [(size, kind) for size, kind in ((length, "u1"), (words, "<u4")) if size]
    found = [repeated_spans(docs, text_col, size, kind).select("td", F.lit(kind).alias("kind"), "start", "end") for size, kind in asked]
    # A text's own anchors, at most one for each of its windows.
    spans = reduce(DataFrame.union, found).groupBy("td").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("spans"))
    rows = docs.select(F.struct(*keep).alias("_kept"), F.col(text_col).alias("_text"), text_digest(F.col(text_col)).alias("td")).join(spans.hint("merge"), "td", "left")
    kept = rows.schema["_kept"].dataType.simpleString()
    pieces = "array<struct<start:long,end:long>>"
    fields = [("n_bytes", "long")]
    fields += [("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string"), ("removed", pieces)] * bool(length)
    fields += [("n_passage_words", "long"), ("n_passages", "long"), ("passages", pieces)] * bool(words) + [("kept_text", "string")] * texts
    arrow = {"long": pa.int64(), "string": pa.string(), pieces: pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in fields]
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                data = (text.as_py() or "").encode()
                mine: dict[str, list] = {"u1": [], "<u4": []}
                for s in spans.as_py() or ():
                    mine[s["kind"]].append((s["start"], s["end"]))
                row, left = [len(data)], data
                said = lambda x: [{"start": int(a), "end": int(b)} for a, b in x]
                if length:
                    gone = joined_spans(mine["u1"])
                    left = without(data, gone)
                    row += [len(data) - len(left), len(gone), hashlib.sha256(left).hexdigest(), said(gone)]
                if words:
                    gone, left = joined_spans(mine["<u4"]), data
                    n = sum(b - a for a, b in gone)
                    if gone:
                        starts, ends = word_places(np.frombuffer(data, "u1"))
                        gone = [[starts[a], ends[b - 1]] for a, b in gone]
                        left = without(data, gone)
                    row += [n, len(gone), said(gone)]
                for column, x in zip(out, row + [left.decode(errors="ignore")] * texts, strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, arrow[kind]) for x, (_, kind) in zip(out, fields, strict=True))], names=["_kept", *(name for name, _ in fields)])

    return map_arrow(rows.select("_kept", "_text", "spans"), cut, f"_kept {kept}, " + ", ".join(f"{name} {kind}" for name, kind in fields))
