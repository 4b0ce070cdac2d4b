"""N-gram Jaccard join by chosen paths.

A text is its set of word n-grams; equal sets are joined first and go on as one. Each set is
embedded as a fixed number of min-hash tokens. A run puts all sets at a root; at each node one
or two tokens are sampled (1 / similarity on average) and a set goes on to the child of its
own value of each. Pairs that are similar stay together with a probability that falls only
slowly with depth, others part quickly. Nodes with few sets are compared by brute force;
others split again, and a node that is still large at the last depth is compared in blocks
dealt over many tasks. Runs are repeated as often as the target recall asks for at the
threshold itself and at the last depth; more similar or earlier settled pairs do better.

Pairs never become rows. A pair is counted in the least node that both sets share, so each is
counted once however often it meets; a task returns one row for each of its sets: its links
there, and the least set that it hangs together with. Exact n-gram sets decide.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import map_arrow
from .components import components
from .shared import drop, task, text_digest, written

TOKENS = 64
#: Sets that a node may have to be compared at once, and the size of a block of one that stays larger to the last depth.
SMALL = 256
BLOCK = 512
#: Columns of the 0/1 matrices that are multiplied at once.
COLUMNS = 2048
DEPTH = 4
SETS = "uid long, doc_id long, fp binary, n int, sig binary, nodes array<long>, td binary"
#: Sets go on if their min-hash tokens agree this many standard deviations below the threshold or better.
DEVIATIONS = 4.5
BASE = 0x9E3779B97F4A7C15 | 1
GOLD, MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * GOLD
    x = (x ^ (x >> np.uint64(27))) * MIX
    return x ^ (x >> np.uint64(31))


@cache
def _word_signs() -> np.ndarray:
    """Which code points are letters, digits or the underscore."""
    out = np.zeros(0x110000, bool)
    out[[x for x in range(0x110000) if chr(x).isalnum()]] = True
    out[ord("_")] = True
    return out


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2^64."""
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([np.ones(1, "u8"), np.full(n, BASE, "u8")]))
        down = np.cumprod(np.concatenate([np.ones(1, "u8"), np.full(n, pow(BASE, -1, 1 << 64), "u8")]))
    return up, down


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words, lower-cased runs of letters, digits and underscores."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    if not len(codes):
        return np.zeros(0, "u8")
    word = _word_signs()[codes]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype("i1")))
    starts, ends = edge[::2], edge[1::2]
    up, down = _powers(1 << max(12, int(len(codes)).bit_length()))
    sums = np.concatenate([np.zeros(1, "u8"), np.cumsum((codes.astype("u8") + np.uint64(1)) * up[: len(codes)], dtype="u8")])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def gram_hashes(text: str, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; a text of fewer words is one gram, one without words none."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(n, len(words))
    out = np.full(len(words) - width + 1, width, "u8")
    for k in range(width):
        out = mixed(out * np.uint64(BASE) + words[k : len(words) - width + 1 + k])
    return np.unique(out)


@cache
def _multipliers() -> np.ndarray:
    return np.random.default_rng(20240229).integers(1, 1 << 63, TOKENS, dtype="u8") * np.uint64(2) + np.uint64(1)


def min_hashes(grams: np.ndarray) -> np.ndarray:
    """TOKENS min-hash values of 64 bits."""
    least = np.full(TOKENS, (1 << 64) - 1, "u8")
    for lo in range(0, len(grams), 4096):
        own = grams[lo : lo + 4096, None] * _multipliers()
        own ^= own >> np.uint64(32)
        own *= GOLD
        least = np.minimum(least, own.min(0))
    return mixed(least)


def chance(similarity: float, depth: int, agreeing: float | None = None) -> float:
    """That two sets of this similarity, the threshold too, still share a node at a depth in one run.

    ``agreeing`` is the share of their min-hash tokens that agree, where it isn't the similarity.
    """
    second, p = 1 / similarity - 1, similarity if agreeing is None else agreeing
    q = 1.0
    for _ in range(depth):
        q = (1 - second) * p * q + second * (1 - (1 - p * q) ** 2)
    return q


def missed(runs: int, similarity: float, depth: int) -> float:
    """That two sets of this similarity, the threshold too, share no node at a depth in any run.

    All runs sample the same tokens, so the chance is that of each number of agreeing tokens, averaged.
    """
    share = lambda k: math.comb(TOKENS, k) * similarity**k * (1 - similarity) ** (TOKENS - k)
    return sum(share(k) * (1 - chance(similarity, depth, k / TOKENS)) ** runs for k in range(TOKENS + 1))


def runs_for(recall: float, similarity: float, depth: int) -> int:
    """The least number of runs that miss at most 1 - recall of the pairs at the threshold."""
    runs = 1
    while missed(runs, similarity, depth) > 1 - recall:
        runs += 1
    return runs


def children(nodes: np.ndarray, signatures: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Child nodes, and which row each is of: one sampled token a node, a second for some nodes."""
    draw = lambda salt: mixed(nodes + np.uint64(salt) * np.uint64(BASE))
    first = (draw(1) % np.uint64(TOKENS)).astype("i8")
    second = (first + 1 + (draw(2) % np.uint64(TOKENS - 1)).astype("i8")) % TOKENS
    rows = np.arange(len(nodes))
    also = np.flatnonzero(draw(3) < np.uint64(int((1 / similarity - 1) * (1 << 64))))
    at, token = np.concatenate([rows, rows[also]]), np.concatenate([first, second[also]])
    return mixed(mixed(nodes[at] * np.uint64(TOKENS) + token.astype("u8")) + signatures[at, token].astype("u8") * GOLD), at


def short_grams(grams: np.ndarray) -> np.ndarray:
    """32 bits of each hash, which is what sets hold."""
    return np.unique((grams >> np.uint64(32)).astype("<u4"))


def gram_sets(docs: DataFrame, n: int, similarity: float, runs: int, id_col: str, text_col: str) -> DataFrame:
    """A row for each document: a number of its own, its set's fingerprint, size, min-hash tokens and first nodes, and its text's digest.

    First nodes, at which all sets part, are made of whole tokens; 16 bits of each are kept for
    the rest: tokens that differ agree in them once in 65,536 times, and every level adds 16 more.
    """
    roots = np.arange(1, runs + 1, dtype="u8") * np.uint64(BASE)

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = task() << 36
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for doc_id, td, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                with np.errstate(over="ignore"):
                    grams = gram_hashes(text.as_py() or "", n)
                    tokens = min_hashes(grams)
                    nodes, _ = children(roots, np.broadcast_to(tokens, (runs, TOKENS)), similarity)
                    row = (uid, doc_id, hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None, len(short_grams(grams)), (tokens >> np.uint64(48)).astype("<u2").tobytes(), nodes.view("i8"), td)
                uid += 1
                for column, x in zip(out, row, strict=True):
                    column.append(x)
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(out, kinds, strict=True)], names=["uid", "doc_id", "fp", "n", "sig", "nodes", "td"])

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_digest(F.col(text_col)).alias("td"), F.col(text_col).alias("text")), embed, SETS)


def grams_of(texts: DataFrame, n: int) -> DataFrame:
    """(rid, text) to (rid, grams)."""

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with np.errstate(over="ignore"):
                grams = [short_grams(gram_hashes(text.as_py() or "", n)).tobytes() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(grams, pa.binary())], names=["rid", "grams"])

    return map_arrow(texts.select("rid", "text"), embed, "rid long, grams binary")


def split_nodes(rows: DataFrame, similarity: float) -> DataFrame:
    """(node, rid, sig) to the children (node, rid)."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                nodes = batch.column(0).to_numpy(zero_copy_only=False).astype("i8").view("u8")
                signatures = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<u2").reshape(-1, TOKENS)
                with np.errstate(over="ignore"):
                    keys, at = children(nodes, signatures, similarity)
                yield pa.RecordBatch.from_pydict({"node": pa.array(keys.view("i8")), "rid": batch.column(1).take(pa.array(at))})

    return map_arrow(rows.select("node", "rid", "sig"), step, "node long, rid long")


def _groups(batches: Iterator[pa.RecordBatch], names: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with equal first columns, whole, from sorted batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch.column(k).to_pylist() for k in range(names)), strict=True))
        cuts = [k for k in range(1, len(keys)) if keys[k] != keys[k - 1]]
        if held and keys[0] != last:
            yield _joined(held)
            held = []
        at = 0
        for cut in cuts:
            held.append(batch.slice(at, cut - at))
            yield _joined(held)
            held, at = [], cut
        held.append(batch.slice(at))
        last = keys[-1]
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _counted_here(group: pa.RecordBatch, similarity: float) -> np.ndarray:
    """Which pairs of a unit's sets are of it: across its two blocks, of like sizes, and with its node the least they share."""
    node, a, b = (group.column(k)[0].as_py() for k in range(3))
    own, n = np.array(group.column(3).to_pylist()), np.array(group.column(5).to_pylist(), "f8")
    paths = [np.array([p for p in own_paths if p < node], "i8") for own_paths in group.column(6).to_pylist()]
    ok = np.minimum.outer(n, n) >= (similarity - 1e-9) * np.maximum.outer(n, n)
    if a != b:
        ok &= own[:, None] != own[None, :]
    ok &= ~np.eye(len(n), dtype=bool)
    if any(map(len, paths)):
        ok &= common_counts(paths) == 0
    return ok


def likely_members(units: DataFrame, similarity: float) -> DataFrame:
    """The sets of each unit that have a likely partner in it, by min-hash tokens."""
    least = math.floor(TOKENS * similarity - DEVIATIONS * math.sqrt(TOKENS * similarity * (1 - similarity)))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 3):
            if group.num_rows > 1:
                ok = _counted_here(group, similarity)
                i, j = np.nonzero(np.triu(ok))
                signatures = np.frombuffer(b"".join(group.column(7).to_pylist()), "<u2").reshape(-1, TOKENS)
                found = np.zeros(group.num_rows, bool)
                for lo in range(0, len(i), 1 << 15):
                    x, y = i[lo : lo + (1 << 15)], j[lo : lo + (1 << 15)]
                    alike = (signatures[x] == signatures[y]).sum(1) >= least
                    found[x[alike]] = found[y[alike]] = True
                if found.any():
                    yield group.select(list(range(7))).filter(pa.array(found))

    return map_arrow(units.select("node", "a", "b", "own", "rid", "n", "paths", "sig"), look, "node long, a int, b int, own int, rid long, n int, paths array<long>")


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Common elements of every two sets, by products of 0/1 matrices over slices of the elements."""
    who = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, what, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    use = shared[what]
    who, what = who[use], number[what[use]]
    out = np.zeros((len(sets), len(sets)), "f4")
    for lo in range(0, int(shared.sum()), COLUMNS):
        mine = (what >= lo) & (what < lo + COLUMNS)
        part = np.zeros((len(sets), min(COLUMNS, int(shared.sum()) - lo)), "f4")
        part[who[mine], what[mine] - lo] = 1
        out += part @ part.T
    return out


def verified_links(units: DataFrame, similarity: float) -> DataFrame:
    """A row for each unit's set with a link: how many documents and texts it is linked with there, and the least set of its component."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 3):
            if group.num_rows > 1:
                sets = [np.frombuffer(x, "<u4") for x in group.column(7).to_pylist()]
                size = np.array([len(s) for s in sets], "f8")
                common = common_counts(sets).astype("f8")
                links = _counted_here(group, similarity) & (common >= (similarity - 1e-9) * (size[:, None] + size[None, :] - common))
                if links.any():
                    rids, copies = np.array(group.column(4).to_pylist(), "i8"), np.array(group.column(8).to_pylist(), "i8")
                    root = rids.copy()
                    while True:  # the least number of each component of the unit
                        low = np.where(links, root[None, :], root[:, None]).min(1)
                        if (low == root).all():
                            break
                        root = low
                    some = links.any(1)
                    yield pa.RecordBatch.from_pydict({"rid": pa.array(rids[some]), "root": pa.array(root[some]), "docs": pa.array((links @ copies)[some]), "texts": pa.array(links.sum(1)[some].astype("i8"))})

    return map_arrow(units.select("node", "a", "b", "own", "rid", "n", "paths", "grams", "copies"), verify, "rid long, root long, docs long, texts long")


def _dealt(units: DataFrame) -> DataFrame:
    return units.repartition("node", "a", "b").sortWithinPartitions("node", "a", "b", "rid")


def jaccard_classes(docs: DataFrame, n: int = 5, similarity: float = 0.8, recall: float = 0.999, id_col: str = "doc_id", text_col: str = "text", row_keys: bool = False) -> DataFrame:
    """doc_id, class_id, n_links, n_text_links for every document.

    ``class_id`` is the least document id of its component of links; ``n_links`` counts the
    other documents with a similarity of at least ``similarity``, ``n_text_links`` the other
    n-gram sets among them. A text without words (null or empty too) is linked with nothing
    and is a class of its own. Repeated rows are copies of each other; a null id is passed
    on. An empty table gives no rows; other columns are not read.

    With ``row_keys``, ``td`` (the text's digest), ``stays`` and ``has_words`` too: doc_id and td
    tell rows apart, and one such key of each class stays, that of the least id (a null one
    last) and digest. Rows that repeat that key all have ``stays``; a row without words
    (``has_words`` is false) stays, as it is a class of its own.
    """
    sets = written(gram_sets(docs, n, similarity, runs_for(recall, similarity, DEPTH), id_col, text_col), "gram-sets")
    leaders = sets.where("fp is not null").groupBy("fp").agg(F.min("uid").alias("rid"), F.min_by("td", "uid").alias("td"), F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"), *([F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "td")).alias("first_row")] if row_keys else []))
    leaders = written(leaders, "leaders")
    reps = written(sets.select(F.col("uid").alias("rid"), "n", "sig", "nodes").join(leaders.select("rid"), "rid"), "reps")

    rows = reps.select("rid", F.explode("nodes").alias("node"))
    settled, spent = [], []
    for depth in range(1, DEPTH + 1):
        if depth > 1:
            rows = written(split_nodes(rows, similarity), "nodes")
            spent.append(rows)
        sizes = written(rows.groupBy("node").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
        spent.append(sizes)
        sized = rows.join(sizes, "node")
        settled.append(sized if depth == DEPTH else sized.where(F.col("size") <= SMALL))
        if depth < DEPTH:
            large = written(sized.where(F.col("size") > SMALL).select("node", "rid"), "large")
            spent.append(large)
            if large.isEmpty():
                break
            rows = large.join(reps.select("rid", "sig"), "rid")
    ends = settled[0]
    for more in settled[1:]:
        ends = ends.union(more)
    ends = written(ends.select("node", "rid", "size").distinct(), "ends")
    drop(*spent)
    paths = ends.groupBy("rid").agg(F.collect_set("node").alias("paths"))  # at most runs * 2^DEPTH nodes
    about = reps.join(paths, "rid").select("rid", "n", "sig", "paths")
    blocks = F.when(F.col("size") <= SMALL, 1).otherwise(F.ceil(F.col("size") / F.lit(BLOCK)).cast("int"))
    units = ends.select("node", "rid", F.pmod(F.xxhash64("rid"), blocks).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    units = units.select("node", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "rid")
    likely = written(likely_members(_dealt(units.join(about, "rid")), similarity), "likely")
    drop(ends, reps)
    # Grams are made again, for the sets with a likely partner alone; storing all of them would cost more than the texts.
    needed = likely.select("rid").distinct().join(leaders.select("rid", "td"), "rid")
    texts = docs.select(text_digest(F.col(text_col)).alias("td"), F.col(text_col).alias("text")).groupBy("td").agg(F.first("text").alias("text"))
    full = likely.join(grams_of(texts.join(needed.hint("merge"), "td"), n), "rid").join(leaders.select("rid", "copies"), "rid")
    links = written(verified_links(_dealt(full), similarity), "links")
    drop(likely)

    hung = components(links.select(F.col("rid").alias("u"), F.col("root").alias("v")))
    counts = links.groupBy("rid").agg(F.sum("docs").alias("docs"), F.sum("texts").alias("texts"))
    classes = leaders.join(hung.withColumnRenamed("node", "rid"), "rid", "left").join(counts, "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    least = classes.groupBy("root").agg(F.min("first_doc").alias("class_id"), *([F.min("first_row").alias("first")] if row_keys else []))
    by_set = classes.join(least, "root").select("fp", "class_id", *(["first"] if row_keys else []), (F.coalesce("docs", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("texts", F.lit(0)).alias("n_text_links"))
    out = sets.select("doc_id", "fp", *(["td"] if row_keys else [])).join(by_set, "fp", "left")
    stays = F.col("fp").isNull() | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("td") == F.col("first.td")))
    chosen = ["td", stays.alias("stays"), F.col("fp").isNotNull().alias("has_words")] if row_keys else []
    return out.select("doc_id", F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("n_text_links", F.lit(0)).cast("long").alias("n_text_links"), *chosen)
