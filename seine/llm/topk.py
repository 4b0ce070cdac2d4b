"""Exact top-k by inner product: term-at-a-time accumulation over blocks.

Vectors become blocks, one binary row each, of the narrowest integers that hold their weights.
A block of candidates is a set of postings, a list of places and weights for each component,
or all weights where few are zero; each component of a query that isn't zero adds its weighted
postings to a dense array of scores, and a partition selection keeps the k best. Queries are
dealt to numbered blocks by a hash and blocks of candidates to numbered groups; the two meet by
an equi-join on both numbers, so what moves is whole blocks, no single row is paired with
another, and no task has all candidates of a block of queries. Partial winners merge per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import map_arrow
from .shared import partitions, written

RESULT = "query long, query_id long, vec_id long, score long"
BLOCKS = "q_block int, n int, width int, kind string, ids binary, weights binary"


def quantised(rows: DataFrame, id_col: str, vector_col: str, factor: float) -> DataFrame:
    """vec_id and floor(factor * x) of each component as longs, without rows that take no part."""
    v = F.col("_v")
    whole = v.isNotNull() & F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("_v"))
    return rows.where(F.coalesce(whole, F.lit(False)) & F.col("vec_id").isNotNull()).select("vec_id", F.transform("_v", lambda x: F.floor(F.lit(factor) * x).cast("long")).alias("weights"))


def blocked(vectors: DataFrame, rows: int | None = None) -> DataFrame:
    """Blocks of at most ``rows`` vectors of a task or, without it, of each q_block; padded with zeros to one width."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, weights, last = [], [], None

        def block() -> pa.RecordBatch:
            table = np.zeros((len(ids), max(map(len, weights))), "<i8")
            for row, w in zip(table, weights, strict=True):
                row[: len(w)] = w
            kind = next(k for k in ("<i2", "<i4", "<i8") if table.size == 0 or np.iinfo(k).min <= table.min() and table.max() <= np.iinfo(k).max)
            return pa.RecordBatch.from_pydict({"q_block": pa.array([last], pa.int32()), "n": pa.array([len(ids)], pa.int32()), "width": pa.array([table.shape[1]], pa.int32()), "kind": [kind], "ids": pa.array([np.array(ids, "<i8").tobytes()], pa.binary()), "weights": pa.array([table.astype(kind).tobytes()], pa.binary())})

        for batch in batches:
            for number, vec_id, w in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if ids and (number != last or len(ids) == rows):
                    yield block()
                    ids, weights = [], []
                ids.append(vec_id)
                weights.append(w)
                last = number
        if ids:
            yield block()

    return map_arrow(vectors.select("q_block", "vec_id", "weights"), pack, BLOCKS)


def postings_of(table: np.ndarray) -> list[tuple[np.ndarray | None, np.ndarray]]:
    """For each component the places and weights that aren't zero, or None and all weights where most aren't."""
    out = []
    for column in np.ascontiguousarray(table.T):
        at = np.flatnonzero(column)
        out.append((at, column[at]) if 2 * len(at) < len(column) else (None, column))
    return out


def best_of(queries: np.ndarray, query_ids: np.ndarray, table: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best candidates of each query within one block, ties to the smaller id: the query's place in its block, id, score."""
    order = np.argsort(ids, kind="stable")
    ids, postings = ids[order], postings_of(table[order])
    out = []
    for place, (q, own) in enumerate(zip(queries, query_ids, strict=True)):
        scores = np.zeros(len(ids), "i8")
        for term in np.flatnonzero(q[: len(postings)]):
            at, weights = postings[term]
            part = np.multiply(weights, q[term], dtype="i8")
            if at is None:
                scores += part
            else:
                scores[at] += part
        open_ = np.flatnonzero(ids != own)
        if len(open_) > k:
            held = scores[open_]
            least = np.partition(held, len(held) - k)[len(held) - k]
            above, level = open_[held > least], open_[held == least]
            open_ = np.concatenate([above, level[: k - len(above)]])
        out.append((np.full(len(open_), place), ids[open_], scores[open_]))
    return tuple(np.concatenate(x) if out else np.zeros(0, "i8") for x in (zip(*out, strict=True) if out else ((), (), ())))


def exact_top_k(rows: DataFrame, k: int = 5, factor: float = 256.0, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", query_rows: int = 4096, candidate_rows: int = 16384) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for every row whose id is divisible by ``every``.

    Scores are exact integers while sums stay within 64 bits. Vectors that are null or hold a
    null or non-finite component, and rows with a null id, take no part; a shorter vector
    counts as zero where it ends. Repeated candidate rows each count; a repeated query id is
    answered once a distinct vector, and rows of its own id are no candidates for it. Other columns are not read.
    """
    spark = rows.sparkSession
    vectors = written(quantised(rows, id_col, vector_col, factor), "vectors")
    asked = vectors.where(F.col("vec_id") % every == 0).distinct()
    blocks = -(-asked.count() // query_rows)
    if not blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    numbered = asked.withColumn("q_block", F.pmod(F.xxhash64("vec_id", "weights"), F.lit(blocks)).cast("int"))
    asked = blocked(numbered.repartition("q_block").sortWithinPartitions("q_block"))
    asked = asked.select("q_block", *(F.col(c).alias(f"q_{c}") for c in ("n", "width", "kind", "ids", "weights")))
    # A block of queries goes to each group of candidates, so that no task has all candidates of one.
    groups = -(-vectors.count() // candidate_rows)
    held = blocked(vectors.withColumn("q_block", F.lit(None).cast("int")), candidate_rows).withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = [x.repartition(partitions(spark), "q_block", "part") for x in (held.withColumn("q_block", each(blocks)), asked.withColumn("part", each(groups)))]
    pairs = dealt[0].join(dealt[1].hint("merge"), ["q_block", "part"]).select("q_block", "q_n", "q_width", "q_kind", "q_ids", "q_weights", "n", "width", "kind", "ids", "weights")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, qn, qw, qk, qi, qv, n, w, kind, ids, table = (c[i].as_py() for c in batch.columns)
                own = np.frombuffer(qi, "<i8")
                place, found, value = best_of(np.frombuffer(qv, qk).reshape(qn, qw), own, np.frombuffer(table, kind).reshape(n, w), np.frombuffer(ids, "<i8"), k)
                yield pa.RecordBatch.from_pydict({"query": pa.array((block << 32) + place.astype("i8")), "query_id": pa.array(own[place.astype("i8")], pa.int64()), "vec_id": pa.array(found, pa.int64()), "score": pa.array(value, pa.int64())})

    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return map_arrow(pairs, score, RESULT).select("query_id", rank.cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
