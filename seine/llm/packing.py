"""Best-fit packing planned on a histogram of lengths instead of on documents.

Best fit takes pieces from long to short and puts each into the fullest sequence that still
has room. Pieces of one length are alike, so the plan counts them: at most ``size`` lengths
come to the driver however many documents there are, and the plan is a list of runs, each
saying which ranks within a length go to which sequences. Pieces then take their slots by
their rank within their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import map_arrow
from .shared import task, written
from .word_tokens import shared_encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
#: Runs up to this many are broadcast to the pieces; a longer plan is joined by shuffle.
BROADCAST_RUNS = 100_000


def plan_runs(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, end rank, first sequence, pieces a sequence, offset).

    Rank r of a run is piece ``(r - first) % pieces`` of sequence ``first sequence +
    (r - first) // pieces``. Sequences with one history lie together, so a class of them is
    a range; ``open_`` holds ranges by the room that they have left.
    """
    open_: dict[int, list[tuple[int, int]]] = defaultdict(list)
    rooms: list[int] = []
    runs, used = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if not open_[room]:
                insort(rooms, room)
            open_[room].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            k = bisect_left(rooms, length)
            if k < len(rooms):
                room = rooms[k]
                first, n = open_[room].pop()
                if not open_[room]:
                    rooms.pop(k)
            else:
                room, first, n = size, used, -(-left // (size // length))
                used += n
            each = room // length
            full = min(n, left // each)
            offset = size - room
            if full:
                runs.append((length, rank, rank + full * each, first, each, offset))
                put(room - each * length, first, full)
                rank, left, first, n = rank + full * each, left - full * each, first + full, n - full
            if n and left:  # fewer than one sequence takes
                runs.append((length, rank, rank + left, first, left, offset))
                put(room - left * length, first, 1)
                first, n, left = first + 1, n - 1, 0
            put(room, first, n)
    return runs


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int, id_col: str, text_col: str, remember: int = 400_000) -> DataFrame:
    """Pieces of every text with ``end_id``, each with its rank among its task's pieces of that length."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen = shared_encoder(tokenizer, remember), task(), defaultdict(int)
        last = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.encode(text.as_py()) + last
                for k, at in enumerate(range(0, len(ids), 4 * size)):
                    own = ids[at : at + 4 * size]
                    n = len(own) // 4
                    for column, x in zip(out, (doc_id, k, at // 4, n, zlib.crc32(own), seen[n]), strict=True):
                        column.append(x)
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), *(pa.array(x, pa.int64()) for x in out[2:5]), pa.array([part] * len(out[0]), pa.int32()), pa.array(out[5], pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    return map_arrow(rows, pieces, PIECES)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, size: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every document.

    A null or empty text is its end id alone; a null or repeated id is packed as any other
    row; an empty table gives no rows; other columns are not read. Only documents over
    ``size`` tokens are cut.
    """
    spark = docs.sparkSession
    pieces = written(cut_pieces(docs, tokenizer, end_id, size, id_col, text_col), "pieces")
    by_task = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    base = by_task.select("part", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("base"))
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `size` rows
    runs = plan_runs(counts, size)
    by_length = defaultdict(list)
    for length, *run in runs:
        by_length[length].append(tuple(run))
    slots = spark.createDataFrame([(k, v) for k, v in by_length.items()], "length long, runs array<struct<first:long,end:long,sequence:long,each:long,offset:long>>")
    ranked = pieces.join(base, ["part", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    placed = ranked.join(F.broadcast(slots) if len(runs) <= BROADCAST_RUNS else slots, "length")
    run = F.filter("runs", lambda r: (r["first"] <= F.col("rank")) & (F.col("rank") < r["end"]))[0]
    nth = F.col("rank") - F.col("run.first")
    return placed.withColumn("run", run).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("run.sequence") + F.floor(nth / F.col("run.each"))).cast("long").alias("sequence_id"), (F.col("run.offset") + (nth % F.col("run.each")) * F.col("length")).cast("long").alias("offset")
    )
