"""Token ids as directly addressable codes: any token of any segment without decoding a block.

An id is cut into 8-bit chunks. Level 0 holds every token's lowest chunk; a bitmap beside it
says which tokens go on, and level 1 holds the next chunk of those alone, and so on. A rank
directory (ones before every 512th bit) turns a position on one level into the position on
the next with one lookup and a count over at most 512 bits.

A code file is a Parquet table of segments, each a self-contained binary of this format with
its place in the corpus beside it, so any store that Spark writes can hold it, a lost task is
written again, and one token is read by opening one segment.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import map_arrow
from .shared import partitions, task
from .word_tokens import shared_encoder

MAGIC = b"DAC1"
#: Bits between two entries of a rank directory.
RANK_BITS = 512
SEGMENTS = "part int, seq int, part_start long, n_docs long, n_tokens long, code binary"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long, segment string"


def pack(doc_ids: list[int | None], ends: list[int], ids: np.ndarray) -> bytes:
    """One segment: its documents' ids and token ends, then the levels."""
    known = np.array([x is not None for x in doc_ids], "u1")
    out = [MAGIC, struct.pack("<QQ", len(doc_ids), len(ids)), known.tobytes(), np.array([x or 0 for x in doc_ids], "<i8").tobytes(), np.asarray(ends, "<u8").tobytes()]
    rest = ids.astype("<u4", copy=False)
    while len(rest):
        more = rest > 0xFF
        low = (rest & 0xFF).astype("u1")
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (RANK_BITS // 8), "u1")])
        ones = np.bitwise_count(bits.reshape(-1, RANK_BITS // 8)).sum(1, dtype="<u8")
        ranks = np.concatenate([np.zeros(1, "<u8"), np.cumsum(ones, dtype="<u8")])
        out += [struct.pack("<Q", len(low)), low.tobytes(), bits.tobytes(), ranks.tobytes()]
        rest = rest[more] >> 8
    out.append(struct.pack("<Q", 0))
    return b"".join(out)


class Segment:
    """Reads one segment in place."""

    def __init__(self, code: bytes):
        if code[:4] != MAGIC:
            raise ValueError("not a segment of token codes")
        self.n_docs, self.n_tokens = struct.unpack_from("<QQ", code, 4)
        at = 20
        known = np.frombuffer(code, "u1", self.n_docs, at)
        at += self.n_docs
        self.doc_ids = [int(x) if k else None for x, k in zip(np.frombuffer(code, "<i8", self.n_docs, at), known, strict=True)]
        at += 8 * self.n_docs
        self.ends = np.frombuffer(code, "<u8", self.n_docs, at).astype("i8")
        at += 8 * self.n_docs
        self.levels = []
        while n := struct.unpack_from("<Q", code, at)[0]:
            at += 8
            blocks = -(-n // RANK_BITS)
            low, bits, ranks = np.frombuffer(code, "u1", n, at), np.frombuffer(code, "u1", blocks * RANK_BITS // 8, at + n), np.frombuffer(code, "<u8", blocks + 1, at + n + blocks * RANK_BITS // 8)
            self.levels.append((low, bits, ranks))
            at += n + blocks * RANK_BITS // 8 + 8 * (blocks + 1)

    def rank(self, level: int, i: int) -> int:
        """Ones before bit i of a level's bitmap."""
        _, bits, ranks = self.levels[level]
        block, byte = i // RANK_BITS, i // 8
        before = int(np.bitwise_count(bits[block * RANK_BITS // 8 : byte]).sum())
        return int(ranks[block]) + before + (int(bits[byte]) & ((1 << i % 8) - 1)).bit_count() if byte < len(bits) else int(ranks[-1])

    def token(self, i: int) -> int:
        """The i-th id of the segment, by one rank a level."""
        value, shift = 0, 0
        for level, (low, bits, _) in enumerate(self.levels):
            value |= int(low[i]) << shift
            if not bits[i // 8] >> (i % 8) & 1:
                break
            i, shift = self.rank(level, i), shift + 8
        return value

    def tokens(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo to hi of the segment; nothing else is decoded."""
        out, at, shift = np.zeros(hi - lo, "<u4"), np.arange(hi - lo), 0
        for level, (low, bits, _) in enumerate(self.levels):
            if lo >= hi:
                break
            out[at] |= low[lo:hi].astype("<u4") << np.uint32(shift)
            more = np.unpackbits(bits[lo // 8 : -(-hi // 8)], bitorder="little")[lo % 8 : lo % 8 + hi - lo].astype(bool)
            at, lo, hi, shift = at[more], self.rank(level, lo), self.rank(level, hi), shift + 8
        return out

    def document(self, k: int) -> np.ndarray:
        return self.tokens(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


def write_token_codes(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", segment_tokens: int = 1 << 17, remember: int = 450_000) -> None:
    """Encodes every text, appends ``end_id`` and writes segments in ascending id order.

    A null text is an empty one; a null id sorts first; rows with one id sort by a hash of the text (the text itself would go to the driver
    with the sample of sort keys). An
    empty table gives a file without segments. A path that exists already is an error, and nothing
    there changes. Other columns are not read. Texts are put in
    order first and encoded after, so each is encoded once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n = partitions(spark)
    ordered = rows.repartitionByRange(n, F.asc_nulls_first("doc_id"), F.xxhash64("text")).sortWithinPartitions(F.asc_nulls_first("doc_id"), F.xxhash64("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq, before = shared_encoder(tokenizer, remember), task(), 0, 0
        last = np.array([end_id], "<u4").tobytes()
        doc_ids, ends, chunks, held = [], [], [], 0

        def segment() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(chunks), "<u4")
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "part_start": pa.array([before], pa.int64()), "n_docs": pa.array([len(doc_ids)], pa.int64()), "n_tokens": pa.array([held], pa.int64()), "code": pa.array([pack(doc_ids, ends, ids)], pa.binary())})

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.encode(text.as_py()) + last
                held += len(ids) // 4
                doc_ids.append(doc_id)
                ends.append(held)
                chunks.append(ids)
                if held >= segment_tokens:
                    yield segment()
                    seq, before = seq + 1, before + held
                    doc_ids, ends, chunks, held = [], [], [], 0
        if doc_ids:
            yield segment()

    map_arrow(ordered, encode, SEGMENTS).write.parquet(path)


def _bases(segments: DataFrame) -> dict[int, int]:
    """Tokens before each partition's first segment; a row for each partition comes to the driver."""
    base, total = {}, 0
    for r in sorted(segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()):
        base[r.part], total = total, total + r.n
    return base


def read_token_codes(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the file alone: doc_id, start, n_tokens, ids_crc32, segment (its place, part/seq)."""
    segments = spark.read.parquet(path)
    base = _bases(segments)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, seq, start, _, _, code = (c[row].as_py() for c in batch.columns)
                segment = Segment(code)
                ids = segment.tokens(0, segment.n_tokens).tobytes()
                starts = np.concatenate([[0], segment.ends[:-1]]).astype("i8")
                crcs = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts.tolist(), segment.ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(segment.doc_ids, pa.int64()), "start": pa.array(starts + start + base[part]), "n_tokens": pa.array(segment.ends - starts), "ids_crc32": pa.array(crcs, pa.int64()), "segment": pa.array([f"{part}/{seq}"] * segment.n_docs)})

    return map_arrow(segments, decode, DOCUMENTS)


def token_at(spark: SparkSession, path: str, position: int) -> int:
    """The id at a place of the whole corpus: opens one segment and ranks down its levels."""
    segments = spark.read.parquet(path)
    part, first = max((p, b) for p, b in _bases(segments).items() if b <= position)
    row = segments.where((F.col("part") == part) & (F.col("part_start") <= position - first) & (F.col("part_start") + F.col("n_tokens") > position - first)).first()
    if row is None:
        raise IndexError(position)
    return Segment(bytes(row.code)).token(position - first - row.part_start)
