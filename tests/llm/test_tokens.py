import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from seine.llm import byte_bpe, packing, token_codes
from seine.llm.queries import BYTE_BPE, WORD_BPE
from seine.llm.shared import scratch_dir
from seine.llm.word_tokens import WordEncoder

from .common import LONG, ROWS, edge, empty, frame

SIGNS = "abAÉéÀΣσ́ßæ İ\n\t.,*%!?'’sre1<|endoftext|>　\x1c中\U0001f600"


def library():
    t = Tokenizer.from_file(WORD_BPE)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_word_encoder_equals_the_library():
    rng, encode, plain = random.Random(1), WordEncoder(WORD_BPE, remember=50), library()
    for text in ["".join(rng.choice(SIGNS) for _ in range(rng.randrange(30))) for _ in range(4000)] + [t for _, t in ROWS]:
        assert np.frombuffer(encode.encode(text), "<u4").tolist() == plain(text), text


def test_segments_round_trip_and_random_access():
    rng = random.Random(2)
    for ids in ([], [0], [255, 256, 65536, 2**32 - 1], [rng.choice((rng.randrange(200), rng.randrange(50_000), rng.randrange(2**32))) for _ in range(3000)]):
        cut = sorted(rng.randrange(len(ids) + 1) for _ in range(3)) + [len(ids)]
        s = token_codes.Segment(token_codes.pack([1, None, 3, 4], cut, np.array(ids, "<u4")))
        assert s.doc_ids == [1, None, 3, 4] and s.tokens(0, len(ids)).tolist() == ids
        assert [s.token(i) for i in range(len(ids))] == ids
        for _ in range(20):
            lo = rng.randrange(len(ids) + 1)
            hi = rng.randrange(lo, len(ids) + 1)
            assert s.tokens(lo, hi).tolist() == ids[lo:hi]
        assert sum((s.document(k).tolist() for k in range(4)), []) == ids


def test_token_codes(spark):
    plain, path = library(), scratch_dir(spark, "codes")
    token_codes.write_token_codes(edge(spark), path, WORD_BPE, end_id=2, segment_tokens=5000)
    got = sorted(token_codes.read_token_codes(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in ROWS), key=lambda i: (i is not None, i or 0))
    texts, stream = {}, []
    for i, t in ROWS:
        texts.setdefault(i, []).append(plain(t) + [2])
    for r in got:
        assert r.start == len(stream)
        own = next(x for x in texts[r.doc_id] if crc(x) == r.ids_crc32)
        texts[r.doc_id].remove(own)
        assert r.n_tokens == len(own)
        stream += own
    for at in (0, 1, len(stream) // 2, len(stream) - 1):
        assert token_codes.token_at(spark, path, at) == stream[at]
    path = scratch_dir(spark, "codes")
    token_codes.write_token_codes(empty(spark), path, WORD_BPE, end_id=2)
    assert token_codes.read_token_codes(spark, path).count() == 0


def naive_best_fit(lengths, size):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [(r, k) for k, r in enumerate(rooms) if r >= n]
        if fit:
            rooms[min(fit)[1]] -= n
        else:
            rooms.append(size - n)
    return len(rooms)


def test_plan_is_best_fit():
    rng = random.Random(3)
    for _ in range(200):
        size = rng.randrange(5, 60)
        lengths = [rng.randrange(1, size + 1) for _ in range(rng.randrange(120))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        filled, ranks = {}, {}
        for length, first, end, sequence, each, offset in packing.plan_runs(counts, size):
            for r in range(first, end):
                ranks.setdefault(length, []).append(r)
                k = r - first
                filled.setdefault(sequence + k // each, []).append((offset + k % each * length, length))
        assert {n: sorted(x) for n, x in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
        for slots in filled.values():
            at = 0
            for offset, length in sorted(slots):
                assert offset == at
                at += length
            assert at <= size
        assert len(filled) == naive_best_fit(lengths, size)


def test_packing(spark):
    plain, got = library(), packing.pack_documents(edge(spark), WORD_BPE, end_id=1, size=512).collect()
    want = sorted((i if i is not None else -1, k, a, len(own), crc(own)) for i, t in ROWS for ids in [plain(t) + [1]] for k, a in enumerate(range(0, len(ids), 512)) for own in [ids[a : a + 512]])
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    slots = {}
    for r in got:
        slots.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in slots.values():
        ends = [o + n for o, n in sorted(s)]
        assert [o for o, _ in sorted(s)] == [0, *ends[:-1]] and ends[-1] <= 512
    assert len(slots) == naive_best_fit([r.length for r in got], 512)
    assert packing.pack_documents(empty(spark), WORD_BPE, end_id=1).count() == 0


def reference_bpe():
    with open(BYTE_BPE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_tiktoken():
    rng, plain, merger = random.Random(4), reference_bpe(), byte_bpe.Merger(BYTE_BPE, remember=100)
    signs = "ab1 '’\n\t 　é中!?.,sremvltd²Ⅷ́\U0001f600\u200b\x00\x1c\x85"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(5000)] + ["", " ", "  ", "a" * 3000, "!" * 500, "'s" * 9, " 's", "ab " * 500]
    for text, (pieces, starts) in zip(texts, merger.encode(texts), strict=True):
        ids = np.frombuffer(b"".join(pieces), "<u4")
        assert ids.tolist() == plain.encode_ordinary(text), text
        assert merger.decode(ids) == text.encode()
        assert [text[a:b] for a, b in zip(starts.tolist(), [*starts.tolist()[1:], len(text)][: len(starts)], strict=True)] == [merger.decode(np.frombuffer(p, "<u4")).decode() for p in pieces]


def test_code_point_classes_are_the_library_s():
    classes = byte_bpe.code_point_classes()
    rng = random.Random(5)
    for x in rng.sample([*range(0x300), *range(0x300, 0xD800), *range(0xE000, 0x110000)], 6000):
        if x != 0x27:
            assert min(int(classes[x]), 4) % 4 == byte_bpe._asked(chr(x)) % 4 or classes[x] in (3, 4), hex(x)


def test_byte_bpe_query(spark):
    plain, got = reference_bpe(), byte_bpe.encode_digest(edge(spark), BYTE_BPE, chars=1000).collect()
    want = [(i, t or "") for i, t in ROWS]
    row = lambda i, t, ids: (str(i), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(row(i, t, plain.encode_ordinary(t)) for i, t in want)
    full = byte_bpe.encode_decode(frame(spark, [(1, LONG[:500])]), BYTE_BPE).first()
    assert full.ids == plain.encode_ordinary(LONG[:500]) and bytes(full.decoded).decode() == LONG[:500] and full.offsets[0] == 0
    assert byte_bpe.encode_digest(empty(spark), BYTE_BPE).count() == 0


def test_code_files_are_not_written_over(spark, tmp_path):
    path = str(tmp_path / "codes")
    token_codes.write_token_codes(frame(spark, [(1, "one")]), path, WORD_BPE, end_id=2)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        token_codes.write_token_codes(frame(spark, [(1, "two"), (2, "three")]), path, WORD_BPE, end_id=2)
    assert token_codes.read_token_codes(spark, path).count() == 1
