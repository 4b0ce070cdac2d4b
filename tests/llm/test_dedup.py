import hashlib
import random
import re

import numpy as np
import pytest

from seine.llm import chosen_path, components, suffix_dedup, topk

from .common import ROWS, edge, empty, frame, words


def brute_repeats(texts, length):
    count = {}
    data = [(t or "").encode() for t in texts]
    for d in data:
        for k in range(len(d) - length + 1):
            count[d[k : k + length]] = count.get(d[k : k + length], 0) + 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - length + 1):
            if count[d[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        runs = sum(1 for k in range(len(d)) if gone[k] and not (k and gone[k - 1]))
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_arrays_find_all_repeated_windows():
    rng = random.Random(1)
    for _ in range(150):
        pieces = [bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(1, 60))) for _ in range(rng.randrange(1, 8))]
        length = rng.randrange(2, 20)
        whole, ends = b"".join(pieces), np.repeat(np.cumsum([len(p) for p in pieces]), [len(p) for p in pieces])
        windows = [whole[k : k + length] if k + length <= ends[k] else None for k in range(len(whole))]
        again, order, shared = suffix_dedup.repeated_windows([np.frombuffer(p, "u1") for p in pieces], length)
        assert again.tolist() == [w is not None and windows.count(w) > 1 for w in windows]
        suffixes = [whole[k : ends[k]] for k in order]
        assert suffixes == sorted(suffixes)
        for r in range(1, len(order)):
            a, b = suffixes[r - 1], suffixes[r]
            assert shared[r] == next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("contexts", [1024, 2])
def test_remove_repeats(spark, monkeypatch, contexts):
    """Shared passages, copies, repeats within a text, and anchors dealt over several shards."""
    monkeypatch.setattr(suffix_dedup, "SHARD_CONTEXTS", contexts)
    rng = random.Random(2)
    passage, other = words(rng, 60, 5000), words(rng, 30, 5000)
    rows = ROWS + [(100 + k, words(rng, 20, 5000) + " " + (passage if k % 2 else other[: 90 + k]) + " é " + words(rng, 20, 5000)) for k in range(24)]
    rows += [(200, words(rng, 50, 5000))] * 2 + [(201, rows[-1][1]), (202, passage + passage), (203, passage[7:260])]
    got = suffix_dedup.remove_repeats(frame(spark, rows), ["doc_id", "td"], length=100, texts=True).collect()
    want = sorted((str(i), *x) for (i, _), x in zip(rows, brute_repeats([t for _, t in rows], 100), strict=True))
    assert sorted((str(r._kept.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want
    assert all(sum(s.end - s.start for s in r.removed) == r.n_removed and r._kept.td == "td" for r in got)
    assert suffix_dedup.remove_repeats(empty(spark), ["doc_id"], length=100).count() == 0


def test_no_context_with_a_repeated_window_is_put_aside():
    """Contexts as they come from texts, against all windows of the others."""
    rng = random.Random(13)
    for kind, length in (("u1", 100), ("u1", 70), ("<u4", 20)):
        for _ in range(30):
            shared = [rng.choices(range(5), k=rng.randrange(length - 10, 2 * length)) for _ in range(3)]
            texts = [np.array(rng.choices(range(5), k=60) + rng.choice(shared)[rng.randrange(12) :] + rng.choices(range(5), k=60), kind) for _ in range(12)]
            part, first, windows, gram, context, _ = suffix_dedup.anchors(texts, length)
            kinds = {(g, c): texts[p][f : f + w + length - 1] for p, f, w, g, c in zip(part, first, windows, gram.view("i8").tolist(), context.tolist(), strict=True)}
            bodies, names = list(kinds.values()), [g for g, _ in kinds]
            with np.errstate(over="ignore"):
                use = suffix_dedup.alike(bodies, names, length)
            seen = {}
            for k, (body, name) in enumerate(zip(bodies, names, strict=True)):
                for w in range(len(body) - length + 1):
                    seen.setdefault((name, body[w : w + length].tobytes()), set()).add(k)
            assert all(use[k] for found in seen.values() if len(found) > 1 for k in found)


def test_suffix_arrays_over_words():
    rng = random.Random(9)
    for _ in range(150):
        pieces = [[rng.randrange(4) << 29 | rng.randrange(2) for _ in range(rng.randrange(1, 50))] for _ in range(rng.randrange(1, 8))]
        length = rng.randrange(1, 12)
        again, order, shared = suffix_dedup.repeated_windows([np.array(p, "<u4") for p in pieces], length)
        ends = np.repeat(np.cumsum([len(p) for p in pieces]), [len(p) for p in pieces])
        whole = [x for p in pieces for x in p]
        windows = [tuple(whole[k : k + length]) if k + length <= ends[k] else None for k in range(len(whole))]
        assert again.tolist() == [w is not None and windows.count(w) > 1 for w in windows]
        suffixes = [whole[k : ends[k]] for k in order]
        assert suffixes == sorted(suffixes)
        for r in range(1, len(order)):
            a, b = suffixes[r - 1], suffixes[r]
            assert shared[r] == next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def brute_passages(texts, n):
    """Words in passages, passages, and the text left, by looking at every window of n words."""
    found = [[m.span() for m in re.finditer("[^\x20\x09-\x0d]+", t or "")] for t in texts]
    said = [[(t or "")[a:b] for a, b in spans] for t, spans in zip(texts, found, strict=True)]
    count = {}
    for w in said:
        for k in range(len(w) - n + 1):
            count[tuple(w[k : k + n])] = count.get(tuple(w[k : k + n]), 0) + 1
    out = []
    for t, w, spans in zip(texts, said, found, strict=True):
        gone = set()
        for k in range(len(w) - n + 1):
            if count[tuple(w[k : k + n])] > 1:
                gone |= set(range(k, k + n))
        left, at = "", 0
        for k in sorted(gone):
            if k - 1 not in gone:
                left += (t or "")[at : spans[k][0]]
            at = spans[k][1]
        out.append((len(gone), len([k for k in gone if k - 1 not in gone]), left + (t or "")[at:]))
    return out


@pytest.mark.parametrize("contexts", [1024, 2])
def test_remove_passages(spark, monkeypatch, contexts):
    """Passages of 51 to 70 words in several documents, with other white space, within a text, and shorter ones that stay."""
    monkeypatch.setattr(suffix_dedup, "SHARD_CONTEXTS", contexts)
    rng = random.Random(12)
    shared = [words(rng, n, 5000) for n in (51, 53, 60, 70, 49, 50, 200)]
    rows = list(ROWS)
    for k in range(40):
        passage = shared[k % 7]
        passage = passage.replace(" ", rng.choice((" ", "\n", " \t "))) if k % 2 else passage
        rows.append((100 + k, words(rng, 20 + k, 5000) + " é " + passage + "\n" + words(rng, 30, 5000)))
    rows += [(200, shared[6][: len(shared[6]) // 2] + " " + words(rng, 20, 5000)), (201, words(rng, 55, 5000) + " x " + " ".join(shared[2:4])), (202, " ".join([words(rng, 52, 5000)] * 2)), (203, words(rng, 400, 5000))]
    got = suffix_dedup.remove_repeats(frame(spark, rows), ["doc_id", "td"], length=100, words=50, texts=True).collect()
    want = sorted((str(i), *a, *b) for (i, t), a, b in zip(rows, brute_passages([t for _, t in rows], 50), brute_repeats([t for _, t in rows], 100), strict=True))
    assert sorted((str(r._kept.doc_id), r.n_passage_words, r.n_passages, r.kept_text, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want
    alone = suffix_dedup.remove_repeats(frame(spark, rows), ["doc_id"], length=0, words=50, texts=True)
    assert alone.columns == ["_kept", "n_bytes", "n_passage_words", "n_passages", "passages", "kept_text"]
    assert sorted((str(r._kept.doc_id), r.n_passage_words, r.n_passages, r.kept_text, r.n_bytes) for r in alone.collect()) == [x[:5] for x in want]
    assert suffix_dedup.remove_repeats(empty(spark), ["doc_id"], words=50).count() == 0


def test_words_of_a_long_text_are_hashed_slab_by_slab(monkeypatch):
    text = words(random.Random(3), 4000, 300) + " " + "y" * 5000 + " end"
    whole = suffix_dedup.units_of(text, "<u4")
    monkeypatch.setattr(suffix_dedup, "SLAB", 100)
    assert (suffix_dedup.units_of(text, "<u4") == whole).all() and len(whole) == 4002 and len(set(whole.tolist())) == len(set(text.split()))
    assert not len(suffix_dedup.units_of(None, "<u4")) and not len(suffix_dedup.units_of(" \n", "<u4"))


def grams(text, n=5):
    w = re.findall(r"\w+", (text or "").lower())
    return frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute_classes(rows, least=0.8):
    sets, parent, links = [grams(t) for _, t in rows], list(range(len(rows))), [0] * len(rows)

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(rows[k][0])
    least_id = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted((str(rows[k][0]), str(least_id[find(k)]), links[k]) for k in range(len(rows)))


@pytest.mark.parametrize("small", [256, 6])
def test_jaccard_classes(spark, monkeypatch, small):
    """Copies, near copies of each other in chains, one large group, and groups over the size of a node."""
    monkeypatch.setattr(chosen_path, "SMALL", small)
    monkeypatch.setattr(chosen_path, "BLOCK", 2 * small)
    rng = random.Random(3)
    rows = list(ROWS)
    for g in range(12):
        text = words(rng, 120, 5000).split()
        for k in range(rng.randrange(1, 5) if g else 30):
            own = list(text)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = "edit"
            rows.append((1000 + 100 * g + k, " ".join(own)))
    rows += [(3000 + k, words(rng, 40, 5000)) for k in range(60)]
    got = chosen_path.jaccard_classes(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in got) == brute_classes(rows)
    assert chosen_path.jaccard_classes(empty(spark)).count() == 0


def test_chances_and_runs():
    assert chosen_path.chance(0.8, 1) == pytest.approx(0.84)
    runs = chosen_path.runs_for(0.999, 0.8, 4)
    assert 1 - (1 - chosen_path.chance(0.8, 4)) ** runs >= 0.999


def test_runs_reckon_with_the_spread_of_tokens():
    """All runs share their tokens: pairs at the threshold by simulated numbers of agreeing ones."""
    rng = np.random.default_rng(8)
    agreeing, times = np.unique(rng.binomial(chosen_path.TOKENS, 0.8, 200_000), return_counts=True)
    runs = chosen_path.runs_for(0.999, 0.8, chosen_path.DEPTH)
    second, q = 1 / 0.8 - 1, np.ones(len(agreeing))
    for _ in range(chosen_path.DEPTH):
        hit = agreeing / chosen_path.TOKENS * q
        q = (1 - second) * hit + second * (1 - (1 - hit) ** 2)
    assert (times * (1 - q) ** runs).sum() / times.sum() < 0.001


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (102, 101), (7, 7), (200, 200), (3, 2)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100, 102: 100}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_top_k(spark):
    rng = random.Random(4)
    rows = [(k, [rng.choice((-1.0, 0.0, 0.5, 0.37, 2.5)) for _ in range(6)]) for k in range(120)]
    rows += [(500, None), (550, [None, 1.0]), (600, [float("nan")]), (650, [float("inf")]), (None, [1.0]), (700, []), (750, [1.0, 2.0]), (3, [2.5] * 6), (51, rows[50][1]), (50, rows[50][1])]
    frame_ = spark.createDataFrame([(i, v, "other") for i, v in rows], "vec_id long, embedding array<float>, score string")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.exact_top_k(frame_, k=5, candidate_rows=17, query_rows=2).collect())
    whole = [(i, np.floor(256 * np.array(v, "f4").astype("f8")).astype(int).tolist()) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, "f4")).all()]
    want = []
    for q, v in {(i, tuple(v)) for i, v in whole if i % 50 == 0}:
        best = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in whole if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)
    assert topk.exact_top_k(frame_.limit(0)).count() == 0


def test_top_k_answers_each_vector_of_a_repeated_query_id(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (50, [0.0, 1.0])] + [(k, [float(k), 10.0 - k]) for k in range(1, 10)]
    out = topk.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=3, candidate_rows=4, query_rows=1)
    want = [(50, r + 1, v, int(65536 * 10 - 65536 * (r + 1))) for r, v in enumerate((9, 8, 7))] + [(50, r + 1, v, int(65536 * 10 - 65536 * (r + 1))) for r, v in enumerate((1, 2, 3))]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in out.collect()) == sorted(want)


def test_edge_documents_have_one_row_each(spark):
    assert chosen_path.jaccard_classes(edge(spark)).count() == len(ROWS)
