import os
import random

import pytest

import corpus_pipeline
from seine.llm import shared
from seine.llm.queries import QUERIES

from .common import edge, empty, frame, words


def test_stages_on_awkward_rows(spark):
    """Every stage takes null, empty, long and repeated rows, and keeps the columns."""
    for make in (edge, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, make(spark), "")
            out.collect()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == make(spark).columns, name


def test_decisions_take_effect(spark):
    rng = random.Random(1)
    passage = words(rng, 90, 90_000)
    clean = [(k, words(rng, 100, 90_000)) for k in range(30)]
    near = clean[0][1].split()
    near[50] = "edit"
    rows = clean + [(100, clean[1][1]), (101, " ".join(near)), (102, "*** ### " * 40), (103, "short")] + [(200 + k, words(rng, 60, 90_000) + " " + passage + " " + words(rng, 60, 90_000)) for k in range(3)] + [(300, words(rng, 60, 90_000) + " password=hunter2hunter2 " + words(rng, 60, 90_000))]
    docs = frame(spark, rows)
    step = lambda k, d: corpus_pipeline.STAGES[k][1](spark, d, "").cache()
    kept = step(0, docs)
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {102, 103}
    single = step(1, kept)
    assert {r.doc_id for r in single.collect()} == {i for i, _ in rows} - {100, 101, 102, 103}
    cut = step(2, single)
    texts = {r.doc_id: r for r in cut.collect()}
    assert all(passage[30:-30] not in r.text for r in texts.values()) and texts[5].text == dict(rows)[5] and texts[200].n_chars == len(texts[200].text)
    blotted = {r.doc_id: r.text for r in step(3, cut).collect()}
    assert "hunter2" not in blotted[300] and "[ASSIGN]" in blotted[300] and blotted[5] == dict(rows)[5]
    assert {r.doc_id for r in step(4, cut).collect()} == set(texts)


def test_one_row_of_each_class_stays_and_no_other_goes(spark):
    """Ids on rows of different texts, near copies that share an id or have none, repeated rows."""
    rng = random.Random(7)
    text = [words(rng, 100, 90_000) for _ in range(8)]
    near = lambda k: " ".join([*text[k].split()[:-1], "edit"])
    rows = [(1, text[0]), (9, near(0)), (9, text[1]), (9, text[2])]  # one text of a repeated id is a near copy of a smaller id
    rows += [(20, text[3]), (20, near(3))]  # near copies of one id
    rows += [(None, text[4]), (None, near(4)), (None, text[5])]  # and without an id
    rows += [(None, text[6])] * 2 + [(30, text[7])] * 3 + [(None, text[7]), (40, ""), (40, None), (40, "")]
    out = [(r.doc_id, r.text) for r in corpus_pipeline.jaccard_join(spark, frame(spark, rows), "").collect()]
    one_of = lambda *some: len([x for x in out if x in some]) == 1
    assert all(out.count(x) == 1 for x in [(1, text[0]), (9, text[1]), (9, text[2]), (None, text[5]), (None, text[6]), (30, text[7]), (40, None)])
    assert one_of((20, text[3]), (20, near(3))) and one_of((None, text[4]), (None, near(4))) and out.count((40, "")) == 2
    assert len(out) == 11


def test_run_and_queries_on_a_small_table(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    for name in ("op1_feistel_pseudonyms", "op3_quality_rules", "op4_secret_scan", "op9_byte_bpe"):
        assert QUERIES[name](spark, "/root/testdata/sf0.001").count() == 200


def test_written_tables_go_when_their_use_ends(spark):
    at = lambda: set(shared.recorded(spark))
    shared.release(spark)
    with shared.scope(spark) as keep:
        first = keep(shared.written(spark.range(3).toDF("x"), "kept"))
        second = shared.written(spark.range(3).toDF("x"), "gone")
    assert at() == {first._scratch_path} and first.count() == 3 and not os.path.exists(second._scratch_path.removeprefix("file:"))
    with pytest.raises(ZeroDivisionError), shared.scope(spark) as keep:
        keep(shared.written(spark.range(3).toDF("x"), "failed"))
        raise ZeroDivisionError
    assert at() == {first._scratch_path}
    shared.release(spark)
    assert not at() and not os.path.exists(first._scratch_path.removeprefix("file:"))
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and {p.rsplit("/", 1)[1].split("-")[0] for p in at()} <= {"secret_scan", "pieces"}
    shared.release(spark)
