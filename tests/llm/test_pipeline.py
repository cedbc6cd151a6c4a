"""The pipeline's stages against what each should keep of its own input."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from termloom.llm import mixing
from termloom.runtime import settle, table
from tests.llm.test_decontamination import plain
from tests.llm.test_simhash import plain_fingerprint, plain_groups

SMALL = "/root/testdata/sf0.001"


def test_every_stage(spark):
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    benchmark = [(r["item_id"], r["text"]) for r in table(spark, SMALL, "benchmark").collect()]
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SMALL, "labels").collect()}
    (_, toxic), (_, near), (_, leaks), (_, mixed), (_, shards) = corpus_pipeline.STAGES

    first = toxic(spark, docs, SMALL)
    assert first.columns == columns
    gone = set(r["doc_id"] for r in docs.collect()) - set(r["doc_id"] for r in first.collect())
    assert sum(labels.get(i) == 0 for i in gone) <= 0.05 * docs.count()

    second = near(spark, docs, SMALL)  # each stage on the whole table, whatever another one would have dropped
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    groups = plain_groups(np.array([plain_fingerprint(t) for _, t in rows], dtype=np.uint64))
    assert {r["doc_id"] for r in second.collect()} == {rows[g][0] for g in groups} and second.columns == columns

    third = leaks(spark, docs, SMALL)
    assert {r["doc_id"] for r in third.collect()} == {x[0] for x in plain(rows, benchmark) if not x[5]} and third.columns == columns

    fourth = mixed(spark, docs, SMALL)
    copies = {r["doc_id"]: r["copies"] for r in mixing.plan_mix(docs).collect()}
    assert Counter(r["doc_id"] for r in fourth.collect()) == Counter({k: v for k, v in copies.items() if v}) and fourth.columns == columns

    fifth = shards(spark, docs, SMALL).collect()
    slots = defaultdict(list)
    for r in fifth:
        slots[r["shard"]].append(r["slot"])
    assert len(fifth) == len(rows) and all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_run(spark):
    """Runs agree, and a run can be read in the mix's training order."""
    docs = table(spark, SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = settle(stage(spark, docs, SMALL), "stage")
    want = [r["doc_id"] for r in mixing.mix(docs).collect()]
    ran = corpus_pipeline.run(spark, SMALL)
    rows = sorted(ran.collect(), key=lambda r: r["position"])
    assert [r["doc_id"] for r in rows] == want and len(want) > 100
    assert [r["position"] for r in rows] == list(range(len(rows)))
    assert set(docs.columns) < set(ran.columns)
    assert sorted(r["shard"] + 16 * r["slot"] for r in rows) == list(range(len(rows)))


def test_stages_take_bad_rows(spark):
    r = random.Random(4)
    rows = [(i, r.choice([None, "", " ", "a b c", "word " * 50]), None, r.choice([None, "s", "t"]), None) for i in [None, None, 1, 1, 2, 3, 4, 5]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, SMALL)
        assert {"shard", "slot"} <= set(frame.columns)
        frame.collect()
