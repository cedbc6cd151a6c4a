"""The language model: exact counts and base scores, normalised probabilities, gain on held-out text."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa

from termloom.llm import language_model as L
from termloom.runtime import table


def plain_tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def test_counts_base_and_gain(spark, docs):
    extra = docs([(10**6, None), (10**6 + 1, ""), (10**6 + 2, "never-seen-word the")])
    frame = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").union(extra)
    texts = {r["doc_id"]: r["text"] for r in frame.collect()}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts: Counter = Counter()
    for i, t in texts.items():
        if not out[i]:
            counts.update(plain_tokens(t))
            counts[None] += 1
    total, distinct = sum(counts.values()), len(counts)
    rows = L.score_documents(frame).collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = [*plain_tokens(texts[r["doc_id"]]), None]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
        assert r["held_out"] == out[r["doc_id"]] and r["n_tokens"] == len(own) and r["train_tokens"] == total
        assert r["n_known"] == sum(counts[w] > 0 for w in own)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9, abs_tol=1e-6)
        assert r["score"] < 0 or math.isclose(r["score"], 0)
    held = [r for r in rows if r["held_out"]]
    mean = lambda c: sum(r[c] for r in held) / sum(r["n_tokens"] for r in held)
    print("log10 per token: model", mean("score"), "base", mean("base_score"))
    assert mean("score") > mean("base_score")


def test_probabilities_sum_to_one():
    g = np.random.default_rng(2)
    p = L.Parameters(g.normal(0, 0.5, 2 * L.CLASSES * L.DIM + 2 * L.DIM + L.CLASSES))
    a1, a2, z = p.tables()
    for u, v in g.integers(0, L.CLASSES, (20, 2)):
        assert np.isclose(np.exp((a1[u] + a2[v] - z[u, v]).astype(np.float64)).sum(), 1, atol=1e-3)


def test_contrastive_steps_learn():
    """After a few hundred steps the model tells which class follows which."""
    g = np.random.default_rng(3)
    unigram = np.full(L.CLASSES, 1e-6)
    unigram[:8] = 1 / 8
    unigram /= unigram.sum()
    p = L.Parameters.start(unigram)
    grad2 = np.full_like(p.vector, 1e-4)
    log_noise = np.log(L.NOISE * unigram).astype(np.float32)
    for _ in range(400):
        one = g.integers(0, 8, 512)
        L.nce_step(p, grad2, one, g.integers(0, 8, 512), (one + 1) % 8, g.integers(0, 8, L.NOISE), log_noise)
    a1, a2, z = p.tables()
    assert all((a1[u] + a2[0] - z[u, 0]).argmax() == (u + 1) % 8 for u in range(8))


def test_spelling_classes():
    assert all(0 <= L.shape(t.encode()) < L.SHAPES for t in ("a", "z.", "1", "12345678901", "é", "日本", "«", "x-é"))


def test_commonest_never_exceeds_its_bound(spark):
    counts = spark.createDataFrame([(f"t{i}", max(1, 3000 // (i + 1))) for i in range(3000)], "token string, n long")
    for most in (1, 50, 500, 2999, 3000, 9000):
        kept = counts.where(counts["n"] >= L.commonest(counts, most)).count()
        assert kept <= most and (kept == 3000 or most < 3000)
    assert counts.where(counts["n"] >= L.commonest(counts, 500)).count() > 300
    assert L.commonest(counts.where("false"), 5) > 0


def test_large_ids_beside_null_ones(docs):
    got = {r["doc_id"] for r in L.score_documents(docs([((1 << 62) + 1, "a b"), (None, "c")], parts=1)).collect()}
    assert got == {(1 << 62) + 1, None}


def test_every_position_is_a_target_once(monkeypatch):
    """Over all rounds the targets are all tokens and the end of each text, whatever its length."""
    texts = [b" ".join(b"w%d" % (k % 9) for k in range(n)) for n in (0, 1, 2, 3, 4, 5, 6, 7, 50, 3 * L.BATCH + 1)]
    words = [b"w%d" % k for k in range(9)]
    own = L.Vocabulary(words, [1] * 9, [L.shape(w) for w in words], len(texts))
    want = np.bincount(np.concatenate([own.read(L.tokens(t))[1] for t in texts]), minlength=L.CLASSES)
    seen = np.zeros(L.CLASSES, dtype=int)

    def step(p, grad2, one, two, target, noise, log_noise):
        seen[:] += np.bincount(target, minlength=L.CLASSES)

    monkeypatch.setattr(L, "nce_step", step)
    unigram = np.full(L.CLASSES, 1 / L.CLASSES)
    for turn in range(L.ROUNDS):
        run = L._train(SimpleNamespace(value=own), L.Parameters.start(unigram).vector, unigram, turn)
        list(run(iter([pd.DataFrame({"_bytes": texts})])))
    assert (seen == want).all()


def test_training_on_settled_classes():
    """Texts are read once: a replica from their settled classes is the one from the texts themselves."""
    texts = [b" ".join(b"w%d" % (k * k % 11) for k in range(n)) for n in (0, 1, 5, 400, 2 * L.BATCH + 3)] + [" rare é 日本 12 ".encode()]
    words = [b"w%d" % k for k in range(9)]
    own = L.Vocabulary(words, [1] * 9, [L.shape(w) for w in words], len(texts))
    unigram = np.full(L.CLASSES, 1 / L.CLASSES)
    start = L.Parameters.start(unigram).vector
    batch = pa.RecordBatch.from_pydict({"_rid": list(range(len(texts))), "_bytes": texts})
    read = pa.Table.from_batches(L._read(SimpleNamespace(value=own), np.zeros(L.CLASSES))(iter([batch]))).to_pandas()
    assert [list(np.frombuffer(c, L.SETTLED)) for c in read["_classes"]] == [list(own.read(L.tokens(t))[1]) for t in texts]
    (direct,) = L._train(SimpleNamespace(value=own), start, unigram, 0)(iter([pd.DataFrame({"_bytes": texts})]))
    (settled,) = L._train(None, start, unigram, 0)(iter([read]))
    assert (direct["weight"] == settled["weight"]).all() and np.array_equal(direct["total"], settled["total"])


def test_step_against_the_plain_formula():
    """Steps of changing sizes give the parameters of a plain AdaGrad step in double precision."""
    g = np.random.default_rng(4)
    unigram = np.full(L.CLASSES, 1 / L.CLASSES)
    p = L.Parameters.start(unigram)
    q, r, c1, c2, b = (x.astype(np.float64) for x in (p.q, p.r, p.c1, p.c2, p.b))
    grad2 = np.full_like(p.vector, 1e-4)
    sums = [np.full_like(x, 1e-4) for x in (q, r, c1, c2, b)]
    log_noise = np.log(L.NOISE * unigram).astype(np.float32)
    for n in (700, 64, 900, 1):
        one, two, target = g.integers(0, 40, (3, n))
        noise = g.integers(0, 40, L.NOISE)  # some occur twice
        h = q[one] * c1 + q[two] * c2
        up = 1 / (1 + np.exp(-((h * r[target]).sum(1) + b[target] - log_noise[target]))) - 1
        down = 1 / (1 + np.exp(-(h @ r[noise].T + b[noise] - log_noise[noise])))
        dh = up[:, None] * r[target] + down @ r[noise]
        grads = [np.zeros_like(x) for x in (q, r, c1, c2, b)]
        np.add.at(grads[0], one, dh * c1)
        np.add.at(grads[0], two, dh * c2)
        np.add.at(grads[1], target, up[:, None] * h)
        np.add.at(grads[1], noise, down.T @ h)
        grads[2] += (dh * q[one]).sum(0)
        grads[3] += (dh * q[two]).sum(0)
        np.add.at(grads[4], target, up)
        np.add.at(grads[4], noise, down.sum(0))
        for x, gx, s in zip((q, r, c1, c2, b), grads, sums, strict=True):
            s += (gx / n) ** 2
            x -= L.RATE * (gx / n) / (np.sqrt(s) + 1e-6)
        L.nce_step(p, grad2, one, two, target, noise, log_noise)
        assert np.allclose(p.vector, np.concatenate([x.ravel() for x in (q, r, c1, c2, b)]), atol=1e-4)
