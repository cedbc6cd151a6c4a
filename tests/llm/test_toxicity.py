"""Held-out accuracy of the toxicity classifier; what it may and may not read."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from termloom.llm import toxicity
from termloom.llm.common import held_out
from termloom.runtime import table

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = table(spark, SF, "labels")
    docs = table(spark, SF, "documents").join(labels.select("doc_id"), "doc_id", "left_semi").select("doc_id", "text")
    model = toxicity.train(docs, labels)
    scored = toxicity.score_toxicity(docs, model).where(held_out(F.col("doc_id"), toxicity.MODULUS)).join(labels, "doc_id")
    rows = scored.select("toxic", "score", "predicted").collect()
    y, s, p = (np.array([r[k] for r in rows]) for k in range(3))
    order = s.argsort().argsort() + 1
    pos = int(y.sum())
    auc = (order[y == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(y) - pos))
    recall, precision = (p[y == 1]).mean(), y[p == 1].mean()
    print("held out", len(y), "auc", auc, "recall", recall, "precision", precision)
    assert auc > 0.95 and recall > 0.85 and precision > 0.85
    assert ((s >= 0) & (s <= 1)).all()


def test_only_the_text_counts(docs):
    model = toxicity.Model(toxicity.features("some words here"), np.full(len(toxicity.features("some words here")), 0.5), -3.0)
    rows = docs([(1, "some words here", "toxic"), (2, "some words here", None)], "doc_id long, text string, source string")
    assert len({r["score"] for r in toxicity.score_toxicity(rows, model).collect()}) == 1


def test_long_texts_are_read_whole():
    """A text beyond one piece scores by n-grams at its very end and across the pieces' seam."""
    mark = toxicity.features(" qzxqzx ")
    model = toxicity.Model(mark, np.full(len(mark), 1.0), -2.0)
    filler = "a " * (toxicity.PIECE // 2)
    base, end, seam = model.scores([filler * 2, filler * 2 + "qzxqzx", filler[: toxicity.PIECE - 4] + "qzxqzx " + filler])
    assert end > base + 0.2 and seam > base + 0.2


def test_scores_match_the_features():
    g = np.random.default_rng(1)
    texts = ["".join(g.choice(list("abc \n"), n)) for n in (0, 1, 5, 80, 400)] + [None, "É文字 x" * 9]
    index = np.unique(np.concatenate([toxicity.features(t) for t in texts]))[::2]
    model = toxicity.Model(index, g.normal(size=len(index)), 0.1)
    want = [0.1 + model.weight[np.isin(index, toxicity.features(t))].sum() for t in texts]
    assert np.allclose(model.scores(texts), 1 / (1 + np.exp(-np.array(want))))


def test_training_reads_no_held_out_label(spark, docs):
    rows = [(i, f"{'bad' if i % 2 else 'good'} text number {i} " * 4) for i in range(300)]
    d = docs(rows)
    labels = [(i, i % 2) for i, _ in rows]
    flipped = [(i, 1 - t if toxicity.crc32_of(i) % 4 == 2 else t) for i, t in labels]
    a, b = (toxicity.train(d, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, flipped))
    assert (a.index == b.index).all() and np.allclose(a.weight, b.weight) and np.isclose(a.bias, b.bias)


def plain_hash(gram: str) -> int:
    """An n-gram's place, one character at a time in whole numbers."""
    h = len(gram) * 0x2545F491 & 0xFFFFFFFF
    for c, m in zip(gram, toxicity._MULTIPLIERS, strict=False):
        h = (h ^ ord(c)) * m & 0xFFFFFFFF
        h ^= h >> 15
    return h >> (32 - toxicity.BITS)


def plain_features(text: str) -> set[int]:
    line = "".join(" " if ord(c) <= 32 else c for c in f" {text.lower()} ")
    return {plain_hash(line[i : i + n]) for n in toxicity.GRAMS for i in range(len(line) - n + 1)}


def test_training_by_plain_counts(spark, docs):
    """Features, their counts, evidence and ratios, and the minimum of the loss, against a plain version on few texts."""
    r = random.Random(5)
    words = "red green blue grey stone glass house river".split()
    rows = [(i, " ".join(r.choices(words, k=12) + (["vile"] * r.randint(1, 2) if i % 3 == 0 else [])) + ("\tÉnd" if i % 2 else "")) for i in range(240)]
    model = toxicity.train(docs(rows), spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int"))
    train = [(int(i % 3 == 0), plain_features(t)) for i, t in rows if toxicity.crc32_of(i) % 4 != 2]
    n, pos = len(train), sum(y for y, _ in train)
    df, a = Counter(), Counter()
    for y, f in train:
        df.update(f)
        a.update(f if y else ())

    def g(k):
        cells = [(a[k], df[k] * pos / n), (df[k] - a[k], df[k] * (n - pos) / n), (pos - a[k], (n - df[k]) * pos / n), (n - pos - df[k] + a[k], (n - df[k]) * (n - pos) / n)]
        return sum(2 * o * math.log(o / e) for o, e in cells if o > 0)

    told = sorted(k for k in df if df[k] >= toxicity.MIN_TEXTS and g(k) >= toxicity.MIN_EVIDENCE)
    assert model.index.tolist() == told and told
    ratio = np.array([math.log((a[k] + 0.5) / (pos + 1)) - math.log((df[k] - a[k] + 0.5) / (n - pos + 1)) for k in told])
    x = np.array([[k in f for k in told] for _, f in train]) * ratio
    y = np.array([t for t, _ in train])

    def loss(u, b):  # rows are weighted to one in all; the sample is all there is, so its shares are the true ones
        z = x @ u + b
        return (np.logaddexp(0, z) - y * z).mean() + toxicity.DECAY / 2 * u @ u

    u, best = model.weight / ratio, loss(model.weight / ratio, model.bias)
    for _ in range(40):  # nothing near does noticeably better
        assert loss(u + 0.02 * np.random.default_rng(1).normal(size=len(u)), model.bias) > best - 2e-3
    assert best < 0.05 and (model.scores([t for i, t in rows if i % 3 == 0]) > 0.5).mean() > 0.95


def test_all_telling_features_are_kept(spark, docs):
    """Toxic texts share a passage of more than 20,000 telling n-grams; none is left out for their number."""
    r = random.Random(11)
    letters = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    shared = letters(12_000)
    rows = [(i, f"{letters(50)} {shared}" if i % 2 else letters(50)) for i in range(120)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int")
    assert len(toxicity.train(docs(rows), labels).index) > 22_000
