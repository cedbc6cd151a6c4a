"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

Training reads a bounded sample of the labelled rows outside the held-out quarter: up to ``SAMPLE`` rows of each label, by
hash of the id, their whole texts hashed to n-grams and counted on the executors. The ratio of a feature is
log(share of toxic texts with it / share of others with it), smoothed; features in few texts or without evidence go.
A logistic regression on the scaled features, rows weighted back to the labels' true shares, gives the weights. It runs in one
task, on the bounded sample only, and hands the driver a weight for each feature; the texts' features never come there.

Scoring is one pass over whole texts without a shuffle: the n-gram hashes of a batch are computed at once by numpy,
and only those with a weight are looked at again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import Carried, held_out
from termloom.runtime import settle, table

GRAMS = (4, 5, 6)
BITS = 22
#: Labelled training rows of each label.
SAMPLE = 4000
MIN_TEXTS = 3
#: Features whose log-likelihood ratio (2 sum o log o/e of the 2 x 2 table) is below this tell no label apart.
MIN_EVIDENCE = 18.0
DECAY = 3e-4
THRESHOLD = 0.3
MODULUS = 4
#: Texts whose features the trainer looks at together.
BLOCK = 500
#: Characters hashed at once; longer texts are taken in overlapping pieces.
PIECE = 1 << 20
_MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xD3A2646D)


def _codes(text: str) -> np.ndarray:
    """Lower-cased code points between two spaces, white space and control characters as spaces."""
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(c <= 32, np.uint32(32), c)


def _hashes(c: np.ndarray, n: int) -> np.ndarray:
    """A hash below 2 ** BITS for each n-gram of ``c``."""
    m = max(0, len(c) - n + 1)
    h = np.full(m, n * 0x2545F491 & 0xFFFFFFFF, dtype=np.uint32)
    for k in range(n):
        h = (h ^ c[k : k + m]) * np.uint32(_MULTIPLIERS[k])
        h ^= h >> np.uint32(15)
    return h >> np.uint32(32 - BITS)


def features(text: str | None) -> np.ndarray:
    """The distinct n-gram hashes of a whole text."""
    c = _codes(text or "")
    found = [
        np.unique(_hashes(c[at : at + PIECE + n - 1], n)) for n in GRAMS for at in range(0, max(1, len(c)), PIECE)
    ]
    return np.unique(np.concatenate(found))


class Model:
    """Sparse weights by feature hash, and the intercept."""

    def __init__(self, index: np.ndarray, weight: np.ndarray, bias: float):
        self.index, self.weight, self.bias = index.astype(np.uint32), weight.astype(np.float64), float(bias)
        self.slot: np.ndarray | None = None

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probability of label 1 for each text."""
        if self.slot is None:
            self.slot = np.full(1 << BITS, -1, dtype=np.int32)
            self.slot[self.index] = np.arange(len(self.index), dtype=np.int32)
        out = np.full(len(texts), self.bias)
        group: list[int] = []
        size = 0
        for i, t in enumerate(texts):
            group.append(i)
            size += len(t or "")
            if size >= PIECE or i == len(texts) - 1:
                self._add(out, group, [texts[g] or "" for g in group])
                group, size = [], 0
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))

    def _add(self, out: np.ndarray, group: list[int], texts: list[str]) -> None:
        codes = [_codes(t) for t in texts]
        whole = np.concatenate(codes)
        ends = np.cumsum([len(c) for c in codes])
        seen = []
        for n in GRAMS:
            for at in range(0, len(whole), PIECE):
                slot = self.slot[_hashes(whole[at : at + PIECE + n - 1], n)]
                hit = np.flatnonzero(slot >= 0)
                if len(hit):
                    text = np.searchsorted(ends, hit + at, side="right")
                    inside = hit + at + n <= ends[text]
                    seen.append(np.unique(text[inside] * len(self.index) + slot[hit[inside]]))
        if seen and len(self.index):
            pairs = np.unique(np.concatenate(seen))
            add = np.bincount(pairs // len(self.index), weights=self.weight[pairs % len(self.index)], minlength=len(group))
            out[np.array(group)] += add


def evidence(pos: int, n: int):
    """The G statistic of a feature against the label, over ``a`` (toxic texts with the feature) and ``df`` (all texts with it)."""
    cells = [
        ("a", f"df * {pos / n!r}D"),
        ("(df - a)", f"df * {1 - pos / n!r}D"),
        (f"({pos} - a)", f"({n} - df) * {pos / n!r}D"),
        (f"({n - pos} - df + a)", f"({n} - df) * {1 - pos / n!r}D"),
    ]
    return F.expr(" + ".join(f"CASE WHEN {o} > 0 THEN 2D * {o} * ln({o} / ({e})) ELSE 0D END" for o, e in cells))


def fit(rows: list[np.ndarray], toxic: np.ndarray, index: np.ndarray, a: np.ndarray, df: np.ndarray, prior: float, rounds: int = 150) -> Model:
    """The classifier from each text's places in ``index``, 0/1 labels, the features' counts and label 1's true share.

    Without rows of both labels it scores every text with the prior.
    """
    n, pos = len(rows), int(toxic.sum()) if len(rows) else 0
    if not 0 < pos < n:
        p = min(max(prior, 1e-6), 1 - 1e-6)
        return Model(np.empty(0), np.empty(0), float(np.log(p / (1 - p))))
    ratio = np.log((a + 0.5) / (pos + 1)) - np.log((df - a + 0.5) / (n - pos + 1))
    share = np.where(toxic == 1, prior / pos, (1 - prior) / (n - pos))
    u, bias = np.zeros(len(index)), float(np.log(prior / (1 - prior)))
    m, v, step, decay = np.zeros(len(index) + 1), np.zeros(len(index) + 1), 0.05, DECAY
    for t in range(1, rounds + 1):
        grad, w = np.append(decay * u, 0.0), u * ratio
        for lo in range(0, n, BLOCK):  # little memory, whatever the sample
            part = rows[lo : lo + BLOCK]
            cols, text = np.concatenate(part), np.repeat(np.arange(len(part)), [len(r) for r in part])
            z = np.bincount(text, weights=w[cols], minlength=len(part)) + bias
            err = share[lo : lo + BLOCK] * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - toxic[lo : lo + BLOCK])
            grad[:-1] += ratio * np.bincount(cols, weights=err[text], minlength=len(index))
            grad[-1] += err.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        u, bias = u - move[:-1], bias - float(move[-1])
    return Model(index, u * ratio, bias)


def _feature_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each feature the texts of this task that have it, toxic ones and all."""
    a, df = np.zeros(1 << BITS, dtype=np.int32), np.zeros(1 << BITS, dtype=np.int32)
    for b in batches:
        for toxic, text in zip(b["toxic"], b["text"], strict=True):
            found = features(text)
            df[found] += 1
            if toxic:
                a[found] += 1
    at = np.flatnonzero(df)
    for lo in range(0, len(at), 100_000):
        part = at[lo : lo + 100_000]
        yield pd.DataFrame({"gram": part.astype(np.int32), "a": a[part], "df": df[part]})


def _feature_places(index: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            places = [np.flatnonzero(np.isin(index, features(t))).astype("<i4").tobytes() for t in b["text"]]
            yield pd.DataFrame({"toxic": b["toxic"], "places": places})

    return run


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on labelled rows outside the held-out quarter; null ids, null labels and null texts of labels' rows don't count.

    An id with several labels counts as toxic if any says so.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"), MODULUS))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    present = known.join(docs.where("text IS NOT NULL").select("doc_id"), "doc_id", "left_semi")
    counts = {r["toxic"]: r["count"] for r in present.groupBy("toxic").count().collect()}
    chosen = None
    for label in (0, 1):  # at most ``sample`` ids each
        part = present.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.union(part)
    texts = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    texts = settle(texts.select("doc_id", "toxic", "text"), "labelled")  # the bounded sample
    sizes = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    pos, n, total = sizes.get(1, 0), sum(sizes.values()), sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.0
    if not 0 < pos < n:
        return fit([], np.empty(0), np.empty(0), np.empty(0), np.empty(0), prior)
    tallied = texts.select("toxic", "text").mapInPandas(_feature_counts, "gram int, a int, df int")
    telling = (
        tallied.groupBy("gram")
        .agg(F.sum("a").alias("a"), F.sum("df").alias("df"))
        .where(F.col("df") >= MIN_TEXTS)
        .withColumn("g", evidence(pos, n))
        .where(F.col("g") >= MIN_EVIDENCE)
        .collect()  # bounded by the sample and by 2^BITS
    )
    telling.sort(key=lambda r: r["gram"])
    index, a, df = (np.array([r[c] for r in telling], dtype=np.int64) for c in ("gram", "a", "df"))
    placed = texts.select("toxic", "text").mapInPandas(_feature_places(index), "toxic int, places binary")
    weights = placed.repartition(1).mapInPandas(_fitted(index, a, df, prior), "at int, weight double").collect()  # a row a feature
    by_place = dict(map(tuple, weights))
    return Model(index, np.array([by_place[k] for k in range(len(index))]), by_place[len(index)])


def _fitted(index: np.ndarray, a: np.ndarray, df: np.ndarray, prior: float):
    """The sample's rows, at most twice SAMPLE, to the model's weights with the intercept last."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = sorted((y, bytes(p)) for b in batches for y, p in zip(b["toxic"], b["places"], strict=True))  # one order, whatever the tasks'
        if got:
            model = fit([np.frombuffer(p, dtype="<i4") for _, p in got], np.array([y for y, _ in got]), index, a, df, prior)
            yield pd.DataFrame({"at": np.arange(len(index) + 1), "weight": np.append(model.weight, model.bias)})

    return run


def score_toxicity(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Add ``score`` and ``predicted`` to every row; only the text is read.

    Null counts as the empty text, which scores the intercept. Rows equal in text score alike. An empty table gives an
    empty table. Extra columns pass through, those with a result's name give way to it.
    """
    carried = Carried(docs, "text")
    scored = _scored(carried.frame, model).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    return carried.back(scored, "score", "predicted")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, columns as given, whatever their names."""
    carried = Carried(docs, "text")
    return carried.back(_scored(carried.frame, model).where(F.col("score") < threshold))


def _scored(frame: DataFrame, model: Model) -> DataFrame:
    index, weight, bias = model.index, model.weight, model.bias
    held: dict[str, Model] = {}

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = held.setdefault("model", Model(index, weight, bias))
        for texts in batches:
            yield pd.Series(own.scores(list(texts)))

    return frame.withColumn("score", score(F.coalesce(F.col("text"), F.lit(""))))


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select("doc_id", held_out(F.col("doc_id"), MODULUS).alias("held_out"), "score", "predicted")


def crc32_of(doc_id: int | None) -> int:
    """The split's checksum in Python, for tests."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
