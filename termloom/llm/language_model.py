"""LM scoring: a log-bilinear neural model trained by noise-contrastive estimation.

Classes: the ``WORDS`` most frequent training tokens, the text's end, and ``SHAPES`` classes by spelling for all
other tokens. The model has an embedding for each class as context and as target, a diagonal context matrix for each of the
two places before the target, and a bias: s(w | u, v) = (c1 * Q[u] + c2 * Q[v]) . R[w] + b[w].

Texts are read once more after the tokens are counted: their classes, two bytes a token, are settled, and training and
scoring take them from there.

Training: every task runs mini-batches over the texts it has, real targets against noise drawn from the unigram,
from one common start; the replicas' parameters are averaged by a distributed aggregate of bounded width and a second
round starts from the mean. Every position of every training document is a target once, in one of the rounds.

Scoring: batched matrix products give A1 = (Q c1) R', A2 = (Q c2) R' and the normaliser of every pair of context classes,
Z = exp(A1) (exp(A2 + b))', so a token's normalised log-probability is a sum of looked-up values. A token of a spelling
class costs its class and its smoothed share of the class's training tokens.

Counts of all training tokens stay distributed. The ``FREQUENT`` commonest are broadcast (a bounded table); rarer tokens
of each text are joined with their counts by the token.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import held_out
from termloom.runtime import settle, table

MODULUS = 7
WORDS = 959
SHAPES = 64
CLASSES = 1 + WORDS + SHAPES
END = 0
FREQUENT = 200_000
DIM = 32
ROUNDS = 2
#: One of so many positions of each text is a training target, another one in each round, so that each is one once.
STRIDE = ROUNDS
BATCH = 2048
NOISE = 96
RATE = 0.1
#: Texts read at a time.
SLICE = 500
#: Classes as they are settled.
SETTLED = np.dtype("<i2")
#: Distinct tokens that a task counts before it hands them on.
HELD = 400_000


def tokens(text: bytes | None) -> list[bytes]:
    """Lower-cased A-Z, cut at ASCII white space; the end is not among them."""
    return (text or b"").lower().split()


def shape(token: bytes) -> int:
    """The spelling class of a token, 0 to SHAPES - 1: its first letter beyond ASCII, or else its last ASCII letter."""
    if not token.isascii():
        return 32 + next(c for c in token.translate(None, _HEADS) if c >= 128) % 32 if token.translate(None, _HEADS).translate(None, _ASCII) else 31
    letters = token.translate(None, _NOT_LETTERS)
    return letters[-1] - 97 if letters else 26 + min(4, len(token) // 2)


_HEADS = bytes(range(192, 256))  # first bytes of UTF-8 sequences
_ASCII = bytes(range(128))
_NOT_LETTERS = bytes(c for c in range(256) if not 97 <= c <= 122)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: Counter = Counter()

    def out() -> pd.DataFrame:
        return pd.DataFrame({"token": list(held.keys()), "shape": [shape(t) for t in held], "n": list(held.values())})

    for b in batches:
        for t in b["_bytes"]:
            held.update(tokens(t))
            if len(held) > HELD:
                yield out()
                held.clear()
    if held:
        yield out()


class _Places(dict):
    """Token to place, -1 for others."""

    def __missing__(self, token: bytes) -> int:
        return -1


class Vocabulary:
    """What every worker knows: the frequent tokens' places, classes and log counts."""

    def __init__(self, words: list[bytes], counts: list[int], shapes: list[int], ends: int):
        self.words = words
        self.place = _Places((w, i) for i, w in enumerate(words))
        own = np.arange(1, len(words) + 1, dtype=np.int32)
        self.cls = np.where(own <= WORDS, own, 1 + WORDS + np.array(shapes, dtype=np.int32))
        self.log_count = np.log10(np.array(counts, dtype=np.float64) + 1)
        self.ends = ends

    def read(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Places of a text's tokens, -1 where rare, and classes with the end's last."""
        place = np.fromiter(map(self.place.__getitem__, words), dtype=np.int32, count=len(words))
        cls = np.empty(len(words) + 1, dtype=np.int32)
        cls[:-1] = self.cls[place] if len(self.words) else 0
        for i in np.flatnonzero(place < 0).tolist():
            cls[i] = 1 + WORDS + shape(words[i])
        cls[-1] = END
        return place, cls


class Parameters:
    """Q, R: CLASSES x DIM; c1, c2: DIM; b: CLASSES. As one vector for averaging."""

    def __init__(self, vector: np.ndarray):
        self.vector = vector.astype(np.float32)
        k = CLASSES * DIM
        self.q, self.r = self.vector[:k].reshape(CLASSES, DIM), self.vector[k : 2 * k].reshape(CLASSES, DIM)
        self.c1, self.c2 = self.vector[2 * k : 2 * k + DIM], self.vector[2 * k + DIM : 2 * k + 2 * DIM]
        self.b = self.vector[2 * k + 2 * DIM :]

    @staticmethod
    def start(unigram: np.ndarray) -> Parameters:
        g = np.random.default_rng(7)
        small = g.normal(0, 0.1, 2 * CLASSES * DIM)
        return Parameters(np.concatenate((small, np.ones(2 * DIM), np.log(unigram))))

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of targets by each context place, the bias in the second, and the log normaliser of each pair."""
        a1 = (self.q * self.c1) @ self.r.T
        a2 = (self.q * self.c2) @ self.r.T + self.b
        m1, m2 = a1.max(axis=1, keepdims=True), a2.max(axis=1, keepdims=True)
        z = np.exp(a1 - m1).astype(np.float64) @ np.exp(a2 - m2).astype(np.float64).T
        return a1, a2, (np.log(np.maximum(z, 1e-300)) + m1 + m2.T).astype(np.float32)


def contexts(cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes one and two places before each target; ends stand before the text."""
    one, two = np.empty_like(cls), np.empty_like(cls)
    one[0], one[1:] = END, cls[:-1]
    two[:2], two[2:] = END, cls[:-2]
    return one, two


class Work:
    """Room for the arrays of a step, kept from one to the next: giving them back and taking them anew costs as much as the step."""

    def __init__(self):
        self.n = 0

    def fit(self, n: int) -> None:
        if n > self.n:
            self.n = n
            self.u, self.v, self.h, self.real, self.dh, self.product = (np.empty((n, DIM), np.float32) for _ in range(6))
            self.down = np.empty((n, NOISE), np.float32)
            self.values, self.in_order = np.empty((3 * n, DIM), np.float32), np.empty((3 * n, DIM), np.float32)
            size = 2 * CLASSES * DIM + 2 * DIM + CLASSES
            self.g, self.square = np.empty(size, np.float32), np.empty(size, np.float32)


_WORK = Work()


def nce_step(p: Parameters, grad2: np.ndarray, one, two, target, noise, log_noise) -> None:
    """One mini-batch: logistic regression of each target against NOISE shared noise classes; AdaGrad."""
    n = len(target)
    _WORK.fit(n)
    u, v, h, real, dh, product, down = (x[:n] for x in (_WORK.u, _WORK.v, _WORK.h, _WORK.real, _WORK.dh, _WORK.product, _WORK.down))
    np.take(p.q, one, axis=0, out=u, mode="clip")  # the other modes copy
    np.take(p.q, two, axis=0, out=v, mode="clip")
    np.take(p.r, target, axis=0, out=real, mode="clip")
    np.multiply(u, p.c1, out=h)
    h += np.multiply(v, p.c2, out=product)
    up = 1 / (1 + np.exp(-np.clip(np.einsum("ij,ij->i", h, real) + p.b[target] - log_noise[target], -30, 30))) - 1
    other = p.r[noise]
    np.matmul(h, -other.T, out=down)
    down += log_noise[noise] - p.b[noise]
    np.minimum(down, 30, out=down)
    np.exp(down, out=down)
    down += 1
    np.reciprocal(down, out=down)
    np.matmul(down, other, out=dh)
    dh += np.multiply(real, up[:, None], out=product)
    g, k = _WORK.g, CLASSES * DIM
    g[:] = 0
    both = g[: 2 * k].reshape(2 * CLASSES, DIM)
    values, in_order = _WORK.values[: 3 * n], _WORK.in_order[: 3 * n]
    np.multiply(dh, p.c1, out=values[:n])
    np.multiply(dh, p.c2, out=values[n : 2 * n])
    np.multiply(h, up[:, None], out=values[2 * n :])
    rows = np.concatenate((one, two, target), dtype=np.int16, casting="unsafe")  # they fit, and 16 bits are sorted by radix
    rows[2 * n :] += CLASSES
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    at = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    both[rows[at]] = np.add.reduceat(np.take(values, order, axis=0, out=in_order, mode="clip"), at, axis=0)
    np.add.at(both, noise + CLASSES, down.T @ h)
    g[2 * k : 2 * k + DIM] = np.einsum("ij,ij->j", dh, u)
    g[2 * k + DIM : 2 * k + 2 * DIM] = np.einsum("ij,ij->j", dh, v)
    g[2 * k + 2 * DIM :] = np.bincount(target, weights=up, minlength=CLASSES) + np.bincount(noise, weights=down.sum(0), minlength=CLASSES)
    g /= n
    square = _WORK.square
    grad2 += np.multiply(g, g, out=square)
    np.sqrt(grad2, out=square)
    square += 1e-6
    g *= RATE
    p.vector -= np.divide(g, square, out=g)


def _classes(vocabulary, batch: pd.DataFrame) -> Iterator[np.ndarray]:
    """The classes of a batch's texts: as settled, or else read now."""
    if "_classes" in batch:
        return (np.frombuffer(c, SETTLED) for c in batch["_classes"])
    return (vocabulary.value.read(tokens(t))[1] for t in batch["_bytes"])


def _train(vocabulary, start: np.ndarray, unigram: np.ndarray, turn: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = Parameters(start.copy())
        grad2 = np.full_like(p.vector, 1e-4)
        log_noise = np.log(NOISE * unigram).astype(np.float32)
        edges, g = np.cumsum(unigram), np.random.default_rng(turn)
        held: list = []
        size = seen = 0

        def step() -> None:
            one, two, target = (np.concatenate(x) for x in zip(*held, strict=True))
            noise = np.minimum(np.searchsorted(edges, g.random(NOISE)), CLASSES - 1)
            nce_step(p, grad2, one, two, target, noise, log_noise)

        for b in batches:
            for cls in _classes(vocabulary, b):
                one, two = contexts(cls)
                for lo in range(turn, len(cls), STRIDE * BATCH):
                    part = slice(lo, min(len(cls), lo + STRIDE * BATCH), STRIDE)
                    held.append((one[part], two[part], cls[part]))
                    size += len(held[-1][2])
                    if size >= BATCH:
                        step()
                        seen, size, held = seen + size, 0, []
        if size:
            step()
            seen += size
        if seen:
            yield pd.DataFrame({"at": np.arange(len(p.vector)), "total": p.vector.astype(np.float64) * seen, "weight": float(seen)})

    return run


def train(texts: DataFrame, unigram: np.ndarray) -> Parameters:
    """``texts`` has the training documents' ``_classes``."""
    p = Parameters.start(unigram)
    for turn in range(ROUNDS):
        replicas = texts.mapInPandas(_train(None, p.vector, unigram, turn), "at int, total double, weight double")
        mean = replicas.groupBy("at").agg((F.sum("total") / F.sum("weight")).alias("value")).collect()  # one row a parameter
        if mean:
            v = p.vector.copy()
            v[[r["at"] for r in mean]] = [r["value"] for r in mean]
            p = Parameters(v)
    return p


def _read(vocabulary, cost: np.ndarray):
    """What scoring takes from the texts themselves; ``cost``: of each class, the log10 of what its tokens share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary.value
        for b in (b.slice(lo, SLICE) for b in batches for lo in range(0, b.num_rows, SLICE)):
            out: dict[str, list] = {c: [] for c in ("n_tokens", "n_frequent", "log_counts", "log_share", "_classes")}
            rare, rare_times, ends = [], [], [0]
            for t in b.column("_bytes").to_pylist():
                words = tokens(t)
                place, cls = own.read(words)
                known = place[place >= 0]
                logs = own.log_count[known]
                out["n_tokens"].append(len(cls))
                out["n_frequent"].append(len(known))
                out["log_counts"].append(float(logs.sum()))
                out["log_share"].append(float(logs[known >= WORDS].sum() - cost[cls].sum()))
                out["_classes"].append(cls.astype(SETTLED).tobytes())
                if len(known) < len(place):
                    times = Counter(words[i] for i in np.flatnonzero(place < 0).tolist())
                    rare.extend(times.keys())
                    rare_times.extend(times.values())
                ends.append(len(rare))
            pairs = pa.StructArray.from_arrays([pa.array(rare, pa.binary()), pa.array(rare_times, pa.int32())], ["token", "n"])
            made = {c: pa.array(v, _READ[c]) for c, v in out.items()} | {"rare": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)}
            keep = [c for c in b.schema.names if c != "_bytes"]
            yield pa.RecordBatch.from_arrays([*map(b.column, keep), *made.values()], names=[*keep, *made])

    return run


_READ = {"n_tokens": pa.int64(), "n_frequent": pa.int64(), "log_counts": pa.float64(), "log_share": pa.float64(), "_classes": pa.binary()}


def _score(tables):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a1, a2, z = tables.value
        for b in batches:
            model = []
            for cls in _classes(None, b):
                one, two = contexts(cls)
                model.append(float((a1[one, cls] + a2[two, cls] - z[one, two]).sum(dtype=np.float64)) / np.log(10))
            yield pd.DataFrame({"_rid": b["_rid"].to_numpy(), "_model": model})

    return run


def count_training_tokens(texts: DataFrame) -> DataFrame:
    """(token, shape, n) over ``_bytes``, without ends; settled."""
    parts = texts.mapInPandas(_count, "token binary, shape int, n long")
    return settle(parts.groupBy("token").agg(F.first("shape").alias("shape"), F.sum("n").alias("n")), "token-counts")


def commonest(counts: DataFrame, most: int) -> int:
    """The least count so that no more than ``most`` tokens have it or a higher one, by sixteenths of a doubling."""
    bins = counts.groupBy(F.floor(F.log2("n") * 16).alias("bin")).agg(F.min("n").alias("least"), F.count("*").alias("tokens"))
    out, kept = 1 << 62, 0
    for r in sorted(bins.collect(), key=lambda r: -r["bin"]):  # 1024 rows at most
        kept += r["tokens"]
        if kept > most:
            break
        out = r["least"]
    return out


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Null counts as the empty text: its end is its only token. Null ids train, unless their checksum is the held-out one.
    Repeated rows count and are scored each. An empty table gives an empty table; without training rows every
    count is 0, all probabilities come from the smoothing and the untrained start. Other columns are not read.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.monotonically_increasing_id().alias("_rid"),
        F.col("doc_id").cast("string").alias("doc_id"),  # pandas would turn ids beside nulls into doubles
        held_out(F.col("doc_id"), MODULUS).alias("held_out"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("_bytes"),
    )
    training = source.where("NOT held_out").select("_bytes")
    ends = training.count()
    counts = count_training_tokens(training)
    least = commonest(counts, FREQUENT)
    frequent = counts.where(F.col("n") >= least).collect()  # FREQUENT rows at most
    frequent.sort(key=lambda r: (-r["n"], bytes(r["token"])))
    own = Vocabulary([bytes(r["token"]) for r in frequent], [r["n"] for r in frequent], [r["shape"] for r in frequent], ends)
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, distinct = total + ends, distinct + (ends > 0)
    by_shape = {r["shape"]: (r["n"], r["v"]) for r in counts.groupBy("shape").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    for r in frequent[:WORDS]:  # words that are classes of their own leave their spelling class
        n, v = by_shape[r["shape"]]
        by_shape[r["shape"]] = (n - r["n"], v - 1)
    share = np.ones(CLASSES)
    share[END] += ends
    share[1 : 1 + min(WORDS, len(frequent))] += [r["n"] for r in frequent[:WORDS]]
    share[1 + WORDS :] += [by_shape.get(s, (0, 0))[0] for s in range(SHAPES)]
    unigram = share / share.sum()
    vocabulary = spark.sparkContext.broadcast(own)
    cost = np.zeros(CLASSES)
    cost[1 + WORDS :] = [np.log10(sum(by_shape.get(s, (0, 0))) + 1) for s in range(SHAPES)]
    columns = (
        "_rid long, doc_id string, held_out boolean, n_tokens long, n_frequent long, log_counts double, log_share double, "
        "_classes binary, rare array<struct<token: binary, n: int>>"
    )
    read = settle(source.mapInArrow(_read(vocabulary, cost), columns), "read-texts")
    p = train(read.where("NOT held_out").select("_classes"), unigram)
    tables = spark.sparkContext.broadcast(p.tables())
    model = read.select("_rid", "_classes").mapInPandas(_score(tables), "_rid long, _model double")
    rare = read.select("_rid", F.explode("rare").alias("r")).select("_rid", F.col("r.token").alias("token"), F.col("r.n").alias("times"))
    known = rare.join(counts.where(F.col("n") < least), "token").select(
        "_rid", (F.col("times") * F.log10(F.col("n") + 1.0)).alias("_logs"), F.col("times").cast("long").alias("_known"), F.lit(0.0).alias("_model")
    )
    looked_up = (  # one row of the model for each text beside those of its rare tokens
        known.unionByName(model.select("_rid", F.lit(0.0).alias("_logs"), F.lit(0).cast("long").alias("_known"), "_model"))
        .groupBy("_rid")
        .agg(*(F.sum(c).alias(c) for c in ("_logs", "_known", "_model")))
    )
    end_logs = float(np.log10(ends + 1))
    base = F.col("log_counts") + F.col("_logs") + F.lit(end_logs) - F.col("n_tokens") * F.lit(float(np.log10(total + distinct + 1)))
    numbers = read.drop("_classes", "rare")
    return numbers.join(looked_up, "_rid").select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        "held_out",
        "n_tokens",
        (F.col("n_frequent") + F.col("_known") + F.lit(int(ends > 0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("_model") + F.col("log_share") + F.col("_logs")).alias("score"),
    )


def op3_language_model(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
