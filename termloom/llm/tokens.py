"""Token counts through a digest cache.

A text's count depends on its content and the tokenizer's files only. Counts are kept in a table keyed by the SHA-256
of the normalised content and of the tokenizer (its file and the engine's version). A run joins its digests
to the cache, encodes one text for each distinct digest it misses, appends those counts, and joins again. The cache has one
place in the shared folder, so later runs find what earlier ones counted; a row says the same whoever wrote it, so that runs at
the same time, or one that died half-way, leave at most rows that occur twice.

Normalisation may not change a count, and byte-level encoders tell all texts apart, so it does no more than make null
the empty text.

Encoding one text: the library's own encoder, without special tokens added. Because byte-level BPE merges inside
pre-tokens only, a text made of letters, digits and signs whose classes no Unicode version disputes is cut by the
library's published pattern and the library's count of each distinct pre-token is remembered in the worker, a bounded
table; any other text, and any with a special token's string in it, goes to the library whole.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import Carried, hot_keys, meet
from termloom.runtime import scratch_dir, table

OVER = 512
#: Pre-tokens remembered in one worker.
REMEMBERED = 400_000
CACHE = "content_digest string, tokenizer_digest string, n_tokens long"
#: White space, ASCII, Latin letters and common punctuation: the texts that are cut here.
PLAIN = r"[\t\n\r -~¡-¬®-ɏ‐-‧‰-⁞€]*"
#: The library's pattern on such texts, with letters and numbers spelt out.
LETTERS, NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+"


def tokenizer_digest(path: str) -> str:
    """SHA-256 of the tokenizer's file and the library's version."""
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + b"\0tokenizers " + tokenizers.__version__.encode()).hexdigest()


class Counter:
    """Counts tokens of whole texts as the library does."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.known: dict[str, int] = {}
        self.cut = re.compile(PATTERN).findall
        self.plain = re.compile(PLAIN).fullmatch
        self.word = re.compile(f" [{LETTERS}]+").fullmatch
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        pre = self.library.pre_tokenizer
        #: Only this kind of tokenizer may be counted by pre-tokens.
        self.by_pieces = type(pre).__name__ == "ByteLevel" and not pre.add_prefix_space and getattr(pre, "use_regex", True) and self.library.normalizer is None

    def whole(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, pieces: list[str]) -> None:
        """Count pre-tokens. Words with their space stay apart when strung together, so they are encoded in one go."""
        words = [p for p in pieces if self.word(p)]
        rest = [p for p in pieces if not self.word(p)]
        counts = [0] * len(words)
        for w in self.library.encode("".join(words), add_special_tokens=False).word_ids:
            counts[w] += 1
        self.known.update(zip(words, counts, strict=True))
        self.known.update(zip(rest, self.whole(rest), strict=True))

    def count(self, text: str) -> int:
        if not self.by_pieces or not self.plain(text) or (self.special and self.special.search(text)):
            return self.whole([text])[0]
        pieces, known = self.cut(text), self.known
        try:
            return sum([known[p] for p in pieces])
        except KeyError:
            new = list({p for p in pieces if p not in known})
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = list(set(pieces))
            self.learn(new)
            return sum([known[p] for p in pieces])


@functools.lru_cache(maxsize=1)
def worker_counter(path: str, digest: str) -> Counter:
    """One counter for all tasks of a worker process: the library gives back only part of a loaded tokenizer's memory, so that
    a new one in each task would let a worker grow with the number of its tasks."""
    return Counter(path)


def _encode(path: str, digest: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counter = worker_counter(path, digest)
        for b in batches:
            yield pd.DataFrame(
                {"content_digest": b["content_digest"], "tokenizer_digest": digest, "n_tokens": [counter.count(t) for t in b["text"]]}
            )

    return run


def _digests(docs: DataFrame) -> DataFrame:
    return docs.withColumn("content_digest", F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))


def cached(spark, cache: str, digest: str) -> DataFrame | None:
    """The counts that the cache has for one tokenizer, each digest once; None before the first append."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    known = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer_digest") == digest)
    return known.groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))


def fill_cache(docs: DataFrame, cache: str, path: str) -> None:
    """Encode each distinct text of ``docs`` that the cache lacks and append its count. Copies are combined before anything is
    shuffled, so a text that a third of the rows have is one row for each task. The counts, short rows, are gathered into as many
    files as there are cores before they are written, however many tasks encoded."""
    spark, digest = docs.sparkSession, tokenizer_digest(path)
    misses = _digests(docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))).dropDuplicates(["content_digest"])
    known = cached(spark, cache, digest)
    if known is not None:
        misses = misses.join(known.select("content_digest"), "content_digest", "left_anti")
    counts = misses.mapInPandas(_encode(path, digest), CACHE).repartition(spark.sparkContext.defaultParallelism)
    counts.write.mode("append").parquet(cache)


def count_tokens(docs: DataFrame, path: str, cache: str | None = None, over: int = OVER) -> DataFrame:
    """Add ``n_bytes``, ``n_tokens`` and ``over_limit`` to every row.

    ``path`` is the tokenizer's file on every machine, ``cache`` a folder all share (default: ``termloom-token-cache`` in the
    session's shared folder). Null counts as the empty text: no bytes, no tokens. Copies and repeated rows are encoded once and
    each get the count. An empty table gives an empty table. Extra columns pass through, those with a result's name give way to it.
    """
    carried = Carried(docs, "text")
    spark = docs.sparkSession
    cache = cache or f"{scratch_dir(spark)}/termloom-token-cache"
    fill_cache(carried.frame, cache, path)
    known = cached(spark, cache, tokenizer_digest(path))
    digested = (
        _digests(carried.frame)
        .withColumn("n_bytes", F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long"))
        .select("content_digest", *carried.held, "n_bytes")
    )
    copies = digested.groupBy("content_digest").agg(F.count("*").alias("_n"))
    hot = hot_keys(copies, "content_digest", docs.count())
    counted = meet(digested, known, "content_digest", hot).withColumn("over_limit", F.col("n_tokens") > over)
    return carried.back(counted, "n_bytes", "n_tokens", "over_limit")


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", "n_bytes", "n_tokens", "over_limit")
