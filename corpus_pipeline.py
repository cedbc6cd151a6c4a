"""A training corpus from raw documents: toxic texts go, one of each group of near copies stays, benchmark leaks go,
sources are mixed to their weights, and the rest is dealt into shards.

Each stage is (spark, docs, sf_dir) -> DataFrame over all rows its predecessor kept; all but the last return the columns
of documents. ``run`` writes each stage's rows as Parquet into the shared folder and reads them back, so that a lost
executor costs a stage at most; what a stage wrote for itself and what it read are then deleted.

In every stage null texts count as empty ones, rows without id take part, repeated rows are rows of their own (near-dedup keeps one
of them), ties go by a digest of id and text, and an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from termloom.llm import decontamination, mixing, sharding, simhash, toxicity
from termloom.runtime import release_since, settle, settled, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier rejects (score 0.3 or more) go; it is fitted on the labelled rows outside the held-out quarter."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of least id of each SimHash component stays."""
    return simhash.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows go whose text holds ten consecutive words of a benchmark item, or a shorter item whole."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, up to three copies each, so that sources have their target words, written in training order."""
    return mixing.mix(docs)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard (of 16) and slot, and ``position``, its place in the training order that the mix was written in."""
    return sharding.shard_in_order(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("mixing to target weights", mix_sources),
    ("sharding", deal_shards),
]

#: The toxicity model, the SimHash fingerprints and the Feistel permutation are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mark = settled()
    for k, (_, stage) in enumerate(STAGES):
        docs = settle(stage(spark, docs, sf_dir), f"stage-{k}")
        release_since(spark, mark, docs)
    return docs
