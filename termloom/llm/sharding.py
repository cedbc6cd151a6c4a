"""Sharding: a Feistel permutation of global row numbers, walked back into range.

Row numbers: rows are ordered by the md5 of id and text, which spreads any group of copies, and numbered in two
levels: counts of fixed hash buckets give each bucket's first number, a window inside each bucket the rest.
No task holds more than a bucket, whatever one source or group of copies weighs.

The permutation acts on Z_a x Z_b, a = ceil(sqrt(n)), b = ceil(n / a): six rounds add a hash of one half to the
other. The domain is less than sqrt(n) larger than n, so a point seldom lies outside [0, n); if so it is permuted
again until it is inside (cycle walking), which keeps the map a bijection on [0, n).
shard = p mod shards, slot = p div shards: counts differ by one at most and slots have no gaps.

A table that was written in an order worth keeping (a curriculum) is numbered in that order instead, by file and row: then the
number is the row's position in training and its shard and slot are computed from it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.common import Carried
from termloom.runtime import table

ROUNDS = 6
BUCKETS = 4096  # 3 hex digits
#: Walking visits only points outside [0, n), fewer than sqrt(n): up to n = 4096 that many steps always do,
#: beyond it the chance to need more is below n ** -32. A row that did would raise, never be dropped.
WALK = 64


def _div(x: Column, y: Column) -> Column:
    """Whole quotient of longs, exact where a double would round."""
    return F.call_function("div", x, y)


def _permuted(x: Column, a: Column, b: Column, seed: int) -> Column:
    left, right = F.pmod(x, a), _div(x, a)
    for k in range(ROUNDS):
        if k % 2 == 0:
            left = F.pmod(left + F.pmod(F.xxhash64(right, F.lit(seed), F.lit(k)), a), a)
        else:
            right = F.pmod(right + F.pmod(F.xxhash64(left, F.lit(seed), F.lit(k)), b), b)
    return left + a * right


def feistel(x: Column, n: Column, seed: int) -> Column:
    """The place of row number ``x`` under the seed's permutation of [0, n)."""
    a = F.greatest(F.ceil(F.sqrt(n.cast("double"))).cast("long"), F.lit(1).cast("long"))
    b = _div(n + a - 1, a)
    once = _permuted(x, a, b, seed)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)), once, lambda p, _: F.when(p < n, p).otherwise(_permuted(p, a, b, seed))
    )
    p = F.when(once < n, once).otherwise(walked)
    return F.when(p < n, p).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long"))


def number_rows(docs: DataFrame, key: Column, into: str, total: str) -> DataFrame:
    """Add ``into``, a gapless global number from 0 in the order of ``key`` (hex text), and ``total``, the row count."""
    keyed = docs.withColumn("_key", key).withColumn("_bucket", F.substring("_key", 1, 3))
    counts = keyed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    every = Window.orderBy("_bucket")
    starts = counts.select(  # at most BUCKETS rows
        "_bucket",
        (F.sum("_n").over(every) - F.col("_n")).alias("_start"),
        F.sum("_n").over(Window.partitionBy(F.lit(0))).alias(total),
    )
    inside = Window.partitionBy("_bucket").orderBy("_key")
    return (
        keyed.join(F.broadcast(starts), "_bucket")
        .withColumn(into, F.col("_start") + F.row_number().over(inside) - 1)
        .drop("_bucket", "_key", "_start")
    )


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 20_240_601) -> DataFrame:
    """Add ``shard`` (int, 0 to shards - 1), ``slot`` (long, gapless from 0 in each shard) to every row.

    Law: rows. Null ids and texts count as values of their own; rows that are equal in both may swap places, which
    changes no multiset of results. An empty table gives an empty table. Extra columns pass through, those with a result's name
    give way to it.
    """
    carried = Carried(docs, "doc_id", "text")
    numbered = number_rows(carried.frame, _identity(), "_row", "_rows")
    return carried.back(_dealt(numbered, F.col("_row"), F.col("_rows"), shards, seed), "shard", "slot")


def _identity() -> Column:
    """The md5 of ``doc_id`` and ``text``, null unlike any value."""
    return F.md5(
        F.concat_ws(
            "\x01",
            F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
            F.coalesce(F.concat(F.lit("t"), F.col("text")), F.lit("null")),
        ).cast("binary")
    )


def _dealt(numbered: DataFrame, row: Column, rows: Column, shards: int, seed: int) -> DataFrame:
    return (
        numbered.withColumn("_place", feistel(row, rows, seed))
        .withColumn("shard", F.pmod(F.col("_place"), F.lit(shards)).cast("int"))
        .withColumn("slot", _div(F.col("_place"), F.lit(shards).cast("long")))
    )


def in_file_order(docs: DataFrame) -> tuple[DataFrame, Carried] | None:
    """``docs`` with ``_row``, a gapless number from 0 in the order of the files that it was written to (their part numbers) and of
    rows in them, and ``_rows``, the row count; None if ``docs`` is no plain scan of files. Columns are carried.

    Counts of the files, a row each, give each file's first number: no row is shuffled.
    """
    at = "_at"
    while at in (c.lower() for c in docs.columns):
        at += "_"
    try:
        located = docs.select("*", F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")).alias(at))
    except AnalysisException:
        return None
    carried = Carried(located, at)
    carried.names, carried.held = carried.names[:-1], carried.held[:-1]
    placed = carried.frame.select(*carried.held, F.col(f"{at}.file").alias("_file"), F.col(f"{at}.row").alias("_in_file"))
    part = F.regexp_extract("_file", r"^part-(\d+)", 1)
    counts = placed.groupBy("_file").agg(F.max("_in_file").alias("_last"))
    every = Window.orderBy(F.length(part), part, "_file")
    size = F.col("_last") + 1
    starts = counts.select(
        "_file", (F.sum(size).over(every) - size).alias("_start"), F.sum(size).over(Window.partitionBy(F.lit(0))).alias("_rows")
    )
    return placed.join(F.broadcast(starts), "_file").withColumn("_row", F.col("_start") + F.col("_in_file")), carried


def shard_in_order(docs: DataFrame, shards: int = 16, seed: int = 20_240_601) -> DataFrame:
    """``shard_documents`` for a table written in training order: adds ``position``, the row's number in that order, beside
    ``shard`` and ``slot``, which are the permutation's of ``position``. Where ``docs`` is no plain scan of files its order is that
    of ``shard_documents``. Names clash as there; an empty table gives an empty table.
    """
    if (found := in_file_order(docs)) is not None:
        numbered, carried = found
    else:
        carried = Carried(docs, "doc_id", "text")
        numbered = number_rows(carried.frame, _identity(), "_row", "_rows")
    dealt = _dealt(numbered, F.col("_row"), F.col("_rows"), shards, seed).withColumn("position", F.col("_row").cast("long"))
    return carried.back(dealt, "shard", "slot", "position")


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    """Every row of documents with its shard and slot; null text counts as the empty one."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.md5(text.cast("binary")).alias("text"),
    )
    return shard_documents(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
