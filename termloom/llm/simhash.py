"""SimHash near-duplicates by an inverted index of fingerprint bytes with count filtering.

Two 64-bit fingerprints that differ in at most ``bits`` = 4 bits agree in at least 8 - 4 = 4 of their 8 bytes, place for
place. Twenty triples of byte places are such that any four places contain one of them (three groups of 3, 3 and 2
places; a triple lies in one group or takes two places of a group and one of the next), so such a pair meets in a posting
list of some triple of positional bytes: 24 bits, less than one chance meeting for each fingerprint up to millions.
Pairs that meet are tallied by shared positional bytes, those with fewer than four are dropped, the rest verified
by counting differing bits.

Postings hold distinct fingerprints only, so exact copies meet once. A list is worked in one pass over sorted rows,
with no more than ``LIST`` fingerprints in memory, and gives a spanning forest of its links, not all its pairs. The
fingerprints of a longer list take an exact way whose groups are bounded: two that differ in at most four bits
have a common neighbour within two bits of each, so each names its 2081 neighbours, and those who name the
same one (2081 at most, all within four bits of each other) hang on the least.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.common import Carried, hot_keys, meet, row_key
from termloom.llm.components import components
from termloom.runtime import settle, table

SHINGLE = 4
SEED = 42
BITS = 4
#: Longest posting list that is compared pair by pair.
LIST = 2048
_LANES = np.uint64(0x0101010101010101)


def place_triples() -> list[tuple[int, int, int]]:
    """Twenty triples of the eight byte places of which any four places contain one."""
    groups = [(0, 1, 2), (3, 4, 5), (6, 7)]
    inside = [g for g in groups if len(g) == 3]
    across = [(*two, one) for k, g in enumerate(groups) for two in combinations(g, 2) for one in groups[(k + 1) % 3]]
    return inside + across


def fingerprint(text: bytes | None) -> int:
    """The fingerprint of one whole text, as a signed long; 0 for a text without words."""
    words = (text or b"").lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        shingles = [line[a:b] for a, b in zip(starts[: len(words) - SHINGLE + 1].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(s, SEED) for s in shingles), dtype=np.uint64, count=len(shingles))
    return int(majority(h).view(np.int64)[0])


def majority(h: np.ndarray) -> np.ndarray:
    """Bits set in over half of the hashes: eight byte-wide counters in a word, emptied every 255 rows."""
    cuts = np.arange(0, len(h), 255)
    out = np.uint64(0)
    for k in range(8):
        lanes = np.add.reduceat((h >> np.uint64(k)) & _LANES, cuts)
        counts = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for byte in np.flatnonzero(2 * counts > len(h)):
            out |= np.uint64(1) << np.uint64(8 * int(byte) + k)
    return np.array([out], dtype=np.uint64)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        names = [n for n in b.schema.names if n != "_bytes"]
        prints = [fingerprint(t.as_py()) for t in b.column("_bytes")]
        yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(prints, pa.int64())], [*names, "_fp"])


def fingerprints(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and ``_fp``, settled."""
    source = docs.select(*keep, F.col("text").cast("binary").alias("_bytes"))
    schema = T.StructType([*(f for f in source.schema if f.name != "_bytes"), T.StructField("_fp", T.LongType())])
    return settle(source.mapInArrow(_fingerprints, schema), "fingerprints")


def postings(prints: DataFrame) -> DataFrame:
    """(key, fp) for each distinct fingerprint and triple of places; the key holds the triple's number and its bytes."""
    byte = lambda k: F.shiftrightunsigned("fp", 8 * k).bitwiseAND(F.lit(255))
    keys = [
        F.lit(n << 24) + F.shiftleft(byte(a), 16) + F.shiftleft(byte(b), 8) + byte(c) for n, (a, b, c) in enumerate(place_triples())
    ]
    return prints.select("fp", F.explode(F.array(*(k.cast("long") for k in keys))).alias("key"))


def linked(own: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints of one posting list."""
    left, right = np.triu_indices(len(own), 1)
    x = own[left] ^ own[right]
    shared = np.zeros(len(x), dtype=np.uint8)  # the tally of shared positional bytes
    for k in range(8):
        shared += ((x >> np.uint64(8 * k)) & np.uint64(255)) == 0
    near = np.flatnonzero(shared >= 8 - BITS)
    near = near[np.bitwise_count(x[near]) <= BITS]
    root = list(range(len(own)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i, j in zip(left[near].tolist(), right[near].tolist(), strict=True):
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((i, j))
    return out


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key: links (a, b), and (a, null) for each fingerprint of a list that is too long."""

    def batch(pairs: list) -> pa.RecordBatch:
        a, b = zip(*pairs, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    key, held, long = None, np.empty(0, np.int64), False
    out: list = []

    def close() -> None:
        if not long and len(held) > 1:
            out.extend((int(held[i]), int(held[j])) for i, j in linked(held.view(np.uint64)))

    for b in batches:
        keys, prints = b.column("key").to_numpy(zero_copy_only=False), b.column("fp").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(keys)) + 1
        starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(keys)]))
        # a list of one that neither continues the last batch nor may go on in the next has no pairs
        open_ends = (ends - starts > 1) | (starts == 0) | (ends == len(keys))
        for lo, hi in zip(starts[open_ends].tolist(), ends[open_ends].tolist(), strict=True):
            if keys[lo] != key:
                close()
                key, held, long = keys[lo], np.empty(0, np.int64), False
            if long:
                out.extend((int(f), None) for f in prints[lo:hi])
                continue
            held = np.concatenate((held, prints[lo:hi]))
            if len(held) > LIST:
                out.extend((int(f), None) for f in held)
                held, long = np.empty(0, np.int64), True
        if out:
            yield batch(out)
            out = []
    close()
    if out:
        yield batch(out)


def _neighbours(crowded: DataFrame) -> DataFrame:
    """Links of the fingerprints of long lists, by common neighbours within two bits."""
    bit = [1 << k for k in range(64)]
    signed = lambda v: v - (1 << 64) if v >= 1 << 63 else v
    masks = [0, *bit, *(x | y for x, y in combinations(bit, 2))]
    mask = F.explode(F.lit([signed(m) for m in masks])).alias("mask")  # 2081, whatever the data
    named = crowded.select("fp", mask).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("near"))
    least = named.groupBy("near").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
    return named.join(least, "near").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def link_fingerprints(prints: DataFrame) -> DataFrame:
    """Edges (a, b) that connect whatever a chain of links connects, from distinct ``fp``."""
    dealt = postings(prints).repartition("key").sortWithinPartitions("key")
    found = settle(dealt.mapInArrow(_links, "a long, b long"), "links")
    crowded = found.where("b IS NULL").select(F.col("a").alias("fp")).distinct()
    edges = found.where("b IS NOT NULL")
    return edges.union(_neighbours(crowded)) if not crowded.isEmpty() else edges


def groups(prints: DataFrame) -> DataFrame:
    """``_fp``, ``root``, ``component_id`` and ``_n`` (its rows) for each distinct fingerprint of rows with ``doc_id`` and ``_fp``."""
    first = prints.groupBy("_fp").agg(F.min("doc_id").alias("_first"), F.count("*").alias("_n"))
    roots = components(link_fingerprints(first.select(F.col("_fp").alias("fp"))))
    linked_to = first.join(roots.withColumnRenamed("node", "_fp"), "_fp", "left")
    member = settle(linked_to.select("_fp", "_n", "_first", F.coalesce("root", "_fp").alias("root")), "members")
    ids = settle(member.groupBy("root").agg(F.min("_first").alias("component_id"), F.count("*").alias("_n")), "component-ids")
    # a component may hold a third of all fingerprints
    return meet(member.drop("_first"), ids.drop("_n"), "root", hot_keys(ids, "root", member.count()))


def grouped(prints: DataFrame) -> DataFrame:
    """``prints`` with ``root`` and ``component_id``; a fingerprint may be that of a third of all rows."""
    found = groups(prints)
    return meet(prints, found.drop("_n"), "_fp", hot_keys(found, "_fp", prints.count()))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint``, ``component_id`` for every row.

    Null and empty texts have fingerprint zero and link like any other. A null id takes part but is nobody's component
    id, unless no row of the component has an id: then it is null. Repeated rows each get a row. An empty table gives
    an empty table. Other columns are not read.
    """
    return grouped(fingerprints(docs, "doc_id")).select(
        "doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each component stays: the one with the least id, ties by row key. Columns as given, whatever their names."""
    carried = Carried(docs, "doc_id", "text")
    keyed = carried.frame.withColumn("_row", row_key(F.col("doc_id"), F.col("text")))
    rank = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("_row").alias("row"))
    stays = grouped(fingerprints(keyed, "doc_id", "_row")).groupBy("root").agg(F.min(rank).alias("r"))
    one = Window.partitionBy("_row").orderBy(F.lit(0))
    first = (
        keyed.join(stays.select(F.col("r.row").alias("_row")), "_row", "left_semi")
        .withColumn("_turn", F.row_number().over(one))
        .where("_turn = 1")
    )
    return carried.back(first)


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
