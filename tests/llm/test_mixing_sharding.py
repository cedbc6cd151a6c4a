"""The mix against SQL and a plain water filling; shards against their law."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from termloom.llm import mixing, queries, sharding
from termloom.runtime import settle, table
from tests import oracle

SMALL = "/root/testdata/sf0.001"


def plain_targets(sizes: dict) -> dict:
    """Shares by weight; whatever exceeds three times its source's words is dealt again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in free}
        target |= {s: 3.0 * sizes[s] for s in over}
        left -= sum(3.0 * sizes[s] for s in over)
        free -= over
    return target


def test_sql(spark):
    assert oracle.compare(spark, mixing.op5_mixing, queries.oracle_sql()["op5_mixing"], SMALL) == 200


def test_targets_and_takes(spark):
    docs = [(i, s, "w " * n) for i, (s, n) in enumerate([("a", 500), ("b", 10), ("b", 0), ("c", 3), (None, 7), (None, 2), ("é", 90), ("Z", 1)] * 9)]
    frame = spark.createDataFrame(docs, "doc_id long, source string, text string")
    got = mixing.plan_mix(frame).collect()
    sizes: dict = defaultdict(int)
    for _, s, t in docs:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t))
    want = plain_targets(dict(sizes))
    taken: dict = defaultdict(int)
    largest: dict = defaultdict(int)
    for r in got:
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-9)
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3 and len(r["positions"]) == r["copies"]
        assert r["positions"] == sorted(r["positions"]) and all(0 <= t <= 1 for t in r["positions"])
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert all(abs(taken[s] - want[s]) <= 1 + largest[s] / 2 for s in sizes)
    assert sum(want.values()) <= sum(sizes.values()) + 1e-6


def test_order_follows_the_schedule(spark):
    """Weight falls over time for the first weight class and rises for the third."""
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")).alias("source"), F.lit("w x y").alias("text")
    )
    rows = mixing.plan_mix(docs).select("source", F.explode("positions").alias("position")).collect()
    early = Counter(r["source"] for r in rows if r["position"] < 0.25)
    late = Counter(r["source"] for r in rows if r["position"] >= 0.75)
    assert early["a"] > 1.5 * late["a"] and late["c"] > 1.5 * early["c"] and abs(early["b"] - late["b"]) < 0.1 * early["b"]


def test_positions_invert_the_integrated_schedule(spark):
    """At time t a source has been asked for (t + g (t t - t)) of its target: so many of its words stand before t."""
    docs = table(spark, SMALL, "documents")
    order = sorted({r["source"] for r in docs.collect()}, key=lambda s: (s is None, s or ""))
    slope = {s: mixing.SLOPES[k % 3] for k, s in enumerate(order)}
    rows = mixing.plan_mix(docs).collect()
    for s in order:
        own = sorted((t, r["size"], r["target"]) for r in rows if r["source"] == s for t in r["positions"])
        before = 0
        for t, size, target in own:
            assert math.isclose((t + slope[s] * (t * t - t)) * target, before, rel_tol=1e-6, abs_tol=1e-3)
            before += size


def test_mix_gives_whole_copies(spark):
    docs = table(spark, SMALL, "documents")
    planned = {r["doc_id"]: r for r in mixing.plan_mix(docs).collect()}
    mixed = mixing.mix(docs)
    assert mixed.schema == docs.schema
    rows = mixed.collect()
    assert Counter(r["doc_id"] for r in rows) == Counter({k: r["copies"] for k, r in planned.items() if r["copies"]})
    # what op5 says is taken are the words of the mix's rows, source by source and document by document
    words: dict = defaultdict(int)
    for r in rows:
        words[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    assert {r["doc_id"]: r["taken"] for r in mixing.op5_mixing(spark, SMALL).collect()} == {k: words.get(k, 0) for k in planned}


def test_shards_keep_the_training_order(spark):
    mixed = mixing.mix(table(spark, SMALL, "documents"))
    want = [r["doc_id"] for r in mixed.collect()]
    read = settle(mixed, "mixed")
    rows = sorted(sharding.shard_in_order(read).collect(), key=lambda r: r["position"])
    assert [r["doc_id"] for r in rows] == want and [r["position"] for r in rows] == list(range(len(want)))
    assert sorted(r["shard"] + 16 * r["slot"] for r in rows) == list(range(len(rows)))
    places = spark.range(len(want)).select(sharding.feistel(F.col("id"), F.lit(len(want)).cast("long"), 20_240_601).alias("p"))
    assert [r["shard"] + 16 * r["slot"] for r in rows] == [r["p"] for r in places.collect()]
    assert sharding.shard_in_order(read.where("false")).count() == 0
    wide = settle(mixed.selectExpr("*", "1 AS _file", "2 AS position", "3 AS _start", "4 AS _row_"), "mixed")
    assert sorted(sharding.shard_in_order(wide).columns) == sorted([*wide.columns, "shard", "slot"])


def test_rows_law(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    copies = docs.union(spark.createDataFrame([(None, None), (None, ""), (5, "x"), (5, "x")], "doc_id long, text string"))
    a = sharding.shard_documents(copies).collect()
    b = sharding.shard_documents(copies.repartition(7)).collect()
    slots = defaultdict(list)
    for r in a:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(16))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    place = lambda rows: Counter((r["doc_id"], r["text"], r["shard"], r["slot"]) for r in rows)
    assert place(a) == place(b)


def test_feistel_is_a_permutation(spark):
    for n in (1, 2, 3, 10, 101, 4097):
        x = spark.range(n).select(sharding.feistel(F.col("id"), F.lit(n).cast("long"), 9).alias("p"))
        assert sorted(r["p"] for r in x.collect()) == list(range(n))


def test_op6_columns(spark):
    import zlib

    rows = {r["doc_id"]: r for r in sharding.op6_sharding(spark, SMALL).collect()}
    for d in table(spark, SMALL, "documents").collect():
        raw = (d["text"] or "").encode()
        assert rows[d["doc_id"]]["size"] == len(raw) + 1 and rows[d["doc_id"]]["text_crc32"] == zlib.crc32(raw)
