"""SimHash groups against all pairs, long posting lists included."""

from __future__ import annotations

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from termloom.llm import components, simhash
from termloom.runtime import table


def plain_fingerprint(text: str | None) -> int:
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def plain_groups(prints: np.ndarray) -> list[int]:
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= 4).tolist():
            a, b = find(i), find(i + 1 + j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_triples_meet_every_four_places():
    from itertools import combinations

    triples = simhash.place_triples()
    assert len(triples) == 20
    assert all(any(set(t) <= set(four) for t in triples) for four in combinations(range(8), 4))


def test_against_all_pairs(spark):
    r = random.Random(1)
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    texts = {x["doc_id"]: x["text"] for x in docs.collect()}
    more = []
    for k, i in enumerate(r.sample(sorted(texts), 150)):  # near copies at every distance
        words = (texts[i] or "").split(" ")
        for _ in range(r.randint(0, 4)):
            words[r.randrange(len(words))] = "changed"
        more.append((100_000 + k, " ".join(words)))
    whole = docs.union(spark.createDataFrame([*more, (200_000, None), (200_001, " ")], "doc_id long, text string"))
    got = {x["doc_id"]: (x["fingerprint"], x["component_id"]) for x in simhash.near_duplicates(whole).collect()}
    rows = sorted((x["doc_id"], x["text"]) for x in whole.collect() if x["doc_id"] is not None)
    prints = np.array([plain_fingerprint(t) for _, t in rows], dtype=np.uint64)
    groups = plain_groups(prints)
    for k, (i, _) in enumerate(rows):
        assert got[i] == (f"{int(prints[k]):016x}", rows[groups[k]][0])
    assert len(set(groups)) < len(rows) - 150
    kept = {x["doc_id"] for x in simhash.drop_near_duplicates(whole).collect()}
    assert kept == {rows[g][0] for g in groups}


def test_long_lists_lose_no_link(spark):
    """More fingerprints than a list may have share three bytes; some lie four bits apart."""
    r = random.Random(2)
    prints = {r.getrandbits(40) << 24 | 0xABCDEF for _ in range(simhash.LIST + 300)}
    for p in r.sample(sorted(prints), 200):
        for _ in range(r.randint(1, 4)):
            p ^= 1 << r.randrange(64)
        prints.add(p)
    own = np.array(sorted(prints), dtype=np.uint64)
    frame = spark.createDataFrame([(int(p),) for p in own.view(np.int64)], "fp long")
    edges = simhash.link_fingerprints(frame)
    roots = {x["node"]: x["root"] for x in components.components(edges).collect()}
    groups = plain_groups(own)
    want = {}
    for k, g in enumerate(groups):
        want.setdefault(g, set()).add(int(own.view(np.int64)[k]))
    for members in want.values():
        assert len({roots.get(m, m) for m in members}) == 1
    assert len({roots.get(int(p), int(p)) for p in own.view(np.int64)}) == len(want)


def test_components_of_chains(spark):
    pairs = [(i, i + 1) for i in range(300)] + [(1000 + i, 2000) for i in range(50)]
    got = {x["node"]: x["root"] for x in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(301)) and got[2000] == 1000
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_component_of_rows_without_ids(docs):
    got = simhash.near_duplicates(docs([(None, "a b c d"), (None, "a b c d"), (7, "e f g h i")])).orderBy(F.col("doc_id")).collect()
    assert [x["component_id"] for x in got] == [None, None, 7]
