"""Decontamination against a plain search for every window."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np

from termloom.llm import decontamination as D
from termloom.llm import queries
from termloom.runtime import table
from tests import oracle


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain(docs, items):
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    lengths = {len(k) for k in windows}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                own = windows.get(tuple(w[i : i + n]))
                if own:
                    hit |= set(range(i, i + n))
                    found |= own
        listed = sorted(str(f) for f in found if f is not None)
        out.append((doc, len(w), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)))
    return out


def test_against_every_window(spark):
    r = random.Random(3)
    items = [(x["item_id"], x["text"]) for x in table(spark, "/root/testdata/sf0.01", "benchmark").collect()]
    items += [(900, "One-two: three"), (901, items[0][1]), (902, None), (903, " . "), (904, "zz"), (905, "die die die die die die die die die die die die")]
    docs = [(x["doc_id"], x["text"]) for x in table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect()]
    for k in range(200):  # pieces of items of 8 to 14 words, cased and pointed anew, among other words
        w = words(r.choice(items)[1] or "")
        n, at = r.randint(8, 14), r.randrange(max(1, len(w) - 8))
        piece = r.choice([", ", " ", "\n- "]).join(x.upper() if r.random() < 0.3 else x for x in w[at : at + n])
        docs.append((50_000 + k, f"{'left ' * r.randint(0, 3)}{piece}{' right' * r.randint(0, 3)} {piece if r.random() < 0.3 else ''}"))
    docs += [(60_000, None), (60_001, ""), (60_002, "die " * 30), (60_003, "one TWO three zz")]
    got = D.decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string"), "doc_id"
    )
    want = plain(docs, items)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sum(x[5] for x in want) > 100


def test_sql(spark):
    assert oracle.compare(spark, D.op8_decontamination, queries.oracle_sql()["op8_decontamination"], "/root/testdata/sf0.001") > 100


def test_winnowing_keeps_a_place_in_every_window():
    g = np.random.default_rng(1).integers(0, 9, 4000)
    kept = set(D.winnow(g).tolist())
    assert all(kept & set(range(i, i + D.KEPT_OF)) for i in range(len(g) - D.KEPT_OF + 1))


def test_leaking_rows_go(docs, spark):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k l")], "item_id long, text string")
    rows = [(1, "x b c d e f g h i j k y"), (2, "a b c d e"), (3, None), (4, "b c d e f g h i j x k")]
    assert {r["doc_id"] for r in D.drop_contaminated(docs(rows), items).collect()} == {2, 3, 4}
