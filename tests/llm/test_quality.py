"""The counted columns against plain Python; weak supervision on planted junk."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np

from termloom.llm import quality
from termloom.runtime import table


def plain(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(grams)
    inside = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), n < 10 or 100 * len(inside) > 20 * n


def test_counts(spark, docs):
    extra = [(900_000, None), (900_001, ""), (900_002, "a b c d e a b c d e"), (900_003, "a a a a a a"), (900_004, "x\nx\n\n x\nx"), (900_005, "né\x0b\x1c é b c"), (900_006, "p q r s t u p q r s t")]
    frame = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").union(docs(extra))
    texts = {r["doc_id"]: r["text"] for r in frame.collect()}
    for r in quality.judge_quality(frame).collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == plain(texts[r["doc_id"]]), r["doc_id"]
        assert not (r["kept"] and r["base_failed"])
        assert (r["quality"] is not None) or r["base_failed"]


def test_em_tells_junk_from_text():
    good, bad = (1,) * 8, (-1, -1, 1, -1, -1, -1, 0, 1)
    share, right = quality.fit([(good, 9000), (bad, 500), ((1, 1, 1, 1, 1, 1, 0, 1), 300)])
    assert quality.posterior(good, share, right) > 0.9 > 0.5 > quality.posterior(bad, share, right)
    assert quality.posterior((0,) * 8, share, right) > 0.5
    assert quality.fit([])[0] > 0.5


def plain_em(votes: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Dawid and Skene's EM over single texts, for rules that vote 1 or -1 or abstain, with the module's stated pseudo-votes and bounds."""
    good = np.where((votes < 0).any(axis=1), 0.02, 0.998)
    for _ in range(rounds):
        share = np.clip((good.sum() + 9) / (len(votes) + 10), 0.5, 0.98)
        said, yes, no = votes != 0, votes > 0, votes < 0
        a = (good @ yes + 9.8) / (good @ said + 10)
        b = ((1 - good) @ no + 4) / ((1 - good) @ said + 10)
        a = np.clip(a, 0.6, 0.998)
        b = np.minimum(0.95, np.maximum(1.02 - a, b))
        odds = np.log(share / (1 - share)) + yes @ np.log(a / (1 - b)) + no @ np.log((1 - a) / b)
        good = 1 / (1 + np.exp(-odds))
    return good


def test_posteriors_are_those_of_plain_em():
    g = np.random.default_rng(4)
    good = g.random(3000) < 0.85
    votes = np.where(g.random((3000, 8)) < 0.1, 0, np.where(g.random((3000, 8)) < np.where(good, 0.95, 0.3)[:, None], 1, -1))
    counted = Counter(map(tuple, votes.tolist()))
    share, right = quality.fit(list(counted.items()))
    own = np.array([quality.posterior(tuple(v), share, right) for v in votes.tolist()])
    assert np.allclose(own, plain_em(votes), atol=1e-6)
    assert abs(share - good.mean()) < 0.03 and all(abs(a - 0.95) < 0.03 and abs(b - 0.7) < 0.06 for a, b in right)
    assert ((own > 0.5) == good).mean() > 0.98


def test_plain_expressions_only(spark):
    plan = quality.op10_quality(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
