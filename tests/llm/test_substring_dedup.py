"""Substring dedup against one pass over all texts in order; planted passages."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from termloom.llm import substring_dedup as S
from termloom.runtime import table


def plain(rows: list[tuple]) -> dict:
    """Ids to what stays, by first places in the order of ids; for distinct ids."""
    first: dict = {}
    out = {}
    for i, text in sorted(rows):
        raw = (text or "").encode()
        words, starts = S.sentences(raw)
        gone = [False] * len(words)
        for k in range(len(starts) - 1):
            end = k + S.SPAN
            while end < len(starts) and starts[end] - starts[k] < S.LEAST:
                end += 1
            if end < len(starts):
                key = b" ".join(words[starts[k] : starts[end]]), tuple(s - starts[k] for s in starts[k : end + 1])
                if first.setdefault(key, (i, k)) != (i, k):
                    gone[starts[k] : starts[end]] = [True] * (starts[end] - starts[k])
        out[i] = [w for w, g in zip(words, gone, strict=True) if not g]
    return out


def test_against_one_pass(spark, docs):
    frame = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").union(docs([(10**6, None), (10**6 + 1, "")]))
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    want = plain(rows)
    removed = 0
    texts = dict(rows)
    for r in S.dedup_substrings(frame).collect():
        assert r["text"].encode().lower().split() == want[r["doc_id"]], r["doc_id"]
        assert r["n_words"] - r["n_words_removed"] == len(want[r["doc_id"]])
        removed += r["n_removed"]
        if not r["n_removed"]:
            assert r["text"] == (texts[r["doc_id"]] or "")
    assert removed > 1000


def test_groups_of_rows_meet(docs):
    """Rows dealt over many tasks, so that first places are found between their groups."""
    r = random.Random(10)
    lines = [prose(r, 30) for _ in range(60)]
    rows = [((i * 7919) % 1009 - 500, "\n".join(r.choices(lines, k=5))) for i in range(300)]
    want = plain(rows)
    for x in S.dedup_substrings(docs(rows, parts=40)).collect():
        assert x["text"].lower().split() == [w.decode() for w in want[x["doc_id"]]]


def prose(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choice("abcdefghij") for _ in range(6)) + ("." if r.random() < 0.08 else "") for _ in range(n))


def test_passages_spliced_anywhere(docs):
    """A passage between other words, cased and spaced anew, stays in its first place and goes, but for its edges, from others."""
    r = random.Random(5)
    passage = prose(r, 60)
    rows, clean = [], []
    for i in range(40):
        own = prose(r, 200).split(" ")
        at = r.randrange(200)
        if i % 4 == 0:
            clean.append(i)
            rows.append((i, " ".join(own)))
        else:
            own[at:at] = [passage.upper() if i % 3 else passage.replace(" ", "  ")]
            rows.append((i, " ".join(own)))
    out = {x["doc_id"]: x for x in S.dedup_substrings(docs(rows)).collect()}
    for i, text in rows:
        if i in clean or i == 1:
            assert out[i]["text"] == text
        else:
            left = set(re.findall(r"\S+", out[i]["text"].lower())) & set(passage.split(" "))
            assert len(left) <= 14 and out[i]["n_words_removed"] <= 60


def test_copies_and_repeats(docs):
    r = random.Random(6)
    text, other = prose(r, 80), prose(r, 80)
    rows = [(1, text), (2, text), (2, text), (3, f"{other}\n{other}"), (4, "too short")]
    out = sorted((x["doc_id"], x["text"]) for x in S.dedup_substrings(docs(rows)).collect())
    assert out[0] == (1, text) and out[-1] == (4, "too short")
    assert out[1][1] == out[2][1] and len(out[1][1].split()) < 20
    assert 80 <= len(out[3][1].split()) < 100


def test_repeated_rows_lose_all_but_one(docs):
    text = prose(random.Random(7), 90)
    out = [len(x["text"].split()) for x in S.dedup_substrings(docs([(1, text)] * 3)).collect()]
    assert max(out) == 90 and sorted(out)[1] < 20


def test_sentences_are_the_whole_text():
    r = random.Random(8)
    for n in (0, 1, 2, 30, 500):
        raw = (prose(r, n) if n else " \n ").encode()
        words, starts = S.sentences(raw)
        assert words == raw.lower().split() and starts[0] == 0 and starts[-1] == len(words)
        assert all(a < b for a, b in zip(starts[:-1], starts[1:], strict=True))
        assert S.cut(raw, [])[0] == raw


def short_sentences(r: random.Random, lengths: list[int], end_mark: bool) -> str:
    """A passage of whole sentences of so many words."""
    words = [["".join(r.choice("klmnopqrst") for _ in range(7)) for _ in range(n)] for n in lengths]
    text = ". ".join(" ".join(w) for w in words)
    return text + "." if end_mark else text


def test_passages_of_short_sentences(docs):
    """Passages of four or five sentences of 10 to 14 words, alone in one document and spliced mid-sentence in another."""
    r = random.Random(9)
    rows, passages = [], {}
    for k in range(200):
        passage = short_sentences(r, [r.randrange(10, 15) for _ in range(r.choice((4, 5)))], k % 2 == 0)
        own = prose(r, 80).split(" ")
        at = r.randrange(5, 75)
        if own[at - 1].endswith("."):  # spliced mid-sentence
            own[at - 1] = own[at - 1][:-1]
        rows += [(2 * k, passage), (2 * k + 1, " ".join([*own[:at], passage, *own[at:]]))]
        passages[2 * k + 1] = passage.split(" ")
    out = {x["doc_id"]: x for x in S.dedup_substrings(docs(rows)).collect()}
    left = {i: len(set(out[i]["text"].split()) & set(p)) for i, p in passages.items()}
    print("words left of", sum(map(len, passages.values())), ":", sum(left.values()), "at most", max(left.values()))
    assert all(out[2 * k]["text"] == rows[2 * k][1] for k in range(200))
    assert all(left[i] <= 30 for i in left) and sum(left.values()) <= 0.15 * sum(map(len, passages.values()))


def test_packed_places_come_back():
    """Packed places come back as they were."""
    g = np.random.default_rng(4)
    h = np.sort(g.integers(0, 1 << 63, 999, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    rest = [g.integers(-(1 << 63), 1 << 63, 999), *(g.integers(0, 1 << 32, 999, dtype=np.uint32) for _ in range(4))]
    for want, got in zip((h, *rest), S.unpack(S.pack(h, *rest), 999), strict=True):
        assert (want == got).all()


def test_runs_of_one_hash_and_unlike_bits_are_unlike():
    """Two runs agree in 64 bits and differ in the other 32; the third is the first's copy."""
    h = np.array([7, 7, 7, 9], dtype=np.uint64)
    n, at = np.full(4, 4), np.arange(4) * 2
    packed = S.pack(h, np.array([10, 20, 30, 40]) - np.arange(4), at, np.zeros(4), n, np.array([1, 2, 1, 1]))
    bucket = S.pa.table({"bucket": [0], "base": [100], "size": [4], "packed": [packed]})
    assert S._meet(bucket).to_pylist() == [{"rid": 102, "i": 0, "n": 4}]


def test_other_ids(spark, docs):
    text = "one two three four five. six seven eight nine ten. eleven twelve thirteen. fourteen fifteen sixteen."
    short = docs([(1, text), (2, text)], "doc_id int, text string")
    first, second = sorted(S.dedup_substrings(short).collect(), key=lambda r: r["doc_id"])
    assert first["n_removed"] == 0 and second["n_removed"] == second["n_sentences"] > 3 and second["text"] == ""
    with pytest.raises(TypeError):
        S.dedup_substrings(docs([("a", text)], "doc_id string, text string"))
