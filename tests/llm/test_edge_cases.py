"""Nulls anywhere, empty and very long texts, ties, repeated rows, empty tables, clashing extra columns: for every operator."""

from __future__ import annotations

import pytest

from termloom.llm import decontamination, extraction, language_model, mixing, quality, sharding, simhash, substring_dedup, tokens, toxicity

LONG = "Alpha beta gamma delta epsilon zeta eta theta iota kappa. " * 20_000
ROWS = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, LONG, None, None, None),
    (3, LONG, None, None, None),
    (None, "one two three four five six", "de", "b", 27),
    (None, None, None, None, None),
    (4, "one two three four five six", "de", "b", 27),
    (5, " \t\n ", "fr", "c", 4),
    (6, "naïve 文字 \U0001f600 " * 30, "fr", "c", 9),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ITEMS = [(1, "one two three four five six"), (2, None), (None, "x y"), (3, "")]
LABELS = [(1, 1, 0), (3, 0, 1), (4, None, 1), (None, 1, 1), (6, 1, None), (4, 1, 0)]
CLASHES = "score Predicted size shard slot n_words N_Tokens n_bytes over_limit text_crc32 taken position kept root _fp _rid _k _bytes _key _bucket _row _turn _digest found n_removed n_sentences quality _c0".split()


@pytest.fixture(scope="module")
def side(spark):
    return {
        "benchmark": spark.createDataFrame(ITEMS, "item_id long, text string"),
        "labels": spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int"),
    }


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


OPERATORS = {
    "substring": lambda d, s: substring_dedup.dedup_substrings(d),
    "language": lambda d, s: language_model.score_documents(d),
    "simhash": lambda d, s: simhash.near_duplicates(d),
    "mixing": lambda d, s: mixing.plan_mix(d),
    "sharding": lambda d, s: sharding.shard_documents(d),
    "tokens": lambda d, s: tokens.count_tokens(d, tokenizer()),
    "decontamination": lambda d, s: decontamination.decontaminate(d, s["benchmark"], *[c for c in d.columns if c != "text"]),
    "toxicity": lambda d, s: toxicity.score_toxicity(d, toxicity.train(d, s["labels"])),
    "quality": lambda d, s: quality.judge_quality(d),
}
SAME_COLUMNS = {
    "simhash": lambda d, s: simhash.drop_near_duplicates(d),
    "decontamination": lambda d, s: decontamination.drop_contaminated(d, s["benchmark"]),
    "toxicity": lambda d, s: toxicity.drop_toxic(d, toxicity.train(d, s["labels"])),
    "mixing": lambda d, s: mixing.mix(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_once(docs, side, name):
    out = OPERATORS[name](docs(ROWS, SCHEMA), side)
    assert out.count() == len(ROWS)
    ids = sorted((r["doc_id"] for r in out.select("doc_id").collect()), key=lambda v: (v is None, v or 0))
    assert ids == sorted((r[0] for r in ROWS), key=lambda v: (v is None, v or 0))


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs, side, name):
    full = OPERATORS[name](docs(ROWS, SCHEMA), side)
    empty = OPERATORS[name](docs([], SCHEMA), side)
    assert empty.count() == 0 and empty.columns == full.columns


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns(spark, docs, side, name):
    wide = docs([(*r, *("x" for _ in CLASHES)) for r in ROWS], ", ".join([SCHEMA, *(f"{c} string" for c in CLASHES)]))
    out = OPERATORS[name](wide, side)
    plain = OPERATORS[name](docs(ROWS, SCHEMA), side)
    lower = [c.lower() for c in out.columns]
    assert len(set(lower)) == len(lower)
    assert out.count() == len(ROWS)
    own = [c for c in plain.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    assert set(c.lower() for c in own) <= set(lower)
    kinds = dict(plain.dtypes)
    assert all(dict(out.dtypes)[c] == kinds[c] for c in own)


@pytest.mark.parametrize("name", SAME_COLUMNS)
def test_filters_return_the_columns_given(docs, side, name):
    wide = docs([(*r, *("x" for _ in CLASHES)) for r in ROWS], ", ".join([SCHEMA, *(f"{c} string" for c in CLASHES)]))
    out = SAME_COLUMNS[name](wide, side)
    assert out.schema == wide.schema
    assert all(r["score"] == "x" and r["_c0"] == "x" for r in out.collect())
    assert SAME_COLUMNS[name](docs([], SCHEMA), side).count() == 0


def test_pages(spark):
    trees = extraction.boost(*_tiny())
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>a &amp; b"), (3, "u", "<" * 2000), (3, "u", "<p>" + "word " * 100_000), (4, "u", "\0<p>x</p>")]
    out = extraction.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), trees)
    got = out.collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    wide = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, TEXT string, _c0 string")
    assert extraction.extract_pages(wide, trees).columns == ["page_id", "url", "html", "_c0", "text", "n_chars"]
    assert extraction.extract_pages(wide.where("false"), trees).count() == 0


def _tiny():
    import numpy as np

    x = np.stack([extraction.node_features(extraction.parse(f"<nav>{'a' * k}</nav><p>{'b ' * k}</p>"))[0][1] for k in range(1, 40)])
    return x, (np.arange(len(x)) % 2).astype(float), np.ones(len(x))


def test_no_benchmark_and_no_labels(spark, docs):
    d = docs(ROWS, SCHEMA)
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r["contaminated"] for r in decontamination.decontaminate(d, none, "doc_id").collect())
    model = toxicity.train(d, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {r["predicted"] for r in toxicity.score_toxicity(d, model).collect()} == {0}
