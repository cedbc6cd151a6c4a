"""Token counts against the library; the cache is filled once."""

from __future__ import annotations

import pandas as pd
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from termloom.llm import tokens
from termloom.runtime import scratch_dir, scratch_path, table

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = tokens.Counter(PATH)


def count(text: str) -> int:
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="aZé ß'’sdtllve.,-–0²9\n\t\r   <|endoftext|>€­\x1c\x85", max_size=80)))
def test_any_text(text):
    assert COUNTER.count(text) == count(text)


def test_documents(spark):
    special = [(10**6, "a<|endoftext|>b"), (10**6 + 1, None), (10**6 + 2, ""), (10**6 + 3, "don't DON'T I'll  x \n\n y"), (10**6 + 4, "文字" * 500)]
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").union(spark.createDataFrame(special, "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = tokens.count_tokens(docs, PATH).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = count(texts[r["doc_id"]])
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 512)


def test_cache_encodes_each_text_once(spark, docs):
    cache = scratch_path(spark, "tokens-test")
    first = docs([(1, "some text"), (2, "some text"), (3, "more")])
    tokens.count_tokens(first, PATH, cache).collect()
    assert spark.read.parquet(cache).count() == 2
    again = tokens.count_tokens(first.union(docs([(4, "new")])), PATH, cache)
    assert spark.read.parquet(cache).count() == 3
    assert again.count() == 4


def test_the_query_encodes_nothing_twice(spark):
    """A second run of the query finds every digest in the cache: it appends no row, and gives the same rows."""
    cache = f"{scratch_dir(spark)}/termloom-token-cache"
    first = sorted(map(tuple, tokens.op7_token_counts(spark, "/root/testdata/sf0.001").collect()))
    rows = spark.read.parquet(cache).count()
    second = sorted(map(tuple, tokens.op7_token_counts(spark, "/root/testdata/sf0.001").collect()))
    assert second == first and spark.read.parquet(cache).count() == rows > 0
    assert tokens.fill_cache(table(spark, "/root/testdata/sf0.001", "documents"), cache, PATH) is None and spark.read.parquet(cache).count() == rows


def test_tasks_of_a_worker_share_one_counter(monkeypatch):
    """A worker loads the tokenizer once: its memory does not grow with its tasks."""
    made = []

    class Noted(tokens.Counter):
        def __init__(self, path):
            made.append(path)
            super().__init__(path)

    monkeypatch.setattr(tokens, "Counter", Noted)
    for words in (["some text", "more"], ["some text", "other words"]):
        batch = pd.DataFrame({"content_digest": words, "text": words})
        (out,) = tokens._encode(PATH, "digest of this test")(iter([batch]))
        assert out["n_tokens"].tolist() == [count(t) for t in words]
    assert made == [PATH]


def test_few_files_from_many_tasks(spark):
    """One append of the cache writes a file a core at most, whatever the number of shuffle partitions."""
    cache, cores = scratch_path(spark, "tokens-test"), spark.sparkContext.defaultParallelism
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", 4 * cores)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tokens.fill_cache(spark.range(400).selectExpr("concat('words of ', id) AS text"), cache, PATH)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    stored = spark.read.parquet(cache)
    assert len(stored.inputFiles()) <= cores and stored.count() == 400


def test_a_hot_text(spark):
    """A text that most rows have is dealt over tasks; every row gets its count."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "if(id % 10 < 8, 'the same words', concat('words of ', id)) AS text")
    rows = tokens.count_tokens(docs, PATH, scratch_path(spark, "tokens-test")).collect()
    assert len(rows) == 3000 and all(r["n_tokens"] == count(r["text"]) for r in rows)


def test_other_kinds_of_tokenizers_go_to_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    other = tokens.Counter(path)
    assert not other.by_pieces
    assert other.count("Hello there World") == len(Tokenizer.from_file(path).encode("Hello there World", add_special_tokens=False).ids)
