"""The rules over plain lists, and chunks made in Arrow batches, against the column forms on random and odd texts."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from termloom.functions import plain
from termloom.operators import sentences as S
from termloom.operators.occurrences import chunk_rows, token_rows
from termloom.plans import catalog, catalog_more, chunking

WORDS = """the of in to on and is was had been be made using coated built up , . ; ? 3 3.5 1,000 x9 Red glass method Fig figure more most such said e.g. others glass dress uses
building of, said: end! end... a.b ed ing Ous fastest nearly useful von der des Haus system & <b> a>b É ΣΑΣ İx ﬁne 文字 a\xa0b a\x1cb 7  9.\x85 tail.  ~x a~.~ \b. x\x0by \r .\r \f""".split(" ")
RETAG = catalog_more._RETAG


def odd_texts() -> list[str | None]:
    r = random.Random(5)
    made = ["\n".join(" ".join(r.choices(WORDS, k=r.randint(0, 40))) for _ in range(r.randint(1, 5))) for _ in range(250)]
    long = "word . " * 1428
    edges = [None, "", "\n", " \n ", "a. ", " .", "..", "A.B. c", f"{long}tail", f"{long}the tail", f"{long}the tail\nred glass", "é" * 9_000 + " is glass\nfast", "\rred glass\r\nof stone\f", "x.\ty!\x0bz?"]
    return [*edges, *made, " ".join(r.choices(WORDS, k=3000))]


@pytest.fixture(scope="module")
def docs(spark):
    rows = list(enumerate(odd_texts()))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()


def columns_of(docs):
    return S.sentences_of(S.title_sections(S.lines_of(docs)))


def same(a, b, *columns):
    rows = lambda f: sorted(map(tuple, f.select(*columns).collect()), key=repr)
    one, two = rows(a), rows(b)
    assert len(one) > 100
    for x, y in zip(one, two, strict=True):
        assert x == y


def test_sentences_and_tags(docs):
    want = {(r["doc_id"], r["sent_id"]): (r["section"], r["sent_in_section"], [tuple(t) for t in r["toks"]]) for r in columns_of(docs).collect()}
    lexer, got = plain.Lexer(), {}
    lexer.MOST = 50  # all is forgotten again and again
    for k, text in enumerate(odd_texts()):
        for s in lexer.sentences((text or "").encode()):
            got[k, s.sent_id] = (s.section, s.in_section, [(w.tok, w.lc, w.tag) for w in s.words])
    assert got == want and len(got) > 1000


def test_sentences_and_tokens_in_batches(docs):
    columns = "doc_id", "sent_id", "section", "sent_in_section"
    same(S.document_sentences(docs), columns_of(docs), *columns, "toks")
    same(S.document_tokens(docs).withColumnRenamed("tokens", "t"), columns_of(docs).withColumn("t", F.col("toks.tok")), *columns, "t")
    exploded = columns_of(docs).select("doc_id", "sent_id", F.size("toks").alias("n"), F.posexplode("toks").alias("i", "t")).select("doc_id", "sent_id", "i", "n", "t.lc", "t.tag")
    same(token_rows(docs), exploded, "doc_id", "sent_id", "i", "n", "lc", "tag")


@pytest.mark.parametrize("name", sorted(n for n, s in chunking.SCHEMAS.items() if s.islands_ok()))
def test_islands_of_counted_tokens(docs, name):
    made = chunking.islands(token_rows(docs), chunking.SCHEMAS[name], "doc_id", "sent_id")
    same(made, chunk_rows(docs, name, "sent_id", "cs", "ce"), "doc_id", "sent_id", "cs", "ce")


def test_islands_shuffle_only_what_may_stand_in_a_chunk(docs):
    plan = chunking.islands(token_rows(docs), chunking.SCHEMAS["en"], "doc_id", "sent_id")._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and plan.count("Exchange hash") == 1 and plan.index("Exchange hash") < plan.rindex("Filter") < plan.index("MapInArrow")


def test_kept_words_are_bounded():
    lexer = plain.Lexer()
    lexer.MOST = 10
    text = " ".join(["a" * k for k in range(1, 120)]) + " end."
    (s,) = lexer.sentences(text.encode())
    assert len(s.words) == 121 and len(lexer.words) <= 10 and max(map(len, lexer.words)) <= lexer.LONGEST


@pytest.mark.parametrize("schema", sorted(chunking.SCHEMAS))
def test_chunks(docs, schema):
    columns = "sent_id", "section", "sent_in_section", "cs", "ce", "phrase", "term", "tag_sig"
    same(chunk_rows(docs, schema, *columns), S.chunks_of(columns_of(docs), schema), "doc_id", *columns)


@pytest.mark.parametrize("language", ["en", "de", "cn"])
def test_features(docs, language):
    names = RETAG.get(language, {})
    sents = columns_of(docs)
    if names:
        pairs = F.create_map(*(F.lit(x) for p in names.items() for x in p))
        tag = lambda t: F.struct(t["tok"].alias("tok"), t["lc"].alias("lc"), F.coalesce(F.get(F.array(pairs[t["tag"]]), F.lit(0)), t["tag"]).alias("tag"))
        sents = sents.withColumn("toks", F.transform("toks", tag))
    want = S.feature_rows(S.chunks_of(S.with_verbs(sents) if language == "en" else sents, language), language)
    got = chunk_rows(docs, language, "sent_id", "cs", "term", "features", language=language, retag=names)
    same(got, want.withColumn("features", F.array_join("features", "\t")), "doc_id", "sent_id", "cs", "term", "features")


def test_one_feature(docs):
    want = S.feature_rows(S.chunks_of(columns_of(docs), "en"), "en", ["prev_Npr"]).where(F.size("features") > 0)
    got = chunk_rows(docs, "en", "sent_id", "cs", "value", names=["prev_Npr"])
    same(got, want.withColumn("value", F.substring(F.element_at("features", 1), 10, 10_000)), "doc_id", "sent_id", "cs", "value")


def test_candidates_and_marked_sentences(docs):
    chunks = S.chunks_of(S.title_nouns(columns_of(docs)), "en").withColumn("marked", S.highlight(F.col("toks"), F.col("cs"), F.col("ce")))
    got = chunk_rows(docs, "en", "ordinal", "leads", "term", "marked").withColumn("uid", F.concat_ws("_", "doc_id", "ordinal"))
    same(got, S.candidates(chunks, False), "uid", "term", "marked")
    same(got.where("leads"), S.candidates(chunks, True), "uid", "term")


def test_other_columns_and_large_documents(spark):
    """Columns pass whatever their type; a document's chunks go on in as many batches as it takes."""
    rows = [({"a": 1}, None, "red glass of stone . " * 30_000), ({"b": 2}, 3, "wood")]
    frame = spark.createDataFrame(rows, "m map<string, int>, n int, body string").withColumn("body", F.regexp_replace("body", r"((?:\S+ ){400})", "$1\n"))
    made = chunk_rows(frame, "en", "term", body="body")
    assert made.columns == ["m", "n", "term"]
    assert {(tuple(r["m"].items()), r["n"], r["term"], r["k"]) for r in made.groupBy(F.map_entries("m").alias("e"), "n", "term").agg(F.count("*").alias("k"), F.any_value("m").alias("m")).collect()} == {
        ((("a", 1),), None, "red glass", 30_000), ((("a", 1),), None, "stone", 30_000), ((("b", 2),), 3, "wood", 1),
    }


@pytest.mark.parametrize("name", [
    "features_english", "highlighted_terms", "features_prev_v", "features_prev_vnp", "features_prev_npr", "features_cn", "features_basic", "features_de", "title_noun_filter", "feature_lines",
    "chunks_en", "chunks_en_w_of", "chunks_en_w_lists", "chunks_de", "chunks_en_w_verbs", "features_prev_jpr", "chunks_cn", "type_token_counts", "chunks_en_w_of_org",
])
def test_no_expression_tree_is_walked_for_each_token(spark, name):
    """Before, these queries took most of their time in lambdas of columns, and some sorted every chunk to number it."""
    plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "lambda" not in plan
    assert name == "type_token_counts" or "Exchange" not in plan
