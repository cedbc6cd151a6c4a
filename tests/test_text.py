"""Cleaning, segmenter input, sentence assembly and rendering."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from termloom.functions import tagging, text
from termloom.operators import segmenting
from termloom.operators import sentences as S
from termloom.sources import sinks


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "value, f, want",
    [
        ("aaa", lambda c: text.find_offsets(c, "aa"), [0, 1]),
        ("", lambda c: text.find_offsets(c, "aa"), []),
        ("Foo™ bar", text.remove_trademark, "Foo bar"),
        ("see<figref>1</figref>b", lambda c: text.space_tag(c, "figref", " "), "see <figref>1</figref> b"),
        ('see<figref idref="a">1</figref>.', lambda c: text.space_tag(c, "figref", " "), 'see<figref idref="a">1</figref>.'),
        ("\n\fa~b\bc\r\n", text.fix_line, "abc"),
        ("x" * 10_001, text.keep_line, False),
        ("naïve", text.is_latin1, True),
        ("naïve", text.is_ascii, False),
        ("2011", text.is_skippable, False),
        ("abc", text.is_skippable, True),
        ("中文 2011", text.is_skippable, False),
        ("一 二。三。四", text.split_han, ["一二。", "三。", "四"]),
        ("SOME TITLE", text.proper_case, "Some Title"),
        ("Some TITLE", text.proper_case, "Some TITLE"),
        ("(_NN a_NN )_NR", text.fix_paren_tag, "(_PU a_NN )_PU"),
        ("FH_DESC_REST:", S.section_name, "DESC"),
        ("FH_TITLE:", S.section_name, "TITLE"),
    ],
)
def test_columns(spark, value, f, want):
    assert one(spark, value, f) == want


def test_sections_and_sentences(spark):
    lines = ["stray_NN line_NN", "FH_TITLE:", "A_DT b_NN", "FH_DESC_REST:", "c_NN d_VB", "e_NN", "END"]
    frame = spark.createDataFrame([(1, n, x) for n, x in enumerate(lines)], "doc_id int, line_no int, line string")
    rows = S.sentences_of(S.sections_of(frame), pretagged=True).orderBy("sent_id").collect()
    assert [(r["sent_id"], r["section"], r["sent_in_section"], len(r["toks"])) for r in rows] == [(0, "NONE", 0, 2), (1, "TITLE", 0, 2), (2, "DESC", 0, 2), (3, "DESC", 1, 1)]
    assert [r["line"] for r in sinks.tagged_lines(S.sentences_of(S.sections_of(frame), pretagged=True)).orderBy("sent_id").collect()] == [x for x in lines if "_" in x and not x.startswith("FH_")]


def test_tokens_keep_what_stands_before_the_last_underscore(spark):
    toks = one(spark, "a_b_NN plain", tagging.parse_tagged)
    assert [(t["tok"], t["tag"]) for t in toks] == [("a_b", "NN"), ("plain", None)]


def test_candidate_filter_counts_before_it_drops(spark):
    lines = ["FH_TITLE:", "Glass_NN", "FH_DESC:", "red_JJ water_NN ._.", "the_DT glass_NN plate_NN ._."]
    frame = spark.createDataFrame([(1, n, x) for n, x in enumerate(lines)], "doc_id int, line_no int, line string")
    chunks = S.chunks_of(S.title_nouns(S.sentences_of(S.sections_of(frame), pretagged=True)), "en")
    got = S.candidates(chunks, True).orderBy("uid").select("uid", "term").collect()
    assert [tuple(r) for r in got] == [("1_0", "glass"), ("1_2", "glass plate")]
    marked = S.candidates(chunks, False).select(S.highlight(F.col("toks"), F.col("cs"), F.col("ce")).alias("h")).collect()
    assert "the <np>glass plate</np> ." in {r["h"] for r in marked}


def test_gathering_chinese_lines(spark):
    lines = ["FH_TITLE:", "一种 系统", "。的　方法", "", "abc def ghi jkl mno", "12", "二。三", "END", "四" * 501 + "。五"]
    frame = spark.createDataFrame([(1, n, x) for n, x in enumerate(lines)], "doc_id int, line_no int, line string")
    rows = segmenting.gathered(frame).orderBy("line_no", "part").collect()
    assert [r["line"] for r in rows] == ["FH_TITLE:", "一种系统。", "的方法", "12", "二。", "三", "END", "五"]
    done = segmenting.segmented(segmenting.gathered(frame), lambda: lambda ls: [" ".join(x) if "二" not in x else 1 / 0 for x in ls]).orderBy("line_no", "part").collect()
    assert done[1]["line"] == "一 种 系 统 。" and done[4]["error"] and done[4]["line"] == "二。" and done[0]["line"] == "FH_TITLE:"


def test_external_tagger_errors_stay_in_their_row(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, "bad")], "doc_id int, line string")
    start = lambda: lambda ls: [" ".join(f"{w}_NN" for w in x.split()) if x != "bad" else 1 / 0 for x in ls]
    rows = {r["doc_id"]: r for r in tagging.external(frame, start).collect()}
    assert rows[1]["tagged"] == "a_NN b_NN" and rows[2]["tagged"] is None and "Zero" in rows[2]["error"]


def test_unknown_languages():
    with pytest.raises(ValueError):
        tagging.chunker_for("fr")


def test_sentences_inside_rows_are_those_of_lines(spark):
    docs = [(1, "Title one. Two!\nx y. z\n\n \n" + "w" * 10_001 + "\nlast"), (2, ""), (3, None), (4, "w" * 10_001 + "\nrest. more"), (5, "\n~\nb")]
    frame = spark.createDataFrame(docs, "doc_id int, text string")
    order = ["doc_id", "sent_id"]
    assert S.document_sentences(frame).orderBy(*order).collect() == S.sentences_of(S.title_sections(S.lines_of(frame))).orderBy(*order).collect()
    assert "Exchange" not in S.document_sentences(frame)._jdf.queryExecution().executedPlan().toString()
