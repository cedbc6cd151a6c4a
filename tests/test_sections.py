"""Section trees of a patent and an article, written by hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from termloom.operators import sections as X
from termloom.operators import structure as S
from termloom.sources import readers

PATENT = [
    ("ABSTRACT", "Short abstract text here."),
    ("TEXT_CHUNK", None), ("SUMMARY", None), ("SECTITLE", "BACKGROUND OF IT"), ("TEXT", "Things were worse before this."), ("/SUMMARY", None),
    ("SECTITLE", "Brief Description of Drawings"), ("TEXT", "A drawing shows the thing in detail, from above and below."), ("TEXT", "Field of use"), ("TEXT", "More of the description comes here, and it is long enough."), ("/TEXT_CHUNK", None),
    ("CLAIMS", None), ("TEXT", "1. A thing."), ("TEXT", "2. The thing of claim 1 or claim 7."), ("TEXT", "  "), ("/CLAIMS", None),
]


def laid_out(parts, closing="/"):
    """Text and (name, start, end) from parts; a part without text stays open until its closing part."""
    text, tags, stack = "", [], []
    for name, body in parts:
        if name.startswith(closing):
            i = stack.pop()
            tags[i] = (*tags[i][:2], len(text))
        elif body is None:
            stack.append(len(tags))
            tags.append((name, len(text), None))
            text += "\n"
        else:
            tags.append((name, len(text), len(text) + len(body)))
            text += body + "\n"
    return text, tags


def test_patent(spark):
    text, tags = laid_out(PATENT)
    lines = [f'STRUCTURE TYPE="{n}" START={a} END={b}' for n, a, b in tags] + ['DOCUMENT COLLECTION="X"', "bad line"]
    facts = spark.createDataFrame([(1, i, x) for i, x in enumerate(reversed(lines))], "doc_id int, tag_id int, line string")
    parsed = facts.select("doc_id", "tag_id", readers.parse_fact(F.col("line")).alias("f")).select("doc_id", "tag_id", "f.*")
    texts = spark.createDataFrame([(1, text)], "doc_id int, text string")
    rows = X.patent_sections(texts, X.structure_tags(parsed)).orderBy("section_id").collect()
    got = [("|".join(r["types"]), r["claim_number"], r["parent_claims"], r["parent_id"]) for r in rows]
    assert got == [
        ("Abstract", None, None, None),
        ("Description", None, None, None),
        ("Description|Summary", None, None, 2),
        ("Description|Summary|Header|Background", None, None, 3),
        ("Description|Summary|Background", None, None, 3),
        ("Description|Header|Figures", None, None, 2),
        ("Description|Figures", None, None, 2),
        ("Description|Header|Field", None, None, 2),  # a short paragraph with a header's word
        ("Description|Field", None, None, 2),
        ("Claims", None, None, None),
        ("Claims|Claim", 1, [], 10),
        ("Claims|Claim", 2, [1, 7], 10),
        ("Claims|Claim", 3, [], 10),
    ]
    out = [r["line"] for r in X.section_lines(X.patent_sections(texts, X.structure_tags(parsed))).orderBy("section_id").collect()]
    assert len(out) == 12  # the blank one is left out but keeps its number
    assert out[11] == f'SECTION ID=12 PARENT_ID=10 STRUCT="TEXT" TYPE="CLAIMS|CLAIM" START={rows[11]["start"]} END={rows[11]["end"]} CLAIM_NUMBER=2 PARENT_CLAIMS=1,7'
    assert X.pick(X.patent_sections(texts, X.structure_tags(parsed)), ["Claim"], "TEXT").count() == 3


def test_markup_tags_keep_dates_of_publication_only(spark):
    xml = "<doc><bib><invention-title lang='eng'>T</invention-title><publication-reference><id><date>19800101</date></id></publication-reference><other><date>1</date></other></bib><abstract lang='eng'><p>A</p></abstract><junk/></doc>"
    text, tags = readers.standoff(xml)
    frame = spark.createDataFrame([(1, t["tag_id"], t["name"], t["attrs"], t["start"], t["end"]) for t in tags], "doc_id int, tag_id int, name string, attrs map<string,string>, start int, end int")
    kept = X.markup_tags(frame)
    assert sorted(r["name"] for r in kept.collect()) == ["abstract", "date", "invention-title", "p", "publication-reference"]
    rows = X.patent_sections(spark.createDataFrame([(1, text)], "doc_id int, text string"), kept).collect()
    assert {("|".join(r["types"]), r["language"]) for r in rows} >= {("Meta-Title", "eng"), ("Meta-Date", None), ("Abstract", "eng")}


def test_article(spark):
    text = "Intro\nSome words of the introduction.\nMethods\nWhat was done, step by step.\ntail"
    m = text.index("Methods")
    tags = [
        ("title", {}, 0, 5), ("sec", {}, 0, m - 1),
        ("STRUCTURE", {"TYPE": "TITLE"}, m, m + 7), ("STRUCTURE", {"TYPE": "TEXT"}, m + 8, m + 36), ("STRUCTURE", {"TYPE": "TEXT_CHUNK"}, m + 8, m + 20), ("STRUCTURE", {"TYPE": "TEXT_CHUNK"}, m + 8, m + 30),
    ]
    frame = spark.createDataFrame([(1, i, *t) for i, t in enumerate(tags)], "doc_id int, tag_id int, name string, attrs map<string,string>, start int, end int")
    rows = X.article_sections(spark.createDataFrame([(1, text)], "doc_id int, text string"), frame).orderBy("section_id").collect()
    got = [("|".join(r["types"]), r["title"], r["start"], r["end"]) for r in rows]
    assert got[:4] == [("Other", "Intro", 6, m - 1), ("Methods", "Methods", m + 8, m + 20), ("Header", None, 0, 5), ("Header", None, m, m + 7)]
    assert got[4:] == [("Unlabeled", None, 5, 6), ("Unlabeled", None, m - 1, m), ("Unlabeled", None, m + 7, m + 8), ("Unlabeled", None, m + 20, len(text))]


def test_collection_neighbours_and_weight(spark):
    lines = spark.createDataFrame([(1, 0, "PATENT"), (1, 1, 'DOCUMENT ID=1 COLLECTION="A"'), (1, 2, 'DOCUMENT COLLECTION="B"')], "doc_id int, line_no int, line string")
    assert X.collection(lines).first()["collection"] == "A"
    rows = [(1, 1, 0, 100, ["D"]), (1, 2, 10, 60, ["D", "S"]), (1, 3, 20, 30, ["S"]), (1, 4, 100, 200, ["C"])]
    frame = spark.createDataFrame(rows, "doc_id int, section_id int, start int, end int, types array<string>")
    assert X.type_weight(frame, "S").first()["weight"] == 50 / 200
    assert [(r["prev_id"], r["next_id"]) for r in X.neighbours(frame).orderBy("section_id").collect()] == [(None, 2), (1, 3), (2, 4), (3, None)]


def test_header_types(spark):
    frame = spark.createDataFrame([("Materials and Methods",), ("Summary of the Invention",), ("Summary",), ("xyz",), ("Field of the Invention",)], "h string")
    got = {r["h"]: r["t"] for r in frame.select("h", S.header_types(F.col("h")).alias("t")).collect()}
    assert got["Materials and Methods"] == ["Materials", "Methods"] and got["xyz"] == ["Other"]
    assert got["Summary"] == ["Conclusion", "Summary"] and got["Summary of the Invention"] == ["Summary"] and got["Field of the Invention"] == ["Field"]


def test_pieces_of_blocks(spark):
    """Pieces anywhere in a long text, and whether they are headings, as the text itself says."""
    import random

    r = random.Random(3)
    text = "".join(r.choices(["the ", "Field\t", "summary", "é", "文", "𝄞", "\n", " ", " " * 70, "background"], k=900))
    spans = [(a, b) for a, b in ((r.randrange(len(text) + 9), r.randrange(len(text) + 9)) for _ in range(600)) if a <= b]
    spans += [(a, a + r.randrange(140)) for a in r.choices(range(len(text)), k=600)] + [(0, len(text)), (0, 0), (len(text), len(text) + 5)]
    frame = spark.createDataFrame([(text, a, b) for a, b in spans], "text string, a int, b int")
    start, end = F.col("a"), F.col("b")
    piece = F.substring("text", start + 1, end - start)
    made = frame.select(X._piece(X._blocks(F.col("text")), start, end - start).alias("p"), X._is_heading(X._blocks(F.col("text")), start, end).alias("h"), S.is_header(piece).alias("want"))
    got = made.collect()
    assert [x["p"] for x in got] == [text[a:b] for a, b in spans]
    assert [x["h"] for x in got] == [x["want"] for x in got] and {x["h"] for x in got} == {True, False}


def test_text_and_tags_are_shuffled_once(spark):
    texts = spark.createDataFrame([(1, "a b")], "doc_id int, text string")
    tags = spark.createDataFrame([(1, 1, "p", {"lang": "en"}, 0, 3)], "doc_id int, tag_id int, name string, attrs map<string,string>, start int, end int").withColumn("struct", F.col("name"))
    made = X.patent_sections(texts, tags)
    assert made.select("section_id", "types", "parent_id", "body").collect() == [(1, [], None, "a b")]
    plan = made.select("doc_id", "types", "parent_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hash") == 2, plan
