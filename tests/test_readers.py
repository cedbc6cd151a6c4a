"""Every source format from a small document; broken ones never end a job."""

from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from termloom.sources import manifests, readers


def fields(spark, source, content, path="/a/journal/GLDZ2011041.xml", **options):
    frame = spark.createDataFrame([("d", path, content)], "doc_id string, path string, content string")
    out: dict = {}
    for r in readers.read(source, frame, **options).orderBy("field_ord", "line_ord").collect():
        if r["error"]:
            assert r["field"] is None and r["line"] is None
            return "error"
        out.setdefault(r["field"].removeprefix("FH_") + str(r["field_ord"]), []).append(r["line"])
    return out


def test_journal_markup(spark):
    got = fields(spark, "cnki", '<x><fs:ArticleTitle lang="zh">标<b>题</b></fs:ArticleTitle><fs:Body>正\n文</fs:Body></x>')
    assert got == {"TITLE0": ["标<b>题</b>"], "DATE1": ["2011"], "BODY3": ["正", "文"]}


def test_abstract_lines(spark):
    got = fields(spark, "signal-processing", "<title>T</title>\n<year>1999</year>\n<title>U</title>\n")
    assert got == {"DATE0": ["1999"], "TITLE1": ["U"], "ABSTRACT2": ["None"]}


def test_clinical_notes(spark):
    got = fields(spark, "thyme", '[meta rev_date="1"]\n[start section id="1"]\na\n\nb\n[end section id="1"]\n[start section id="2"]\nc\n')
    assert got == {"SECTION1": ["a", "b"], "SECTION2": ["c"]}


def test_parsed_science(spark):
    got = fields(spark, "spv1", '{"title": "T", "year": 2001, "sections": [{"text": "a"}, {"text": "b"}]}')
    assert got == {"TITLE0": ["T"], "DATE1": ["2001"], "DESCRIPTION3": ["a", "b"]}
    assert fields(spark, "spv1", "no json") == {}


def test_pubmed(spark):
    xml = "<article><front><title-group><article-title>T</article-title></title-group><subj-group><subject>S1</subject><subject>S2</subject></subj-group><pub-date><year>2009</year></pub-date><pub-date><year>2008</year></pub-date><abstract><sec><p>ab</p></sec><p>loose</p></abstract></front><body><sec><p>one</p><p>two</p><sec><p>deep</p></sec></sec></body></article>"
    assert fields(spark, "pm", xml) == {"TITLE0": ["T"], "JOURNAL1": ["journal"], "SUBJECT2": ["S2"], "DATE3": ["2008"], "ABSTRACT4": ["ab"], "TEXT5": ["one", "two"]}


def test_applications(spark):
    xml = "<us-patent-application><invention-title>T</invention-title><publication-reference><date>20070102</date></publication-reference><abstract><p>A</p></abstract><description><heading level='2'>H</heading><p>x</p><description-of-drawings><p>y</p></description-of-drawings></description><claims><claim>c1</claim><claim>c2</claim></claims></us-patent-application>"
    assert fields(spark, "uspto", xml) == {"TITLE0": ["T"], "DATE1": ["2007"], "ABSTRACT2": ["A"], "HEADER_LEVEL_23": ["H"], "PARA4": ["x"], "PARA5": ["y"], "CLAIM6": ["c1"], "CLAIM7": ["c2"]}
    assert fields(spark, "uspto", "<us-patent-grant/>") == {}


def test_granted(spark):
    xml = "<p-doc><invention-title>T</invention-title><abstract><p>A</p></abstract><description><summary>S</summary>rest</description><claims><claim>c1</claim></claims></p-doc>"
    got = fields(spark, "ln", xml)
    assert got["TITLE0"] == ["T"] and got["ABSTRACT1"] == ["A"] and ["Srest"] in got.values()


PATENT = "<p-doc><invention-title lang='{lang}'>A GLASS HOUSE</invention-title><publication-reference><date>20010203</date></publication-reference><date>1999</date><abstract lang='eng'>Abs</abstract><description>{parts}rest</description><claims><claim>c1</claim><claim>c2</claim><claim>c3</claim></claims></p-doc>"


def named(got: dict) -> dict:
    return {re.sub(r"\d+$", "", k): v for k, v in got.items()}


def test_language_guard(spark):
    """Other languages' runs lose what is marked as English, an English run loses nothing."""
    for lang in ("eng", "chi", "ger"):
        got = named(fields(spark, "ln", PATENT.format(lang=lang, parts="")))
        assert got["TITLE"] == ["A GLASS HOUSE"] and got["ABSTRACT"] == ["Abs"]
    chinese = named(fields(spark, "ln", PATENT.format(lang="chi", parts=""), language="cn"))
    assert chinese["TITLE"] == ["A GLASS HOUSE"] and "ABSTRACT" not in chinese
    assert "TITLE" not in named(fields(spark, "ln", PATENT.format(lang="eng", parts=""), language="cn"))
    assert named(fields(spark, "ln", PATENT.format(lang="ger", parts=""), language="de"))["TITLE"] == ["A Glass House"]


RESTS = {
    "": "rest",
    "<summary>S</summary>": "rest",
    "<technical-field>F</technical-field>": "rest",
    "<background-art>B</background-art>": "rest",
    "<technical-field>F</technical-field><background-art>B</background-art>": "rest",
    "<background-art>B</background-art>more<summary>S</summary>": "rest",
    "<background-art>B</background-art><technical-field>F</technical-field>": "Frest",
}


@pytest.mark.parametrize("parts", RESTS)
def test_innermost_types(spark, parts):
    """Nine fields; the rest of the description follows the summary, or the background art, or the technical field, or is all of it."""
    got = fields(spark, "ln", PATENT.format(lang="eng", parts=parts), match="last")
    want = {"TITLE": "A GLASS HOUSE", "DATE": "20010203", "ABSTRACT": "Abs"}
    for tag, field, body in (("summary", "SUMMARY", "S"), ("technical-field", "TECHNICAL_FIELD", "F"), ("background-art", "BACKGROUND_ART", "B")):
        if tag in parts:
            want[field] = body
    want |= {"DESC_REST": RESTS[parts], "FIRST_CLAIM": "c1", "OTHER_CLAIMS": "c2"}
    assert {k: v[0] for k, v in named(got).items()} == want and [re.sub(r"\d+$", "", k) for k in got] == list(want)
    assert named(got)["OTHER_CLAIMS"] == ["c2", "c3"]


def test_whole_type_strings(spark):
    """Nested summaries and claims have longer type strings than the fields', so the rest is the whole description."""
    got = named(fields(spark, "ln", PATENT.format(lang="eng", parts="<summary>S</summary>")))
    assert got == {"TITLE": ["A GLASS HOUSE"], "DATE": ["20010203"], "ABSTRACT": ["Abs"], "DESC_REST": ["Srest"]}


def test_broken_and_unknown(spark):
    assert fields(spark, "pm", "<a><b></a>") == "error"
    broken = spark.createDataFrame([("a", "", "<a><b></a>")], "doc_id string, path string, content string")
    assert readers.render_fielded(readers.read("pm", broken)).count() == 0
    with pytest.raises(ValueError):
        readers.read("wos", None)
    frame = spark.createDataFrame([("a", "<x>1<y>2</y></x>"), ("b", "<x>")], "doc_id string, content string")
    rows = {r["doc_id"]: r for r in readers.documents_with_tags(frame).collect()}
    assert rows["a"]["text"] == "12" and rows["b"]["error"] and rows["b"]["text"] is None


NAMES = st.sampled_from(["a", "b", "p"])
TREES = st.recursive(st.text("xyz é&<>\"'\n", max_size=6), lambda kids: st.tuples(NAMES, st.lists(kids, max_size=4)), max_leaves=12)


def built(node) -> str:
    from xml.sax.saxutils import escape

    return escape(node) if isinstance(node, str) else f"<{node[0]}>{''.join(map(built, node[1]))}</{node[0]}>"


@settings(max_examples=150, deadline=None)
@given(st.lists(TREES, max_size=4))
def test_standoff_and_back(trees):
    xml = f"<root>{''.join(map(built, trees))}</root>"
    text, tags = readers.standoff(xml)
    again = readers.inline(text, tags)
    assert readers.standoff(again) == (text, tags) and again == xml.replace("<a/>", "<a></a>")


def test_manifests(spark):
    lines = spark.createDataFrame([(0, "1999\t/a/b.xml"), (1, "2000\t/c.xml\td.xml"), (2, "/e.xml"), (3, " "), (4, "2001\tx")], "line_no int, value string")
    rows = [tuple(r) for r in manifests.parse(manifests.until_blank(lines)).orderBy("line_no").collect()]
    assert rows == [(0, "1999", "/a/b.xml", "a/b.xml"), (1, "2000", "/c.xml", "d.xml"), (2, None, None, "e.xml")]
    assert manifests.until_blank(lines.where("line_no < 3")).count() == 3


def test_directories(spark, tmp_path):
    """All files below a folder, in path order or shuffled by a seed, the same for the same seed."""
    for k in range(30):
        (tmp_path / f"d{k % 3}").mkdir(exist_ok=True)
        (tmp_path / f"d{k % 3}" / f"{k:02d}.xml").write_text("x")
    listed = [(r["year"], r["source"].rsplit("/", 1)[1]) for r in manifests.from_directory(spark, str(tmp_path)).collect()]
    assert [n for _, n in listed] == [f"{k:02d}.xml" for d in range(3) for k in range(d, 30, 3)] and {y for y, _ in listed} == {"0000"}
    one, again, other = ([r["source"] for r in manifests.from_directory(spark, str(tmp_path), seed).collect()] for seed in (1, 1, 2))
    assert one == again != other and sorted(one) == sorted(other) and sorted(one) != one
