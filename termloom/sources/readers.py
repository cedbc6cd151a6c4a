"""Source formats to fielded text. Flat formats are column expressions; XML with mixed content is parsed in batches.

``READERS`` maps a source key to a function of a frame (doc_id, path, content) giving (doc_id, field_ord, field, line_ord, line, error);
a document that fails gives one row without field and line, the message in ``error``, and never a failed job: downstream it is
an empty document.
"""

from __future__ import annotations

import re
import xml.sax
import xml.sax.handler
from collections.abc import Callable, Iterator
from io import StringIO

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OUT = "doc_id string, field_ord int, field string, line_ord int, line string, error string"


def between(body: Column, opened: str, closed: str) -> Column:
    """What stands between a literal and the next other literal, mark-up kept; null if there is none."""
    inner = F.get(F.split(F.get(F.split(body, re.escape(opened), 2), F.lit(1)), re.escape(closed), 2), F.lit(0))
    return F.when(inner != "", inner)


def digits_year(name: Column) -> Column:
    """The first four digits of a name, null if it has fewer."""
    digits = F.regexp_replace(name, "[^0-9]", "")
    return F.when(F.length(digits) >= 4, F.left(digits, F.lit(4)))


def _fields(docs: DataFrame, *fields: tuple[str, Column]) -> DataFrame:
    """Fields in order, their text cut into lines; null ones are left out."""
    array = F.array(*(F.struct(F.lit(k).alias("field_ord"), F.lit(f"FH_{n}").alias("field"), c.alias("body")) for k, (n, c) in enumerate(fields)))
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.explode(array).alias("f")).select("doc_id", "f.*").where("body IS NOT NULL")
    lines = rows.select("doc_id", "field_ord", "field", F.posexplode(F.split("body", "\n", -1)).alias("line_ord", "line"))
    return lines.withColumn("error", F.lit(None).cast("string"))


def journal_markup(docs: DataFrame) -> DataFrame:
    """Chinese journal articles: title, abstract, body and rest by literal tags; the year from the file's digits."""
    b, name = F.col("content"), F.element_at(F.split("path", "/"), -1)
    return _fields(
        docs,
        ("TITLE", between(b, '<fs:ArticleTitle lang="zh">', "</fs:ArticleTitle>")),
        ("DATE", digits_year(name)),
        ("ABSTRACT", between(b, '<fs:AbstractBlock lang="zh">', "</fs:AbstractBlock>")),
        ("BODY", between(b, "<fs:Body>", "</fs:Body>")),
        ("STUFF", between(b, "<fs:Stuff>", "</fs:Stuff>")),
    )


def abstract_lines(docs: DataFrame) -> DataFrame:
    """Lines <year>, <title>, <abstract>; the last of each wins, a missing one is the word None."""

    def last(tag: str) -> Column:
        found = F.regexp_extract_all("content", F.lit(rf"(?m)^<{tag}>(.*?)(?:</{tag}>)?\s*$"), F.lit(1))
        return F.coalesce(F.get(found, F.size(found) - 1), F.lit("None"))

    return _fields(docs, ("DATE", last("year")), ("TITLE", last("title")), ("ABSTRACT", last("abstract")))


def clinical_notes(docs: DataFrame) -> DataFrame:
    """Notes with [start section ...] marks; meta lines, end marks and blank lines go."""
    lines = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.posexplode(F.split("content", "\n")).alias("n", "line"))
    kept = lines.where(~F.col("line").startswith("[meta rev") & ~F.col("line").startswith("[end section") & (F.trim("line") != ""))
    mark = F.col("line").startswith("[start section").cast("int")
    order = Window.partitionBy("doc_id").orderBy("n")
    numbered = kept.withColumn("field_ord", F.sum(mark).over(order).cast("int")).where(mark == 0)
    inside = Window.partitionBy("doc_id", "field_ord").orderBy("n")
    line_ord = (F.row_number().over(inside) - 1).cast("int").alias("line_ord")
    return numbered.select("doc_id", "field_ord", F.lit("FH_SECTION").alias("field"), line_ord, "line", F.lit(None).cast("string").alias("error"))


def parsed_science(docs: DataFrame) -> DataFrame:
    """JSON with title, year, abstractText and sections[].text."""
    schema = "title string, year int, abstractText string, sections array<struct<text: string>>"
    j = docs.withColumn("j", F.from_json("content", schema))
    sections = F.when(F.col("j.sections").isNotNull(), F.array_join(F.transform("j.sections", lambda s: F.coalesce(s["text"], F.lit(""))), "\n"))
    return _fields(j, ("TITLE", F.col("j.title")), ("DATE", F.col("j.year").cast("string")), ("ABSTRACT", F.col("j.abstractText")), ("DESCRIPTION", sections))


class _Standoff(xml.sax.handler.ContentHandler):
    """Text and tags with code-point offsets in one pass."""

    def __init__(self):
        super().__init__()
        self.parts: list[str] = []
        self.size = 0
        self.tags: list[dict] = []
        self.open: list[int] = []

    def startElement(self, name, attrs):  # noqa: N802
        self.open.append(len(self.tags))
        parent = self.open[-2] if len(self.open) > 1 else None
        self.tags.append({"tag_id": len(self.tags), "name": name, "attrs": dict(attrs.items()), "start": self.size, "end": self.size, "parent": parent})

    def endElement(self, name):  # noqa: N802
        self.tags[self.open.pop()]["end"] = self.size

    def characters(self, content):
        self.parts.append(content)
        self.size += len(content)


def standoff(document: str) -> tuple[str, list[dict]]:
    """The text of an XML document and its elements as tags over it. External entities are never read."""
    handler = _Standoff()
    reader = xml.sax.make_parser()
    reader.setFeature(xml.sax.handler.feature_external_ges, False)
    reader.setFeature(xml.sax.handler.feature_external_pes, False)
    reader.setContentHandler(handler)
    source = xml.sax.xmlreader.InputSource()
    source.setCharacterStream(StringIO(document.lstrip("﻿")))
    reader.parse(source)
    return "".join(handler.parts), handler.tags


def inline(text: str, tags: list[dict]) -> str:
    """XML again from text and nested tags."""
    from xml.sax.saxutils import escape, quoteattr

    kids: dict[int | None, list[dict]] = {}
    for t in tags:
        kids.setdefault(t["parent"], []).append(t)

    def make(t: dict) -> str:
        attrs = "".join(f" {k}={quoteattr(v)}" for k, v in t["attrs"].items())
        at, out = t["start"], []
        for k in kids.get(t["tag_id"], []):
            out += [escape(text[at : k["start"]]), make(k)]
            at = k["end"]
        return f"<{t['name']}{attrs}>{''.join(out)}{escape(text[at : t['end']])}</{t['name']}>"

    return "".join(make(t) for t in kids.get(None, []))


TAGS = "doc_id string, text string, tags array<struct<tag_id: int, name: string, attrs: map<string,string>, start: int, end: int, parent: int>>, error string"


def documents_with_tags(docs: DataFrame) -> DataFrame:
    """(doc_id, text, tags, error) of XML documents; a broken one has an error and no text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for key, content in zip(b["doc_id"], b["content"], strict=True):
                try:
                    text, tags = standoff(content)
                    out.append((key, text, tags, None))
                except Exception as e:  # one broken document must not end the job
                    out.append((key, None, [], repr(e)))
            yield pd.DataFrame(out, columns=["doc_id", "text", "tags", "error"])

    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "content").mapInPandas(run, TAGS)


def parse_fact(line: Column) -> Column:
    """struct(name, attrs, start, end) of a line NAME KEY="VALUE" ... with START/END or *:offset/*:length numbers."""
    values = F.regexp_extract_all(line, F.lit(r'([\w:.-]+)=(?:"([^"]*)"|(\S*))'), F.lit(0))
    bare = F.transform(values, lambda v: F.regexp_replace(F.regexp_replace(v, r"^[^=]*=", ""), r'^"|"$', ""))
    names = F.transform(values, lambda v: F.regexp_extract(v, r"^([^=]*)=", 1))
    attrs = F.map_from_arrays(names, bare)
    start = F.coalesce(attrs["START"].try_cast("int"), F.get(F.map_values(F.map_filter(attrs, lambda k, v: k.endswith(":offset"))), F.lit(0)).try_cast("int"), F.lit(-1))
    length = F.get(F.map_values(F.map_filter(attrs, lambda k, v: k.endswith(":length"))), F.lit(0)).try_cast("int")
    end = F.coalesce(attrs["END"].try_cast("int"), start + length, F.lit(-1))
    return F.struct(F.regexp_extract(line, r"^\s*(\S+)", 1).alias("name"), attrs.alias("attrs"), start.alias("start"), end.alias("end"))


def _xml_fields(pick: Callable[..., list[tuple[str, str]]]):
    def read(docs: DataFrame, **options) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                out: list[tuple] = []
                for key, path, content in zip(b["doc_id"], b["path"], b["content"], strict=True):
                    try:
                        fields = pick(*standoff(content), path or "", **options)
                    except Exception as e:  # one broken document must not end the job
                        out.append((key, 0, None, 0, None, repr(e)))
                        continue
                    for k, (name, body) in enumerate(fields):
                        out += [(key, k, f"FH_{name}", n, line, None) for n, line in enumerate(body.split("\n"))]
                yield pd.DataFrame(out, columns=["doc_id", "field_ord", "field", "line_ord", "line", "error"])

        return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "path", F.col("content").cast("string").alias("content")).mapInPandas(run, OUT)

    return read


def _named(tags, name, parent=None):
    by_id = {t["tag_id"]: t for t in tags}
    return [t for t in tags if t["name"] == name and (parent is None or (t["parent"] is not None and by_id[t["parent"]]["name"] == parent))]


def _pubmed(text: str, tags: list[dict], path: str) -> list[tuple[str, str]]:
    """Last title, journal from the folder, last subject, least year, paragraphs of sections of abstract and body."""
    body = lambda t: text[t["start"] : t["end"]]
    by_id = {t["tag_id"]: t for t in tags}
    up = lambda t: by_id.get(t["parent"]) if t else None
    out = []
    titles, subjects = _named(tags, "article-title", "title-group"), _named(tags, "subject", "subj-group")
    years = sorted(body(t).strip() for t in _named(tags, "year", "pub-date"))
    if titles:
        out.append(("TITLE", body(titles[-1])))
    if "/" in path:
        out.append(("JOURNAL", path.split("/")[-2]))
    if subjects:
        out.append(("SUBJECT", body(subjects[-1])))
    if years:
        out.append(("DATE", years[0]))
    for field, name in (("ABSTRACT", "abstract"), ("TEXT", "body")):
        found = [body(t) for t in _named(tags, "p", "sec") if (g := up(up(t))) and g["name"] == name]
        if found:
            out.append((field, "\n".join(found)))
    return out


def _application(text: str, tags: list[dict], path: str) -> list[tuple[str, str]]:
    """Patent applications: title, year, abstract, paragraphs and headings in order, claims; other roots give nothing."""
    body = lambda t: text[t["start"] : t["end"]].strip()
    if not tags or tags[0]["name"] != "us-patent-application":
        return []
    by_id = {t["tag_id"]: t for t in tags}

    def inside(t, name):
        p = t["parent"]
        while p is not None:
            if by_id[p]["name"] == name:
                return True
            p = by_id[p]["parent"]
        return False

    out = [("TITLE", body(t)) for t in _named(tags, "invention-title")[:1]]
    out += [("DATE", body(t)[:4]) for t in _named(tags, "date") if inside(t, "publication-reference")][:1]
    abstract = [body(t) for t in _named(tags, "p", "abstract")]
    if abstract:
        out.append(("ABSTRACT", "\n".join(abstract)))
    for t in tags:
        if t["parent"] is not None and by_id[t["parent"]]["name"] in ("description", "description-of-drawings"):
            if t["name"] == "heading":
                out.append((f"HEADER_LEVEL_{t['attrs'].get('level', '1')}", body(t)))
            elif t["name"] == "p":
                out.append(("PARA", body(t)))
    return [*out, *(("CLAIM", body(t)) for t in _named(tags, "claim"))]


#: A patent's fields in order of output by the type of section that they take, the description's rest and claims apart.
PATENT_FIELDS = {
    "TITLE": "Meta-Title", "DATE": "Meta-Date", "ABSTRACT": "Abstract", "SUMMARY": "Summary", "TECHNICAL_FIELD": "Technical_Field", "BACKGROUND_ART": "Background_Art",
}
#: Types that only ``match="last"`` knows.
MORE_TYPES = {"technical-field": "Technical_Field", "background-art": "Background_Art"}


def _proper(title: str) -> str:
    """An all-capital title with initial capitals."""
    return title.lower().title() if title.isupper() else title


def _granted(text: str, tags: list[dict], path: str, language: str = "en", match: str = "exact") -> list[tuple[str, str]]:
    """Patents: title, date, abstract, summary, technical field, background art, rest of the description, first and other claims.

    ``exact``: a section counts only if its whole type string, ancestors' types included, is the field's; so nested summaries
    and claims don't, and the rest is the whole description. ``last``: the innermost type counts, technical fields and background art
    have types, and the rest of the description begins after its summary, or else its background art, or else its technical field.
    Of each field but other claims the first section is kept. In runs of another language than English, titles and abstracts
    marked as English are left out; German titles in capitals get initial capitals. A date counts inside a publication reference.
    """
    from termloom.operators.structure import TAG_TYPES

    if match not in ("exact", "last"):
        raise ValueError(f"unknown match {match!r}")
    known = TAG_TYPES | MORE_TYPES if match == "last" else TAG_TYPES
    above: list[list[str]] = []
    dated: list[bool] = []
    found: dict[str, list[tuple[int, int]]] = {}
    for t in tags:  # parents come before their children
        up = t["parent"]
        own = known.get(t["name"])
        dated.append(t["name"] == "publication-reference" or (up is not None and dated[up]))
        above.append([*(above[up] if up is not None else []), *([own] if own else [])])
        if own is None or (own == "Meta-Date" and not dated[-1]):
            continue
        if language != "en" and own in ("Meta-Title", "Abstract") and t["attrs"].get("lang") == "eng":
            continue
        found.setdefault("|".join(above[-1]) if match == "exact" else own, []).append((t["start"], t["end"]))
    body = lambda span: text[span[0] : span[1]].strip()
    out = []
    for field, kind in PATENT_FIELDS.items():
        for span in found.get(kind, [])[:1]:
            out.append((field, _proper(body(span)) if field == "TITLE" and language == "de" else body(span)))
    for start, end in found.get("Description", [])[:1]:
        lead = next((found[k][0][1] for k in ("Summary", "Background_Art", "Technical_Field") if k in found), start)
        out.append(("DESC_REST", text[lead:end].strip()))
    claims = found.get("Claim", [])
    if claims:
        out.append(("FIRST_CLAIM", body(claims[0])))
        if claims[1:]:
            out.append(("OTHER_CLAIMS", "\n".join(body(c) for c in claims[1:])))
    return [(field, b) for field, b in out if b]


READERS: dict[str, Callable[..., DataFrame]] = {
    "ln": _xml_fields(_granted),
    "cnki": journal_markup,
    "pm": _xml_fields(_pubmed),
    "signal-processing": abstract_lines,
    "uspto": _xml_fields(_application),
    "thyme": clinical_notes,
    "spv1": parsed_science,
}


def read(source: str, docs: DataFrame, **options) -> DataFrame:
    """Fielded text of documents (doc_id, path, content) of one source. ``ln`` takes ``language`` (en, de, cn) and ``match`` (exact, last)."""
    if source not in READERS:
        raise ValueError(f"unknown data source {source!r}; known: {sorted(READERS)}")
    return READERS[source](docs, **options)


def render_fielded(fields: DataFrame) -> DataFrame:
    """(doc_id, text): FH_ headers, lines, END; documents that failed have no fields."""
    one = fields.where("field IS NOT NULL").groupBy("doc_id", "field_ord", "field").agg(F.array_sort(F.collect_list(F.struct("line_ord", "line"))).alias("ls"))
    block = F.concat(F.col("field"), F.lit(":\n"), F.array_join(F.col("ls.line"), "\n"))
    whole = one.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("field_ord", block.alias("b")))).alias("bs"))
    return whole.select("doc_id", F.concat(F.array_join(F.col("bs.b"), "\n"), F.lit("\nEND\n")).alias("text"))


def fielded_lines(fields: DataFrame) -> DataFrame:
    """(doc_id, line_no, line): fielded text as the lines that tagging reads, a header line before each field."""
    order = F.struct("field_ord", F.col("line_ord") + 1)
    heads = fields.where("field IS NOT NULL AND line_ord = 0").select("doc_id", F.struct("field_ord", F.lit(0)).alias("at"), F.concat("field", F.lit(":")).alias("line"))
    rows = heads.union(fields.where("field IS NOT NULL").select("doc_id", order, "line"))
    return rows.select("doc_id", (F.row_number().over(Window.partitionBy("doc_id").orderBy("at")) - 1).cast("int").alias("line_no"), "line")
