"""Typed sections of patents and articles from text and standoff tags, as joins and windows over intervals.

``texts`` is (doc_id, text); ``tags`` is (doc_id, tag_id, name, attrs, start, end). All work is keyed by document, so a table of any
size is spread by it, and no join looks beyond a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.operators import structure as S

#: Names of structure tags by their TYPE.
STRUCTURES = {
    "SECTITLE": "heading", "TEXT": "p", "ABSTRACT": "abstract", "SUMMARY": "summary",
    "RELATED_APPLICATIONS": "related-apps", "TEXT_CHUNK": "description", "CLAIMS": "claims",
}
#: Tags that markup documents keep; dates count only inside a publication reference.
MARKUP = ("abstract", "background-art", "claim", "claims", "description", "heading", "p", "related-apps", "summary", "technical-field")
META = ("invention-title", "publication-reference")
#: Names in journal articles' markup.
ARTICLE = {"fs:AbstractBlock": "abstract", "fs:P": "p"}


def collection(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, collection): what the first DOCUMENT line that names a collection says."""
    found = F.regexp_extract("line", r'^DOCUMENT.*COLLECTION="(\S+)"', 1)
    return lines.where(found != "").groupBy(key).agg(F.min_by(found, "line_no").alias("collection"))


def structure_tags(tags: DataFrame, key: str = "doc_id") -> DataFrame:
    """STRUCTURE tags under markup names; texts inside the document's first claims section are claims."""
    kind = F.col("attrs")["TYPE"]
    names = F.create_map(*(F.lit(x) for pair in STRUCTURES.items() for x in pair))
    first = tags.where((F.col("name") == "STRUCTURE") & (kind == "CLAIMS")).groupBy(key).agg(F.min_by(F.struct("start", "end"), "tag_id").alias("_c"))
    claim = (kind == "TEXT") & (F.col("start") >= F.col("_c.start")) & (F.col("end") <= F.col("_c.end"))
    named = F.when(F.coalesce(claim, F.lit(False)), F.lit("claim")).otherwise(F.get(F.array(names[kind]), F.lit(0)))
    kept = tags.where(F.col("name") == "STRUCTURE").join(first, key, "left")
    return kept.withColumn("struct", kind).withColumn("name", named).where("name IS NOT NULL").drop("_c")


def markup_tags(tags: DataFrame, key: str = "doc_id", rename: dict[str, str] | None = None) -> DataFrame:
    """Tags of XML documents that sections are made of, titles and dates of publication included."""
    order = Window.partitionBy(key).orderBy("tag_id").rowsBetween(Window.unboundedPreceding, 0)
    ref = F.last(F.when(F.col("name") == "publication-reference", F.struct("start", "end")), ignorenulls=True).over(order)
    seen = tags.withColumn("_r", ref).withColumn("struct", F.col("name"))
    dated = (F.col("name") == "date") & (F.col("start") >= F.col("_r.start")) & (F.col("end") <= F.col("_r.end"))
    for old, new in (rename or {}).items():
        seen = seen.withColumn("name", F.when(F.col("name") == old, F.lit(new)).otherwise(F.col("name")))
    return seen.where(F.col("name").isin(*MARKUP, *META) | F.coalesce(dated, F.lit(False))).drop("_r")


def _body(start: Column, end: Column) -> Column:
    return F.substring("text", start + 1, F.greatest(end - start, F.lit(0)))


#: Characters in a block of text: a piece far into a text is cut out of the blocks that hold it, not found by walking from the start.
BLOCK = 512


def _blocks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def _piece(blocks: Column, start: Column, n: Column) -> Column:
    """``n`` characters from ``start`` of the text in blocks."""
    first = F.floor(start / BLOCK).cast("int")
    held = F.slice(blocks, first + 1, F.floor((start % BLOCK + n) / BLOCK).cast("int") + 1)
    return F.substring(F.array_join(held, ""), start % BLOCK + 1, n)


def _is_heading(blocks: Column, start: Column, end: Column) -> Column:
    """``structure.is_header`` of a piece; where its beginning is too long already, white space made one, the rest is not looked at."""
    n = F.greatest(end - start, F.lit(0))
    begin = F.trim(F.regexp_replace(_piece(blocks, start, F.least(n, F.lit(100))), r"\s+", " "))
    return F.when(F.length(begin) > 50, False).otherwise(S.is_header(_piece(blocks, start, n)))


def _linked(sections: DataFrame, key: str) -> DataFrame:
    """Add ``parent_id``: of the longer sections around each the one that begins last, ties by id."""
    order = Window.partitionBy(key).orderBy("start", F.desc("end"), "section_id")
    ordered = sections.withColumn("ord", F.row_number().over(order).cast("int"))
    met = ordered.join(S.enclosing(ordered, F.col("section_id").cast("string"), key), [key, "ord"], "left")
    longer = F.filter("around", lambda o: o["e"] - o["s"] > F.col("end") - F.col("start"))
    nearest = F.array_max(F.transform(longer, lambda o: F.struct(o["s"].alias("s"), o["label"].cast("int").alias("id"))))
    return met.withColumn("parent_id", nearest["id"]).drop("ord", "around")


SECTION = ("section_id", "parent_id", "struct", "types", "language", "title", "start", "end", "claim_number", "parent_claims", "body")


def patent_sections(texts: DataFrame, tags: DataFrame, key: str = "doc_id") -> DataFrame:
    """A row for each selected tag (see ``structure_tags``, ``markup_tags``): inherited and header types, claims numbered.

    A document's tags meet in one row and its text meets them there, once; what is then exploded knows all that surrounds it, so nothing
    is joined back. The text goes on only where ``body`` is asked for.
    """
    tag = F.struct("start", (-F.col("end")).alias("back"), "tag_id", "end", "name", "struct", F.col("attrs")["lang"].alias("language"))
    listed = tags.groupBy(key).agg(F.array_sort(F.collect_list(tag)).alias("_t"))
    kinds = F.create_map(*(F.lit(x) for pair in S.TAG_TYPES.items() for x in pair))

    def named(t: Column, i: Column) -> Column:
        heading = (t["name"] == "p") & _is_heading(F.col("_b"), t["start"], t["end"])
        name = F.when(heading, "heading").otherwise(t["name"])
        return F.struct((i + 1).alias("ord"), t["start"].alias("start"), t["end"].alias("end"), name.alias("name"), t["struct"].alias("struct"), t["language"].alias("language"))

    def typed(t: Column) -> Column:
        body = _piece(F.col("_b"), t["start"], F.greatest(t["end"] - t["start"], F.lit(0)))
        own = F.get(F.array(kinds[t["name"]]), F.lit(0))
        head = F.when(t["name"] == "heading", S.header_types(body))
        return F.struct(t.alias("t"), own.alias("own"), head.alias("head"), F.when(t["name"] == "claim", S.claim_references(body)).alias("refs"))

    known = (
        listed.join(texts.select(key, "text"), key)
        .withColumn("_b", _blocks(F.col("text")))
        .withColumn("_t", F.transform("_t", named))
        .withColumn("_t", F.transform("_t", typed))
        .withColumn("_a", S.stacked(F.transform("_t", lambda x: F.struct(x["t"]["ord"].alias("ord"), x["t"]["start"].alias("start"), x["t"]["end"].alias("end"), x["own"].alias("label")))))
    )
    rows = known.select(key, "text", F.explode(F.arrays_zip("_t", "_a")).alias("_x")).select(key, "text", "_x._t.*", F.col("_x._a.around").alias("around")).select(
        key, "text", "t.*", "own", "head", "refs", "around"
    )
    longer = F.filter("around", lambda o: o["e"] - o["s"] > F.col("end") - F.col("start"))
    nearest = F.array_max(F.transform(longer, lambda o: F.struct(o["s"].alias("s"), o["ord"].alias("id"))))
    inherited = F.filter(F.col("around")["label"], lambda x: x.isNotNull())
    nodes = rows.select(
        key, "ord", "name", "struct", "language", "start", "end", "refs",
        nearest["id"].alias("parent_id"), F.concat(inherited, F.array_compact(F.array("own"))).alias("_base"), F.col("head").alias("types"),
        (F.col("name") == "heading").alias("is_header"), (F.col("name") == "claims").alias("is_stop"), _body(F.col("start"), F.col("end")).alias("body"),
    )
    spread = S.spread_headers(nodes, key).withColumn("types", F.when(F.col("header_types").isNull(), F.col("_base")).otherwise(S.with_header_types(F.col("_base"), F.col("header_types"))))
    claim = F.col("name") == "claim"
    number = F.sum(claim.cast("int")).over(Window.partitionBy(key).orderBy("ord"))
    return spread.select(
        key,
        F.col("ord").alias("section_id"),
        "parent_id",
        "struct",
        "types",
        "language",
        F.lit(None).cast("string").alias("title"),
        "start",
        "end",
        F.when(claim, number).cast("int").alias("claim_number"),
        F.col("refs").alias("parent_claims"),
        "body",
    ).select(key, *SECTION)


def article_sections(texts: DataFrame, tags: DataFrame, key: str = "doc_id", reach: int = 30) -> DataFrame:
    """Sections of articles: texts under their headers, the headers, abstracts, and what none of them covers."""
    kind = F.col("attrs")["TYPE"]
    span = lambda frame: frame.select(key, "tag_id", "start", "end")
    turn = F.row_number().over(Window.partitionBy(key, "start").orderBy("tag_id"))
    titles = span(tags.where("name = 'title'")).withColumn("turn", turn).select(key, F.col("tag_id").alias("h_id"), F.col("start").alias("h_start"), F.col("end").alias("h_end"), "turn")
    secs = span(tags.where("name = 'sec'")).withColumn("turn", turn)
    # of titles and sections that begin alike the first goes with the first; the section then begins after its title
    met = titles.join(secs.withColumnRenamed("start", "h_start").drop("tag_id"), [key, "h_start", "turn"])
    direct = met.select(key, F.lit(0).alias("rank"), "h_id", "h_start", "h_end", (F.col("h_end") + 1).alias("start"), "end")
    structures = tags.where(F.col("name") == "STRUCTURE")
    heads = structures.where(kind == "TITLE").select(key, F.col("tag_id").alias("h_id"), "start", "end")
    bodies = structures.where(kind.startswith("TEXT")).select(key, "start", "end", (kind == "TEXT_CHUNK").alias("is_chunk"))
    near = S.headed(heads, bodies, reach, key).select(key, "h_start", "h_end", "start", "end")
    banded = heads.withColumnRenamed("start", "h_start").withColumnRenamed("end", "h_end").join(near, [key, "h_start", "h_end"]).select(key, F.lit(1).alias("rank"), "h_id", "h_start", "h_end", "start", "end")
    matched = direct.union(banded)
    header_text = _body(F.col("h_start"), F.col("h_end"))
    abstract = (F.col("name") == "abstract") | ((F.col("name") == "STRUCTURE") & (kind == "ABSTRACT"))
    with_text = lambda frame: frame.join(texts.select(key, "text"), key)
    one = lambda t: F.array(F.lit(t))
    named = (
        with_text(matched).select(key, F.lit(0).alias("part"), "rank", "h_id", S.header_types(header_text).alias("types"), header_text.alias("title"), "start", "end")
        .union(matched.select(key, F.lit(1), "rank", "h_id", one("Header"), F.lit(None).cast("string"), "h_start", "h_end"))
        .union(tags.where(abstract).select(key, F.lit(2), F.lit(0), "tag_id", one("Abstract"), F.lit(None).cast("string"), "start", "end"))
    )
    empty = S.gaps(named.select(key, "start", "end"), texts.select(key, F.length("text").alias("length")), key)
    every = named.union(empty.select(key, F.lit(3), F.lit(0), F.col("start"), one("Unlabeled"), F.lit(None).cast("string"), "start", "end"))
    order = Window.partitionBy(key).orderBy("part", "rank", "h_id", "start")
    numbered = with_text(every.withColumn("section_id", F.row_number().over(order).cast("int")))
    rows = numbered.select(
        key, "section_id", F.lit(None).cast("string").alias("struct"), "types", F.lit(None).cast("string").alias("language"),
        F.trim(F.regexp_replace("title", r"\s+", " ")).alias("title"), F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"),
        F.lit(None).cast("int").alias("claim_number"), F.lit(None).cast("array<int>").alias("parent_claims"), _body(F.col("start"), F.col("end")).alias("body"),
    )
    return _linked(rows, key).select(key, *SECTION)


def section_lines(sections: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, section_id, start, line) of sections that have text; suppressed ones keep their number."""
    line = S.section_line({c: F.col(c) for c in SECTION})
    return sections.where(F.trim(F.regexp_replace("body", r"\s+", " ")) != "").select(key, "section_id", "start", line.alias("line"))


def pick(sections: DataFrame, types: list[str] | None = None, struct: str | None = None) -> DataFrame:
    """Sections that have all of ``types`` and stand in ``struct`` tags; None asks for nothing."""
    out = sections if struct is None else sections.where(F.col("struct") == struct)
    for t in types or []:
        out = out.where(F.array_contains("types", t))
    return out


def neighbours(sections: DataFrame, key: str = "doc_id") -> DataFrame:
    """Add ``prev_id`` and ``next_id`` in order of start."""
    order = Window.partitionBy(key).orderBy("start", "section_id")
    return sections.withColumn("prev_id", F.lag("section_id").over(order)).withColumn("next_id", F.lead("section_id").over(order))


def type_weight(sections: DataFrame, wanted: str, key: str = "doc_id") -> DataFrame:
    """One row, ``weight``: characters in outermost sections of a type, over characters in outermost sections."""
    size = F.col("end") - F.col("start")
    pairs = S.links(sections, key).join(
        sections.select(F.col(key).alias("_k"), F.col("section_id").alias("_id"), F.array_contains("types", wanted).alias("_has")),
        (F.col(key) == F.col("_k")) & (F.col("subsumer_id") == F.col("_id")),
    )
    above = pairs.groupBy(key, "section_id").agg(F.max("_has").alias("_in"))
    placed = sections.join(above, [key, "section_id"], "left")
    own = F.sum(F.when(F.array_contains("types", wanted) & ~F.coalesce("_in", F.lit(False)), size))
    return placed.agg((F.coalesce(own, F.lit(0)) / F.sum(F.when(F.col("_in").isNull(), size))).alias("weight"))
