"""Document structure as interval algebra over tags (doc, tag_id, name, start, end), half-open offsets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The type of a section by its tag's name.
TAG_TYPES = {
    "abstract": "Abstract", "claim": "Claim", "claims": "Claims", "date": "Meta-Date", "description": "Description", "heading": "Header",
    "invention-title": "Meta-Title", "related-apps": "Related_Applications", "summary": "Summary",
}
#: A short paragraph with one of these is a heading.
HEADER_WORDS = ("background", "description of prior art", "description of related art", "field", "summary")
#: Fixed values, semantic header types: pieces that call for one, pieces that forbid it, in a header of lower-case letters only.
HEADER_TYPES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "Abbreviations": (("abbreviat",), ()),
    "Abstract": (("abstract",), ("e", "ion")),
    "Acknowledgements": (("acknowledg",), ()),
    "Analysis": (("analyses", "analysis"), ("statistic",)),
    "Authors' Contributions": (("authorscontributions",), ()),
    "Background": (("background",), ()),
    "Case Report": (("case",), ()),
    "Competing Interests": (("competinginterests",), ()),
    "Conclusion": (("conclu", "summary"), ("invention",)),
    "Discussion": (("discuss",), ()),
    "Examples": (("example",), ()),
    "Field": (("field",), ()),
    "Figures": (("drawing", "figure", "illust"), ()),
    "Government Interest": (("government",), ()),
    "Images": (("image",), ()),
    "Introduction": (("introduction",), ()),
    "Invention": (("invention",), ("background", "field", "summary")),
    "Materials": (("material",), ("supplement",)),
    "Methods": (("experiment", "implementation", "method", "procedure", "studydesign"), ()),
    "Operation": (("operation",), ()),
    "Preferred Embodiments": (("preferredembodiment",), ()),
    "Prepublication History": (("prepublicationhistory",), ()),
    "Purpose": (("objective", "purpose"), ()),
    "References": (("reference",), ()),
    "Results": (("result",), ()),
    "Statistical Analysis": (("statistic",), ()),
    "Subjects": (("participants", "patient", "population", "subjects"), ("communication",)),
    "Summary": (("summar",), ()),
    "Supplementary": (("supplement", "supporting"), ()),
    "Tables": (("table",), ("abbreviat",)),
}


def in_order(tags: DataFrame, key: str = "doc_id") -> DataFrame:
    """Tags with ``ord``, their place in document order: outer ones first."""
    order = Window.partitionBy(key).orderBy("start", F.desc("end"), "tag_id")
    return tags.withColumn("ord", F.row_number().over(order).cast("int"))


def enclosing(ordered: DataFrame, label: Column, key: str = "doc_id") -> DataFrame:
    """(key, ord, around): of each tag the earlier ones that enclose it, outermost first, as structs of ``ord``, the string ``label``, and
    their span ``s`` to ``e``.

    One fold over a document's tags in order keeps those on a stack that may still enclose a later one, so n tags that nest take n
    steps of their depth; tags that cross stay on it too, which makes it right for any.
    """
    tag = F.struct("ord", "start", "end", label.alias("label"))
    each = ordered.groupBy(key).agg(F.array_sort(F.collect_list(tag)).alias("_t"))
    return each.select(key, F.explode(stacked(F.col("_t"))).alias("_f")).select(key, F.col("_f.ord").alias("ord"), F.col("_f.around").alias("around"))


def stacked(tags: Column) -> Column:
    """``enclosing`` of one document: array<struct<ord, around>> of its tags (ord, start, end, label) in order."""
    near = "array<struct<ord: int, s: int, e: int, label: string>>"
    start = F.struct(
        F.expr(f"cast(array() as {near})").alias("open"),
        F.expr(f"cast(array() as array<struct<ord: int, around: {near}>>)").alias("out"),
    )

    def step(a: Column, t: Column) -> Column:
        # what ends before this one begins can enclose nothing later; an empty tag at that very place is still inside
        still = F.filter(a["open"], lambda o: (o["e"] > t["start"]) | ((o["e"] == t["start"]) & (t["end"] == t["start"])) | (o["s"] == t["start"]))
        own = F.struct(t["ord"].cast("int").alias("ord"), t["start"].cast("int").alias("s"), t["end"].cast("int").alias("e"), t["label"].alias("label"))
        around = F.filter(still, lambda o: (o["s"] <= t["start"]) & (o["e"] >= t["end"]))
        found = F.struct(t["ord"].cast("int").alias("ord"), around.alias("around"))
        return F.struct(F.concat(still, F.array(own)).alias("open"), F.concat(a["out"], F.array(found)).alias("out"))

    return F.aggregate(tags, start, step, lambda a: a["out"])


def parents(ordered: DataFrame, key: str = "doc_id") -> DataFrame:
    """``parent``: the ``ord`` of the nearest earlier tag that encloses each, null at the top."""
    around = F.col("around")
    found = enclosing(ordered, F.lit(None).cast("string"), key).select(key, "ord", F.get(around, F.size(around) - 1)["ord"].alias("parent"))
    return ordered.join(found, [key, "ord"], "left")


def links(sections: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, section_id, subsumer_id): every section with those that enclose it and are longer."""
    outer = sections.select(F.col(key).alias("_k"), F.col("section_id").alias("subsumer_id"), F.col("start").alias("_s"), F.col("end").alias("_e"))
    longer = F.col("_e") - F.col("_s") > F.col("end") - F.col("start")
    inside = (F.col(key) == F.col("_k")) & (F.col("_s") <= F.col("start")) & (F.col("_e") >= F.col("end")) & longer
    return sections.select(key, "section_id", "start", "end").join(outer, inside).select(key, "section_id", "subsumer_id")


def gaps(sections: DataFrame, lengths: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start, end) of what no section covers, the tail up to ``length`` included."""
    before = Window.partitionBy(key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    seen = sections.withColumn("covered", F.coalesce(F.max("end").over(before), F.lit(0)))
    inner = seen.where("start > covered").select(key, F.col("covered").alias("start"), F.col("start").alias("end"))
    most = sections.groupBy(key).agg(F.max("end").alias("_most"))
    tail = lengths.join(most, key, "left").withColumn("_most", F.coalesce("_most", F.lit(0))).where("_most < length")
    return inner.union(tail.select(key, F.col("_most").cast("int").alias("start"), F.col("length").cast("int").alias("end")))


def is_header(body: Column, words: tuple[str, ...] = HEADER_WORDS, longest: int = 50) -> Column:
    """Whether a text is short, white space made one space, and has one of the words; null for null."""

    def told(flat: Column) -> Column:
        hit = F.lit(False)
        for w in words:
            hit = hit | flat.contains(w)
        return (F.length(flat) < longest) & hit

    return _let(F.trim(F.regexp_replace(F.lower(body), r"\s+", " ")), told)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once: the one element of an array is bound to a lambda's variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def norm_header(header: Column) -> Column:
    """Lower case without anything but letters and underscores."""
    return F.regexp_replace(F.lower(header), r"\W|\d", "")


def header_types(header: Column) -> Column:
    """Sorted semantic types of a header; Other if none."""

    def holds(flat: Column, pieces: tuple[str, ...]) -> Column:
        out = F.lit(False)
        for p in pieces:
            out = out | flat.contains(p)
        return out

    def found(flat: Column) -> Column:
        return F.array_compact(F.array(*(F.when(holds(flat, yes) & ~holds(flat, no), F.lit(t)) for t, (yes, no) in HEADER_TYPES.items())))

    types = _let(norm_header(header), found)
    return F.when(F.size(types) > 0, F.array_sort(types)).otherwise(F.array(F.lit("Other")))


def header_types_sql(flat: str) -> str:
    """The same as a list for another engine, in type order."""
    cases = []
    for t, (yes, no) in HEADER_TYPES.items():
        test = " OR ".join(f"contains({flat}, '{p}')" for p in yes)
        bar = "".join(f" AND NOT contains({flat}, '{p}')" for p in no)
        cases.append(f"CASE WHEN ({test}){bar} THEN '{t.replace(chr(39), chr(39) * 2)}' END")
    return f"list_filter([{', '.join(cases)}], x -> x IS NOT NULL)"


def spread_headers(nodes: DataFrame, key: str = "doc_id") -> DataFrame:
    """Nodes (key, ord, is_header, is_stop, types) with ``header_types``: a header's types hold for it and all that follow, until
    the next header or a stop."""
    order = Window.partitionBy(key).orderBy("ord")
    group = F.sum((F.col("is_header") | F.col("is_stop")).cast("int")).over(order)
    grouped = nodes.withColumn("_g", group)
    inside = Window.partitionBy(key, "_g").orderBy("ord")
    first = F.first(F.when(F.col("is_header"), F.col("types"))).over(inside)
    return grouped.withColumn("header_types", first).drop("_g")


def claim_references(body: Column) -> Column:
    return F.transform(F.regexp_extract_all(body, F.lit(r"claim (\d+)"), F.lit(1)), lambda x: x.cast("int"))


def with_header_types(types: Column, more: Column) -> Column:
    """Node types and those header types that differ from the last node type."""
    last = F.element_at(types, -1)
    return F.when(F.size(types) > 0, F.concat(types, F.filter(more, lambda x: ~x.eqNullSafe(last)))).otherwise(more)


def section_line(s: dict[str, Column]) -> Column:
    """A section as text; fields without a value are left out."""
    quoted = lambda n, c: F.concat(F.lit(n + '="'), c, F.lit('"'))
    plain = lambda n, c: F.concat(F.lit(n + "="), c.cast("string"))
    parts = [
        F.lit("SECTION"), plain("ID", s["section_id"]), plain("PARENT_ID", s["parent_id"]), quoted("STRUCT", s["struct"]),
        quoted("TYPE", F.upper(F.array_join(s["types"], "|"))), quoted("LANGUAGE", s["language"]), quoted("TITLE", s["title"]),
        plain("START", s["start"]), plain("END", s["end"]), plain("CLAIM_NUMBER", s["claim_number"]),
        F.when(F.size(s["parent_claims"]) > 0, F.concat(F.lit("PARENT_CLAIMS="), F.array_join(s["parent_claims"].cast("array<string>"), ","))),
    ]
    return F.concat_ws(" ", *parts)


def best_structure(candidates: DataFrame, *keys: str) -> DataFrame:
    """Of texts for a header the smallest chunk, or else the largest text."""
    size = F.col("end") - F.col("start")
    order = Window.partitionBy(*keys).orderBy(F.desc("is_chunk"), F.when(F.col("is_chunk"), size).otherwise(-size), "start")
    return candidates.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")


def headed(headers: DataFrame, texts: DataFrame, reach: int = 30, key: str = "doc_id") -> DataFrame:
    """Headers with the text that begins near them: (key, h_start, h_end, start, end, is_chunk)."""
    h = headers.select(key, F.col("start").alias("h_start"), F.col("end").alias("h_end"))
    near = h.join(texts.select(key, "start", "end", "is_chunk"), key).where(
        f"h_start < start + {reach} AND start - h_end < {reach}"
    )
    return best_structure(near, key, "h_start", "h_end")
