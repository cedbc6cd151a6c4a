"""Counts over terms, tokens, sections, identifiers and domains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def term_counts(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("term").agg(F.count("*").alias("n"))


def type_token_counts(terms: DataFrame, *keys: str) -> DataFrame:
    return terms.groupBy(*keys).agg(F.countDistinct("term").alias("types"), F.count("*").alias("tokens"))


def token_counts(docs: DataFrame, *keys: str, body: str = "text") -> DataFrame:
    """Documents, lines and white-space tokens of texts, header lines included, by the given keys."""
    tokens = F.regexp_count(F.col(body), F.lit(r"[^ \n\t\r\f]+")).cast("long")
    return docs.groupBy(*keys).agg(F.count("*").alias("docs"), F.sum(F.size(F.split(F.col(body), "\n", -1))).alias("lines"), F.sum(tokens).alias("tokens"))


def first_in_section(lines: DataFrame, section: str, key: str = "doc_id") -> DataFrame:
    """(key, line): the first line with text of a section, over lines with ``section``, ``line_no`` and ``line``; null for documents without one."""
    hit = F.when((F.col("section") == section) & (F.trim("line") != ""), F.struct("line_no", "line"))
    return lines.groupBy(key).agg(F.min(hit).alias("_f")).select(key, F.col("_f.line").alias("line"))


def subject_histogram(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """How many documents have each first line of the subject field; null counts those without one."""
    return first_in_section(lines, "SUBJECT", key).groupBy(F.col("line").alias("subject")).agg(F.count("*").alias("n"))


def list_analysis(paths: DataFrame, path: str = "path") -> DataFrame:
    """Of a list of files letter/journal_number/name: lines, distinct names, distinct short paths and journals, by the journal's letter.

    A journal's name is its folder without digits, dashes and underscores at the end; the short path is letter, journal and name.
    """
    parts = F.split(F.col(path), "/")
    name = F.element_at(parts, -1)
    journal = F.rtrim(F.element_at(parts, -2), F.lit("_-1234567890"))
    named = paths.select(F.left(journal, F.lit(1)).alias("letter"), journal.alias("journal"), name.alias("name"))
    short = F.struct("letter", "journal", "name")
    return named.groupBy("letter").agg(
        F.count("*").alias("lines"), F.countDistinct("name").alias("names"), F.countDistinct(short).alias("short_paths"), F.countDistinct("journal").alias("journals")
    )


def common_types(sections: DataFrame, most: int = 100) -> DataFrame:
    """The most frequent section types; ties by name."""
    counted = sections.select(F.explode("types").alias("type")).groupBy("type").agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), "type").limit(most)


def type_frequency(sections: DataFrame, key: str = "doc_id") -> DataFrame:
    """Share of documents that have each type."""
    total = sections.agg(F.countDistinct(key)).scalar()
    having = sections.select(key, F.explode("types").alias("type")).distinct().groupBy("type").agg(F.count("*").alias("n"))
    return having.select("type", F.round(F.col("n") / total, 6).alias("share"))


def sections_of_type(sections: DataFrame, wanted: str, most: int = 20, key: str = "doc_id") -> DataFrame:
    return sections.where(F.array_contains("types", wanted)).orderBy(key, "section_id").limit(most)


def set_overlap(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """How many values both sides, either, only the first and only the second have."""
    sides = a.select(column, F.lit(1).alias("a"), F.lit(0).alias("b")).union(b.select(column, F.lit(0).alias("a"), F.lit(1).alias("b")))
    each = sides.groupBy(column).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    count = lambda test: F.coalesce(F.sum(F.expr(test).cast("long")), F.lit(0))
    kinds = {"both": "a = 1 AND b = 1", "either": "true", "only_first": "b = 0", "only_second": "a = 0"}
    row = each.agg(*(count(t).alias(k) for k, t in kinds.items()))
    return row.unpivot([], list(kinds), "kind", "n")


def domain_lookup(codes: DataFrame, domains: DataFrame, key: str = "doc_id") -> DataFrame:
    """Codes (key, major, minor) to the domain of the shorter code, or else of the longer; the first by name for each key."""
    long = domains.select(F.col("code").alias("_long"), F.col("domain").alias("_d1"))
    short = domains.select(F.col("code").alias("_short"), F.col("domain").alias("_d2"))
    met = codes.join(short, codes["major"] == F.col("_short"), "left").join(long, F.concat("major", "minor") == F.col("_long"), "left")
    return met.groupBy(key).agg(F.min(F.coalesce("_d2", "_d1")).alias("domain"))


def first_by(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def latest_by(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The last row of each key: what loading an index line by line leaves."""
    return first_by(rows, keys, *(c.desc() for c in order))


def duplicates(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their number."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def membership(ids: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """One row: how many rows of ``ids`` are in ``known`` and how many are not."""
    met = ids.join(known.select(key).distinct().withColumn("_there", F.lit(1)), key, "left")
    return met.agg(F.count("_there").alias("inside"), (F.count("*") - F.count("_there")).alias("outside"))


def histogram(rows: DataFrame, value: Column, name: str = "value") -> DataFrame:
    return rows.groupBy(value.alias(name)).agg(F.count("*").alias("n"))


def classification_codes(xml: Column) -> Column:
    """Sorted distinct section-class-subclass codes of the bibliographic part; incomplete ones are left out."""
    head = F.get(F.split(xml, "</bibliographic-data>", 2), F.lit(0))
    blocks = F.regexp_extract_all(head, F.lit(r"(?s)(<classification-ipcr?\b.*?</classification-ipcr?>)"), F.lit(1))

    def code(block: Column) -> Column:
        part = lambda tag: F.regexp_extract(block, rf"<{tag}>\s*([^<]*?)\s*</{tag}>", 1)
        section, cls, sub = part("section"), part("class"), part("subclass")
        return F.when((section != "") & (cls != "") & (sub != ""), F.concat_ws("-", section, cls, sub))

    return F.array_sort(F.array_distinct(F.array_compact(F.transform(blocks, code))))


def domain_table(lines: DataFrame) -> DataFrame:
    """(code, domain) from lines (line_no, line): a domain's line, then its codes indented below it."""
    order = Window.orderBy("line_no")  # one small file
    head = F.regexp_extract("line", r"^(\S+)\s+-", 1)
    filled = lines.withColumn("domain", F.last(F.when(head != "", head), ignorenulls=True).over(order))
    code = F.regexp_extract("line", r"^\s+(\S+)", 1)
    return filled.where(code != "").select(code.alias("code"), "domain")


def years_and_domains(paths: DataFrame, dates: DataFrame, domains: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, year, domain): the year of the application's date, 9999 without one; the domain may be missing."""
    dated = dates.select(key, F.left("date", F.lit(4)).alias("year"))
    return paths.select(key).join(dated, key, "left").join(domains.select(key, "domain"), key, "left").withColumn("year", F.coalesce("year", F.lit("9999")))


def short_id(path: Column) -> Column:
    """A file's name without folder, extension, country and kind: digits with their letter prefix."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    return F.regexp_replace(F.regexp_replace(name, r"\.[A-Za-z.]+$", ""), r"^US|[A-Z]\d?$", "")


def unique_path(ids: DataFrame, index: DataFrame, key: str = "short_id") -> DataFrame:
    """Each id with its path if the index has exactly one for it, else null."""
    one = index.groupBy(key).agg(F.count("*").alias("_n"), F.first("path").alias("path")).where("_n = 1").drop("_n")
    return ids.join(one, key, "left")


def patent_id(name: Column) -> Column:
    """struct(prefix, number, kind) of US0123456A1 and the like; null parts where the name doesn't fit."""
    bare = F.regexp_replace(F.regexp_replace(name, r"\.[A-Za-z]+$", ""), "^US", "")
    pattern = r"^(HD|RE|PP|B|D|H|T)?(\d+)(.*)$"
    part = lambda k: F.when(bare.rlike(pattern), F.regexp_extract(bare, pattern, k))
    return F.struct(part(1).alias("prefix"), part(2).alias("number"), part(3).alias("kind"))


def id_path(ident: Column) -> Column:
    """The folder of an identifier: years, letters or leading digits, and all but the last two characters."""
    n = F.length(ident)
    lead = (
        F.when(ident.rlike("^(19|20)"), 4).when(ident.rlike("^[A-Z]{2}"), 2).when(ident.rlike("^[A-Z]"), 1).otherwise(2)
    )
    head = F.left(ident, lead)
    rest = F.substring(ident, lead + 1, F.greatest(n - lead - 2, F.lit(0)))
    return F.concat_ws("/", head, rest)
