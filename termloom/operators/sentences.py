"""From fielded lines to tagged sentences, chunks and feature rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions import features, tagging, text
from termloom.plans import chunking


def lines_of(docs: DataFrame, key: str = "doc_id", body: str = "text") -> DataFrame:
    """(key, line_no, line): the lines of each text, numbered from 0, cleaned; over-long ones go."""
    cut = docs.select(key, F.posexplode(F.split(F.col(body), "\n", -1)).alias("line_no", "line"))
    return cut.where(text.keep_line(F.col("line"))).withColumn("line", text.fix_line(F.col("line")))


def section_name(header: Column) -> Column:
    """The piece of an ``FH_NAME:`` line after its first underscore, up to the next one."""
    return F.rtrim(F.element_at(F.split(header, "_"), 2), F.lit(": "))


def sections_of(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """Fielded lines with ``section`` (FH_NONE before any header) and ``header_no``; headers and END marks go."""
    order = Window.partitionBy(key).orderBy("line_no")
    header = F.when(F.col("line").startswith("FH_"), F.col("line"))
    filled = lines.withColumn("_header", F.last(header, ignorenulls=True).over(order)).withColumn(
        "header_no", F.count(header).over(order).cast("int")
    )
    return (
        filled.where(~F.col("line").startswith("FH_") & (F.col("line") != "END"))
        .withColumn("section", F.coalesce(section_name(F.col("_header")), F.lit("NONE")))
        .drop("_header")
    )


def years_of(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, year): the first four characters of the DATE field's first line with text, 9999 without one; over lines with sections."""
    from termloom.operators import stats
    from termloom.sources import manifests

    return stats.first_in_section(lines, "DATE", key).select(key, manifests.year_of(F.trim("line")).alias("year"))


def title_sections(lines: DataFrame) -> DataFrame:
    """Plain lines: the first is the TITLE, the others are the DESC section."""
    first = F.col("line_no") == 0
    return lines.withColumn("section", F.when(first, "TITLE").otherwise("DESC")).withColumn("header_no", F.when(first, 1).otherwise(2))


def sentences_of(lines: DataFrame, key: str = "doc_id", pretagged: bool = False) -> DataFrame:
    """(key, sent_id, section, sent_in_section, toks): tagged sentences, numbered from 0 in document and section."""
    if pretagged:
        toks = lines.select(key, "line_no", "section", "header_no", F.lit(0).alias("part"), tagging.parse_tagged(F.col("line")).alias("toks"))
    else:
        parts = lines.select(key, "line_no", "section", "header_no", F.posexplode(tagging.split_sentences(F.col("line"))).alias("part", "sentence"))
        toks = parts.withColumn("_t", tagging.split_tokens(F.col("sentence"))).withColumn("toks", tagging.tagged(F.col("_t"))).drop("_t", "sentence")
    order = Window.partitionBy(key).orderBy("line_no", "part")
    inside = Window.partitionBy(key, "header_no").orderBy("line_no", "part")
    return toks.where(F.size("toks") > 0).select(
        key,
        (F.row_number().over(order) - 1).cast("int").alias("sent_id"),
        "section",
        (F.row_number().over(inside) - 1).cast("int").alias("sent_in_section"),
        "toks",
    )


def document_tokens(docs: DataFrame, key: str = "doc_id", body: str = "text") -> DataFrame:
    """The sentences of ``document_sentences`` with ``tokens`` (array<string>) in place of tagged ones."""
    from termloom.operators import occurrences

    return occurrences.sentence_rows(docs.select(key, body), body, tags=False)


def document_sentences(docs: DataFrame, key: str = "doc_id", body: str = "text") -> DataFrame:
    """What ``sentences_of(title_sections(lines_of(docs)))`` gives of documents whose key is theirs alone: one pass over the texts, no shuffle."""
    from termloom.operators import occurrences

    return occurrences.sentence_rows(docs.select(key, body), body)


def chunks_of(sentences: DataFrame, schema: str | chunking.Schema, key: str = "doc_id") -> DataFrame:
    """A row for each chunk: its span, phrase, tags and the sentence it stands in. No shuffle."""
    rules = chunking.SCHEMAS[schema] if isinstance(schema, str) else schema
    spans = sentences.withColumn("_c", F.explode(chunking.fold(F.col("toks"), rules)))
    own = F.slice("toks", F.col("_c.cs") + 1, F.col("_c.ce") - F.col("_c.cs"))
    return spans.select(
        *sentences.columns,
        F.col("_c.cs").alias("cs"),
        F.col("_c.ce").alias("ce"),
        F.array_join(own["tok"], " ").alias("phrase"),
        F.array_join(own["lc"], " ").alias("term"),
        F.array_join(own["tag"], "_").alias("tag_sig"),
    )


def with_verbs(sentences: DataFrame) -> DataFrame:
    """Add ``verbs``, the governing verb at each place: once for a sentence instead of once for each of its chunks."""
    return sentences.withColumn("verbs", features.governing_verbs(F.col("toks")))


def title_nouns(sentences: DataFrame, key: str = "doc_id", lead: tuple[str, ...] = ("TITLE", "ABSTRACT")) -> DataFrame:
    """Sentences with ``lead_nouns``, the lower-cased nouns of title and abstract so far, this sentence's included."""
    nouns = F.transform(F.filter("toks", lambda t: t["tag"].startswith("N")), lambda t: t["lc"])
    own = F.when(F.col("section").isin(*lead), nouns)  # others are null, which no list collects: it grows with title and abstract only
    so_far = Window.partitionBy(key).orderBy("sent_id").rowsBetween(Window.unboundedPreceding, 0)
    return sentences.withColumn("lead_nouns", F.array_distinct(F.flatten(F.collect_list(own).over(so_far))))


def candidates(chunks: DataFrame, filtered: bool, key: str = "doc_id") -> DataFrame:
    """Chunks with ``uid`` (counted before the filter); the filter keeps titles and chunks that share a word with ``lead_nouns``.

    Counting sorts each document's chunks: drop what is no longer needed first, ``toks`` above all.
    """
    order = Window.partitionBy(key).orderBy("sent_id", "cs")
    numbered = chunks.withColumn("uid", F.concat_ws("_", F.col(key).cast("string"), (F.row_number().over(order) - 1).cast("string")))
    if not filtered:
        return numbered
    return numbered.where((F.col("section") == "TITLE") | F.arrays_overlap(F.split("term", " "), "lead_nouns"))


def feature_rows(chunks: DataFrame, language: str = "en", names: list[str] | None = None) -> DataFrame:
    """Chunks with ``features``, the sorted name=value strings."""
    context = {c: F.col(c) for c in ("sent_id", "section", "sent_in_section", "verbs") if c in chunks.columns}
    made = features.render(language, F.col("toks"), F.col("cs"), F.col("ce"), context, names)
    return chunks.withColumn("features", made)


def highlight(toks: Column, cs: Column, ce: Column) -> Column:
    """The sentence with the chunk between <np> and </np>, tokens escaped."""

    def one(t: Column, i: Column) -> Column:
        safe = text.escape_xml(t["tok"])
        return F.concat(F.when(i == cs, "<np>").otherwise(""), safe, F.when(i == ce - 1, "</np>").otherwise(""))

    return F.array_join(F.transform(toks, one), " ")


def tsv_row(uid: Column, year: Column, term: Column, feats: Column) -> Column:
    return F.concat_ws("\t", uid, year, term, feats)
