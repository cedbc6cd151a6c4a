"""The engine's queries over the driver's tables, each with the same question in another engine's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termloom.functions import tagging, text
from termloom.operators import sentences as S
from termloom.operators import stats
from termloom.operators.occurrences import chunk_rows, token_rows
from termloom.operators import structure as D
from termloom.plans import chunking
from termloom.runtime import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


# --- shared pieces -----------------------------------------------------------------------------------------------------

def _lines(spark, d):
    return S.lines_of(table(spark, d, "documents").select("doc_id", "text"))


def _sentences(spark, d):
    return S.document_sentences(table(spark, d, "documents").select("doc_id", "text"))


def _chunks(spark, d, schema):
    return S.chunks_of(_sentences(spark, d), schema)


def _texts(spark, d, *columns):
    return table(spark, d, "documents").select(*(columns or ("doc_id",)), "text")


def _uid():
    return F.concat_ws("_", F.col("doc_id").cast("string"), F.col("ordinal").cast("string"))


_LINES = r"""l0 AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INT) AS line_no FROM documents
), l AS (
  SELECT doc_id, line_no, regexp_replace(regexp_replace(line, '^[\n\r\f]+|[\n\r\f]+$', '', 'g'), '[~\x08]', '', 'g') AS line FROM l0 WHERE length(line) <= 10000
)"""
_SENT = r"""s0 AS (
  SELECT doc_id, line_no, list_filter(string_split(regexp_replace(line, '([.!?])\s+', '\1' || chr(10), 'g'), chr(10)), lambda x: x <> '') AS parts FROM l
), s1 AS (
  SELECT doc_id, line_no, unnest(parts) AS s, generate_subscripts(parts, 1) - 1 AS part FROM s0
), s2 AS (
  SELECT doc_id, line_no, part, list_filter(regexp_split_to_array(regexp_replace(s, '([.,;:!?])(\s|$)', ' \1\2', 'g'), '\s+'), lambda x: x <> '') AS toks FROM s1
), s AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line_no, part) - 1 AS INT) AS sent_id,
    CASE WHEN line_no = 0 THEN 'TITLE' ELSE 'DESC' END AS section,
    CAST(row_number() OVER (PARTITION BY doc_id, line_no = 0 ORDER BY line_no, part) - 1 AS INT) AS sent_in_section, toks
  FROM s2 WHERE len(toks) > 0
)"""


def _tag_sql(tok: str) -> str:
    import re

    return re.sub(r"MATCH\((lower\(\w+\)|\w+), '([^']*)'\)", r"regexp_full_match(\1, '\2')", tagging.tag_case(tok))


_TOK = f"""t0 AS (
  SELECT doc_id, sent_id, section, sent_in_section, unnest(toks) AS tok, CAST(generate_subscripts(toks, 1) - 1 AS INT) AS i FROM s
), t AS (
  SELECT *, lower(tok) AS lc, {_tag_sql('tok')} AS tag FROM t0
)"""
_BASE = f"WITH {_LINES}, {_SENT}, {_TOK}"


def _islands_sql(schema: str) -> str:
    c = chunking.SCHEMAS[schema]
    return f"""f AS (
  SELECT doc_id, sent_id, i, {chunking.rules_sql(c.start)} AS st, {chunking.rules_sql(c.cont)} AS c, {chunking.rules_sql(c.end)} AS e FROM t
), g AS (
  SELECT *, sum(CASE WHEN c THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, sent_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS grp,
    count(*) OVER (PARTITION BY doc_id, sent_id) AS n FROM f
), h AS (
  SELECT doc_id, sent_id, grp, min(CASE WHEN st THEN i END) AS cs, max(CASE WHEN e THEN i END) AS le, max(i) AS mx, max(n) AS n FROM g WHERE c GROUP BY ALL
), c AS (
  SELECT doc_id, sent_id, CAST(cs AS INT) AS cs, CAST(CASE WHEN mx = n - 1 THEN n ELSE le + 1 END AS INT) AS ce
  FROM h WHERE cs IS NOT NULL AND (mx = n - 1 OR le >= cs)
), w AS (
  SELECT doc_id, sent_id, any_value(section) AS section, any_value(sent_in_section) AS sent_in_section,
    list(lc ORDER BY i) AS lcs, list(tag ORDER BY i) AS tags FROM t GROUP BY doc_id, sent_id
), p AS (
  SELECT c.*, w.section, w.sent_in_section, w.lcs, w.tags, array_to_string(lcs[cs + 1:ce], ' ') AS term, array_to_string(tags[cs + 1:ce], '_') AS tag_sig
  FROM c JOIN w USING (doc_id, sent_id)
)"""


# --- lines and text ------------------------------------------------------------------------------------------------------

@query(f"WITH {_LINES} SELECT doc_id, line_no, line FROM l")
def doc_lines(spark, d):
    return _lines(spark, d).select("doc_id", F.col("line_no").cast("int").alias("line_no"), "line")


@query("SELECT lang, count(*) AS docs, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS lines, CAST(sum(len(regexp_extract_all(text, '[^ \\n\\t\\r\\f]+'))) AS BIGINT) AS tokens FROM documents GROUP BY lang")
def token_counts_by_lang(spark, d):
    return stats.token_counts(table(spark, d, "documents"), "lang")


@query(r"SELECT page_id, replace(regexp_replace(regexp_replace(html, '(</b>)([A-Za-z0-9])', '\1 \2', 'g'), '([^\s])(<b>)', '\1 \2', 'g'), '™', '') AS html FROM pages")
def clean_markup(spark, d):
    html = text.remove_trademark(text.space_tag(F.col("html"), "b", " "))
    return table(spark, d, "pages").select("page_id", html.alias("html"))


@query(r"SELECT page_id, CAST(len(regexp_extract_all(html, '[^\s]<p>')) + len(regexp_extract_all(html, '</p>[A-Za-z0-9]')) AS BIGINT) AS glued FROM pages")
def tag_statistics(spark, d):
    return table(spark, d, "pages").select("page_id", text.glued_tags(F.col("html"), "p").cast("long").alias("glued"))


@query("SELECT doc_id, array_to_string(list_transform(list_filter(range(1, len(text) + 1), lambda i: substring(text, i, 5) = 'tion '), lambda i: i - 1), ',') AS offsets FROM documents")
def find_offsets(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.array_join(text.find_offsets(F.col("text"), "tion ").cast("array<string>"), ",").alias("offsets"))


@query(r"""WITH x AS (SELECT doc_id, regexp_replace(text, '[ \t\n\r\f]', '', 'g') AS b, regexp_matches(text, '[^\x00-\x{FF}]') AS wide FROM documents)
SELECT doc_id, NOT wide AS latin1, len(b) > 5000 OR (len(b) > 10 AND len(regexp_replace(b, '[^\x00-\x{FF}]', '', 'g')) > 0.9 * len(b))
  OR (len(regexp_replace(b, '[^\x00-\x{FF}]', '', 'g')) = len(b) AND NOT regexp_matches(b, '^[0-9]+$')) AS skippable FROM x""")
def segmenter_guards(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", text.is_latin1(t).alias("latin1"), text.is_skippable(t).alias("skippable"))


# --- tags, chunks, features --------------------------------------------------------------------------------------------------

@query(f"{_BASE} SELECT tag, count(*) AS n FROM t GROUP BY tag")
def pos_tags(spark, d):
    words = S.document_tokens(table(spark, d, "documents").select("doc_id", "text")).select(F.explode("tokens").alias("tok"))
    return words.withColumn("lc", F.lower("tok")).select(tagging.tag_of(F.col("tok"), F.col("lc")).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


@query(f"{_BASE} SELECT doc_id, sent_id, section, sent_in_section, CAST(len(toks) AS INT) AS n_tokens FROM s")
def sentence_table(spark, d):
    rows = S.document_tokens(table(spark, d, "documents").select("doc_id", "text"))  # a count needs no tags
    return rows.select("doc_id", "sent_id", "section", "sent_in_section", F.size("tokens").alias("n_tokens"))


def _chunk_query(name: str):
    def run(spark, d):
        return chunk_rows(_texts(spark, d), name, "sent_id", "cs", "ce", "term", "tag_sig")

    run.__name__ = f"chunks_{name}"
    query(f"{_BASE}, {_islands_sql(name)} SELECT doc_id, sent_id, cs, ce, term, tag_sig FROM p")(run)


for _name in ("en", "en_w_of", "en_w_verbs", "en_w_lists", "en_w_of_org", "de"):
    _chunk_query(_name)


@query(f"{_BASE}, {_islands_sql('en')} SELECT doc_id, sent_id, cs, ce FROM c")
def chunks_by_islands(spark, d):
    return chunking.islands(token_rows(_texts(spark, d)), chunking.SCHEMAS["en"], "doc_id", "sent_id")


_BASIC = ["doc_loc", "sent_loc", "section_loc", "prev_n3", "prev_n2", "next_n3", "next_n2", "next2_tags", "last_word", "suffix3", "suffix4", "suffix5", "first_word", "plen", "tag_sig"]
_around = lambda lo, hi: f"array_to_string(list_transform(range({lo}, {hi}), lambda j: CASE WHEN j < 0 OR j >= len(lcs) THEN '^' ELSE lcs[j + 1] END), '_')"
_BASIC_SQL = {
    "doc_loc": "CAST(sent_id AS VARCHAR)", "sent_loc": "cs || '-' || ce", "section_loc": "section || CASE WHEN sent_in_section = 0 THEN '_sent1' ELSE '_later' END",
    "prev_n3": _around("cs - 3", "cs"), "prev_n2": _around("cs - 2", "cs"), "next_n3": _around("ce", "ce + 3"), "next_n2": _around("ce", "ce + 2"),
    "next2_tags": "nullif(array_to_string(tags[ce + 1:ce + 2], '_'), '')", "last_word": "lcs[ce]",
    **{f"suffix{k}": f"CASE WHEN len(lcs[ce]) >= {k + 3} THEN right(lcs[ce], {k}) END" for k in (3, 4, 5)},
    "first_word": "CASE WHEN ce - cs > 1 THEN lcs[cs + 1] END", "plen": "CAST(ce - cs AS VARCHAR)", "tag_sig": "tag_sig",
}
_LIST_SQL = ", ".join(f"'{k}=' || replace({v}, ' ', '_')" for k, v in _BASIC_SQL.items())


@query(f"{_BASE}, {_islands_sql('en')} SELECT doc_id, sent_id, cs, term, array_to_string(list_sort(list_filter([{_LIST_SQL}], lambda x: x IS NOT NULL)), chr(9)) AS features FROM p")
def features_basic(spark, d):
    return chunk_rows(_texts(spark, d), "en", "sent_id", "cs", "term", "features", names=_BASIC)


_AUX = "'am', 'are', 'be', 'been', 'being', 'had', 'has', 'have', 'having', 'is', 'was', 'were'"
_VERB_SQL = f"""k AS (
  SELECT c.doc_id, c.sent_id, c.cs, t.i, t.lc, t.tag, lag(t.tag) OVER o AS ptag, lag(t.lc) OVER o AS plc
  FROM c JOIN t ON t.doc_id = c.doc_id AND t.sent_id = c.sent_id AND t.i < c.cs WINDOW o AS (PARTITION BY c.doc_id, c.sent_id, c.cs ORDER BY t.i)
), k1 AS (
  SELECT *, max(CASE WHEN tag IN ('RP', 'IN', 'TO') THEN i END) OVER (PARTITION BY doc_id, sent_id, cs) AS last_prep,
    tag IN ('VBG', 'VBP', 'VBZ', 'VB') OR (tag IN ('VBD', 'VBN') AND NOT (ptag = 'DT' OR (ptag LIKE 'V%' AND plc NOT IN ({_AUX})))) AS verb
  FROM k WHERE i > 0
), k2 AS (
  SELECT doc_id, sent_id, cs, max(CASE WHEN verb OR (tag LIKE 'N%' AND NOT verb) OR ((tag LIKE 'J%' OR lc = ',') AND last_prep > i) THEN i END) AS stop FROM k1 GROUP BY ALL
), k3 AS (
  SELECT k2.*, any_value(CASE WHEN k1.i = stop AND verb THEN k1.lc END) AS v, list(k1.lc ORDER BY k1.i) FILTER (WHERE k1.i > stop AND k1.tag IN ('RP', 'IN', 'TO')) AS preps
  FROM k2 JOIN k1 USING (doc_id, sent_id, cs) GROUP BY ALL
)"""


@query(f"{_BASE}, {_islands_sql('en')}, {_VERB_SQL} SELECT doc_id, sent_id, cs, array_to_string(list_concat([v], coalesce(preps, [])[1:2]), '_') AS prev_v FROM k3 WHERE v IS NOT NULL")
def features_prev_v(spark, d):
    return chunk_rows(_texts(spark, d), "en", "sent_id", "cs", "value", names=["prev_V"]).withColumnRenamed("value", "prev_v")


@query()
def features_english(spark, d):
    """All English features; the scans without SQL are tested against a plain transcription."""
    return chunk_rows(_texts(spark, d), "en", "sent_id", "cs", "term", "features")


_TITLE_SQL = f"""n AS (
  SELECT doc_id, list_distinct(list(lc) FILTER (WHERE section = 'TITLE' AND tag LIKE 'N%')) AS nouns FROM t GROUP BY doc_id
), u AS (
  SELECT p.*, doc_id || '_' || (row_number() OVER (PARTITION BY doc_id ORDER BY sent_id, cs) - 1) AS uid FROM p
)"""


@query(f"{_BASE}, {_islands_sql('en')}, {_TITLE_SQL} SELECT uid, term FROM u LEFT JOIN n USING (doc_id) WHERE section = 'TITLE' OR list_has_any(string_split(term, ' '), coalesce(nouns, []))")
def title_noun_filter(spark, d):
    return chunk_rows(_texts(spark, d), "en", "ordinal", "leads", "term").where("leads").select(_uid().alias("uid"), "term")


@query(f"{_BASE}, {_islands_sql('en')}, {_TITLE_SQL} SELECT uid || chr(9) || '2024' || chr(9) || term || chr(9) || 'plen=' || (ce - cs) || chr(9) || 'tag_sig=' || tag_sig AS line FROM u")
def feature_lines(spark, d):
    rows = chunk_rows(_texts(spark, d), "en", "ordinal", "term", "features", names=["plen", "tag_sig"])
    return rows.select(S.tsv_row(_uid(), F.lit("2024"), F.col("term"), F.col("features")).alias("line"))


# --- counts ------------------------------------------------------------------------------------------------------------------

@query(f"{_BASE}, {_islands_sql('en')} SELECT term, count(*) AS n FROM p GROUP BY term")
def term_counts(spark, d):
    return stats.term_counts(chunk_rows(_texts(spark, d), "en", "term"))


@query(f"{_BASE}, {_islands_sql('en')} SELECT source, count(DISTINCT term) AS types, count(*) AS tokens FROM p JOIN documents USING (doc_id) GROUP BY source")
def type_token_counts(spark, d):
    return stats.type_token_counts(chunk_rows(_texts(spark, d, "source"), "en", "term"), "source")  # the source rides along: no join


@query("SELECT nullif(regexp_extract(url, '/(en|de|fr|es)/', 1), '') AS subject, count(*) AS n FROM pages GROUP BY ALL")
def subject_histogram(spark, d):
    subject = F.regexp_extract("url", "/(en|de|fr|es)/", 1)
    return table(spark, d, "pages").groupBy(F.when(subject != "", subject).alias("subject")).agg(F.count("*").alias("n"))


# --- structure -----------------------------------------------------------------------------------------------------------------

def _spans(spark, d):
    """Intervals from lines: each line, and each document as a whole; short lines with a common word are headings."""
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"), F.length("text").cast("int").alias("length"))
    order = Window.partitionBy("doc_id").orderBy("line_no")
    at = F.sum(F.length("line") + 1).over(order) - F.length("line") - 1
    placed = lines.withColumn("start", at.cast("int")).withColumn("end", (at + F.length("line")).cast("int"))
    return placed.select("doc_id", (F.col("line_no") + 1).alias("tag_id"), "start", "end", "line", "length")


_HEADS = ("the", "of", "is", "de")
_SPANS = """x0 AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS INT) AS tag_id, CAST(len(text) AS INT) AS length FROM documents
), x AS (
  SELECT *, CAST(sum(len(line) + 1) OVER (PARTITION BY doc_id ORDER BY tag_id) - len(line) - 1 AS INT) AS start,
    CAST(sum(len(line) + 1) OVER (PARTITION BY doc_id ORDER BY tag_id) - 1 AS INT) AS "end" FROM x0
)"""
_IS_HEAD = "(len(line) < 50 AND (" + " OR ".join(f"contains(lower(line), '{w}')" for w in _HEADS) + "))"


@query(f"WITH {_SPANS} SELECT doc_id, tag_id, start, \"end\", {_IS_HEAD} AS heading FROM x")
def line_headings(spark, d):
    return _spans(spark, d).select("doc_id", "tag_id", "start", "end", D.is_header(F.col("line"), _HEADS).alias("heading"))


def _nested(spark, d):
    """Lines, groups of ten lines and documents as tags."""
    lines = _spans(spark, d).select("doc_id", "tag_id", "start", "end")
    group = F.floor((F.col("tag_id") - 1) / 10)
    tens = lines.groupBy("doc_id", group.alias("g")).agg(F.min("start").alias("start"), F.max("end").alias("end"))
    docs = lines.groupBy("doc_id").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return (
        lines.union(tens.select("doc_id", (-F.col("g") - 1).cast("int").alias("tag_id"), "start", "end"))
        .union(docs.select("doc_id", F.lit(-1_000_000).alias("tag_id"), "start", "end"))
    )


_NESTED = f"""{_SPANS}, y AS (
  SELECT doc_id, tag_id, start, "end" FROM x
  UNION ALL SELECT doc_id, CAST(-((tag_id - 1) // 10) - 1 AS INT), min(start), max("end") FROM x GROUP BY doc_id, (tag_id - 1) // 10
  UNION ALL SELECT doc_id, -1000000, min(start), max("end") FROM x GROUP BY doc_id
), z AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY start, "end" DESC, tag_id) AS INT) AS ord FROM y)"""


@query(f"""WITH {_NESTED} SELECT a.doc_id, a.tag_id, a.ord, max(b.ord) AS parent FROM z a LEFT JOIN z b
ON a.doc_id = b.doc_id AND b.ord < a.ord AND b.start <= a.start AND b."end" >= a."end" GROUP BY ALL""")
def section_parents(spark, d):
    return D.parents(D.in_order(_nested(spark, d))).select("doc_id", "tag_id", "ord", "parent")


@query(f"""WITH {_NESTED} SELECT a.doc_id, a.tag_id AS section_id, b.tag_id AS subsumer_id FROM z a JOIN z b
ON a.doc_id = b.doc_id AND b.start <= a.start AND b."end" >= a."end" AND b."end" - b.start > a."end" - a.start""")
def section_links(spark, d):
    return D.links(_nested(spark, d).withColumnRenamed("tag_id", "section_id"))


@query(f"""WITH {_SPANS}, s AS (SELECT * FROM x WHERE len(line) >= 50), r AS (
  SELECT *, coalesce(max("end") OVER (PARTITION BY doc_id ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cov FROM s)
SELECT doc_id, cov AS start, start AS "end" FROM r WHERE start > cov
UNION ALL SELECT d.doc_id, coalesce(m, 0), CAST(len(text) AS INT) FROM documents d LEFT JOIN (SELECT doc_id, max("end") AS m FROM s GROUP BY doc_id) q ON q.doc_id = d.doc_id WHERE coalesce(m, 0) < len(text)""")
def section_gaps(spark, d):
    lengths = table(spark, d, "documents").select("doc_id", F.length("text").alias("length"))
    return D.gaps(_spans(spark, d).where(F.length("line") >= 50).select("doc_id", "start", "end"), lengths)


@query(f"""WITH {_SPANS}, r AS (SELECT doc_id, tag_id, line, {_IS_HEAD} AS hd FROM x), q AS (
  SELECT *, sum(CASE WHEN hd THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY tag_id) AS g FROM r)
SELECT doc_id, tag_id, first_value(CASE WHEN hd THEN lower(regexp_replace(line, '[^A-Za-z_]', '', 'g')) END) OVER (PARTITION BY doc_id, g ORDER BY tag_id) AS header FROM q""")
def header_spread(spark, d):
    nodes = _spans(spark, d).select(
        "doc_id", F.col("tag_id").alias("ord"), D.is_header(F.col("line"), _HEADS).alias("is_header"), F.lit(False).alias("is_stop"),
        F.array(D.norm_header(F.regexp_replace("line", "[^A-Za-z_]", ""))).alias("types"),
    )
    return D.spread_headers(nodes).select("doc_id", F.col("ord").alias("tag_id"), F.get("header_types", F.lit(0)).alias("header"))


_WORDS = ["Background", "Summary of the Invention", "Field", "Materials and Methods", "Results", "Claims"]
_HEADER_OF = "[" + ", ".join(f"'{w}'" for w in _WORDS) + "][page_id % 6 + 1]"


@query(f"""WITH h AS (SELECT page_id, {_HEADER_OF} || ' ' || regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS header FROM pages),
n AS (SELECT *, regexp_replace(lower(header), '[^A-Za-z_]', '', 'g') AS flat FROM h), k AS (SELECT *, {D.header_types_sql('flat').replace('x -> x', 'lambda x: x')} AS ts FROM n)
SELECT page_id, header, CASE WHEN len(ts) = 0 THEN 'Other' ELSE array_to_string(ts, '|') END AS types FROM k""")
def html_headings(spark, d):
    lead = F.element_at(F.array(*map(F.lit, _WORDS)), (F.col("page_id") % 6 + 1).cast("int"))
    header = F.concat(lead, F.lit(" "), F.regexp_extract("html", "<h1>([^<]*)</h1>", 1))
    return table(spark, d, "pages").select("page_id", header.alias("header")).withColumn("types", F.array_join(D.header_types(F.col("header")), "|"))


def _typed(spark, d):
    """Pages' elements as sections with types."""
    found = F.regexp_extract_all("html", F.lit(r"<(nav|article|footer|h1|p|li)\b"), F.lit(1))
    rows = table(spark, d, "pages").select("page_id", F.posexplode(found).alias("section_id", "name"))
    return rows.select("page_id", "section_id", F.array("name").alias("types"))


_TYPED = r"""ty AS (SELECT page_id, unnest(regexp_extract_all(html, '<(nav|article|footer|h1|p|li)\b', 1)) AS type FROM pages)"""


@query(f"WITH {_TYPED} SELECT type, count(*) AS n FROM ty GROUP BY type ORDER BY n DESC, type LIMIT 4")
def topk_section_types(spark, d):
    return stats.common_types(_typed(spark, d), 4)


@query(f"WITH {_TYPED} SELECT type, round(count(DISTINCT page_id) / (SELECT count(DISTINCT page_id) FROM ty), 6) AS share FROM ty GROUP BY type")
def type_frequency(spark, d):
    return stats.type_frequency(_typed(spark, d), "page_id")


@query(r"""SELECT doc_id, array_to_string(list_transform(regexp_extract_all('claim ' || doc_id || ' of claim 7 ' || text, 'claim (\d+)', 1), lambda x: CAST(x AS INT)), ',') AS refs FROM documents""")
def claim_refs(spark, d):
    body = F.concat(F.lit("claim "), F.col("doc_id").cast("string"), F.lit(" of claim 7 "), F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.array_join(D.claim_references(body).cast("array<string>"), ",").alias("refs"))


# --- readers ----------------------------------------------------------------------------------------------------------------------

@query(r"""SELECT page_id, nullif(split_part(split_part(html, '<title>', 2), '</title>', 1), '') AS title,
  CASE WHEN len(regexp_replace(url, '[^0-9]', '', 'g')) >= 4 THEN left(regexp_replace(url, '[^0-9]', '', 'g'), 4) END AS year FROM pages""")
def fields_from_pages(spark, d):
    from termloom.sources import readers

    return table(spark, d, "pages").select("page_id", readers.between(F.col("html"), "<title>", "</title>").alias("title"), readers.digits_year(F.col("url")).alias("year"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.missing') AS missing FROM events")
def json_reader(spark, d):
    parsed = F.from_json("props", "k long, missing string")
    return table(spark, d, "events").select("event_id", parsed.alias("p")).select("event_id", "p.k", "p.missing")


@query("""SELECT conv_id AS doc_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS INT) AS field_ord, 'FH_' || upper(role) AS field, text FROM conversations""")
def fielded_conversations(spark, d):
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return table(spark, d, "conversations").select(
        F.col("conv_id").alias("doc_id"), (F.row_number().over(order) - 1).cast("int").alias("field_ord"), F.concat(F.lit("FH_"), F.upper("role")).alias("field"), "text"
    )


# --- manifests, repositories, views ---------------------------------------------------------------------------------------------

def _manifest(spark, d):
    docs = table(spark, d, "documents")
    line = F.concat_ws("\t", F.lit("1999"), F.concat(F.lit("/"), F.col("source"), F.lit("/US"), F.col("doc_id"), F.lit("A1.xml")))
    return docs.select(F.col("doc_id").alias("line_no"), line.alias("value"))


@query("SELECT doc_id AS line_no, '1999' AS year, '/' || source || '/US' || doc_id || 'A1.xml' AS source, source || '/US' || doc_id || 'A1.xml' AS target FROM documents")
def manifest(spark, d):
    from termloom.sources import manifests

    return manifests.parse(_manifest(spark, d))


@query("SELECT doc_id AS line_no, '/' || source || '/US' || doc_id || 'A1.xml' AS source FROM documents WHERE doc_id >= 100 ORDER BY doc_id LIMIT 50")
def resume_slice(spark, d):
    from termloom.sources import manifests

    return manifests.resume(manifests.parse(_manifest(spark, d)), 100, 50).select("line_no", "source")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ")
def manifest_new(spark, d):
    from termloom.sources import manifests

    return manifests.unseen(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id"), "doc_id")


@query("""WITH a AS (SELECT DISTINCT doc_id FROM documents), b AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1)
SELECT 'both' AS kind, count(*) AS n FROM (FROM a INTERSECT FROM b) UNION ALL SELECT 'either', count(*) FROM (FROM a UNION FROM b)
UNION ALL SELECT 'only_first', count(*) FROM (FROM a EXCEPT FROM b) UNION ALL SELECT 'only_second', count(*) FROM (FROM b EXCEPT FROM a)""")
def list_overlap(spark, d):
    return stats.set_overlap(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").where("quality = 1").select("doc_id"), "doc_id")


_CODES = [("sr0", "A41"), ("sr1", "A42"), ("sr2", "A43"), ("sr12", "A44"), ("sr19", "A45"), ("sr7", "A46")]


@query("WITH m(code, domain) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in _CODES) + """), c AS (
  SELECT doc_id, 'sr' || left(substring(source, 4), 1) AS major, substring(source, 5) AS minor FROM documents)
SELECT doc_id, min(coalesce(s.domain, l.domain)) AS domain FROM c LEFT JOIN m s ON c.major = s.code LEFT JOIN m l ON c.major || c.minor = l.code GROUP BY doc_id""")
def domain_lookup(spark, d):
    number = F.substring("source", 4, 10)
    codes = table(spark, d, "documents").select("doc_id", F.concat(F.lit("sr"), F.left(number, F.lit(1))).alias("major"), F.substring("source", 5, 10).alias("minor"))
    return stats.domain_lookup(codes, spark.sql("VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in _CODES)).toDF("code", "domain"))


@query(r"""WITH n AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'D' WHEN 2 THEN 'PP' ELSE '20' END || (doc_id + 100000) AS id FROM documents)
SELECT doc_id, nullif(regexp_extract(id, '^(HD|RE|PP|B|D|H|T)?(\d+)', 1), '') AS prefix, regexp_extract(id, '^(HD|RE|PP|B|D|H|T)?(\d+)', 2) AS number,
  CASE WHEN id SIMILAR TO '(19|20).*' THEN id[1:4] || '/' || id[5:len(id) - 2] WHEN id SIMILAR TO '[A-Z]{2}.*' THEN id[1:2] || '/' || id[3:len(id) - 2]
  WHEN id SIMILAR TO '[A-Z].*' THEN id[1:1] || '/' || id[2:len(id) - 2] ELSE id[1:2] || '/' || id[3:len(id) - 2] END AS folder FROM n""")
def patent_ids(spark, d):
    lead = F.element_at(F.array(*map(F.lit, ("", "D", "PP", "20"))), (F.col("doc_id") % 4 + 1).cast("int"))
    rows = table(spark, d, "documents").select("doc_id", F.concat(lead, (F.col("doc_id") + 100_000).cast("string")).alias("id"))
    parsed = rows.withColumn("p", stats.patent_id(F.concat(F.lit("US"), F.col("id"), F.lit("A1.xml"))))
    return parsed.select("doc_id", F.nullif("p.prefix", F.lit("")).alias("prefix"), F.col("p.number").alias("number"), stats.id_path(F.col("id")).alias("folder"))


@query("SELECT count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS size, CAST(sum(n_chars) // 1000000 AS BIGINT) AS megabytes FROM documents")
def repo_size(spark, d):
    from termloom.operators import corpus

    return corpus.repository_size(table(spark, d, "documents").select(F.col("n_chars").alias("size")))


@query("SELECT count(*) AS listed, count(l.doc_id) AS present, count(*) - count(l.doc_id) AS missing FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id")
def view_coverage(spark, d):
    from termloom.operators import corpus

    return corpus.view_coverage(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id"), "doc_id")


@query("SELECT event_type AS stage, count(*) AS runs, round(sum(value), 4) AS seconds, round(sum(value) / count(*), 4) AS per_doc, strftime(min(ts), '%Y:%m:%d-%H:%M:%S') AS first_run FROM events GROUP BY event_type")
def run_history(spark, d):
    from termloom.operators import corpus

    runs = table(spark, d, "events").select(F.col("event_type").alias("stage"), F.lit(1).alias("limit"), F.col("ts").alias("at"), F.col("value").alias("seconds"))
    return corpus.processing_time(runs)


@query(r"""WITH p AS (SELECT page_id AS line_no, regexp_extract(url, '//([^/]+)/', 1) AS journal FROM pages), s AS (
  SELECT *, left(rtrim(journal, '_-1234567890'), 1) || '/' || rtrim(journal, '_-1234567890') AS short FROM p)
SELECT short, min(line_no) AS line_no FROM s GROUP BY short""")
def first_per_short_path(spark, d):
    journal = F.rtrim(F.regexp_extract("url", "//([^/]+)/", 1), F.lit("_-1234567890"))
    rows = table(spark, d, "pages").select(F.col("page_id").alias("line_no"), F.concat_ws("/", F.left(journal, F.lit(1)), journal).alias("short"))
    return stats.first_by(rows, ["short"], F.col("line_no")).select("short", "line_no")


# --- whole sections, segmenter input, index statistics -------------------------------------------------------------------------------

def _as_patent(spark, d):
    """Documents as descriptions, every other ten lines as a summary, short lines as headings, the others as paragraphs: the tags of
    ``_nested``, each made beside the first line in it."""
    own = Window.partitionBy("doc_id").orderBy("tag_id").rowsBetween(0, 9)
    lines = _spans(spark, d).withColumn("ten_end", F.max("end").over(own))
    n = F.col("tag_id")
    tag = lambda tag_id, name, start, end: F.struct(tag_id.cast("int").alias("tag_id"), name.alias("name"), start.cast("int").alias("start"), end.cast("int").alias("end"))
    ten = -F.floor((n - 1) / 10) - 1
    tags = F.array_compact(F.array(
        tag(n, F.when(F.length("line") < 40, "heading").otherwise("p"), F.col("start"), F.col("end")),
        F.when(n % 10 == 1, tag(ten, F.when(ten % 2 == 0, "summary").otherwise("related-apps"), F.col("start"), F.col("ten_end"))),
        F.when(n == 1, tag(F.lit(-1_000_000), F.lit("description"), F.lit(0), F.col("length"))),
    ))
    each = lines.select("doc_id", F.explode(tags).alias("t"))
    return each.select("doc_id", "t.tag_id", "t.name", F.col("t.name").alias("struct"), F.create_map(F.lit("lang"), F.lit("eng")).alias("attrs"), "t.start", "t.end")


@query(f"""WITH {_SPANS}, r AS (
  SELECT doc_id, start, "end", line, len(line) < 40 AS hd, list_concat(['Description', CASE WHEN ((tag_id - 1) // 10) % 2 = 1 THEN 'Summary' ELSE 'Related_Applications' END], CASE WHEN len(line) < 40 THEN ['Header'] ELSE [] END) AS base,
    sum(CASE WHEN len(line) < 40 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY tag_id) AS g FROM x
), h AS (
  SELECT *, first_value(CASE WHEN hd THEN regexp_replace(lower(line), '[^A-Za-z_]', '', 'g') END) OVER (PARTITION BY doc_id, g ORDER BY start, "end") AS flat FROM r
), t AS (SELECT *, {D.header_types_sql('flat').replace('x -> x', 'lambda x: x')} AS found FROM h)
SELECT doc_id, start, "end", array_to_string(CASE WHEN flat IS NULL THEN base
  ELSE list_concat(base, list_filter(CASE WHEN len(found) = 0 THEN ['Other'] ELSE found END, lambda y: y <> base[-1])) END, '|') AS types FROM t WHERE len(line) > 0""")
def patent_sections(spark, d):
    from termloom.operators import sections

    texts = table(spark, d, "documents").select("doc_id", "text")
    made = sections.patent_sections(texts, _as_patent(spark, d))
    return made.where(F.col("struct").isin("p", "heading") & (F.col("end") > F.col("start"))).select("doc_id", "start", "end", F.array_join("types", "|").alias("types"))


@query(f"""WITH {_NESTED}, i AS (
  SELECT a.doc_id, a.tag_id, max(CASE WHEN b.tag_id = -1000000 THEN 1 ELSE 2 END) AS deep, max(CASE WHEN b.tag_id < 0 AND b.tag_id > -1000000 THEN 1 ELSE 0 END) AS inside
  FROM z a JOIN z b ON a.doc_id = b.doc_id AND b.start <= a.start AND b."end" >= a."end" AND b."end" - b.start > a."end" - a.start GROUP BY ALL)
SELECT round(sum(CASE WHEN z.tag_id < 0 AND z.tag_id > -1000000 AND coalesce(i.inside, 0) = 0 THEN "end" - start ELSE 0 END) / sum(CASE WHEN i.doc_id IS NULL THEN "end" - start END), 6) AS weight
FROM z LEFT JOIN i USING (doc_id, tag_id)""")
def type_weight(spark, d):
    from termloom.operators import sections

    ten = (F.col("tag_id") < 0) & (F.col("tag_id") > -1_000_000)
    typed = _nested(spark, d).select("doc_id", F.col("tag_id").alias("section_id"), "start", "end", F.array(F.when(ten, "Ten").otherwise("Other")).alias("types"))
    return sections.type_weight(typed, "Ten").select(F.round("weight", 6).alias("weight"))


@query(f"""WITH {_SPANS} SELECT doc_id, tag_id AS section_id, lag(tag_id) OVER o AS prev_id, lead(tag_id) OVER o AS next_id FROM x WINDOW o AS (PARTITION BY doc_id ORDER BY start, tag_id)""")
def section_neighbours(spark, d):
    from termloom.operators import sections

    rows = _spans(spark, d).select("doc_id", F.col("tag_id").alias("section_id"), "start")
    return sections.neighbours(rows).select("doc_id", "section_id", "prev_id", "next_id")


@query(r"""WITH l0 AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents
), l AS (SELECT doc_id, line_no, trim(CASE WHEN line_no % 5 = 3 THEN raw ELSE translate(raw, 'aeo', '一二。') END, ' ') AS line FROM l0
), k AS (SELECT *, regexp_replace(line, '[ \t\n\r\f\v]', '', 'g') AS b, regexp_replace(regexp_replace(line, '[ \t\n\r\f\v]', '', 'g'), '[^\x00-\x{FF}]', '', 'g') AS lat FROM l WHERE line <> ''
), m AS (SELECT *, len(b) > 5000 OR (len(b) > 10 AND len(lat) > 0.9 * len(b)) OR (len(lat) = len(b) AND NOT regexp_matches(b, '^[0-9]+$')) AS skip, NOT regexp_matches(line, '[^\x00-\x{FF}]') AS latin FROM k
), g AS (SELECT *, sum(CASE WHEN skip OR latin THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS grp FROM m
), p AS (SELECT doc_id, min(line_no) AS line_no, string_agg(line, ' ' ORDER BY line_no) AS passage FROM g WHERE NOT skip AND NOT latin GROUP BY doc_id, grp
), s AS (SELECT doc_id, line_no, list_filter(string_split(replace(regexp_replace(passage, '[ \t\n\r\f\v]', '', 'g'), '。', '。' || chr(10)), chr(10)), lambda x: x <> '' AND len(x) <= 500) AS parts FROM p)
SELECT doc_id, CAST(line_no AS INT) AS line_no, CAST(generate_subscripts(parts, 1) - 1 AS INT) AS part, unnest(parts) AS line FROM s""")
def segmenter_input(spark, d):
    """Lines with letters made Chinese, every fifth left as it is: passages and their sentences."""
    from termloom.operators import segmenting

    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    mixed = lines.withColumn("line", F.when(F.col("line_no") % 5 == 3, F.col("line")).otherwise(F.translate("line", "aeo", "一二。")))
    return segmenting.gathered(mixed).where("is_prose").select("doc_id", "line_no", "part", "line")


@query("SELECT md5(text) AS digest, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1")
def duplicate_texts(spark, d):
    return stats.duplicates(table(spark, d, "documents").select(F.md5(F.col("text").cast("binary")).alias("digest")), "digest")


@query("SELECT count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)) AS inside, count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)) AS outside FROM documents")
def id_membership(spark, d):
    return stats.membership(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").where("quality = 1"), "doc_id")


@query("SELECT len(text) // 100 AS hundreds, count(*) AS n FROM documents GROUP BY ALL")
def length_histogram(spark, d):
    return stats.histogram(table(spark, d, "documents"), F.expr("CAST(length(text) div 100 AS BIGINT)"), "hundreds")


@query("SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def last_index_entry(spark, d):
    rows = table(spark, d, "events").select("user_id", "ts", "event_id")
    return stats.latest_by(rows, ["user_id"], F.col("ts"), F.col("event_id")).select("user_id", "event_id")


@query("""WITH c AS (SELECT doc_id, chr(CAST(65 + doc_id % 8 AS INT)) || '-' || doc_id % 90 || '-B' AS a, CASE WHEN doc_id % 5 <> 0 THEN 'H-' || doc_id % 7 || '-C' END AS b FROM documents)
SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter([a, b], lambda x: x IS NOT NULL))), ',') AS codes FROM c""")
def classification_codes(spark, d):
    n = F.col("doc_id")
    block = lambda tag, *p: F.concat(F.lit(f"<{tag} n='1'>\n<section>"), p[0], F.lit("</section><class>"), p[1].cast("string"), F.lit("</class>\n <subclass>"), p[2], F.lit(f"</subclass></{tag}>"))
    first = block("classification-ipc", F.expr("char(65 + doc_id % 8)"), n % 90, F.lit("B"))
    more = block("classification-ipcr", F.lit("H"), n % 7, F.when(n % 5 != 0, "C").otherwise(""))
    late = block("classification-ipc", F.lit("Z"), n, F.lit("Z"))
    xml = F.concat(F.lit("<bibliographic-data>"), first, more, first, F.lit("</bibliographic-data>"), late)
    return table(spark, d, "documents").select("doc_id", F.array_join(stats.classification_codes(xml), ",").alias("codes"))


@query("SELECT doc_id, 'D' || doc_id AS id FROM documents")
def short_ids(spark, d):
    path = F.concat(F.lit("/a/b/USD"), F.col("doc_id").cast("string"), F.lit("S1.xml"))
    return table(spark, d, "documents").select("doc_id", stats.short_id(path).alias("id"))


@query("""WITH c AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE '2001' || doc_id END AS date, CASE WHEN doc_id % 4 = 0 THEN source END AS domain FROM documents)
SELECT doc_id, coalesce(left(date, 4), '9999') AS year, domain FROM c""")
def years_and_domains(spark, d):
    docs = table(spark, d, "documents")
    dates = docs.where("doc_id % 3 <> 0").select("doc_id", F.concat(F.lit("2001"), F.col("doc_id").cast("string")).alias("date"))
    return stats.years_and_domains(docs.select("doc_id"), dates, docs.where("doc_id % 4 = 0").select("doc_id", F.col("source").alias("domain")))


@query(r"""WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k, text FROM conversations), l AS (
  SELECT conv_id, k, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM t)
SELECT CAST(conv_id AS VARCHAR) AS doc_id, CAST(k AS INT) AS field_ord, CAST(row_number() OVER (PARTITION BY conv_id, k ORDER BY n) - 1 AS INT) AS line_ord, line FROM l WHERE trim(line, ' ') <> ''""")
def clinical_notes(spark, d):
    from termloom.sources import readers

    turns = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    body = F.array_join(F.transform("t", lambda x: F.concat(F.lit('[start section id="'), x["role"], F.lit('"]\n'), x["text"], F.lit("\n[end section]\n"))), "\n")
    notes = turns.select(F.col("conv_id").alias("doc_id"), F.lit("").alias("path"), F.concat(F.lit('[meta rev_date="1"]\n'), body).alias("content"))
    return readers.read("thyme", notes).select("doc_id", "field_ord", "line_ord", "line")


@query("""SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(0 AS INT) AS field_ord, 'FH_DATE' AS field, '1999' AS line FROM documents UNION ALL SELECT CAST(doc_id AS VARCHAR), 1, 'FH_TITLE', source FROM documents
UNION ALL SELECT CAST(doc_id AS VARCHAR), 2, 'FH_ABSTRACT', CASE WHEN doc_id % 2 = 0 THEN lang ELSE 'None' END FROM documents""")
def abstract_lines(spark, d):
    from termloom.sources import readers

    text = F.concat(F.lit("<title>old</title>\n<year>1999</year>\n<title>"), "source", F.lit("</title>"), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("\n<abstract>"), "lang", F.lit("</abstract>"))).otherwise(""))
    docs = table(spark, d, "documents").select("doc_id", F.lit("").alias("path"), text.alias("content"))
    return readers.read("signal-processing", docs).select("doc_id", "field_ord", "field", "line")


@query("""SELECT doc_id AS line_no, 0 AS kind, 0 AS ord, source || '/' || doc_id AS line FROM documents
UNION ALL SELECT doc_id, 1, CAST(quality AS INT), chr(9) || 'toxic=' || toxic FROM labels JOIN documents USING (doc_id)""")
def feature_listing(spark, d):
    from termloom.sources import sinks

    listed = table(spark, d, "documents").select(F.col("doc_id").alias("line_no"), F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("target"))
    rows = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "source"), "doc_id").select(
        F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("target"), F.col("quality").cast("int").alias("ord"), F.concat(F.lit("toxic="), F.col("toxic").cast("string")).alias("line")
    )
    return sinks.manifest_listing(rows, listed)


@query(f"""{_BASE}, {_islands_sql('de')} SELECT doc_id, sent_id, cs, lcs[cs] AS prev_j FROM p WHERE cs > 0 AND tags[cs] LIKE 'J%'""")
def features_prev_j(spark, d):
    return chunk_rows(_texts(spark, d), "de", "sent_id", "cs", "value", names=["prev_J"]).withColumnRenamed("value", "prev_j")


def _scan_sql(stop: str, skip: str) -> str:
    """A preposition and, beyond it, a word whose tag begins with ``stop``, at most four tokens left of the chunk."""
    step = lambda k: f"""e{k} AS (
  SELECT *, CASE WHEN done OR cs - {k} <= 0 THEN prep WHEN tags[cs - {k} + 1] IN ('RP', 'IN', 'TO') THEN lcs[cs - {k} + 1] ELSE prep END AS prep_n,
    CASE WHEN NOT done AND cs - {k} > 0 AND tags[cs - {k} + 1] LIKE '{stop}%' AND prep <> '' THEN lcs[cs - {k} + 1] ELSE word END AS word_n,
    done OR cs - {k} <= 0 OR NOT (tags[cs - {k} + 1] IN ('RP', 'IN', 'TO') OR ({skip.format(tag=f'tags[cs - {k} + 1]')})) AS done_n FROM f{k - 1}
), f{k} AS (SELECT doc_id, sent_id, cs, lcs, tags, prep_n AS prep, word_n AS word, done_n OR word_n <> '' AS done FROM e{k})"""  # noqa: E731
    return "f0 AS (SELECT doc_id, sent_id, cs, lcs, tags, '' AS prep, '' AS word, false AS done FROM p), " + ", ".join(step(k) for k in (1, 2, 3, 4))


@query(f"""{_BASE}, {_islands_sql('en')}, {_scan_sql('N', "regexp_matches({tag}, '^[JD]') AND prep = ''")} SELECT doc_id, sent_id, cs, word || '_' || prep AS prev_npr FROM f4 WHERE word <> ''""")
def features_prev_npr(spark, d):
    return chunk_rows(_texts(spark, d), "en", "sent_id", "cs", "value", names=["prev_Npr"]).withColumnRenamed("value", "prev_npr")


@query(f"""{_BASE}, {_islands_sql('en')}, {_scan_sql('J', "regexp_matches({tag}, '^[JD]')")} SELECT doc_id, sent_id, cs, word || '_' || prep AS prev_jpr FROM f4 WHERE word <> ''""")
def features_prev_jpr(spark, d):
    return chunk_rows(_texts(spark, d), "en", "sent_id", "cs", "value", names=["prev_Jpr"]).withColumnRenamed("value", "prev_jpr")
