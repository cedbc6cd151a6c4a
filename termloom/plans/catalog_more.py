"""More queries with SQL: readers, standoff tags, taggers, fielded sections, German and Chinese features, sinks, repositories.

The SQL says what SURVEY's rules give for documents made from the driver's tables; it reads none of the engine's word lists but
through ``catalog``'s chunks.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from termloom.functions import features, tagging, text
from termloom.operators import corpus, sections, segmenting, stats
from termloom.operators import sentences as S
from termloom.operators import structure as D
from termloom.operators.occurrences import chunk_rows
from termloom.plans import chunking
from termloom.plans.catalog import _BASE, _BASIC_SQL, _SPANS, _TITLE_SQL, _VERB_SQL, _chunks, _islands_sql, _scan_sql, _spans, _texts, _uid, query, ORACLES
from termloom.runtime import scratch_path, table
from termloom.sources import manifests, readers, sinks


def _docs(spark, d, *columns):
    return table(spark, d, "documents").select("doc_id", *columns)


def _source(spark, d, content, path=""):
    """Documents as one source's files."""
    return table(spark, d, "documents").select(F.col("doc_id"), (F.lit(path) if isinstance(path, str) else path).alias("path"), content.alias("content"))


def _text(*parts):
    """Literals and columns strung together; column names stand after a $."""
    return F.concat(*(F.col(p[1:]).cast("string") if p.startswith("$") else F.lit(p) for p in parts))


def _id():
    return F.col("doc_id")


def _if(test: str, *parts):
    return F.when(F.expr(test), _text(*parts)).otherwise("")


# --- readers ----------------------------------------------------------------------------------------------------------------

@query("""WITH f AS (
  SELECT doc_id, 0 AS k, 'FH_TITLE' AS field, 'a<b>' || source || '</b>' AS line FROM documents WHERE doc_id % 3 <> 0
  UNION ALL SELECT doc_id, 1, 'FH_DATE', left(CAST(doc_id + 20110 AS VARCHAR), 4) FROM documents
  UNION ALL SELECT doc_id, 2, 'FH_ABSTRACT', lang FROM documents
  UNION ALL SELECT doc_id, 3, 'FH_BODY', unnest(['x' || doc_id, 'y']) FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(k AS INT) AS field_ord, field, line FROM f""")
def cnki_reader(spark, d):
    title = F.concat(_if("doc_id % 3 <> 0", '<fs:ArticleTitle lang="zh">a<b>', "$source", "</b></fs:ArticleTitle>"), F.lit('<fs:ArticleTitle lang="en">E</fs:ArticleTitle>'))
    rest = _text('<fs:AbstractBlock lang="zh">', "$lang", "</fs:AbstractBlock>", "<fs:Body>x", "$doc_id", "\ny</fs:Body><fs:Stuff></fs:Stuff>")
    path = F.concat(F.lit("/c/GLDZ"), (_id() + 20110).cast("string"), F.lit(".xml"))
    return readers.read("cnki", _source(spark, d, F.concat(title, rest), path)).select("doc_id", "field_ord", "field", "line")


@query("""WITH r AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, doc_id % 7 = 0 AS broken, source, lang, doc_id AS n FROM documents),
f AS (SELECT doc_id, unnest(list_concat(CASE WHEN n % 2 = 0 THEN ['FH_TITLE|new ' || source] ELSE [] END,
  ['FH_JOURNAL|' || lang, 'FH_SUBJECT|late', 'FH_DATE|' || least(1990 + n % 20, 2000), 'FH_ABSTRACT|in ' || n || '!'], CASE WHEN n % 5 <> 0 THEN ['FH_TEXT|one', 'FH_TEXT|two ' || source] ELSE [] END)) AS x FROM r WHERE NOT broken)
SELECT doc_id, split_part(x, '|', 1) AS field, split_part(x, '|', 2) AS line, false AS failed FROM f UNION ALL SELECT doc_id, NULL, NULL, true FROM r WHERE broken""")
def pubmed_reader(spark, d):
    """Every seventh document is broken XML: an error, no text."""
    xml = F.concat(
        F.lit("<article><front>"),
        _if("doc_id % 2 = 0", "<title-group><article-title>old</article-title><article-title>new <i>", "$source", "</i></article-title></title-group><x><article-title>no</article-title></x>"),
        _text("<subj-group><subject>early</subject><subject>late</subject></subj-group><pub-date><year>2000</year></pub-date><pub-date><year>"),
        (F.lit(1990) + _id() % 20).cast("string"),
        _text("</year></pub-date><abstract><sec><p>in <b>", "$doc_id", "</b>!</p></sec><p>loose</p></abstract></front><body>"),
        _if("doc_id % 5 <> 0", "<sec><p>one</p><p>two ", "$source", "</p><sec><p>deep</p></sec></sec>"),
        F.lit("</body>"),
        F.when(_id() % 7 == 0, "<open>").otherwise(""),
        F.lit("</article>"),
    )
    rows = readers.read("pm", _source(spark, d, xml, F.concat(F.lit("/j/"), F.col("lang"), F.lit("/a.nxml"))))
    return rows.select("doc_id", "field", "line", F.col("error").isNotNull().alias("failed"))


@query("""WITH f AS (SELECT doc_id, unnest(['FH_TITLE|T' || doc_id, 'FH_DATE|2007', 'FH_ABSTRACT|' || lang, 'FH_ABSTRACT|' || source, 'FH_HEADER_LEVEL_2|H', 'FH_PARA|x ' || source, 'FH_PARA|drawn', 'FH_CLAIM|c1', 'FH_CLAIM|c2 of ' || lang]) AS x,
  unnest([0, 1, 2, 2, 3, 4, 5, 6, 7]) AS k FROM documents WHERE doc_id % 4 <> 0)
SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(k AS INT) AS field_ord, split_part(x, '|', 1) AS field, split_part(x, '|', 2) AS line FROM f""")
def application_reader(spark, d):
    """Applications; every fourth document is a grant, which gives nothing."""
    body = _text(
        "<invention-title>T", "$doc_id", "</invention-title><publication-reference><doc><date>20070102</date></doc></publication-reference><date>1999</date><abstract><p>", "$lang", "</p><p>", "$source",
        "</p></abstract><description><heading level='2'>H</heading><p>x <i>", "$source", "</i></p><description-of-drawings><p>drawn</p></description-of-drawings></description><claims><claim>c1</claim><claim>c2 of <b>", "$lang", "</b></claim></claims>",
    )
    root = F.when(_id() % 4 == 0, "us-patent-grant").otherwise("us-patent-application")
    return readers.read("uspto", _source(spark, d, F.concat(F.lit("<"), root, F.lit(">"), body, F.lit("</"), root, F.lit(">")))).select("doc_id", "field_ord", "field", "line")


_PATENT = (
    "<p-doc><invention-title lang='", "$lang3", "'>A ", "$source", "</invention-title><publication-reference><date>2001", "$doc_id", "</date></publication-reference><date>1999</date><abstract lang='eng'>Abs</abstract><description>",
    "$lead", "rest ", "$source", "</description><claims><claim>c1</claim>", "$more", "</claims></p-doc>",
)


def _patents(spark, d):
    lead = F.concat(
        _if("doc_id % 2 = 0", "<background-art>B ", "$source", "</background-art>"), _if("doc_id % 3 = 0", "<technical-field>F</technical-field>"), _if("doc_id % 5 = 0", "<summary>S</summary>")
    )
    docs = _docs(spark, d, "source").withColumn("lang3", F.when(_id() % 4 == 0, "eng").otherwise("chi")).withColumn("lead", lead).withColumn("more", F.when(_id() % 3 != 1, "<claim>c2</claim><claim>c3</claim>").otherwise(""))
    return docs.select("doc_id", F.lit("").alias("path"), _text(*_PATENT).alias("content"))


@query("""WITH f AS (SELECT doc_id, unnest(list_concat(['TITLE|A ' || source, 'DATE|2001' || doc_id, 'ABSTRACT|Abs'],
  ['DESC_REST|' || CASE WHEN doc_id % 2 = 0 THEN 'B ' || source ELSE '' END || CASE WHEN doc_id % 3 = 0 THEN 'F' ELSE '' END || CASE WHEN doc_id % 5 = 0 THEN 'S' ELSE '' END || 'rest ' || source])) AS x FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'FH_' || split_part(x, '|', 1) AS field, split_part(x, '|', 2) AS line FROM f""")
def patent_reader(spark, d):
    """English run, whole type strings: nested summaries and claims give nothing."""
    return readers.read("ln", _patents(spark, d)).select("doc_id", "field", "line")


@query("""WITH f AS (SELECT doc_id, unnest(list_concat(CASE WHEN doc_id % 4 <> 0 THEN ['TITLE|A ' || source] ELSE [] END, ['DATE|2001' || doc_id], CASE WHEN doc_id % 5 = 0 THEN ['SUMMARY|S'] ELSE [] END,
  CASE WHEN doc_id % 3 = 0 THEN ['TECHNICAL_FIELD|F'] ELSE [] END, CASE WHEN doc_id % 2 = 0 THEN ['BACKGROUND_ART|B ' || source] ELSE [] END,
  ['DESC_REST|' || CASE WHEN doc_id % 2 = 0 AND doc_id % 3 = 0 AND doc_id % 5 <> 0 THEN 'F' ELSE '' END || 'rest ' || source, 'FIRST_CLAIM|c1'], CASE WHEN doc_id % 3 <> 1 THEN ['OTHER_CLAIMS|c2', 'OTHER_CLAIMS|c3'] ELSE [] END)) AS x FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'FH_' || split_part(x, '|', 1) AS field, split_part(x, '|', 2) AS line FROM f""")
def patent_reader_innermost(spark, d):
    """Chinese run, innermost types: English titles and abstracts go; the rest follows summary, background art or technical field."""
    return readers.read("ln", _patents(spark, d), language="cn", match="last").select("doc_id", "field", "line")


@query("""WITH f AS (SELECT doc_id, unnest(list_concat(['TITLE|' || source], CASE WHEN doc_id % 2 = 0 THEN ['DATE|1999'] ELSE [] END, ['ABSTRACT|' || lang], CASE WHEN doc_id % 3 <> 0 THEN ['DESCRIPTION|a', 'DESCRIPTION|' || lang] ELSE [] END)) AS x FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'FH_' || split_part(x, '|', 1) AS field, split_part(x, '|', 2) AS line FROM f""")
def science_reader(spark, d):
    parts = F.struct(
        F.col("source").alias("title"), F.when(_id() % 2 == 0, 1999).alias("year"), F.col("lang").alias("abstractText"),
        F.when(_id() % 3 != 0, F.array(F.struct(F.lit("a").alias("text")), F.struct(F.col("lang").alias("text")))).alias("sections"),
    )
    return readers.read("spv1", _source(spark, d, F.to_json(parts))).select("doc_id", "field", "line")


@query("""SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'FH_DATE:' || chr(10) || '1999' || chr(10) || 'FH_TITLE:' || chr(10) || source || chr(10) || 'FH_ABSTRACT:' || chr(10) || lang || chr(10) || 'END' || chr(10) AS text FROM documents""")
def fielded_text(spark, d):
    """A document's fields as the text file that later stages read."""
    content = _text("<year>1999</year>\n<title>", "$source", "</title>\n<abstract>", "$lang", "</abstract>")
    return readers.render_fielded(readers.read("signal-processing", _source(spark, d, content)))


# --- standoff tags ----------------------------------------------------------------------------------------------------------

@query("""WITH t AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, source, CAST(len(source) AS INT) AS n, CAST(len(lang) AS INT) AS m FROM documents)
SELECT doc_id, CAST(x[1] AS INT) AS tag_id, ['r', 'a', 'b', 'c'][x[1] + 1] AS name, CAST(x[2] AS INT) AS start, CAST(x[3] AS INT) AS "end", CAST(CASE WHEN x[1] = 0 THEN NULL WHEN x[1] = 2 THEN 1 ELSE 0 END AS INT) AS parent
FROM (SELECT doc_id, unnest([[0, 0, n + m + 3], [1, 1, n + 2], [2, 2, n + 2], [3, n + 2, n + m + 2]]) AS x FROM t)""")
def standoff_tags(spark, d):
    """Elements as tags over the text, offsets in characters."""
    xml = _text("<r>é<a>&amp;<b>", "$source", "</b></a><c k='v'>", "$lang", "</c>.</r>")
    made = readers.documents_with_tags(_source(spark, d, xml)).select("doc_id", F.explode("tags").alias("t"))
    return made.select("doc_id", "t.tag_id", "t.name", "t.start", "t.end", "t.parent")


@query("""WITH l AS (SELECT doc_id, unnest(['DOCUMENT ID="' || doc_id || '" COLLECTION="' || source || '"', 'STRUCTURE TYPE="TEXT" START=3 END=9', 'claim standoff:offset="4" standoff:length="6" lang="' || lang || '"']) AS k, unnest([0, 1, 2]) AS n FROM documents)
SELECT doc_id, CAST(n AS INT) AS line_no, ['DOCUMENT', 'STRUCTURE', 'claim'][n + 1] AS name, CAST([-1, 3, 4][n + 1] AS INT) AS start, CAST([-1, 9, 10][n + 1] AS INT) AS "end", source AS collection
FROM l JOIN documents USING (doc_id)""")
def fact_lines(spark, d):
    """Tag lines of both kinds, and the collection that the first DOCUMENT line names."""
    lines = F.array(
        F.concat(_text('DOCUMENT ID="', "$doc_id", '" COLLECTION="', "$source", '"')), F.lit('STRUCTURE TYPE="TEXT" START=3 END=9'), _text('claim standoff:offset="4" standoff:length="6" lang="', "$lang", '"')
    )
    rows = table(spark, d, "documents").select("doc_id", F.posexplode(lines).alias("line_no", "line"))
    parsed = rows.withColumn("t", readers.parse_fact(F.col("line"))).select("doc_id", "line_no", "t.name", "t.start", "t.end")
    return parsed.join(sections.collection(rows), "doc_id")


def _tags(spark, d, rows):
    """Tags (tag_id, name, TYPE, start, end) for every document, shifted by its id."""
    each = F.array(*(F.struct(F.lit(i).alias("tag_id"), F.lit(n).alias("name"), F.create_map(F.lit("TYPE"), F.lit(t)).alias("attrs"), F.lit(s).alias("s"), F.lit(e).alias("e")) for i, (n, t, s, e) in enumerate(rows)))
    made = _docs(spark, d).select("doc_id", F.explode(each).alias("t"))
    at = (_id() % 5).cast("int")
    return made.select("doc_id", "t.tag_id", "t.name", "t.attrs", (F.col("t.s") + at).alias("start"), (F.col("t.e") + at).alias("end"))


_STRUCTURES = [("STRUCTURE", "SECTITLE", 0, 5), ("STRUCTURE", "TEXT", 5, 30), ("STRUCTURE", "CLAIMS", 30, 60), ("STRUCTURE", "TEXT", 30, 40), ("STRUCTURE", "TEXT", 41, 60), ("STRUCTURE", "OTHER", 0, 60), ("DOCUMENT", "TEXT", 0, 60), ("STRUCTURE", "CLAIMS", 70, 90), ("STRUCTURE", "TEXT", 72, 80), ("STRUCTURE", "TEXT_CHUNK", 0, 29)]


@query("""SELECT doc_id, CAST(x.i AS INT) AS tag_id, x.n AS name, CAST(x.s + doc_id % 5 AS INT) AS start FROM (SELECT doc_id, unnest([{'i': 0, 'n': 'heading', 's': 0}, {'i': 1, 'n': 'p', 's': 5}, {'i': 2, 'n': 'claims', 's': 30},
 {'i': 3, 'n': 'claim', 's': 30}, {'i': 4, 'n': 'claim', 's': 41}, {'i': 7, 'n': 'claims', 's': 70}, {'i': 8, 'n': 'p', 's': 72}, {'i': 9, 'n': 'description', 's': 0}]) AS x FROM documents)""")
def structure_tags(spark, d):
    """Structures under mark-up names; texts inside the first claims are claims."""
    return sections.structure_tags(_tags(spark, d, _STRUCTURES)).select("doc_id", "tag_id", "name", "start")


_MARKUP = [("invention-title", "", 0, 9), ("date", "", 2, 4), ("publication-reference", "", 10, 20), ("date", "", 12, 18), ("date", "", 22, 25), ("fs:P", "", 30, 40), ("figref", "", 31, 33), ("fs:AbstractBlock", "", 41, 50), ("claim", "", 60, 70)]


@query("""SELECT doc_id, CAST(x.i AS INT) AS tag_id, x.n AS name FROM (SELECT doc_id, unnest([{'i': 0, 'n': 'invention-title'}, {'i': 2, 'n': 'publication-reference'}, {'i': 3, 'n': 'date'}, {'i': 5, 'n': 'p'}, {'i': 7, 'n': 'abstract'}, {'i': 8, 'n': 'claim'}]) AS x FROM documents)""")
def markup_tags(spark, d):
    """Tags that sections are made of, with articles' names; dates count inside the latest publication reference."""
    return sections.markup_tags(_tags(spark, d, _MARKUP), rename=sections.ARTICLE).select("doc_id", "tag_id", "name")


@query(f"""WITH {_SPANS}, c AS (SELECT doc_id, start, "end", line, row_number() OVER (PARTITION BY doc_id ORDER BY tag_id) AS n FROM x WHERE len(line) > 0)
SELECT doc_id, start, CAST(n AS INT) AS claim_number, array_to_string(regexp_extract_all(line, 'claim (\\d+)', 1), ',') AS parents FROM c""")
def patent_claims(spark, d):
    """Every line with text as a claim of one claims section: numbers, and references."""
    spans = _spans(spark, d).where("end > start")
    docs = _docs(spark, d, F.length("text").alias("n"))
    blank = F.create_map(F.lit("lang"), F.lit("eng"))
    tags = spans.select("doc_id", "tag_id", F.lit("claim").alias("name"), F.lit("claim").alias("struct"), blank.alias("attrs"), "start", "end")
    whole = docs.select("doc_id", F.lit(0).alias("tag_id"), F.lit("claims").alias("name"), F.lit("claims").alias("struct"), blank.alias("attrs"), F.lit(0).alias("start"), (F.col("n") + 1).alias("end"))
    made = sections.patent_sections(_docs(spark, d, "text"), whole.union(tags))
    claims = sections.pick(made, ["Claims", "Claim"], "claim")
    return claims.select("doc_id", "start", "claim_number", F.array_join(F.col("parent_claims").cast("array<string>"), ",").alias("parents"))


@query(f"""WITH {_SPANS}, a AS (SELECT doc_id, tag_id, length, "end" AS e1, line, lower(regexp_replace(line, '[^A-Za-z_]', '', 'g')) AS flat, substring((SELECT any_value(text) FROM documents WHERE documents.doc_id = x.doc_id), "end" + 2) AS rest FROM x WHERE tag_id = 1
), two AS (SELECT DISTINCT doc_id FROM x WHERE tag_id = 2), t AS (SELECT a.*, {D.header_types_sql('flat').replace('x -> x', 'lambda x: x')} AS found FROM a JOIN two USING (doc_id)
), s AS (SELECT doc_id, 1 AS id, e1 + 1 AS st, length AS en, CASE WHEN len(found) = 0 THEN ['Other'] ELSE found END AS types, trim(regexp_replace(line, '\\s+', ' ', 'g')) AS title, rest AS body FROM t
  UNION ALL SELECT doc_id, 2, 0, e1, ['Header'], NULL, line FROM t UNION ALL SELECT doc_id, 1, 0, length, ['Unlabeled'], NULL, line FROM a WHERE length > 0 AND doc_id NOT IN (SELECT doc_id FROM two))
SELECT doc_id, CAST(id AS INT) AS section_id, 'SECTION ID=' || id || ' TYPE="' || upper(array_to_string(types, '|')) || '"' || CASE WHEN title IS NULL THEN '' ELSE ' TITLE="' || title || '"' END || ' START=' || st || ' END=' || en AS line
FROM s WHERE trim(regexp_replace(body, '\\s+', ' ', 'g')) <> ''""")
def article_sections(spark, d):
    """Documents' first lines as titles over the rest: typed sections, headers, and what none covers, as lines."""
    spans = _spans(spark, d)
    title = F.col("tag_id") == 1
    tags = spans.where("tag_id <= 2").select(
        "doc_id", "tag_id", F.when(title, "title").otherwise("sec").alias("name"), F.create_map(F.lit("TYPE"), F.lit("NONE")).alias("attrs"),
        F.lit(0).alias("start"), F.when(title, F.col("end")).otherwise(F.col("length")).alias("end"),
    )
    made = sections.article_sections(_docs(spark, d, "text"), tags)
    return sections.section_lines(made).select("doc_id", "section_id", "line")


@query("""SELECT * FROM (SELECT page_id AS doc_id, CAST(generate_subscripts(k, 1) - 1 AS INT) AS section_id, unnest(k) AS type FROM (SELECT page_id, regexp_extract_all(html, '<(nav|article|footer|h1|p|li)\\b', 1) AS k FROM pages)) WHERE type = 'p' ORDER BY doc_id, section_id LIMIT 20""")
def sections_of_type(spark, d):
    from termloom.plans.catalog import _typed

    return stats.sections_of_type(_typed(spark, d).withColumnRenamed("page_id", "doc_id"), "p").select("doc_id", "section_id", F.get("types", F.lit(0)).alias("type"))


# --- cleaning ---------------------------------------------------------------------------------------------------------------

@query(r"""SELECT doc_id, 'a' || chr(10) || '<claim-text>' || source || '</claim-text>' || chr(10) || '1 see <claim-ref>2</claim-ref> x<figref id="1">' || lang || '</figref>, ' || '<figref>3</figref> of' AS text FROM documents""")
def spaced_tags(spark, d):
    glued = _text("a<claim-text>", "$source", "</claim-text>1 see<claim-ref>2</claim-ref> x<figref id=\"1\">", "$lang", "</figref>, <figref>3</figref>of")
    return table(spark, d, "documents").select("doc_id", text.space_tags(glued).alias("text"))


@query("""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'Glass Of ' || upper(source[1]) || lower(source[2:]) ELSE 'Glass OF ' || source END AS title, doc_id % 3 = 0 AS han, '一(_PU x_NN )_PU' AS paren, 'a' || lang || 'b|c。|d' AS sentences FROM documents""")
def chinese_and_german_text(spark, d):
    """Proper capitals, Han characters, parenthesis tags, glued sentences."""
    title = F.when(_id() % 2 == 0, F.upper(_text("GLASS OF ", "$source"))).otherwise(_text("Glass OF ", "$source"))
    return table(spark, d, "documents").select(
        "doc_id",
        text.proper_case(title).alias("title"),
        text.has_han(F.when(_id() % 3 == 0, "a文b").otherwise("é")).alias("han"),
        text.fix_paren_tag(F.lit("一(_NN x_NN )_JJ")).alias("paren"),
        F.array_join(text.restore_sentences(_text("a\n", "$lang", "\nb\n\n\nc。d")), "|").alias("sentences"),
    )


# --- taggers, fields --------------------------------------------------------------------------------------------------------

@query("""WITH l AS (SELECT doc_id, unnest(['FH_TITLE:', 'x ' || doc_id, CASE WHEN doc_id % 9 = 0 THEN 'boom' ELSE '( 7 )' END]) AS line, unnest([0, 1, 2]) AS n FROM documents)
SELECT doc_id, CAST(n AS INT) AS line_no, CASE WHEN n = 0 THEN line WHEN n = 1 THEN 'x_NN ' || doc_id || '_CD' WHEN doc_id % 9 <> 0 THEN '(_PU 7_CD )_PU' END AS tagged, n = 2 AND doc_id % 9 = 0 AS failed FROM l""")
def tagged_lines(spark, d):
    """A user's tagger over Chinese text: headers pass, parentheses are punctuation, a line that fails has an error."""
    third = F.when(_id() % 9 == 0, "boom").otherwise("( 7 )")
    lines = _docs(spark, d).select("doc_id", F.posexplode(F.array(F.lit("FH_TITLE:"), _text("x ", "$doc_id"), third)).alias("line_no", "line"))
    return tagging.tag_lines(lines, "cn", tagging.number_tagger).select("doc_id", "line_no", "tagged", F.col("error").isNotNull().alias("failed"))


@query("""SELECT doc_id, CAST(i - 1 AS INT) AS line_no, ['FH_TITLE:', '文 字 。', '系 统', '2014'][i] AS line FROM (SELECT doc_id, unnest([1, 2, 3, 4]) AS i FROM documents)""")
def segmented_lines(spark, d):
    """A user's segmenter over gathered lines; a passage is cut after full stops."""
    raw = _docs(spark, d).select("doc_id", F.posexplode(F.array(F.lit("FH_TITLE:"), F.lit("文字。系"), F.lit("统"), F.lit("2014"))).alias("line_no", "line"))
    made = segmenting.segmented(segmenting.gathered(raw), segmenting.by_character)
    return made.select("doc_id", (F.row_number().over(segmenting.Window.partitionBy("doc_id").orderBy("line_no", "part")) - 1).cast("int").alias("line_no"), "line")


@query("""SELECT doc_id, CAST(i - 1 AS INT) AS i, ['a_b', lang, 'c'][i] AS tok, ['NN', 'JJ', NULL][i] AS tag FROM (SELECT doc_id, lang, unnest([1, 2, 3]) AS i FROM documents)""")
def pretagged_tokens(spark, d):
    """token_TAG lines, cut at the last underscore."""
    toks = _docs(spark, d, "lang").select("doc_id", F.posexplode(tagging.parse_tagged(_text("a_b_NN  ", "$lang", "_JJ c"))).alias("i", "t"))
    return toks.select("doc_id", "i", "t.tok", "t.tag")


def _fielded(spark, d):
    """Fields as lines: title, date (missing in every third document), summary, claim."""
    date = F.when(_id() % 3 == 0, F.array(F.lit("FH_JOURNAL:"), F.lit("J"))).otherwise(F.array(F.lit("FH_DATE:"), F.lit(" "), F.concat(F.lit("1998"), _id().cast("string"))))
    rest = F.array(F.lit("FH_DESC_REST:"), F.lit("red glass ."), F.lit("more"), F.lit("FH_FIRST_CLAIM:"), F.lit("END"), F.lit("claim"), F.lit("FH_DESC_REST:"), F.lit("late"), F.lit("END"))
    lines = F.concat(F.array(F.lit("before"), F.lit("FH_TITLE:"), F.col("source")), date, rest)
    return _docs(spark, d, "source").select("doc_id", F.posexplode(lines).alias("line_no", "line"))


@query("""WITH l AS (SELECT doc_id, unnest(list_concat([{'s': 'NONE', 'l': 'before'}, {'s': 'TITLE', 'l': source}], CASE WHEN doc_id % 3 = 0 THEN [{'s': 'JOURNAL', 'l': 'J'}] ELSE [{'s': 'DATE', 'l': '1998' || doc_id}] END,
  [{'s': 'DESC', 'l': 'red glass .'}, {'s': 'DESC', 'l': 'more'}, {'s': 'FIRST', 'l': 'claim'}, {'s': 'DESC', 'l': 'late'}])) AS x, unnest(range(0, 7)) AS n FROM documents)
SELECT doc_id, CAST(n AS INT) AS sent_id, x.s AS section, CAST(CASE WHEN n = 4 THEN 1 ELSE 0 END AS INT) AS sent_in_section, x.l AS sentence FROM l""")
def fielded_sections(spark, d):
    """Sections of fielded lines: headers and END marks go, each header begins a section anew."""
    sents = S.sentences_of(S.sections_of(_fielded(spark, d)).where("trim(line) <> ''"))
    return sents.select("doc_id", "sent_id", "section", "sent_in_section", F.array_join(F.col("toks.tok"), " ").alias("sentence"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '9999' ELSE '1998' END AS year FROM documents")
def document_years(spark, d):
    return S.years_of(S.sections_of(_fielded(spark, d)))


@query("""WITH s AS (SELECT CASE WHEN doc_id % 4 = 0 THEN NULL ELSE lang END AS subject FROM documents) SELECT subject, count(*) AS n FROM s GROUP BY subject""")
def document_subjects(spark, d):
    """Histogram of the first line of the subject field."""
    has = F.array(F.lit("FH_TITLE:"), F.lit("t"), F.lit("FH_SUBJECT:"), F.col("lang"), F.lit("other"))
    lines = _docs(spark, d, "lang").select("doc_id", F.posexplode(F.when(_id() % 4 == 0, F.slice(has, 1, 2)).otherwise(has)).alias("line_no", "line"))
    return stats.subject_histogram(S.sections_of(lines))


# --- chunks and features ----------------------------------------------------------------------------------------------------

@query(f"{_BASE}, {_islands_sql('cn')} SELECT doc_id, sent_id, cs, ce, term, tag_sig FROM p")
def chunks_cn(spark, d):
    """These texts have none of the adjectives that may start but not continue a Chinese chunk, so windows give its chunks too; the
    automaton's test has them."""
    return chunk_rows(_texts(spark, d), "cn", "sent_id", "cs", "ce", "term", "tag_sig")


_SCHEMA_LINES = ["start_pat\tNN", "start_pat\tNNS", "cont_pat\tNN", "cont_pat\tNNS", "cont_pat\tIN + of", "", "end_pat\tNN - that hewh", "end_pat\tNNS"]


@query(f"{_BASE}" + """, f AS (SELECT doc_id, sent_id, i, tag IN ('NN', 'NNS') AS st, tag IN ('NN', 'NNS') OR (tag = 'IN' AND lc = 'of') AS c, tag = 'NNS' OR (tag = 'NN' AND lc NOT IN ('that', 'hewh')) AS e FROM t
), g AS (SELECT *, sum(CASE WHEN c THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, sent_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS grp, max(i) OVER (PARTITION BY doc_id, sent_id) AS mx FROM f
), h AS (SELECT doc_id, sent_id, grp, min(CASE WHEN st THEN i END) AS cs, max(CASE WHEN e THEN i END) AS le, max(i) AS last, max(mx) AS mx FROM g WHERE c GROUP BY ALL)
SELECT doc_id, sent_id, CAST(cs AS INT) AS cs, CAST(CASE WHEN last = mx THEN mx ELSE le END AS INT) AS last FROM h WHERE cs IS NOT NULL AND (last = mx OR le >= cs)""")
def chunks_of_a_schema_file(spark, d):
    """Chunks by a schema read from lines."""
    made = chunk_rows(_texts(spark, d), chunking.parse_schema(_SCHEMA_LINES), "sent_id", "cs", "ce")
    return made.select("doc_id", "sent_id", "cs", (F.col("ce") - 1).alias("last"))


@query(f"""{_BASE}, {_islands_sql('en')}, {_TITLE_SQL}, m AS (SELECT doc_id, sent_id, list(replace(replace(replace(tok, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') ORDER BY i) AS toks FROM t GROUP BY ALL)
SELECT uid, term, array_to_string(list_concat(list_concat(toks[1:cs], ['<np>' || array_to_string(toks[cs + 1:ce], ' ') || '</np>']), toks[ce + 1:]), ' ') AS sentence FROM u JOIN m USING (doc_id, sent_id)""")
def highlighted_terms(spark, d):
    """uid, term and the sentence with the term marked, escaped."""
    return chunk_rows(_texts(spark, d), "en", "ordinal", "term", "marked").select(_uid().alias("uid"), "term", F.col("marked").alias("sentence"))


_NOUN_SQL = _scan_sql("N", "regexp_matches({tag}, '^[JD]') AND prep = ''")

@query(f"""{_BASE}, {_islands_sql('en')}, {_NOUN_SQL}, vn AS (
  SELECT doc_id, sent_id, cs AS chunk, word, prep, list_filter(range(cs - 1, greatest(cs - 5, 0), -1), lambda j: tags[j + 1] LIKE 'N%')[1] AS noun FROM f4 WHERE word <> ''
), c2 AS (SELECT DISTINCT doc_id, sent_id, CAST(noun AS INT) AS cs FROM vn), {_VERB_SQL.replace('FROM c JOIN', 'FROM c2 c JOIN')}
SELECT vn.doc_id, vn.sent_id, vn.chunk AS cs, array_to_string(list_concat([v], coalesce(preps, [])[1:2]), '_') || '|' || word || '|' || prep AS prev_vnp
FROM vn JOIN k3 ON vn.doc_id = k3.doc_id AND vn.sent_id = k3.sent_id AND vn.noun = k3.cs WHERE v IS NOT NULL""")
def features_prev_vnp(spark, d):
    return chunk_rows(_texts(spark, d), "en", "sent_id", "cs", "value", names=["prev_VNP"]).withColumnRenamed("value", "prev_vnp")


def _near(test: str, most: str = "0") -> str:
    """The index of the nearest token left of the chunk, token 0 left out, for which ``test`` holds of its tag ``@``."""
    return f"list_filter(range(cs - 1, greatest({most}, 0), -1), lambda j: {test.replace('@', 'tags[j + 1]')})[1]"


_INSIDE = "list_filter(range(cs, ce), lambda j: {})"
_GERMAN = {
    "prev_V": f"CASE WHEN tags[{_near("(@ LIKE 'V%' AND @ <> 'VAINF') OR @ LIKE 'N%'")} + 1] LIKE 'V%' THEN lcs[{_near("(@ LIKE 'V%' AND @ <> 'VAINF') OR @ LIKE 'N%'")} + 1] END",
    "prev_N": f"lcs[{_near("@ LIKE 'N%'", 'cs - 4')} + 1]",
    "chunk_lead_J": "CASE WHEN tags[cs + 1] = 'ADJA' THEN lcs[cs + 1] END",
    "initial_J": "CASE WHEN tags[cs + 1] = 'ADJA' THEN lcs[cs + 1] END",
    "initial_V": "CASE WHEN tags[cs + 1] LIKE 'V%' THEN lcs[cs + 1] END",
    "von_head": f"CASE WHEN {_INSIDE.format("tags[j + 1] = 'APPR'")}[1] > cs THEN lcs[{_INSIDE.format("tags[j + 1] = 'APPR'")}[1]] END",
    "prev_J": "CASE WHEN cs > 0 AND tags[cs] = 'ADJA' THEN lcs[cs] END",
    "following_prep": "CASE WHEN tags[ce + 1] = 'IN' THEN lcs[ce + 1] END",
}
_CHINESE = {
    "prev_N": f"lcs[{_near("@ = 'NN'", 'cs - 4')} + 1]",
    "prev_V": f"CASE WHEN tags[{_near("@ LIKE 'V%' OR @ LIKE 'N%'")} + 1] LIKE 'V%' THEN lcs[{_near("@ LIKE 'V%' OR @ LIKE 'N%'")} + 1] END",
    "first_Adj": f"lcs[{_INSIDE.format("tags[j + 1] IN ('JJ', 'VA')")}[1] + 1]",
    "prev_J": f"lcs[{_INSIDE.format("tags[j + 1] IN ('JJ', 'VA')")}[-1] + 1]",
    "prev_CD_M": f"CASE WHEN {_near("@ = 'M'")} > 1 THEN lcs[{_near("@ = 'M'")}] || ' ' ELSE '' END || lcs[{_near("@ = 'M'")} + 1]",
    "prev_DT": f"lcs[{_near("@ = 'DT'")} + 1]",
}
#: The rules tagger's tags under those of the languages' own tag sets, so that every rule meets some.
_RETAG = {
    "de": {"JJ": "ADJA", "IN": "APPR", "NNP": "NE", "VBD": "VAINF", "RB": "IN"},
    "cn": {"NNP": "NR", "CD": "M", "RB": "VA", "VBN": "DEG", "IN": "CD"},
}


def _own_features(language: str, values: dict[str, str]) -> None:
    names = _RETAG[language]
    cases = "CASE tag " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in names.items()) + " ELSE tag END"
    base = _BASE + f", t2 AS (SELECT * REPLACE ({cases} AS tag) FROM t)"
    sql = f"{base}, {_islands_sql(language).replace('FROM t ', 'FROM t2 ').replace('FROM t' + chr(10), 'FROM t2' + chr(10))}"
    listed = ", ".join(f"'{k}=' || replace({v}, ' ', '_')" for k, v in values.items())

    def run(spark, d):
        return chunk_rows(_texts(spark, d), language, "sent_id", "cs", "features", language=language, names=list(values), retag=names)

    run.__name__ = f"features_{language}"
    run.__doc__ = "The language's own features, over the rules tagger's tags under its tag set's names."
    query(f"{sql} SELECT doc_id, sent_id, cs, array_to_string(list_sort(list_filter([{listed}], lambda x: x IS NOT NULL)), chr(9)) AS features FROM p")(run)


_own_features("de", _GERMAN)
_own_features("cn", _CHINESE)


@query(f"{_BASE}, {_islands_sql('en')} SELECT doc_id, sent_id, cs, 'letters=' || length(term) AS feature FROM p")
def registered_feature(spark, d):
    """A feature of the user's own, registered under a name for a language."""

    @features.feature("letters", "en")
    def letters(toks, cs, ce, ctx):
        return F.length(F.array_join(F.slice(toks, cs + 1, ce - cs)["lc"], " ")).cast("string")

    try:
        rows = S.feature_rows(_chunks(spark, d, "en"), "en", ["letters"])
    finally:
        del features.REGISTRY["en"]["letters"]
    return rows.select("doc_id", "sent_id", "cs", F.element_at("features", 1).alias("feature"))


# --- lists, indexes, repositories --------------------------------------------------------------------------------------------

@query(r"""WITH p AS (SELECT rtrim(regexp_extract(url, '//([^/]+)/', 1), '_-1234567890') AS journal, page_id % 50 || '.nxml' AS name FROM pages)
SELECT left(journal, 1) AS letter, count(*) AS lines, count(DISTINCT name) AS names, count(DISTINCT journal || '/' || name) AS short_paths, count(DISTINCT journal) AS journals FROM p GROUP BY ALL""")
def list_analysis(spark, d):
    path = F.concat_ws("/", F.lit("x"), F.regexp_extract("url", "//([^/]+)/", 1), F.concat((F.col("page_id") % 50).cast("string"), F.lit(".nxml")))
    return stats.list_analysis(table(spark, d, "pages").select(path.alias("path")))


@query("SELECT doc_id, '/a/' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '.xml.gz' ELSE '.xml' END AS path FROM documents")
def compressed_first(spark, d):
    """Of a file and its .gz the latter."""
    bare = F.concat(F.lit("/a/"), _id().cast("string"), F.lit(".xml"))
    both = F.when(_id() % 2 == 0, F.array(bare, F.concat(bare, F.lit(".gz")))).otherwise(F.array(bare))
    got = manifests.prefer_gz(_docs(spark, d).select(F.explode(both).alias("path")))
    return got.select(F.regexp_extract("path", r"(\d+)", 1).cast("long").alias("doc_id"), "path")


@query("SELECT d.doc_id AS line_no, '1999' AS year, l.quality AS content, l.doc_id IS NULL AS missing FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def populated(spark, d):
    """Manifest lines with their files' content, those without a file marked."""
    line = F.concat_ws("\t", F.lit("1999"), F.concat(F.lit("/f/"), _id().cast("string")))
    listed = manifests.parse(_docs(spark, d).select(_id().alias("line_no"), line.alias("value")))
    files = table(spark, d, "labels").select(F.concat(F.lit("/f/"), _id().cast("string")).alias("path"), F.col("quality").alias("content"))
    return manifests.populate(listed, files).select("line_no", "year", "content", "missing")


@query("""SELECT doc_id, 'old' AS kind FROM labels UNION ALL SELECT doc_id, 'added' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'log 2024' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def manifest_additions(spark, d):
    """A manifest with a batch's new lines, and the log of what was added when."""
    old = table(spark, d, "labels").select("doc_id", F.lit("old").alias("kind"))
    new = _docs(spark, d).withColumn("kind", F.lit("added"))
    grown, log = manifests.add(old, new.union(new), "doc_id", "2024")
    return grown.union(log.select("doc_id", F.concat(F.lit("log "), "added_at").alias("kind")))


@query("""WITH l AS (SELECT doc_id // 10 AS g, doc_id, chr(CAST(65 + doc_id // 10 % 26 AS INT)) || '4' || doc_id // 10 AS domain FROM documents) SELECT 'C' || doc_id AS code, domain FROM l WHERE doc_id % 10 <> 0""")
def domain_table(spark, d):
    """Codes below their domains' lines."""
    domain = F.concat(F.expr("char(65 + doc_id div 10 % 26)"), F.lit("4"), F.expr("doc_id div 10").cast("string"))
    line = F.when(_id() % 10 == 0, F.concat(domain, F.lit(" - things"))).otherwise(F.concat(F.lit("   C"), _id().cast("string"), F.lit(" words")))
    return stats.domain_table(_docs(spark, d).select(_id().alias("line_no"), line.alias("line")))


@query("SELECT doc_id, quality FROM labels UNION ALL SELECT doc_id, -1 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def repository_grown(spark, d):
    """A repository with a batch that holds every document twice."""
    have = table(spark, d, "labels").select("doc_id", F.col("quality").cast("int").alias("quality"))
    batch = _docs(spark, d).withColumn("quality", F.lit(-1))
    return have.union(corpus.add_to_repository(have, batch.union(batch)))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN '/p/' || doc_id END AS path FROM documents")
def unique_paths(spark, d):
    """Ids with one path in the index; none or two give null."""
    index = _docs(spark, d).where("doc_id % 3 <> 0").select(_id().alias("short_id"), F.explode(F.when(_id() % 3 == 1, F.array(_text("/p/", "$doc_id"))).otherwise(F.array(F.lit("/a"), F.lit("/b")))).alias("path"))
    return stats.unique_path(_docs(spark, d).select(_id().alias("short_id")), index).select(F.col("short_id").alias("doc_id"), "path")


@query("SELECT d.doc_id, l.quality AS path FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def corpus_view(spark, d):
    """A view's ids with what the repository has of them."""
    return corpus.view(_docs(spark, d), table(spark, d, "labels").select("doc_id", F.col("quality").alias("path")))


@query("SELECT event_type AS stage, arg_min(user_id, ts) AS version, arg_min(props, ts) AS options FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY event_type, ts ORDER BY event_id) = 1) GROUP BY event_type")
def first_options(spark, d):
    """Version and options of each stage's first run."""
    runs = table(spark, d, "events").select(F.col("event_type").alias("stage"), F.col("user_id").alias("version"), F.col("props").alias("options"), F.col("ts").alias("at"), "event_id")
    return corpus.earliest_options(stats.first_by(runs, ["stage", "at"], F.col("event_id")))


@query("SELECT doc_id, doc_id || chr(9) || '1999' || chr(9) || source || chr(9) || 'a=1' || chr(9) || 'b=' || lang AS line FROM documents")
def feature_files(spark, d):
    """Feature rows as compressed text files, read back."""
    path = scratch_path(spark, "feature-files")
    rows = _docs(spark, d, "source", "lang").select(_id().cast("string").alias("uid"), F.lit("1999").alias("year"), F.col("source").alias("term"), F.array(F.lit("a=1"), F.concat(F.lit("b="), "lang")).alias("features"))
    sinks.feature_files(rows, path)
    return spark.read.text(path).select(F.split("value", "\t")[0].cast("long").alias("doc_id"), F.col("value").alias("line"))


@query(r"""WITH l AS (SELECT doc_id, 'A' || 40 + doc_id % 12 AS domain, CAST(1990 + doc_id % 30 AS INT) AS year FROM documents) SELECT doc_id, domain, year FROM l WHERE domain BETWEEN 'A41' AND 'A50' AND year BETWEEN 1995 AND 2014""")
def files_by_domain(spark, d):
    """Ids in a folder for each wanted domain and year, read back."""
    path = scratch_path(spark, "by-domain")
    index = _docs(spark, d).select(_id().cast("string").alias("value"), F.concat(F.lit("A"), (F.lit(40) + _id() % 12).cast("string")).alias("domain"), (F.lit(1990) + _id() % 30).cast("string").alias("year"))
    sinks.by_domain_and_year(index, path, [f"A{k}" for k in range(41, 51)])
    return spark.read.text(path).select(F.col("value").cast("long").alias("doc_id"), "domain", "year")


@query(f"{_BASE} SELECT doc_id, sent_id, string_agg(tok || '_' || tag, ' ' ORDER BY i) AS line FROM t GROUP BY ALL")
def tagged_text(spark, d):
    """Sentences as token_TAG lines."""
    return sinks.tagged_lines(S.document_sentences(_docs(spark, d, "text"))).select("doc_id", "sent_id", "line")


_RUN_BASE = f"""WITH l0 AS (SELECT doc_id, ['1999', 'Red glass of ' || source || ', a new method', lang || ' houses are built in ' || source || '. Old stones fall'] AS ls FROM documents
), l AS (SELECT doc_id, unnest(ls) AS line, unnest([0, 1, 2]) AS line_no FROM l0), {_BASE[_BASE.index("s0 AS ("):]}"""


@query(f"""{_RUN_BASE}, {_islands_sql('en')} SELECT doc_id AS line_no, doc_id || '_' || (row_number() OVER (PARTITION BY doc_id ORDER BY sent_id, cs) - 1) AS uid, '1999' AS year, term, tag_sig FROM p""")
def stage_runner(spark, d):
    """A corpus through populate, text, tags and features, a third of it first and then the rest."""
    docs = _docs(spark, d, "source", "lang")
    path = F.concat(F.lit("/in/"), _id().cast("string"))
    manifest = docs.select(_id().alias("line_no"), F.lit("1999").alias("year"), path.alias("source"), _id().cast("string").alias("target"))
    content = _text("<year>1999</year>\n<title>Red glass of ", "$source", ", a new method</title>\n<abstract>", "$lang", " houses are built in ", "$source", ". Old stones fall</abstract>")
    made = corpus.Corpus(spark, scratch_path(spark, "corpus"), manifest, docs.select(path.alias("path"), content.alias("content")), source="signal-processing")
    made.run(limit=50)
    rows = made.run()
    tags = F.regexp_extract(F.array_join("features", "\t"), r"tag_sig=(\S+)", 1)
    return rows.select("line_no", "uid", "year", "term", tags.alias("tag_sig"))


@query(r"""SELECT doc_id, '<div class="doc">a &amp; <div class="n"><div class="s">' || source || '</div>!</div></div><div class="t">&lt;' || lang || '</div>.' AS html FROM documents""")
def html_view(spark, d):
    """Texts with nested tags as nested divs."""
    from termloom.operators.htmlview import html_view as view

    n, m = F.length("source"), F.length("lang")
    docs = _docs(spark, d, "source", "lang")
    spans = [("doc", F.lit(0), n + 5), ("n", F.lit(4), n + 5), ("s", F.lit(4), n + 4), ("t", n + 5, n + m + 6), ("empty", F.lit(2), F.lit(2)), ("beyond", F.lit(0), n + 99)]
    each = F.array(*(F.struct(F.lit(k).alias("tag_id"), F.lit(name).alias("name"), a.cast("int").alias("start"), b.cast("int").alias("end")) for k, (name, a, b) in enumerate(spans)))
    tags = docs.select("doc_id", F.explode(each).alias("t")).select("doc_id", "t.*")
    return view(docs.select("doc_id", _text("a & ", "$source", "!<", "$lang", ".").alias("text")), tags)


def _english_sql() -> str:
    """All English features of a chunk: the basic ones, and each scan's SQL joined to it."""
    adjective = re.sub(r"\b([ef])(\d)\b", r"\1j\2", _scan_sql("J", "regexp_matches({tag}, '^[JD]')"))
    from_noun = re.sub(r"\bk(\d?)\b", r"kn\1", _VERB_SQL).replace("FROM c JOIN", "FROM c2 c JOIN")
    verb = "array_to_string(list_concat([v], coalesce(preps, [])[1:2]), '_')"
    scans = f"""{_VERB_SQL}, {_NOUN_SQL}, {adjective}, vn AS (
  SELECT doc_id, sent_id, cs AS chunk, word, prep, list_filter(range(cs - 1, greatest(cs - 5, 0), -1), lambda j: tags[j + 1] LIKE 'N%')[1] AS noun FROM f4 WHERE word <> ''
), c2 AS (SELECT DISTINCT doc_id, sent_id, CAST(noun AS INT) AS cs FROM vn), {from_noun}, s1 AS (
  SELECT doc_id, sent_id, cs, {verb} AS prev_v FROM k3 WHERE v IS NOT NULL
), s2_ AS (SELECT doc_id, sent_id, cs, word || '_' || prep AS prev_npr FROM f4 WHERE word <> ''
), s3 AS (SELECT doc_id, sent_id, cs, word || '_' || prep AS prev_jpr FROM fj4 WHERE word <> ''
), s4 AS (SELECT vn.doc_id, vn.sent_id, vn.chunk AS cs, {verb} || '|' || word || '|' || prep AS prev_vnp
  FROM vn JOIN kn3 ON vn.doc_id = kn3.doc_id AND vn.sent_id = kn3.sent_id AND vn.noun = kn3.cs WHERE v IS NOT NULL)"""
    values = {**_BASIC_SQL, "prev_V": "prev_v", "prev_Npr": "prev_npr", "prev_Jpr": "prev_jpr", "prev_VNP": "prev_vnp", "prev_J": "CASE WHEN cs > 0 AND tags[cs] LIKE 'J%' THEN lcs[cs] END"}
    listed = ", ".join(f"'{k}=' || replace({v}, ' ', '_')" for k, v in values.items())
    joined = " ".join(f"LEFT JOIN {s} USING (doc_id, sent_id, cs)" for s in ("s1_", "s2_", "s3", "s4"))
    return f"""{_BASE}, {_islands_sql('en')}, {scans.replace('s1 AS (', 's1_ AS (')}
SELECT doc_id, sent_id, cs, term, array_to_string(list_sort(list_filter([{listed}], lambda x: x IS NOT NULL)), chr(9)) AS features FROM p {joined}"""


ORACLES["features_english"] = _english_sql()
