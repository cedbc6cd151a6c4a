"""Text with tags over it as nested HTML, for people to look at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions import text as T


def html_view(texts: DataFrame, tags: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, html): each text with a ``<div class=name>`` for each of its tags (key, tag_id, name, start, end), outer ones first.

    Texts are cut at the tags' edges; between two cuts the divs that end come before those that begin, so tags that nest give
    nested divs. Empty tags and those beyond the text's ends are left out. All work is keyed by document.
    """
    size = F.length("text")
    placed = tags.select(key, "tag_id", "name", "start", "end").join(texts.select(key, "text"), key).where((F.col("end") > F.col("start")) & (F.col("start") >= 0) & (F.col("end") <= size))
    # at one place: ends first, the innermost (begun last) foremost; then begins, the outermost (ending last) foremost
    edge = lambda at, kind, a, b, mark: F.struct(at.alias("at"), F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"), mark.alias("mark"))
    begin = edge(F.col("start"), 1, -F.col("end"), F.col("tag_id"), F.concat(F.lit('<div class="'), _attribute(F.col("name")), F.lit('">')))
    end = edge(F.col("end"), 0, -F.col("start"), -F.col("tag_id"), F.lit("</div>"))
    edges = placed.select(key, F.explode(F.array(begin, end)).alias("e")).groupBy(key).agg(F.array_sort(F.collect_list("e")).alias("_e"))
    met = texts.select(key, "text").join(edges, key, "left")
    e = F.coalesce(F.col("_e"), F.slice(F.array(F.struct(F.lit(0).alias("at"), F.lit(0).alias("kind"), F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit("").alias("mark"))), 1, 0))
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, x: Column) -> Column:
        piece = F.substring("text", a["at"] + 1, x["at"] - a["at"])
        return F.struct(x["at"].alias("at"), F.concat(a["out"], T.escape_xml(piece), x["mark"]).alias("out"))

    tail = lambda a: F.concat(a["out"], T.escape_xml(F.substring("text", a["at"] + 1, F.length("text"))))
    return met.select(key, F.aggregate(e, first, step, tail).alias("html"))


def _attribute(name: Column) -> Column:
    return F.replace(T.escape_xml(name), F.lit('"'), F.lit("&quot;"))
