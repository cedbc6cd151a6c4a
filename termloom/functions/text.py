"""Text cleaning as column expressions: every function takes and gives columns and stays inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_LINE = 10_000
SPACED_TAGS = {"claim-text": "\n", "claim-ref": " ", "figref": " "}


def find_offsets(text: Column, needle: str) -> Column:
    """All offsets of a literal, overlapping ones too, from 0. The text is cut into characters once, so time is linear in it."""

    def places(chars: Column) -> Column:
        def here(i: Column) -> Column:
            out = F.lit(True)
            for k, c in enumerate(needle):
                out = out & (F.get(chars, i + k) == c)
            return F.coalesce(out, F.lit(False))

        return F.filter(F.sequence(F.lit(0), F.greatest(F.size(chars) - 1, F.lit(0))), here)

    return F.element_at(F.transform(F.array(F.split(text, "")), places), 1)


def remove_trademark(text: Column) -> Column:
    return F.replace(text, F.lit("™"), F.lit(""))


def space_tag(text: Column, tag: str, filler: str) -> Column:
    """Put ``filler`` before an attribute-free open tag glued to a character, and after a close tag glued to a letter or digit."""
    opened = F.regexp_replace(text, rf"(\S)(?=<{tag}>)", F.lit("$1" + filler))
    return F.regexp_replace(opened, rf"(</{tag}>)(?=[\p{{L}}\p{{N}}])", F.lit("$1" + filler))


def space_tags(text: Column) -> Column:
    for tag, filler in SPACED_TAGS.items():
        text = space_tag(text, tag, filler)
    return text


def glued_tags(text: Column, tag: str) -> Column:
    """How many open and close tags stick to their neighbours."""
    return F.regexp_count(text, F.lit(rf"\S<{tag}>")) + F.regexp_count(text, F.lit(rf"</{tag}>[\p{{L}}\p{{N}}]"))


def keep_line(line: Column, most: int = MAX_LINE) -> Column:
    return F.length(line) <= most


def fix_line(line: Column) -> Column:
    """Strip line ends and form feeds at both ends, delete tildes and backspaces."""
    return F.regexp_replace(F.regexp_replace(line, r"^[\n\r\f]+|[\n\r\f]+\z", ""), "[~\b]", "")


def han_line(line: Column) -> Column:
    """Ideographic spaces go, no-break spaces become spaces, ends are stripped."""
    return F.trim(F.translate(line, " 　", " "))


def is_latin1(text: Column) -> Column:
    return ~text.rlike(r"[^\x00-\xFF]")


def is_ascii(text: Column) -> Column:
    return ~text.rlike(r"[^\x00-\x7F]")


def is_skippable(text: Column, longest: int = 5000) -> Column:
    """Segmenter input that isn't Chinese prose: too long, mostly Latin-1, or Latin-1 that is not just digits."""
    bare = F.regexp_replace(text, r"\s", "")
    n, latin = F.length(bare), F.length(F.regexp_replace(bare, r"[^\x00-\xFF]", ""))
    return (n > longest) | ((n > 10) & (latin > 0.9 * n)) | ((latin == n) & ~bare.rlike("^[0-9]+$"))


def split_han(text: Column) -> Column:
    """Sentences of Chinese text: white space goes, cuts come after the full stop."""
    parts = F.split(F.regexp_replace(F.regexp_replace(text, r"\s", ""), "。", "。\n"), "\n")
    return F.filter(parts, lambda p: p != "")


def restore_sentences(text: Column) -> Column:
    """Glue lines of Chinese text, keep one line feed per run of blank lines, cut after full stops."""
    runs = F.regexp_replace(text, r"\n[ \t]*(\n[ \t]*)+", "\u0001")
    glued = F.replace(F.replace(runs, F.lit("\n"), F.lit("")), F.lit("\u0001"), F.lit("\n"))
    return F.filter(F.split(F.replace(glued, F.lit("。"), F.lit("。\n")), "\n"), lambda p: p != "")


def proper_case(text: Column) -> Column:
    """All-capital titles come back with initial capitals."""
    return F.when((F.upper(text) == text) & (text != F.lower(text)), F.initcap(F.lower(text))).otherwise(text)


def has_han(text: Column) -> Column:
    return text.rlike("[一-龥]")


def fix_paren_tag(tagged: Column) -> Column:
    """Parentheses are punctuation, whatever the tagger said."""
    return F.regexp_replace(tagged, r"([()])_\S*", "$1_PU")


def escape_xml(text: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text
