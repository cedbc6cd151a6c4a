"""Tag providers: ``rules`` (a deterministic tagger as one CASE expression) and ``pretagged`` (token_TAG lines).

``rules`` knows function words and suffixes only; it claims no parity with a statistical tagger. What reads tags does not
care which provider made them. ``external`` wraps a user's tagger in batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions import text

#: Function words by tag, looked up in this order.
LEXICON = {
    "DT": "a an the this that these those each every der die das ein eine les la le el los",
    "IN": "of in on at by for from with as into between through under over von mit de en por pour par dans sur",
    "TO": "to",
    "CC": "and or but nor und y et",
    "PRP": "it he she they we you i",
    "VBZ": "is has does",
    "VBP": "are have do",
    "VBD": "was were had did",
    "VB": "be",
    "MD": "can may will shall must should would could",
    "RP": "up out off",
    "WDT": "which",
    "RB": "not very also",
}
#: Endings by tag, tried in this order, and how many characters at least stand before them.
SUFFIXES = [
    ("VBG", ("ing",), 2), ("VBN", ("ed",), 2), ("RB", ("ly",), 2), ("JJ", ("ous", "ful", "ble", "ive", "ic", "al"), 2), ("JJS", ("est",), 3),
]


def tag_case(tok: str) -> str:
    """The rules as SQL for checks on another engine, MATCH(x, p) standing for a full match."""
    lc = f"lower({tok})"
    parts = [
        f"WHEN {tok} IN ('.', '!', '?') THEN '.'",
        f"WHEN {tok} = ',' THEN ','",
        f"WHEN {tok} IN (';', ':') THEN ':'",
    ]
    for tag, words in LEXICON.items():
        quoted = ", ".join(f"'{w}'" for w in words.split())
        parts.append(f"WHEN {lc} IN ({quoted}) THEN '{tag}'")
    parts.append(f"WHEN MATCH({tok}, '[0-9][0-9.,]*') THEN 'CD'")
    parts += [f"WHEN MATCH({lc}, '.{{{least},}}({'|'.join(ends)})') THEN '{tag}'" for tag, ends, least in SUFFIXES]
    parts.append(f"WHEN MATCH({lc}, '.{{2,}}[^s]s') THEN 'NNS'")
    parts.append(f"WHEN MATCH({tok}, '[A-Z].*') THEN 'NNP'")
    return f"CASE {' '.join(parts)} ELSE 'NN' END"


def split_sentences(line: Column) -> Column:
    """Cut a line after end marks followed by white space."""
    return F.array_remove(F.split(F.regexp_replace(line, r"([.!?])\s+", "$1\n"), "\n"), "")


def split_tokens(sentence: Column) -> Column:
    """White-space tokens, a final punctuation mark on its own."""
    spaced = F.regexp_replace(sentence, r"([.,;:!?])(\s|\z)", " $1$2")
    return F.array_remove(F.split(spaced, r"\s+"), "")


def tagged(tokens: Column) -> Column:
    """array<struct<tok, lc, tag>> by the rules; the lower-cased token is made once."""
    cased = F.transform(tokens, lambda t: F.struct(t.alias("tok"), F.lower(t).alias("lc")))
    return F.transform(cased, lambda x: F.struct(x["tok"].alias("tok"), x["lc"].alias("lc"), tag_of(x["tok"], x["lc"]).alias("tag")))


def tag_of(t: Column, lc: Column) -> Column:
    """The tag of a token and its lower-cased form. Most tokens are no function words, which one look into a set tells; numbers
    and names are told by their first character before any pattern is tried."""
    listed = [(".", (".", "!", "?")), (",", (",",)), (":", (";", ":")), *((tag, words.split()) for tag, words in LEXICON.items())]
    known = None
    for tag, words in listed:
        test = lc.isin(*words)
        known = F.when(test, tag) if known is None else known.when(test, tag)
    out = F.when(lc.isin(*(w for _, words in listed for w in words)), known)
    out = out.when((t >= "0") & (t < ":") & t.rlike(r"^[0-9][0-9.,]*\z"), "CD")
    for tag, ends, least in SUFFIXES:
        hit = None
        for e in ends:
            one = lc.endswith(e) & (F.length(lc) >= len(e) + least)
            hit = one if hit is None else hit | one
        out = out.when(hit, tag)
    plural = lc.endswith("s") & ~lc.endswith("ss") & (F.length(lc) >= 4)
    return out.when(plural, "NNS").when((t >= "A") & (t < "["), "NNP").otherwise("NN")


def parse_tagged(line: Column) -> Column:
    """array<struct<tok, lc, tag>> of a line of token_TAG, cut at the last underscore; tokens without one get a null tag."""
    parts = F.filter(F.split(line, " "), lambda x: x != "")

    def one(x: Column) -> Column:
        has = x.contains("_")
        tok = F.when(has, F.regexp_extract(x, "^(.*)_([^_]*)$", 1)).otherwise(x)
        return F.struct(tok.alias("tok"), F.lower(tok).alias("lc"), F.when(has, F.regexp_extract(x, "^(.*)_([^_]*)$", 2)).alias("tag"))

    return F.transform(parts, one)


def external(fields: DataFrame, start: Callable[[], Callable[[list[str]], list[str]]]) -> DataFrame:
    """Tag ``line`` by a user's tagger, started once a partition, into ``tagged``; header lines (FH_) pass as they are. A line it fails on
    gives a null and the message in ``error``."""
    columns = fields.columns
    schema = ", ".join([*(f"`{c}` {t}" for c, t in fields.dtypes), "tagged string, error string"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = start()
        for b in batches:
            done, errors = [], []
            for line in b["line"]:
                try:
                    done.append(line if line.startswith("FH_") else tagger([line])[0])
                    errors.append(None)
                except Exception as e:  # one bad line must not end the job
                    done.append(None)
                    errors.append(repr(e))
            yield b[columns].assign(tagged=done, error=errors)

    return fields.mapInPandas(run, schema)


def number_tagger() -> Callable[[list[str]], list[str]]:
    """The least provider: numbers are CD, all else NN. It can't read the word ``boom``, to show what becomes of such lines."""

    def tag(lines: list[str]) -> list[str]:
        if any("boom" in line for line in lines):
            raise ValueError("boom")
        return [" ".join(f"{w}_{'CD' if w.isdigit() else 'NN'}" for w in line.split()) for line in lines]

    return tag


def tag_lines(fields: DataFrame, language: str, start: Callable[[], Callable[[list[str]], list[str]]]) -> DataFrame:
    """``external`` for a language with a chunk schema; in Chinese text parentheses are punctuation, whatever the tagger said."""
    chunker_for(language)
    out = external(fields, start)
    return out.withColumn("tagged", text.fix_paren_tag(F.col("tagged"))) if language == "cn" else out


PROVIDERS = ("rules", "pretagged", "external")
LANGUAGES = {"en": "en", "de": "de", "cn": "cn"}


def chunker_for(language: str) -> str:
    """The chunk schema of a language."""
    if language not in LANGUAGES:
        raise ValueError(f"no chunk schema for language {language!r}; known: {sorted(LANGUAGES)}")
    return LANGUAGES[language]
