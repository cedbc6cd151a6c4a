"""The rules of ``tagging``, ``chunking`` and ``features`` over plain lists, for work in Arrow batches.

The column forms evaluate an expression tree for every token. Here a distinct word is looked at once a task, and then costs one look
into a dictionary: its tokens, their tags and the characters that stand for them, on which chunks and scans are searches in strings.
``tests/test_plain.py`` compares both forms.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from termloom.functions import tagging
from termloom.functions.features import AUXILIARY, COMMON
from termloom.functions.text import MAX_LINE

#: Lower-cased words by their tag; the first tag that lists a word has it.
LISTED = {w: tag for tag, words in reversed([(".", ".!?"), (",", ","), (":", ";:"), *((t, ws.split()) for t, ws in tagging.LEXICON.items())]) for w in words}
_NUMBER = re.compile(r"[0-9][0-9.,]*\Z")
#: Endings by their last character, so that most words need no test or one.
_ENDS: dict[str, list[tuple[str, str, int]]] = {}
for _tag, _ends, _least in tagging.SUFFIXES:
    for _e in _ends:
        _ENDS.setdefault(_e[-1], []).append((_e, _tag, len(_e) + _least))
PREPOSITIONS = ("RP", "IN", "TO")


def tag_of(tok: str, lc: str) -> str:
    """``tagging.tag_of``."""
    if lc in LISTED:
        return LISTED[lc]
    if "0" <= tok[0] <= "9" and _NUMBER.match(tok):
        return "CD"
    last = lc[-1]
    for end, tag, least in _ENDS.get(last, ()):
        if len(lc) >= least and lc.endswith(end):
            return tag
    if last == "s" and len(lc) >= 4 and lc[-2] != "s":
        return "NNS"
    return "NNP" if "A" <= tok[0] <= "Z" else "NN"


def _admits(rules: dict, tag: str, lc: str) -> bool:
    kind, words = rules.get(tag, ("none", ()))
    return kind == "any" or (kind == "in" and lc in words) or (kind == "not" and lc not in words)


def _kind(tag: str, lc: str) -> str:
    """A token's character in the scans: D determiner, V and A main verb and auxiliary, P and Q participle and auxiliary one, N noun, J adjective,
    i preposition, c comma, v another verb tag, d another tag with D, - all else."""
    aux = lc in AUXILIARY
    if tag in ("VBG", "VBP", "VBZ", "VB"):
        return "A" if aux else "V"
    if tag in ("VBD", "VBN"):
        return "Q" if aux else "P"
    if tag in PREPOSITIONS:
        return "i"
    if tag == "DT":
        return "D"
    if tag[0] in "NJ":
        return tag[0]
    if tag[0] == "V":
        return "-" if aux else "v"
    return "d" if tag[0] == "D" else "c" if lc == "," else "-"


#: What a token's three flags (may start, continue, end a chunk) are written as, and the chunks of a sentence written so: a chunk
#: runs on to what can't continue it, and that token begins none.
_FLAGS = "abcdefgh"
_RUN = re.compile("([bdfh][cdgh]*).?")
_NO_END = "abcd"
#: Participles after a determiner or a verb that is no auxiliary are no verbs of their own.
_BLOCKED = re.compile("(?<=[DVPv])[PQ]")
_VERB = str.maketrans("AQP", "VVV")


class Token:
    """A distinct token: itself, lower-cased, its tag, and its characters among flags and kinds."""

    __slots__ = ("tok", "lc", "tag", "flag", "kind")

    def __init__(self, tok: str, lc: str, tag: str, flag: str, kind: str):
        self.tok, self.lc, self.tag, self.flag, self.kind = tok, lc, tag, flag, kind


class Sentence:
    """A sentence of a document: ``words`` are its tokens; what is derived from them is made once."""

    __slots__ = ("words", "sent_id", "title", "in_section", "lcs", "_tags", "_kinds", "_verbs", "_scan", "_framed")

    def __init__(self, words: list[Token], sent_id: int, title: bool, in_section: int):
        self.words, self.sent_id, self.title, self.in_section = words, sent_id, title, in_section
        self.lcs = [w.lc for w in words]
        self._tags = self._kinds = self._verbs = self._scan = self._framed = None

    @property
    def tags(self) -> list[str]:
        if self._tags is None:
            self._tags = [w.tag for w in self.words]
        return self._tags

    @property
    def kinds(self) -> str:
        if self._kinds is None:
            self._kinds = "".join([w.kind for w in self.words])
        return self._kinds

    @property
    def section(self) -> str:
        return "TITLE" if self.title else "DESC"

    @property
    def framed(self) -> list[str]:
        """The lower-cased tokens with three ^ at both ends."""
        if self._framed is None:
            self._framed = ["^", "^", "^", *self.lcs, "^", "^", "^"]
        return self._framed

    def chunks(self) -> Iterator[tuple[int, int]]:
        """``chunking.fold``: half-open spans."""
        flags = "".join([w.flag for w in self.words])
        n = len(flags)
        for m in _RUN.finditer(flags):
            cs, last = m.span(1)
            if last == n:  # open at the sentence's end: whole
                yield cs, n
            elif held := len(m[1].rstrip(_NO_END)):
                yield cs, cs + held

    def verb(self, at: int) -> str | None:
        """``features.governing_verbs`` at one index: the nearest verb, unless a noun is nearer, with two prepositions after it; none if an
        adjective or comma stands between it and a preposition."""
        if self._verbs is None:
            kinds = "-" + self.kinds[1:]  # token 0 is never looked at, but it may block token 1
            if "P" in kinds or "Q" in kinds:
                blocked = _BLOCKED.sub("-", self.kinds)
                kinds = "-" + blocked[1:]
            self._verbs = kinds.translate(_VERB)
        kinds = self._verbs
        v = kinds.rfind("V", 0, at)
        if v < 0 or kinds.rfind("N", v, at) > v:
            return None
        out, weak, preps = self.lcs[v], False, 0
        for i in range(v + 1, at):
            k = kinds[i]
            if k == "i":
                if weak:
                    return None
                if preps < 2:
                    out = f"{out}_{self.lcs[i]}"
                preps += 1
            elif k == "J" or k == "c":
                weak = True
        return out

    def noun(self, cs: int) -> tuple[int, int] | None:
        """The places of a noun and the preposition after it, within four tokens left of ``cs``."""
        if self._scan is None or self._scan[0] != cs:
            self._scan = (cs, self._noun(cs))
        return self._scan[1]

    def _noun(self, cs: int) -> tuple[int, int] | None:
        prep, kinds = 0, self.kinds
        for i in range(cs - 1, max(0, cs - 5), -1):
            k = kinds[i]
            if k == "i":
                prep = i
            elif prep:
                return (i, prep) if k == "N" else None
            elif k not in "JDd":
                return None
        return None

    def adjective(self, cs: int) -> tuple[int, int] | None:
        """The same of an adjective; other adjectives and determiners may stand between."""
        prep, kinds = 0, self.kinds
        for i in range(cs - 1, max(0, cs - 5), -1):
            k = kinds[i]
            if k == "i":
                prep = i
            elif k == "J":
                if prep:
                    return i, prep
            elif k not in "Dd":
                return None
        return None


class Lexer:
    """Documents' sentences. Each distinct word is cut and tagged once, its outcome kept, and all are forgotten beyond ``MOST``; words over
    ``LONGEST`` bytes are not kept, so that what is kept is bounded."""

    MOST, LONGEST = 1 << 17, 64

    def __init__(self, schema=None, retag: dict[str, str] | None = None):
        self.retag = retag or {}
        self.roles = [] if schema is None else [(1, schema.start), (2, schema.cont), (4, schema.end)]
        self.words: dict[bytes, tuple[tuple[Token, ...], bool]] = {}
        self.usual: dict[str, tuple[str, str, frozenset[str]]] = {}
        self.marks = {x: self._token(x) for x in ".,;:!?"}

    def _flag(self, tag: str, lc: str) -> str:
        return _FLAGS[sum(k for k, rules in self.roles if _admits(rules, tag, lc))]

    def _token(self, tok: str) -> Token:
        """Flag and kind are the tag's, but for the words that a rule for the tag names."""
        lc = tok.lower()
        tag = tag_of(tok, lc)
        tag = self.retag.get(tag, tag)
        if tag not in self.usual:
            named = frozenset([*AUXILIARY, ",", *(w for _, rules in self.roles for w in rules.get(tag, ("", ()))[1])])
            self.usual[tag] = (self._flag(tag, ""), _kind(tag, ""), named)
        flag, kind, named = self.usual[tag]
        return Token(tok, lc, tag, self._flag(tag, lc), _kind(tag, lc)) if lc in named else Token(tok, lc, tag, flag, kind)

    def _word(self, w: bytes) -> tuple[tuple[Token, ...], bool]:
        """A word between white space: a last punctuation mark is a token of its own, and some end the sentence."""
        said = w.decode("utf-8", "replace")
        last = said[-1]
        if last in ".,;:!?":
            mark = self.marks[last]
            made = ((self._token(said[:-1]), mark) if len(said) > 1 else (mark,), last in ".!?")
        else:
            made = ((self._token(said),), False)
        if len(w) <= self.LONGEST:
            if len(self.words) >= self.MOST:
                self.words.clear()
            self.words[w] = made
        return made

    def sentences(self, text: bytes) -> Iterator[Sentence]:
        """``sentences.document_sentences`` of one text, in UTF-8. Words of bytes are cut at ASCII white space only, as the patterns do."""
        known, make = self.words.get, self._word
        dirty = b"~" in text or b"\b" in text
        k = lead = 0
        for n, line in enumerate(text.split(b"\n")):
            if len(line) > MAX_LINE and len(line.decode("utf-8", "replace")) > MAX_LINE:
                continue
            own: list[Token] = []
            for w in (line.translate(None, b"~\b") if dirty else line).split():
                toks, ends = known(w) or make(w)
                own += toks
                if ends:
                    yield Sentence(own, k, n == 0, k - lead)
                    k, own = k + 1, []
            if own:
                yield Sentence(own, k, n == 0, k - lead)
                k += 1
            if n == 0:
                lead = k


# --- features: (sentence, cs, ce) to a value, None or empty where it doesn't hold -------------------------------------------------

PLAIN: dict[str, dict[str, Callable[[Sentence, int, int], str | None]]] = {COMMON: {}, "en": {}, "de": {}, "cn": {}}


def plain(name: str, language: str = COMMON):
    def add(f):
        PLAIN[language][name] = f
        return f

    return add


def features_of(language: str, names: list[str] | None = None) -> list[tuple[str, Callable]]:
    """(name=, function) of the features by the order of their names, as ``features.render`` has them."""
    known = {**PLAIN[COMMON], **PLAIN[language]}
    return sorted((f"{n}=", f) for n, f in known.items() if names is None or n in names)


plain("doc_loc")(lambda s, cs, ce: str(s.sent_id))
plain("sent_loc")(lambda s, cs, ce: f"{cs}-{ce}")
plain("section_loc")(lambda s, cs, ce: ("TITLE" if s.title else "DESC") + ("_later" if s.in_section else "_sent1"))
plain("prev_n2")(lambda s, cs, ce: "_".join(s.framed[cs + 1 : cs + 3]))
plain("prev_n3")(lambda s, cs, ce: "_".join(s.framed[cs : cs + 3]))
plain("next_n2")(lambda s, cs, ce: "_".join(s.framed[ce + 3 : ce + 5]))
plain("next_n3")(lambda s, cs, ce: "_".join(s.framed[ce + 3 : ce + 6]))
plain("next2_tags")(lambda s, cs, ce: "_".join(s.tags[ce : ce + 2]))
plain("last_word")(lambda s, cs, ce: s.lcs[ce - 1])
plain("suffix3")(lambda s, cs, ce: s.lcs[ce - 1][-3:] if len(s.lcs[ce - 1]) >= 6 else None)
plain("suffix4")(lambda s, cs, ce: s.lcs[ce - 1][-4:] if len(s.lcs[ce - 1]) >= 7 else None)
plain("suffix5")(lambda s, cs, ce: s.lcs[ce - 1][-5:] if len(s.lcs[ce - 1]) >= 8 else None)
plain("first_word")(lambda s, cs, ce: s.lcs[cs] if ce - cs > 1 else None)
plain("plen")(lambda s, cs, ce: str(ce - cs))
plain("tag_sig")(lambda s, cs, ce: "_".join(s.tags[cs:ce]))
plain("prev_V", "en")(lambda s, cs, ce: s.verb(cs))


@plain("prev_Npr", "en")
def _noun_prep(s, cs, ce):
    got = s.noun(cs)
    return got and f"{s.lcs[got[0]]}_{s.lcs[got[1]]}"


@plain("prev_VNP", "en")
def _verb_noun_prep(s, cs, ce):
    got = s.noun(cs)
    verb = got and s.verb(got[0])
    return verb and f"{verb}|{s.lcs[got[0]]}|{s.lcs[got[1]]}"


@plain("prev_Jpr", "en")
def _adjective_prep(s, cs, ce):
    got = s.adjective(cs)
    return got and f"{s.lcs[got[0]]}_{s.lcs[got[1]]}"


plain("prev_J", "en")(lambda s, cs, ce: s.lcs[cs - 1] if cs and s.kinds[cs - 1] == "J" else None)


def _nearest(s: Sentence, cs: int, stop: Callable[[str], bool], most: int | None = None) -> int:
    """The nearest place left of the chunk whose tag stops the scan, -1 if there is none; token 0 is never looked at."""
    for i in range(cs - 1, 0 if most is None else max(0, cs - 1 - most), -1):
        if stop(s.tags[i]):
            return i
    return -1


def _verb_before(s: Sentence, cs: int, verb: Callable[[str], bool]) -> str | None:
    i = _nearest(s, cs, lambda t: t[0] == "N" or verb(t))
    return s.lcs[i] if i > 0 and verb(s.tags[i]) else None


def _word_before(s: Sentence, cs: int, stop: Callable[[str], bool], most: int | None = None) -> str | None:
    i = _nearest(s, cs, stop, most)
    return s.lcs[i] if i > 0 else None


plain("prev_V", "de")(lambda s, cs, ce: _verb_before(s, cs, lambda t: t[0] == "V" and t != "VAINF"))
plain("prev_N", "de")(lambda s, cs, ce: _word_before(s, cs, lambda t: t[0] == "N", 3))
plain("chunk_lead_J", "de")(lambda s, cs, ce: s.lcs[cs] if s.tags[cs] == "ADJA" else None)
plain("initial_J", "de")(lambda s, cs, ce: s.lcs[cs] if s.tags[cs] == "ADJA" else None)
plain("initial_V", "de")(lambda s, cs, ce: s.lcs[cs] if s.tags[cs][0] == "V" else None)
plain("prev_J", "de")(lambda s, cs, ce: s.lcs[cs - 1] if cs and s.tags[cs - 1] == "ADJA" else None)
plain("following_prep", "de")(lambda s, cs, ce: s.lcs[ce] if ce < len(s.tags) and s.tags[ce] == "IN" else None)


@plain("von_head", "de")
def _von_head(s, cs, ce):
    own = s.tags[cs:ce]
    at = own.index("APPR") if "APPR" in own else 0
    return s.lcs[cs + at - 1] if at else None


plain("prev_V", "cn")(lambda s, cs, ce: _verb_before(s, cs, lambda t: t[0] == "V"))
plain("prev_N", "cn")(lambda s, cs, ce: _word_before(s, cs, lambda t: t == "NN", 3))
plain("prev_DT", "cn")(lambda s, cs, ce: _word_before(s, cs, lambda t: t == "DT"))


def _chinese_adjectives(s: Sentence, cs: int, ce: int) -> list[str]:
    return [s.lcs[i] for i in range(cs, ce) if s.tags[i] in ("JJ", "VA")]


plain("first_Adj", "cn")(lambda s, cs, ce: (_chinese_adjectives(s, cs, ce) or [None])[0])
plain("prev_J", "cn")(lambda s, cs, ce: (_chinese_adjectives(s, cs, ce) or [None])[-1])


@plain("prev_CD_M", "cn")
def _measure_word(s, cs, ce):
    i = _nearest(s, cs, lambda t: t == "M")
    return None if i < 1 else s.lcs[i] if i == 1 else f"{s.lcs[i - 1]}_{s.lcs[i]}"
