"""Contextual features of a chunk: a registry of column builders over a sentence's tokens and the chunk's span.

A feature is a function (toks, cs, ce, ctx) -> string column, null where it doesn't hold. ``toks`` is
array<struct<tok, lc, tag>>; cs and ce are 0-based and half-open. Scans to the left never look at token 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

COMMON = "*"
REGISTRY: dict[str, dict[str, Callable[..., Column]]] = {COMMON: {}, "en": {}, "de": {}, "cn": {}}


def feature(name: str, *languages: str):
    """Register a feature for the languages, or for all."""

    def add(f: Callable[..., Column]) -> Callable[..., Column]:
        for lang in languages or (COMMON,):
            REGISTRY[lang][name] = f
        return f

    return add


def features_of(language: str) -> dict[str, Callable[..., Column]]:
    """All common features and the language's own."""
    if language not in REGISTRY:
        raise ValueError(f"no features for language {language!r}")
    return {**REGISTRY[COMMON], **REGISTRY[language]}


def _at(toks: Column, i: Column) -> Column:
    return F.get(toks, i)


def _some(value: Column) -> Column:
    """Null for the empty string."""
    return F.when(value != "", value)


def _left(toks: Column, cs: Column, most: int) -> Column:
    """The ``most`` tokens left of the chunk, nearest first, each with its index; null ones stand for token 0 and what is before it."""
    at = [cs - k for k in range(1, most + 1)]
    return F.array(*(F.struct(i.cast("int").alias("i"), F.when(i >= 1, _at(toks, i)).alias("t")) for i in at))


def _before(toks: Column, cs: Column) -> Column:
    """All tokens left of the chunk but token 0, nearest first."""
    return F.reverse(F.slice(toks, F.lit(2), F.greatest(cs - 1, F.lit(0))))


def _is(tag: Column, *starts: str) -> Column:
    out = F.lit(False)
    for s in starts:
        out = out | tag.startswith(s)
    return out


def _prep(t: Column) -> Column:
    return t["tag"].isin("RP", "IN", "TO")


@feature("doc_loc")
def doc_loc(toks, cs, ce, ctx):
    return ctx["sent_id"].cast("string")


@feature("sent_loc")
def sent_loc(toks, cs, ce, ctx):
    return F.concat_ws("-", cs.cast("string"), ce.cast("string"))


@feature("section_loc")
def section_loc(toks, cs, ce, ctx):
    return F.concat(ctx["section"], F.when(ctx["sent_in_section"] == 0, "_sent1").otherwise("_later"))


def _window(toks: Column, lo: Column, n: int) -> Column:
    """``n`` tokens from ``lo`` on, ^ for those outside the sentence."""
    return F.concat_ws("_", *(F.coalesce(_at(toks, lo + k)["lc"], F.lit("^")) for k in range(n)))


for _n in (2, 3):
    feature(f"prev_n{_n}")(lambda toks, cs, ce, ctx, n=_n: _window(toks, cs - n, n))
    feature(f"next_n{_n}")(lambda toks, cs, ce, ctx, n=_n: _window(toks, ce, n))


@feature("next2_tags")
def next2_tags(toks, cs, ce, ctx):
    return _some(F.concat_ws("_", _at(toks, ce)["tag"], _at(toks, ce + 1)["tag"]))


@feature("last_word")
def last_word(toks, cs, ce, ctx):
    return _at(toks, ce - 1)["lc"]


for _n in (3, 4, 5):
    feature(f"suffix{_n}")(
        lambda toks, cs, ce, ctx, n=_n: F.when(F.length(_at(toks, ce - 1)["lc"]) >= n + 3, F.right(_at(toks, ce - 1)["lc"], F.lit(n)))
    )


@feature("first_word")
def first_word(toks, cs, ce, ctx):
    return F.when(ce - cs > 1, _at(toks, cs)["lc"])


@feature("plen")
def plen(toks, cs, ce, ctx):
    return (ce - cs).cast("string")


@feature("tag_sig")
def tag_sig(toks, cs, ce, ctx):
    return F.array_join(_inside(toks, cs, ce)["tag"], "_")


AUXILIARY = ("be", "is", "are", "was", "were", "been", "being", "am", "has", "have", "had", "having")


def _scan(steps: Column, step: Callable[[Column, Column], Column], **start: str) -> Column:
    """Fold from the nearest token on until the state's ``done`` is set."""
    begin = F.struct(*(F.lit(v).alias(k) for k, v in start.items()), F.lit(False).alias("done"))
    return F.aggregate(steps, begin, lambda a, x: F.when(a["done"], a).otherwise(step(a, x)))


def governing_verbs(toks: Column) -> Column:
    """array<string>: at each index the governing verb, with up to two prepositions, of a chunk that begins there.

    The scan from a chunk to the left takes the first verb that no rule blocks; nouns end it, and adjectives and commas do once it
    holds a preposition. Here one fold from left to right has the answer for every index: a verb sets it, a noun clears it, a preposition joins
    it, and clears it where an adjective or comma stands since the verb. Token 0 is never looked at, but it may block token 1.
    """
    kind = F.transform(
        toks,
        lambda t, i: F.struct(
            t["lc"].alias("lc"),
            F.when(i == 0, 0)
            .when(t["tag"].isin("VBG", "VBP", "VBZ", "VB"), 1)
            .when(t["tag"].isin("VBD", "VBN"), F.when(_blocks(_at(toks, i - 1)), 0).otherwise(1))
            .when(t["tag"].startswith("N"), 2)
            .when(t["tag"].startswith("J"), 3)
            .when(t["tag"].isin("RP", "IN", "TO"), 4)
            .when(t["lc"] == ",", 3)
            .otherwise(0)
            .alias("k"),
        ),
    )
    none = F.lit(None).cast("string")
    state = lambda v, n, weak, out: F.struct(v.alias("v"), n.alias("n"), weak.alias("weak"), out.alias("out"))

    def step(a: Column, t: Column) -> Column:
        k, v, n = t["k"], a["v"], a["n"]
        joined = F.when(v.isNull() | a["weak"], none).when(n < 2, F.concat_ws("_", v, t["lc"])).otherwise(v)
        return state(
            F.when(k == 0, v).when(k == 1, t["lc"]).when(k == 2, none).when(k == 4, joined).otherwise(v),
            F.when(k == 1, 0).when(k == 4, n + 1).otherwise(n),
            F.when(k == 1, False).otherwise(a["weak"] | (k == 3)),
            F.concat(a["out"], F.array(v)),
        )

    empty = F.expr("cast(array() as array<string>)")
    return F.aggregate(kind, state(none, F.lit(0), F.lit(False), empty), step, lambda a: a["out"])


def _blocks(before: Column) -> Column:
    """Whether a token keeps a participle after it from being a verb of its own."""
    return F.coalesce((before["tag"] == "DT") | (before["tag"].startswith("V") & ~before["lc"].isin(*AUXILIARY)), F.lit(False))


def _verb_at(toks: Column, at: Column, ctx) -> Column:
    """The governing verb of a chunk that begins at ``at``: from the sentence's ``verbs`` where the context has them."""
    verbs = ctx["verbs"] if "verbs" in ctx else governing_verbs(toks)
    return F.get(verbs, at)


@feature("prev_V", "en")
def prev_verb(toks, cs, ce, ctx):
    return _verb_at(toks, cs, ctx)


def _noun_scan(toks: Column, cs: Column) -> Column:
    """struct(noun, prep, at, done): a preposition and the noun before it, within four tokens."""

    def step(a, x):
        t = x["t"]
        keep = lambda noun, prep, at, done: F.struct(noun.alias("noun"), prep.alias("prep"), at.cast("string").alias("at"), F.lit(done).alias("done"))
        has = a["prep"] != ""
        return (
            F.when(_prep(t), keep(a["noun"], t["lc"], a["at"], False))
            .when(t["tag"].startswith("N") & has, keep(t["lc"], a["prep"], x["i"], True))
            .when(_is(t["tag"], "J", "D") & ~has, a)
            .otherwise(keep(a["noun"], a["prep"], a["at"], True))
        )

    return _scan(_left(toks, cs, 4), step, noun="", prep="", at="")


@feature("prev_Npr", "en")
def prev_noun_prep(toks, cs, ce, ctx):
    s = _noun_scan(toks, cs)
    return F.when(s["noun"] != "", F.concat_ws("_", s["noun"], s["prep"]))


@feature("prev_VNP", "en")
def prev_verb_noun_prep(toks, cs, ce, ctx):
    s = _noun_scan(toks, cs)
    verb = _verb_at(toks, F.coalesce(s["at"].try_cast("int"), F.lit(0)), ctx)
    return F.when((s["noun"] != "") & verb.isNotNull(), F.concat_ws("|", verb, s["noun"], s["prep"]))


@feature("prev_Jpr", "en")
def prev_adjective_prep(toks, cs, ce, ctx):
    def step(a, x):
        t = x["t"]
        keep = lambda adj, prep, done: F.struct(adj.alias("adj"), prep.alias("prep"), F.lit(done).alias("done"))
        return (
            F.when(_prep(t), keep(a["adj"], t["lc"], False))
            .when(t["tag"].startswith("J") & (a["prep"] != ""), keep(t["lc"], a["prep"], True))
            .when(_is(t["tag"], "J", "D"), a)
            .otherwise(keep(a["adj"], a["prep"], True))
        )

    s = _scan(_left(toks, cs, 4), step, adj="", prep="")
    return F.when(s["adj"] != "", F.concat_ws("_", s["adj"], s["prep"]))


@feature("prev_J", "en")
def prev_adjective(toks, cs, ce, ctx):
    before = F.when(cs > 0, _at(toks, F.greatest(cs - 1, F.lit(0))))
    return F.when(before["tag"].startswith("J"), before["lc"])


def _nearest(toks: Column, cs: Column, most: int | None, stop: Callable[[Column], Column], take: Callable[[Column], Column]) -> Column:
    """The nearest token left of the chunk at which ``stop`` holds, if ``take`` does too."""
    left = _before(toks, cs) if most is None else F.slice(_before(toks, cs), 1, most)
    first = F.get(F.filter(left, stop), F.lit(0))
    return F.when(take(first), first["lc"])


def _inside(toks: Column, cs: Column, ce: Column) -> Column:
    return F.slice(toks, cs + 1, ce - cs)


@feature("prev_V", "de")
def german_verb(toks, cs, ce, ctx):
    verb = lambda t: t["tag"].startswith("V") & (t["tag"] != "VAINF")
    return _nearest(toks, cs, None, lambda t: verb(t) | t["tag"].startswith("N"), verb)


@feature("prev_N", "de")
def german_noun(toks, cs, ce, ctx):
    noun = lambda t: t["tag"].startswith("N")
    return _nearest(toks, cs, 3, noun, noun)


def _initial(toks, cs, wanted: Callable[[Column], Column]) -> Column:
    first = _at(toks, cs)
    return F.when(wanted(first["tag"]), first["lc"])


feature("chunk_lead_J", "de")(lambda toks, cs, ce, ctx: _initial(toks, cs, lambda t: t == "ADJA"))
feature("initial_J", "de")(lambda toks, cs, ce, ctx: _initial(toks, cs, lambda t: t == "ADJA"))
feature("initial_V", "de")(lambda toks, cs, ce, ctx: _initial(toks, cs, lambda t: t.startswith("V")))


@feature("von_head", "de")
def von_head(toks, cs, ce, ctx):
    own = _inside(toks, cs, ce)
    at = F.array_position(F.transform(own, lambda t: t["tag"]), "APPR").cast("int")
    return F.when(at > 1, F.get(own, at - 2)["lc"])


@feature("prev_J", "de")
def german_adjective(toks, cs, ce, ctx):
    before = F.when(cs > 0, _at(toks, F.greatest(cs - 1, F.lit(0))))
    return F.when(before["tag"] == "ADJA", before["lc"])


@feature("following_prep", "de")
def following_prep(toks, cs, ce, ctx):
    after = _at(toks, ce)
    return F.when(after["tag"] == "IN", after["lc"])


@feature("prev_N", "cn")
def chinese_noun(toks, cs, ce, ctx):
    noun = lambda t: t["tag"] == "NN"
    return _nearest(toks, cs, 3, noun, noun)


@feature("prev_V", "cn")
def chinese_verb(toks, cs, ce, ctx):
    return _nearest(toks, cs, None, lambda t: _is(t["tag"], "V", "N"), lambda t: t["tag"].startswith("V"))


def _adjectives(toks, cs, ce):
    return F.filter(_inside(toks, cs, ce), lambda t: t["tag"].isin("JJ", "VA"))


feature("first_Adj", "cn")(lambda toks, cs, ce, ctx: F.get(_adjectives(toks, cs, ce), F.lit(0))["lc"])
#: The last adjective of a Chinese chunk goes by the name prev_J.
feature("prev_J", "cn")(lambda toks, cs, ce, ctx: F.get(F.reverse(_adjectives(toks, cs, ce)), F.lit(0))["lc"])


@feature("prev_CD_M", "cn")
def measure_word(toks, cs, ce, ctx):
    at = cs - F.array_position(_before(toks, cs)["tag"], "M").cast("int")  # cs itself if there is none
    word = F.when(at < cs, _at(toks, at)["lc"])
    return F.when(at > 1, F.concat_ws(" ", F.when(at < cs, _at(toks, at - 1)["lc"]), word)).otherwise(word)


@feature("prev_DT", "cn")
def determiner(toks, cs, ce, ctx):
    dt = lambda t: t["tag"] == "DT"
    return _nearest(toks, cs, None, dt, dt)


def render(language: str, toks: Column, cs: Column, ce: Column, ctx: dict[str, Column], names: list[str] | None = None) -> Column:
    """Sorted array of name=value, spaces in values as underscores; features without a value are left out."""
    chosen = {n: f for n, f in features_of(language).items() if names is None or n in names}
    made = [F.concat(F.lit(n + "="), F.replace(_some(f(toks, cs, ce, ctx)), F.lit(" "), F.lit("_"))) for n, f in chosen.items()]
    return F.array_except(F.sort_array(F.array(*made)), F.array(F.lit(None).cast("string")))
