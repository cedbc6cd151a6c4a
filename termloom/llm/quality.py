"""Quality rules by weak supervision: rules vote good (1), bad (-1) or abstain (0); expectation-maximisation over the
counted vote patterns of the texts that pass the base estimates each rule's accuracy; the posterior probability of good text decides.

All row work is built-in expressions on one text at a time, so nothing but the pattern counts is shuffled: at most
3 ** 8 patterns, whatever the input, reach the driver, where EM runs on them in plain Python; the posteriors go back as
a table of the same bound.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import Carried
from termloom.runtime import settle, table

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
THRESHOLD = 0.5
#: name -> (votes good if, votes bad if); where neither holds a rule abstains.
RULES = {
    "word_length": ("word_chars BETWEEN 2 * n_words AND 12 * n_words", "word_chars > 25 * n_words"),
    "symbols": ("50 * n_symbols < n_words", "4 * n_symbols > n_words"),
    "repeat_words": ("20 * n_repeat_words <= n_words", "5 * n_repeat_words > n_words"),
    "dup_lines": ("n_dup_lines = 0", "n_lines > 3 AND 2 * n_dup_lines > n_lines"),
    "symbol_words": ("20 * n_symbol_words < n_words", "5 * n_symbol_words > n_words"),
    "letters": ("10 * n_other <= 2 * word_chars", "4 * n_other > word_chars AND n_words > 30"),
    "sentences": ("n_stops > 0 AND 80 * n_stops >= n_words", "n_stops = 0 AND n_words > 200"),
    "digits": ("20 * n_digits < word_chars", "2 * n_digits > word_chars"),
}
MEASURED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_other", "n_digits", "n_stops", "n_symbol_words")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
ADDED = (*BASE, "quality", "n_lines", "n_other", "n_digits", "n_stops", "n_symbol_words", *(f"vote_{r}" for r in RULES))


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, evaluated once: the one element of an array is bound to a lambda's variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words inside windows of five that occur twice or more in the text, the first included.

    Windows are hashed to 64 bits. If none is equal to another, that is all; else they are sorted with their places, equal
    neighbours are repeats, and their places, sorted, cover five words each, less what the next one covers too.
    n log n for any text.
    """

    def places(h: Column) -> Column:
        g = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twins(g: Column) -> Column:
            same = lambda i, j: F.coalesce(F.get(g, i)["h"] == F.get(g, j)["h"], F.lit(False))
            return F.filter(g, lambda x, k: same(k, k + 1) | ((k > 0) & same(k, F.greatest(k - 1, F.lit(0)))))

        return F.array_sort(F.transform(_let(g, twins), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        gap = lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))
        return F.aggregate(F.transform(p, gap), F.lit(0), lambda a, x: a + x)

    def counted(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) < F.size(h), _let(places(h), covered)).otherwise(F.lit(0))

    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW))))

    return F.when(F.size(words) > WINDOW, _let(hashes(words), counted)).otherwise(F.lit(0)).cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """Add the base columns and the counts that the rules read."""
    text = F.coalesce(F.col("text"), F.lit(""))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    split = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+", -1), "")
    per_text = _let(
        split,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
        ),
    )
    per_line = _let(
        lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    )
    return (
        docs.withColumn("_words", per_text)
        .withColumn("_text", per_line)
        .withColumns(
            {
                "n_symbols": count("[#*$%&|<>]"),
                "n_symbol_words": count("[#*$%&|<>][^\\x20\\x09-\\x0D]*"),
                "n_other": count("[^\\p{L}\\x20\\x09-\\x0D]"),
                "n_digits": count("[0-9]"),
                "n_stops": count("[.!?。]"),
            }
        )
        .select("*", "_words.*", "_text.*")
        .drop("_words", "_text")
    )


def votes(measured: DataFrame) -> DataFrame:
    vote = lambda good, bad: F.when(F.expr(bad), F.lit(-1)).when(F.expr(good), F.lit(1)).otherwise(F.lit(0)).cast("int")
    return measured.withColumns({f"vote_{name}": vote(*rule) for name, rule in RULES.items()})


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> tuple[float, list[tuple[float, float]]]:
    """EM for independent rules: the share of good texts, and each rule's two accuracies where it votes: how often it votes
    good on good texts and bad on bad texts.

    It starts from "a text without bad votes is good". Rules are taken to be better than chance, which fixes what
    the latent class means; ten pseudo-votes at 0.98 and at 0.4 smooth the accuracies, ten texts the share.
    """
    m = len(RULES)
    guess = [(0.998 if min(vote) >= 0 else 0.02) for vote, _ in patterns]
    share, right = 0.9, [(0.98, 0.4)] * m
    for _ in range(rounds):
        total = sum(n for _, n in patterns)
        share = (sum(n * p for (_, n), p in zip(patterns, guess, strict=True)) + 9) / (total + 10)
        share = min(0.98, max(0.5, share))
        for j in range(m):
            on_good, on_bad, good, bad = 9.8, 4.0, 10.0, 10.0
            for (vote, n), p in zip(patterns, guess, strict=True):
                if vote[j]:
                    good, bad = good + n * p, bad + n * (1 - p)
                    on_good += n * p * (vote[j] > 0)
                    on_bad += n * (1 - p) * (vote[j] < 0)
            on_good = min(0.998, max(0.6, on_good / good))
            right[j] = (on_good, min(0.95, max(1.02 - on_good, on_bad / bad)))
        guess = [posterior(vote, share, right) for vote, _ in patterns]
    return share, right


def posterior(vote: tuple[int, ...], share: float, right: list[tuple[float, float]]) -> float:
    """Probability that a text with these votes is good; an abstention says nothing."""
    odds = math.log(share / (1 - share))
    for v, (on_good, on_bad) in zip(vote, right, strict=True):
        if v > 0:
            odds += math.log(on_good / (1 - on_bad))
        elif v < 0:
            odds += math.log((1 - on_good) / on_bad)
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


def judge_quality(docs: DataFrame, threshold: float = THRESHOLD, carry_text: bool = True) -> DataFrame:
    """Add the base columns, the rules' votes, ``quality`` (the posterior) and ``kept`` to every row.

    ``quality`` is null where the base failed and no passing text has the same votes. Null and empty texts have no words
    and fail the base. An empty table gives an empty table. Rows equal in text are equal in result. Extra columns pass
    through, those with a result's name give way to it. The measured rows are settled, without ``text`` unless it is carried.
    """
    carried = Carried(docs, "text")
    if not carry_text:
        kept = [n.lower() != "text" for n in carried.names]
        carried.held = [h for h, k in zip(carried.held, kept, strict=True) if k]
        carried.names = [n for n, k in zip(carried.names, kept, strict=True) if k]
    names = [f"vote_{r}" for r in RULES]
    measured = measure(carried.frame).select(*carried.held, *(c for c in MEASURED))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    voted = settle(votes(measured).withColumn("base_failed", failed), "measured")
    counted = voted.where("NOT base_failed").groupBy(*names).count().collect()  # at most 3 ** 8 rows
    share, right = fit([(tuple(r[n] for n in names), r["count"]) for r in counted])
    rows = [(*(r[n] for n in names), posterior(tuple(r[n] for n in names), share, right)) for r in counted]
    values = ", ".join(f"({', '.join(map(str, r[:-1]))}, {r[-1]!r}D)" for r in rows)
    of = f"VALUES {values}" if rows else f"SELECT {', '.join(['0'] * len(names))}, 0D WHERE false"
    verdicts = docs.sparkSession.sql(of).toDF(*names, "quality")
    judged = voted.join(F.broadcast(verdicts), names, "left").withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("quality") >= threshold, F.lit(False))
    )
    return carried.back(judged, *ADDED)


def op10_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_quality(docs, carry_text=False).select("doc_id", *BASE, "quality")
