"""Chinese text on its way to a word segmenter: lines are gathered, cut into sentences, and given to a provider in batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions import text

LONGEST = 500


def gathered(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, line_no, part, line, is_prose) from (key, line_no, line).

    Neighbouring lines of prose are one passage, cut after full stops; sentences of more than ``LONGEST`` characters go. Headers, end
    marks and Latin-1 lines end a passage and stay as they are, skippable lines end it and go, blank ones go without ending it.
    """
    line = text.han_line(F.col("line"))
    kept = lines.withColumn("line", line).where("line <> ''")
    as_is = F.col("line").startswith("FH_") | (F.col("line") == "END")
    drop = ~as_is & text.is_skippable(F.col("line"))
    as_is = as_is | text.is_latin1(F.col("line"))
    marked = kept.withColumn("_stop", (as_is | drop).cast("int")).withColumn("_drop", drop)
    order = Window.partitionBy(key).orderBy("line_no")
    islands = marked.withColumn("_g", F.sum("_stop").over(order)).where("NOT _drop")
    whole = islands.groupBy(key, "_g", "_stop").agg(F.min("line_no").alias("line_no"), F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("_l"))
    passage = F.array_join(F.transform("_l", lambda x: x["line"]), " ")
    prose = F.col("_stop") == 0
    parts = F.when(prose, F.filter(text.split_han(passage), lambda s: F.length(s) <= LONGEST)).otherwise(F.array(passage))
    return whole.select(key, "line_no", prose.alias("is_prose"), F.posexplode(parts).alias("part", "line")).select(key, "line_no", "part", "line", "is_prose")


def segmented(sentences: DataFrame, start: Callable[[], Callable[[list[str]], list[str]]]) -> DataFrame:
    """Give prose to a user's segmenter, started once a partition; a line it fails on keeps its text and has the message in ``error``."""
    columns = sentences.columns
    schema = ", ".join([*(f"`{c}` {t}" for c, t in sentences.dtypes), "error string"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        segmenter = start()
        for b in batches:
            done, errors = [], []
            for line, prose in zip(b["line"], b["is_prose"], strict=True):
                try:
                    done.append(segmenter([line])[0] if prose and not all(ord(c) < 256 for c in line) else line)
                    errors.append(None)
                except Exception as e:  # one bad line must not end the job
                    done.append(line)
                    errors.append(repr(e))
            yield b[columns].assign(line=done, error=errors)

    return sentences.mapInPandas(run, schema)


def by_character() -> Callable[[list[str]], list[str]]:
    """The least provider: every character is a word."""
    return lambda lines: [" ".join(line) for line in lines]
