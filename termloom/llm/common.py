"""What the operators of this subpackage share: splits, word counts, row keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One word: a run of anything but ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"


def held_out(doc_id: Column, modulus: int, remainder: int = 2) -> Column:
    """crc32 of the id's decimal text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def word_count(text: Column) -> Column:
    """Words of a text as a long; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(*cols: Column) -> Column:
    """A 256-bit key of the given columns, null distinct from any value."""
    parts = [F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n")) for c in cols]
    lengths = [F.length(p).cast("string") for p in parts]
    return F.sha2(F.concat_ws("\x01", *lengths, *parts), 256)


#: A key with more than one of so many rows is hot: there are fewer hot keys than this, whatever the table.
HOT = 256


def hot_keys(counts: DataFrame, key: str, total: int) -> list:
    """Keys that hold more than 1 / HOT of ``total`` rows, from ``counts`` (key, _n); fewer than HOT."""
    return [r[key] for r in counts.where(F.col("_n") * HOT > total).select(key).collect()]


def meet(rows: DataFrame, values: DataFrame, key: str, hot: list) -> DataFrame:
    """Join ``rows`` with ``values``, which has each key once. The rows of a hot key are dealt over all tasks, by the hash of
    their columns and of the task that they come from; its one value goes to each."""
    if not hot:
        return rows.join(values, key)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    none, is_hot = F.lit(0).cast("long"), F.col(key).isin(hot)
    salt = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in rows.columns), F.spark_partition_id()), F.lit(tasks))
    dealt = rows.withColumn("_salt", F.when(is_hot, salt).otherwise(none))
    each = values.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(none, F.lit(tasks - 1).cast("long"))).otherwise(F.array(none))))
    return dealt.join(each, [key, "_salt"]).drop("_salt")


class Carried:
    """A frame's columns under names that clash with nothing, beside those an operator reads, and the way back.

    ``frame`` has the columns ``read`` under their own names and every input column as ``_c0``, ``_c1``, ...; of input columns
    that share a name (in any case) the first is read. ``back`` gives the input's columns their names again, in order, and adds
    the results; an input column with a result's name gives way to it.
    """

    def __init__(self, docs: DataFrame, *read: str):
        self.names = docs.columns
        self.held = [f"_c{i}" for i in range(len(self.names))]
        lower = [n.lower() for n in self.names]
        self.frame = docs.toDF(*self.held).select(*self.held, *(F.col(self.held[lower.index(r)]).alias(r) for r in read))

    def kept(self, *results: str) -> list[Column]:
        """The input's columns but for those that results replace."""
        gone = {r.lower() for r in results}
        return [F.col(h).alias(n) for h, n in zip(self.held, self.names, strict=True) if n.lower() not in gone]

    def back(self, made: DataFrame, *results: str) -> DataFrame:
        return made.select(*self.kept(*results), *results)
