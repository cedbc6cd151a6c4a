"""Mixing sources to target weights by a time-varying curriculum.

Sources in code-point order (null last) weigh 1, 2, 3, repeating, and share all words; a target stops at
``max_epochs`` times its source's words, what is left is shared anew by weight (water filling, closed form over
the sources ordered by cap / weight).

Each source has a weight schedule over training time t in [0, 1], w(t) = 1 + g (2 t - 1) with slope g; its integral
t + g (t * t - t) is the share of the source's target that training has asked for by t. A document that starts
at cumulative word c of its source's stream is due when the demand reaches c: t is the root of
g t^2 + (1 - g) t = c / target. Sorting by t (range partitions) gives the training order.

A document is taken whole: its copies are the full passes over its source's stream, and one more if its middle lies inside what is
left of the target. Every copy has its own position, later passes later ones.

The stream order inside a source is that of the md5 of id and text. Cumulative words come in two levels, sums of
md5 buckets and a window inside each (source, bucket), so one source with a third of all rows is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.common import Carried, word_count
from termloom.runtime import table

MAX_EPOCHS = 3
#: Slope of the weight schedule for weights 1, 2, 3: from early to late in training.
SLOPES = (-0.5, 0.0, 0.5)
ADDED = ("size", "source_size", "target", "taken", "copies", "positions")


def _sources(sums: DataFrame, epochs: int) -> DataFrame:
    """A row for each source: its words, weight class, target. All sources meet in one task, a row each, whatever their size."""
    totals = sums.groupBy("_src", "source").agg(F.sum("_sum").alias("source_size"))
    ranked = totals.withColumn("w", ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1).cast("long"))
    by_ratio = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(0))
    cap = F.col("source_size") * epochs
    levels = (
        ranked.withColumn("all_words", F.sum("source_size").over(every))
        .withColumn("left_words", F.col("all_words") - (F.sum(cap).over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) - cap))
        .withColumn("left_w", F.sum("w").over(every) - (F.sum("w").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) - F.col("w")))
    )
    level = F.col("left_words") / F.col("left_w")
    fits = F.col("left_words") * F.col("w") <= cap * F.col("left_w")
    filled = levels.withColumn("level", F.max(F.when(fits, level)).over(every))
    return filled.select(
        "_src",
        "source_size",
        F.least(cap.cast("double"), F.col("level") * F.col("w")).alias("target"),
        F.element_at(F.array(*map(F.lit, SLOPES)), F.col("w").cast("int")).alias("_slope"),
    )


def plan_mix(docs: DataFrame, epochs: int = MAX_EPOCHS) -> DataFrame:
    """Every row with ``size``, ``source_size``, ``target``, ``copies`` (whole documents that the mix takes), ``taken`` (their
    words, size times copies) and ``positions`` (training time of each copy, ascending; empty if none).

    A source's taken words are within half a document of its target. Null text has size 0, null source is a source, null ids are
    ordered by text. Rows equal in id and text may swap results. An empty table gives an empty table. Extra columns pass through,
    those with a result's name give way to it.
    """
    carried = Carried(docs, "doc_id", "source", "text")
    return carried.back(_planned(carried.frame, epochs), *ADDED)


def _planned(docs: DataFrame, epochs: int) -> DataFrame:
    keyed = (
        docs.withColumn("_size", word_count(F.col("text")))
        .withColumn("_src", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null")))
        .withColumn(
            "_key",
            F.md5(F.concat_ws("\x01", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce(F.col("text"), F.lit(""))).cast("binary")),
        )
        .withColumn("_bucket", F.substring("_key", 1, 3))
    )
    sums = keyed.groupBy("_src", "source", "_bucket").agg(F.sum("_size").alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy("_src").orderBy("_bucket")) - F.col("_sum")
    starts = sums.select("_src", "_bucket", before.alias("_before")).join(_sources(sums, epochs), "_src")
    inside = Window.partitionBy("_src", "_bucket").orderBy("_key")
    placed = keyed.join(starts, ["_src", "_bucket"]).withColumn(
        "_before", F.col("_before") + F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size")
    )
    goal = F.round("target").cast("long")
    full = F.when(F.col("source_size") > 0, F.call_function("div", goal, F.col("source_size"))).otherwise(F.lit(1).cast("long"))
    rest = goal - full * F.col("source_size")
    inside_rest = (2 * F.col("_before") + F.col("_size") < 2 * rest).cast("long")
    at = [due(F.col("_before") + k * F.col("source_size"), F.col("target"), F.col("_slope")) for k in range(epochs)]
    return (
        placed.withColumn("copies", (full + inside_rest).cast("int"))
        .withColumn("taken", F.col("copies") * F.col("_size"))
        .withColumn("positions", F.slice(F.array(*at), F.lit(1), F.col("copies")))
        .withColumnRenamed("_size", "size")
        .drop("_src", "_bucket", "_sum")
    )


def due(words: Column, target: Column, slope: Column) -> Column:
    """The time at which the integrated schedule has asked for ``words`` of ``target``."""
    u = F.when(target > 0, F.least(F.lit(1.0), words / target)).otherwise(F.lit(0.0))
    lead = F.lit(1.0) - slope
    return F.when(slope == 0, u).otherwise(F.abs((F.sqrt(lead * lead + F.lit(4.0) * slope * u) - lead) / (F.lit(2.0) * slope)))


def mix(docs: DataFrame, epochs: int = MAX_EPOCHS) -> DataFrame:
    """The training set: a row for each whole copy, the input's columns only, range-sorted by training time.

    Ties in time are ordered by the md5 of id and text and by pass, so the order is one and the same on every run, up to rows equal
    in id and text. Written files hold it: file by file, row by row (see ``sharding.in_file_order``).
    """
    carried = Carried(docs, "doc_id", "source", "text")
    copies = _planned(carried.frame, epochs).select(*carried.held, "_key", F.posexplode("positions").alias("_pass", "_at"))
    return carried.back(copies.orderBy("_at", "_key", "_pass"))


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    """Every document of the table with what the mix takes of it, and the training times of its copies; in order of the first
    (documents not taken last)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    time = {"position" + ("" if k == 0 else f"_{k + 1}"): F.get("positions", F.lit(k)) for k in range(MAX_EPOCHS)}
    return (
        plan_mix(docs)
        .select("doc_id", "size", "source_size", "target", "taken", "copies", *(t.alias(n) for n, t in time.items()))
        .orderBy(F.col("position").asc_nulls_last(), "doc_id")
    )


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || chr(1) || coalesce(text, '')) AS k
  FROM documents
), s0 AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS ss, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM d GROUP BY source
), s1 AS (
  SELECT *, sum(ss) OVER () - (sum(3 * ss) OVER o - 3 * ss) AS lw, sum(w) OVER () - (sum(w) OVER o - w) AS ww
  FROM s0 WINDOW o AS (ORDER BY ss / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), s2 AS (
  SELECT *, max(CASE WHEN lw * w <= 3 * ss * ww THEN CAST(lw AS DOUBLE) / CAST(ww AS DOUBLE) END) OVER () AS level FROM s1
), s AS (
  SELECT source, ss, least(CAST(3 * ss AS DOUBLE), level * w) AS target,
         CASE w WHEN 1 THEN -0.5::DOUBLE WHEN 2 THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS g FROM s2
), p AS (
  SELECT d.*, s.ss, s.target, s.g, CAST(round(s.target) AS BIGINT) AS goal,
         CAST(sum(size) OVER (PARTITION BY d.source ORDER BY k ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS b
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source
), q AS (
  SELECT *, CASE WHEN ss > 0 THEN goal // ss ELSE 1 END AS e FROM p
), r AS (
  SELECT *, CAST(e + CASE WHEN 2 * b + size < 2 * (goal - e * ss) THEN 1 ELSE 0 END AS INT) AS copies FROM q
), u AS (
  SELECT *, list_transform([0, 1, 2], lambda k: CASE WHEN target > 0 THEN least(1.0::DOUBLE, (b + k * ss) / target) ELSE 0.0::DOUBLE END) AS us FROM r
), t AS (
  SELECT *, list_transform(us, lambda x: CASE WHEN g = 0 THEN x
    ELSE abs((sqrt((1.0::DOUBLE - g) * (1.0::DOUBLE - g) + 4.0::DOUBLE * g * x) - (1.0::DOUBLE - g)) / (2.0::DOUBLE * g)) END) AS ts FROM u
)
SELECT doc_id, CAST(size AS BIGINT) AS size, ss AS source_size, target, CAST(copies * size AS BIGINT) AS taken, copies,
       CASE WHEN copies > 0 THEN ts[1] END AS position, CASE WHEN copies > 1 THEN ts[2] END AS position_2, CASE WHEN copies > 2 THEN ts[3] END AS position_3
FROM t
"""
