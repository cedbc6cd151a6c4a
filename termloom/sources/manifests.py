"""Corpus manifests: lines of year, source and target, tab-separated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.runtime import sorted_side


def read(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value) of a manifest file; a manifest is one small file, so its lines keep the order of one partition."""
    return spark.read.text(path, wholetext=True).select(F.posexplode(F.split(F.regexp_replace("value", "\r?\n$", ""), "\r?\n")).alias("line_no", "value"))


def parse(lines: DataFrame) -> DataFrame:
    """(line_no, year, source, target): a missing target is the source without its first slash; one column is the target only."""
    c = F.split("value", "\t")
    own = F.coalesce(F.get(c, F.lit(2)), F.get(c, F.lit(1)), F.get(c, F.lit(0)))
    many = F.size(c) > 1
    return lines.select(
        "line_no",
        F.when(many, F.get(c, F.lit(0))).alias("year"),
        F.when(many, F.get(c, F.lit(1))).alias("source"),
        F.regexp_replace(own, "^/", "").alias("target"),
    )


def until_blank(lines: DataFrame) -> DataFrame:
    """Lines before the first blank one."""
    blank = lines.where(F.trim("value") == "").agg(F.min("line_no")).scalar()
    return lines.where(blank.isNull() | (F.col("line_no") < blank))


def resume(manifest: DataFrame, done: int, most: int) -> DataFrame:
    """The next ``most`` lines after ``done`` processed ones."""
    return manifest.where(F.col("line_no") >= done).orderBy("line_no").limit(most)


def unseen(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key is not in ``old``, the first of each key."""
    return new.join(old.select(key).distinct(), key, "left_anti").dropDuplicates([key])


def add(old: DataFrame, new: DataFrame, key: str, at: str) -> tuple[DataFrame, DataFrame]:
    """The manifest with the lines of ``new`` that it lacks after its own, and the log: those lines with the time ``at``. ``old`` stays
    as it is, so the version before is its own backup."""
    lines = unseen(new, old, key).select(*old.columns)
    return old.unionByName(lines), lines.withColumn("added_at", F.lit(at))


def from_directory(spark: SparkSession, path: str, seed: int | None = None) -> DataFrame:
    """Every file below ``path`` with year 0000, in path order or shuffled by the seed."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("source"))
    listed = files.select(F.lit("0000").alias("year"), "source")
    return listed.orderBy("source") if seed is None else listed.orderBy(F.xxhash64("source", F.lit(seed)), "source")


def prefer_gz(files: DataFrame, path: str = "path") -> DataFrame:
    """Of a file and its .gz the latter."""
    bare = F.regexp_replace(path, r"\.gz$", "")
    return files.withColumn("_bare", bare).groupBy("_bare").agg(F.max_by(path, F.length(path)).alias(path)).drop("_bare")


def populate(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Manifest rows with their content; ``missing`` marks those without a file."""
    met = manifest.join(sorted_side(files.select(F.col("path").alias("source"), "content")), "source", "left")
    return met.withColumn("missing", F.col("content").isNull())


def year_of(date: Column) -> Column:
    """The first four characters, 9999 if there is no date."""
    return F.when(F.length(date) > 0, F.left(date, F.lit(4))).otherwise("9999")
