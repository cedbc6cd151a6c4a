"""Where stages' output goes: Parquet tables, fielded and tagged text, feature rows, files by domain and year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append(frame: DataFrame, path: str, *partitions: str) -> None:
    """Append to a Parquet table, in folders of the given columns."""
    (frame.write.mode("append").partitionBy(*partitions) if partitions else frame.write.mode("append")).parquet(path)


def create(frame: DataFrame, path: str) -> None:
    """A new Parquet table; one that is there already is an error, as a corpus is never overwritten."""
    frame.write.mode("errorifexists").parquet(path)


def text_files(lines: DataFrame, path: str, compress: bool = True) -> None:
    """One column of lines to text files, gzip-compressed unless told otherwise."""
    lines.write.option("compression", "gzip" if compress else "none").text(path)


def tagged_lines(sentences: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, sent_id, line): tagged sentences as token_TAG lines."""
    return sentences.select(key, "sent_id", F.array_join(F.transform("toks", lambda t: F.concat_ws("_", t["tok"], t["tag"])), " ").alias("line"))


def feature_files(rows: DataFrame, path: str) -> None:
    """uid, year, term and features (an array) as tab-separated, compressed lines."""
    text_files(rows.select(F.concat_ws("\t", "uid", "year", "term", F.array_join("features", "\t")).alias("value")), path)


def manifest_listing(rows: DataFrame, manifest: DataFrame, key: str = "target") -> DataFrame:
    """(line_no, kind, ord, line): per manifest line its path (kind 0), then its feature rows indented by a tab (kind 1)."""
    heads = manifest.select("line_no", F.lit(0).alias("kind"), F.lit(0).alias("ord"), F.col(key).alias("line"))
    details = manifest.select("line_no", key).join(rows, key).select("line_no", F.lit(1).alias("kind"), F.col("ord").cast("int").alias("ord"), F.concat(F.lit("\t"), "line").alias("line"))
    return heads.union(details)


def by_domain_and_year(index: DataFrame, path: str, domains: list[str], years: tuple[int, int] = (1995, 2014)) -> None:
    """Ids of wanted domains and years into a folder for each pair."""
    kept = index.where(F.col("domain").isin(*domains) & F.col("year").try_cast("int").between(*years))
    kept.write.partitionBy("domain", "year").option("compression", "none").text(path)
