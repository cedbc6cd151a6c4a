"""Documents that arrive over time: each micro-batch goes through the per-document operators and is appended once.

Beside the table stands one of the keys that have been processed, with output or without, in folders by the key's hash: a batch reads
the folders of its own keys only. A batch writes a folder of its own in either table, output first and keys last, so one that is
replayed after a failure writes its folders anew and changes nothing else.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from termloom.operators import corpus
from termloom.runtime import exists, scratch_path

#: Folders of processed keys.
BUCKETS = 256


def grow(batch: DataFrame, path: str, stage: Callable[[DataFrame], DataFrame], key: str = "doc_id", batch_id: int = 0) -> None:
    """Add ``stage`` of the batch's new documents to the table at ``path``, as its folder ``batch=<batch_id>``."""
    spark, keys = batch.sparkSession, f"{path}-keys"
    new = batch.dropDuplicates([key]).withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"))
    if exists(spark, keys):
        met = [r["_bucket"] for r in new.select("_bucket").distinct().collect()]  # BUCKETS at most
        seen = spark.read.parquet(keys).where(F.col("_bucket").isin(met) & (F.col("batch") != batch_id))
        new = corpus.pending(new, seen, key)
    stage(new.drop("_bucket")).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    new.select(key, "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{keys}/batch={batch_id}")


def follow(stream: DataFrame, path: str, stage: Callable[[DataFrame], DataFrame], key: str = "doc_id", checkpoint: str | None = None, once: bool = True) -> StreamingQuery:
    """Run ``grow`` on every micro-batch of a streaming frame; ``once`` stops when all that is there has been read."""
    at = checkpoint or scratch_path(stream.sparkSession, "stream")
    writer = stream.writeStream.foreachBatch(lambda batch, n: grow(batch, path, stage, key, n)).option("checkpointLocation", at)
    return (writer.trigger(availableNow=True) if once else writer).start()
