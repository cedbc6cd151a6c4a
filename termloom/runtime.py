"""Session helpers: input tables, the shared scratch folder, settled intermediate tables."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def show_package(spark: SparkSession) -> None:
    """Let Python workers find this package where it runs from a folder instead of being installed."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; the path goes to Spark's reader only, so any file system it knows will do."""
    show_package(spark)
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


#: The usual size of a Parquet row group, which one task reads; and what is too little to be worth spreading.
ROW_GROUP, LITTLE = 128 << 20, 1 << 20


def spread(df: DataFrame) -> DataFrame:
    """``df`` over as many partitions as the session has cores, if its scan gives fewer: a small table is often one file with
    one row group. A scan of many or of large files comes back as it is, so nothing is shuffled at scale."""
    spark = df.sparkSession
    cores, files = spark.sparkContext.defaultParallelism, df._jdf.inputFiles()
    if len(files) >= cores:
        return df
    paths = [spark._jvm.org.apache.hadoop.fs.Path(f) for f in files]
    sizes = [p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getLen() for p in paths]
    if sum(sizes) < LITTLE or sum(-(-n // ROW_GROUP) for n in sizes) >= cores:
        return df
    return df.repartition(cores)


def sorted_side(df: DataFrame) -> DataFrame:
    """``df`` as a join's side that is sorted and merged. Spark judges a side by the size of its files, and files of repetitive text or
    of numbers in order take many times their size in memory: a side that grows with the corpus must never be collected to be broadcast."""
    return df.hint("merge")


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where a local session leaves it unset (tests) a temporary folder of this machine is set once for the session; any other
    session has to name one, since executors can't see this machine's folders.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="termloom-")
        spark.conf.set("spark.checkpoint.dir", where)
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/termloom-{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage ends there and lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    if not _SETTLED:
        atexit.register(_sweep, spark)
    _SETTLED.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._settled_at = path
    return out


#: Folders that this process has settled and not released.
_SETTLED: list[str] = []


def release(df: DataFrame) -> None:
    """Delete the folder of a settled table that no plan still to run reads."""
    path = getattr(df, "_settled_at", None)
    if path in _SETTLED:
        _SETTLED.remove(path)
        delete(df.sparkSession, path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the shared file system has a file or folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def settled() -> int:
    """A mark for ``release_since``."""
    return len(_SETTLED)


def release_since(spark: SparkSession, mark: int, keep: DataFrame) -> None:
    """Delete what has been settled since ``mark`` but for one table, when all plans over the others have run."""
    own = getattr(keep, "_settled_at", None)
    for path in _SETTLED[mark:]:
        if path != own:
            _SETTLED.remove(path)
            delete(spark, path)


def _sweep(spark: SparkSession) -> None:
    """At the process's end its settled tables go, if the session still answers."""
    for path in _SETTLED:
        try:
            delete(spark, path)
        except Exception:  # the session is gone: the folder's owner cleans up
            return
