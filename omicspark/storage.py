"""Tables that cut lineage, in the folder that driver and executors share."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
ROWS = 1 << 18  # that a task gets where rows are dealt by their number


def shared_dir(spark: SparkSession) -> str:
    """The URI of the shared folder.

    It is what the cluster names in ``spark.checkpoint.dir``. Where that is unset a
    temporary folder is made and set for the session if all runs in one local
    process; on a cluster, where executors don't see the driver's disk, it is an error.
    """
    found = spark.conf.get(_SETTING, None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"{_SETTING} must name a folder that driver and executors of {master or 'the cluster'} share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set(_SETTING, found)
    return found.rstrip("/")


_runs: dict[str, str] = {}


def run_dir(spark: SparkSession) -> str:
    """The folder of this run below the shared one. It goes when the driver's process ends."""
    key = f"{shared_dir(spark)} {spark.conf.get('spark.app.id', '')}"
    if key not in _runs:
        found = f"{shared_dir(spark)}/omicspark/{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(found)
        store = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        store.mkdirs(path)
        store.deleteOnExit(path)
        _runs[key] = found
    return _runs[key]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the run's folder that nothing has used."""
    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Spark's commit protocol lets only successful attempts count, and later reads
    survive the loss of the executors that wrote it.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let the files go that shuffles of written steps have left; Spark removes them once the driver's garbage has been collected."""
    gc.collect()
    spark._jvm.System.gc()


def parts_of(rows: int) -> int:
    """A number of partitions of about ROWS rows. It follows the rows, so a task's part stays as it is at any input."""
    return max(1, -(-rows // ROWS))


def dealt(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """``df`` written, counted and dealt by ``keys`` to tasks of about ROWS rows; what is grouped by them needs no other shuffle."""
    held = materialize(df, name)
    return held.repartition(parts_of(held.count()), *keys)


def spread(spark: SparkSession, rows: int = 1 << 62, most: int = 1 << 12) -> int:
    """A number of partitions for few small rows that stand for much work each.

    Adaptive execution would put them into one task by their size; a number that is
    given stays.
    """
    return max(1, min(rows, most, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def bound_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Let Python workers get at most ``rows`` rows at a time, for tables of long texts.

    The session keeps the setting, as plans are made when their results are asked
    for; a smaller number that is set already stays.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(setting, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(setting, str(rows))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bounded(df: DataFrame, most: int, what: str) -> DataFrame:
    """``df`` written, if it has at most ``most`` rows; an error otherwise. For sides that meet every row of another table."""
    held = materialize(df, "bounded")
    if held.limit(most + 1).count() > most:
        raise ValueError(f"over {most} {what}")
    return held
