"""Intermediate tables in the shared folder that the cluster names.

A table written there cuts lineage: a lost executor costs only the tasks that
were running, and later steps read columns they need.  Tables are dropped as
soon as no later step reads them.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import checkpoint_dir


ARROW_ROWS = 1024


def gives_back(scan: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A scan over record batches that returns the memory it has freed to the
    system at its end: Python workers are used again by later tasks, and what
    they hold counts against the executor."""
    @wraps(scan)
    def run(batches, *args, **kwargs):
        yield from scan(batches, *args, **kwargs)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc
        if trim is not None:
            trim(0)
    return run


def small_batches(spark: SparkSession) -> None:
    """Rows that travel to Python at once: whole texts may be long, and the
    usual 10,000 of them need memory in the JVM and in the worker.  A smaller
    setting of the session stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as a full URI: without a scheme it lies in Spark's own default
    file system, which Python code in the tasks could not know."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """One run's folder below ``spark.checkpoint.dir``.

    A lazy result reads its tables until its caller is done with it, so no
    operator can remove them all: the caller does, by ``clean_up`` when its
    results are written."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{_home(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and read it back."""
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Remove a table that nothing reads any more."""
        _delete(self.spark, self.path(name))


def _home(spark: SparkSession) -> str:
    return f"{qualified(spark, checkpoint_dir(spark)).rstrip('/')}/vigil-{spark.sparkContext.applicationId}"


def clean_up(spark: SparkSession) -> None:
    """Remove every intermediate table that this application's operators have
    left in the shared folder.  Results that are not written yet are lost."""
    _delete(spark, _home(spark))


ROW = ["__file", "__index"]


def located(docs: DataFrame, run: Scratch) -> DataFrame:
    """``docs`` with columns ``ROW`` that name each row the same way in every
    scan and sort as the table's files do: the file and the row's place in it.
    What is no plain scan of files is written first."""
    place = [F.col("_metadata.file_path").alias(ROW[0]), F.col("_metadata.row_index").alias(ROW[1])]
    try:
        return docs.select("*", *place)
    except AnalysisException:
        return run.keep(docs, "located").select("*", *place)
