"""Tables that are replaced whole, in versions with a commit marker each.

A version is a folder; its marker, an empty file written last, makes it the
current one.  A write that fails leaves the versions before it as they were,
and readers see the last whole one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def run_of(batch: DataFrame, run_id: str | None) -> str:
    """The run a micro-batch belongs to: the id of its streaming query, which
    its checkpoint keeps over restarts, unless the caller names the run;
    batches written outside a query and without a name are one run."""
    run = run_id or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"run-{run or 'unnamed'}"     # never read back as a number or a date


def file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str, int]]:
    """(number, run, batch id) of the committed versions, oldest first."""
    fs, folder = file_system(spark, f"{path}/_committed")
    if not fs.exists(folder):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(folder)]
    out = []
    for name in names:
        number, run, batch = name.split("--")
        out.append((int(number), run, int(batch)))
    return sorted(out)


def versioned_table_writer(path: str, keep: int = 2, run_id: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer of a table that each batch replaces whole.

    A batch writes a new folder and then, as the last step, its commit marker;
    a batch that fails leaves the versions before it as they were.  A batch
    that is replayed after its commit changes nothing.  The ``keep`` newest
    versions stay, so that a reader of the last one is not cut off."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, run_of(batch, run_id)
        done = _versions(spark, path)
        if any((r, b) == (run, batch_id) for _, r, b in done):
            return
        number = done[-1][0] + 1 if done else 0
        batch.write.mode("overwrite").parquet(f"{path}/version={number}")
        fs, marker = file_system(spark, f"{path}/_committed/{number:012d}--{run}--{batch_id}")
        fs.create(marker, True).close()
        for old, r, b in done[:max(0, len(done) + 1 - keep)]:
            # the marker first: a version without its folder must not look whole
            for gone in (f"{path}/_committed/{old:012d}--{r}--{b}", f"{path}/version={old}"):
                old_fs, p = file_system(spark, gone)
                old_fs.delete(p, True)
    return write


def read_versioned(spark: SparkSession, path: str) -> DataFrame:
    """The last committed version of a table written by ``versioned_table_writer``."""
    done = _versions(spark, path)
    if not done:
        raise FileNotFoundError(f"no committed version in {path}")
    return spark.read.parquet(f"{path}/version={done[-1][0]}")
