"""Session helpers.

Library code never creates its own cluster settings: it takes the session it
is given.  ``get_session`` is for tests, scripts and the bench, and only fills
in settings that are still unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  Time zone is pinned so day
# buckets agree with the DuckDB twins; AQE re-plans joins and splits skewed
# shuffle partitions at run time.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "vigil") -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        for k, v in _REQUIRED.items():
            active.conf.set(k, v)
        return active
    master = master or os.environ.get("VIGIL_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("VIGIL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in _REQUIRED.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_CHECKPOINTS: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and lineage-cutting tables.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach; it is read from the session (Spark applies it to the context at
    start-up).  Only when it is unset in local mode (tests) is a private
    scratch folder created and registered with the context -- the setting
    itself is fixed at start-up and is never changed here.  On a cluster a
    missing setting is an error: executors cannot read the driver's folders.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if d:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
        return d
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = sc.applicationId
    if app not in _LOCAL_CHECKPOINTS:
        _LOCAL_CHECKPOINTS[app] = tempfile.mkdtemp(prefix="vigil-ckpt-")
        sc.setCheckpointDir(_LOCAL_CHECKPOINTS[app])
    return _LOCAL_CHECKPOINTS[app]
