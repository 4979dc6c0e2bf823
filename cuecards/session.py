"""Session helpers.

Cluster settings (shuffle partitions, checkpoint folder, memory) belong to
whoever launches the job; these helpers only fill gaps for local runs and
tests.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "cuecards") -> SparkSession:
    """Return the active session, or build a local one for tests and benches."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    builder = builder.master(master or os.environ.get("CUECARDS_MASTER", "local[8]"))
    for key, value in _LOCAL_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("CUECARDS_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder for checkpoints and stage tables.

    The cluster names it in ``spark.checkpoint.dir``; we only set our own
    (``fallback``, or a folder under the system temp dir) when it is unset on a
    local master, which happens in tests and local benches.  Elsewhere a missing
    setting is an error: executors on other machines would not see the folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not (fallback or re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master)):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        current = fallback or os.path.join(os.environ.get("TMPDIR", "/tmp"), "cuecards-checkpoints")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def cut_lineage(df):
    """``df`` written once as Parquet to the shared checkpoint folder, and read back.

    Used where a table is read many times (vocabularies, fold tables of
    k-fold loops): it is computed once, readers read only the columns they
    use, and a lost executor re-reads the files instead of recomputing the
    lineage.  Never a local checkpoint.  ``drop_tables`` removes the files.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(schema).parquet(path)


_written: list[str] = []


def drop_tables(spark: SparkSession) -> int:
    """Delete the tables that ``cut_lineage`` has written in this process, when
    nothing reads them any more; returns how many."""
    done = 0
    while _written:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_written.pop())
        done += bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
    return done
