"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
SHARED_MOUNT_KEY = "spark.tallyspark.sharedMount"
WAREHOUSE_KEY = "spark.sql.warehouse.dir"

RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Where every partition of the smaller side is small, join without sorting.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Do not record a Python call site for every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "tallyspark", **conf: str) -> SparkSession:
    """A session with the recommended settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    overrides = {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in {**RECOMMENDED_CONF, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder of the session.

    That is ``spark.checkpoint.dir``, or else the folder given to
    ``setCheckpointDir``, or else the warehouse.  A folder of a local file system
    may be mounted by all machines or by one only, which its name does not tell:
    on a cluster the tasks write there once, and the driver looks what it finds.

    Only a local-mode session may go without these settings: there the driver and
    all tasks share one machine, so a temporary folder is visible to every task.
    """
    context = spark.sparkContext
    base = (
        spark.conf.get(CHECKPOINT_KEY, None)
        or context.getConf().get(CHECKPOINT_KEY)
        or context.getCheckpointDir()
    )
    if _in_local_mode(context.master):
        base = base or _own_folder(context.applicationId)
    else:
        base = base or spark.conf.get(WAREHOUSE_KEY)
        if _on_one_machine(spark, base):
            _check_reach(spark, base)
    return _below(base, context.applicationId, label)


def _below(base: str, application: str, label: str) -> str:
    return f"{base.rstrip('/')}/tallyspark/{application}/{label}-{uuid.uuid4().hex}"


def _in_local_mode(master: str) -> bool:
    """Are driver and tasks one process?  ``local-cluster`` has executors of its own."""
    return master == "local" or master.startswith("local[")


_reached: set[tuple[str, str]] = set()


def _check_reach(spark: SparkSession, base: str) -> None:
    """Refuse a folder where the driver does not find what the tasks wrote; once per application."""
    application = spark.sparkContext.applicationId
    if (application, base) in _reached:
        return
    path, n = _below(base, application, "reach"), spark.sparkContext.defaultParallelism
    failure = None
    try:
        spark.range(0, n, 1, n).write.parquet(path)
        found = spark.read.schema("id long").parquet(path).count()
    except Exception as error:
        found, failure = 0, error
    if found != n:
        raise RuntimeError(
            f"of {n} files that tasks wrote below {base} {found} could be read again: set {CHECKPOINT_KEY}"
            f" to a folder that every executor can reach"
        ) from failure
    _reached.add((application, base))


@cache
def _own_folder(application: str) -> str:
    """One temporary folder for a local session without a shared one."""
    return tempfile.mkdtemp(prefix="tallyspark-")


def _on_one_machine(spark: SparkSession, path: str) -> bool:
    """Does the path name a local file system that is not declared to be a shared mount?"""
    if spark.conf.get(SHARED_MOUNT_KEY, "false") == "true":
        return False
    return file_system(spark, path).getScheme() == "file"


def file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf)


def clear_shared(spark: SparkSession) -> bool:
    """Remove what this application wrote in between; results read from there are gone too."""
    base = os.path.dirname(shared_folder(spark, "any"))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    return file_system(spark, base).delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result no longer depends on how (or how often) ``df`` would be
    evaluated, and survives the loss of any executor.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
