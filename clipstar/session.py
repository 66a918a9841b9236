"""SparkSession construction and shared-storage helpers."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on.  UTC pins the timestamp -> wall-clock
# conversion; ANSI stays on (bad input is handled with try_* functions).
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Execution settings.  AQE re-plans at runtime from real shuffle statistics:
# it coalesces small partitions, turns a join into a broadcast join only when
# the materialised side is below spark.sql.adaptive.autoBroadcastJoinThreshold,
# and splits skewed join partitions.
#
# On a large cluster, pass in ``conf``: spark.sql.shuffle.partitions at about
# (largest shuffle bytes / 200 MB), e.g. 20000 for a 4 TB event shuffle (AQE
# coalesces what turns out small); spark.sql.files.maxPartitionBytes left at
# 128 MB; spark.sql.adaptive.advisoryPartitionSizeInBytes 128-256 MB.  Nothing
# here pins a partition count: tests set their own.
EXECUTION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "clipstar",
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**EXECUTION_CONF, **SEMANTIC_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    pin_semantics(spark)
    return spark


def pin_semantics(spark: SparkSession) -> None:
    """Apply the session settings whose values change query results."""
    for key, value in SEMANTIC_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Only when the session names none and runs on this machine alone is a
    local folder created and registered, so ``DataFrame.checkpoint()`` works
    as well; a cluster without a shared folder is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    master = sc.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all of {master} shares")
    local = tempfile.mkdtemp(prefix="clipstar-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused location under the shared folder."""
    return f"{shared_dir(spark)}/clipstar/{name}-{uuid.uuid4().hex[:16]}"


def working_session(spark: SparkSession) -> SparkSession:
    """A session with the settings that ``spark`` has now, for work that ends in written tables.

    * No join is broadcast because Spark takes a side for small.  It goes by the bytes of files, and of well compressed
      ones that may be a thirtieth of the rows, which the driver then has to hold.  Once a side has been shuffled, its
      rows are measured, and it is broadcast if these are under the session's threshold.
    * Shuffle files go when the write that made them has ended, not when the driver happens to collect its garbage.
      Its DataFrames are therefore to be written, not returned: run a second time, they would be shuffled again.
    """
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    measured = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    if own.conf.get(measured, None) is None:
        own.conf.set(measured, str(own._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()))
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    own.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return own
