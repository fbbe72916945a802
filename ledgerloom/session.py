"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Adaptive execution turns a sort-merge join into a broadcast join only after
# the size of the small side has been measured, coalesces small shuffle
# partitions and splits skewed ones. Nothing in this package hints a broadcast
# for a side whose size depends on the data.
SMALLEST_PARTITION = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    SMALLEST_PARTITION: "16k",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # call-site capture costs several driver round trips per column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "ledgerloom", **conf: str) -> SparkSession:
    """A session with the package defaults; ``conf`` adds or overrides settings."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    use_defaults(session)
    return session


def use_defaults(spark: SparkSession) -> None:
    """What a session made elsewhere needs of the defaults.

    Source timestamps carry no zone; UTC keeps ``Z`` strings and dates aligned.
    Tables by day have thousands of small folders: they are listed by as many
    tasks as run at once instead of one task for each folder, and small
    shuffles before a write keep their partitions.
    """
    spark.conf.set("spark.sql.session.timeZone", DEFAULTS["spark.sql.session.timeZone"])
    slots = max(8, spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(slots))
    spark.conf.set(SMALLEST_PARTITION, DEFAULTS[SMALLEST_PARTITION])


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="ledgerloom-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can reach, as named by the cluster.

    Only a local session without ``spark.checkpoint.dir`` gets a folder of its
    own, because there the driver and the tasks share one disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        named = _local_folder(spark.sparkContext.applicationId)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path of its own below the shared folder; nothing is written there yet.

    All paths of an application share one parent, which may be removed once the
    application has ended.
    """
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
