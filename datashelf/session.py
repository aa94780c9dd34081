"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# What the library relies on. Sizes (shuffle partitions, memory) are left to the cluster.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app: str = "datashelf", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder and context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="datashelf-"))
        folder = context.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def work_folder(spark: SparkSession) -> str:
    """The folder of this application below the shared one, in which all intermediates are."""
    return f"{shared_folder(spark)}/datashelf-{spark.sparkContext.applicationId}"


def fresh_folder(spark: SparkSession, label: str = "work") -> str:
    """A path below the work folder that no other run uses."""
    return f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove_work(spark: SparkSession) -> bool:
    """Delete the intermediates of this application. Frames that were built on them can not be read any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(work_folder(spark))
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
