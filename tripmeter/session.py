"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  Partition counts and memory belong to the cluster.
JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

_local_scratch: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings every job relies on; wall-clock arithmetic needs the UTC zone."""
    for key, value in JOB_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may leave the setting out (tests); it then gets one
    temporary folder, also set as its checkpoint folder.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="tripmeter-")
        context.setCheckpointDir(_local_scratch[app])
    return _local_scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses; :func:`clear_scratch` removes it."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def file_system(spark: SparkSession, path: str):
    """Hadoop file system of a path, and the path in its terms."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote below the shared folder: call it when its results are stored."""
    for path in _made.pop(spark.sparkContext.applicationId, []):
        files, where = file_system(spark, path)
        files.delete(where, True)
