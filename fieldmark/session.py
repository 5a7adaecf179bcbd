"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on.  Everything else is left to the cluster.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot series is split even where the split costs one more exchange above.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "fieldmark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local master may fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    name = spark.sparkContext.applicationId
    if name not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[name] = tempfile.mkdtemp(prefix="fieldmark-")
    return _LOCAL_FOLDERS[name]


# Temporary folders of local sessions, and the stages written within open scopes.
_LOCAL_FOLDERS: dict[str, str] = {}
_SCOPES: list[list[str]] = []


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the stages written inside, at the end.

    Results that still read from them have to be written or collected inside.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for folder in _SCOPES.pop():
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, for a table written within a job."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write `df` as a table below the shared folder and read it back.

    For a stage that several later steps read, or whose rows must not change when
    a lost task is run again.  It is computed once, when this is called; later plans
    are short, and column pruning and filters reach the stored files.  The folder keeps
    it until it is cleaned, as it does with checkpoints, or until the end of a `stage_scope`.
    A stream has no end to be stored.
    """
    if df.isStreaming:
        raise ValueError("a stream cannot be stored as a stage; use it inside foreachBatch")
    path = work_folder(df.sparkSession, label)
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured(aggregate: DataFrame) -> DataFrame:
    """Store an aggregate, so that Spark knows its real size when it is joined.

    One row per series may be four rows or a billion.  Stored, it is broadcast
    if it is below `spark.sql.autoBroadcastJoinThreshold`, and the large side is
    not shuffled at all; above that the join is shuffled and skew is split at
    run time.  An aggregate that is only planned counts as large as its input,
    so the large side would be shuffled by a few hot keys in any case.
    """
    return stored(aggregate, "aggregate")
