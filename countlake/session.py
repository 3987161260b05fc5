"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_scratch = threading.local()


def build_session(
    app_name: str = "countlake",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the jobs are written for.

    Sizes (executors, shuffle partitions, memory) belong to the cluster and
    are left to ``spark-submit``; ``conf`` overrides anything set here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Streaming state beyond executor heap.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, reachable by all executors.

    Only a local-mode session without that setting falls back to a temporary
    folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    app_id = spark.sparkContext.applicationId
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the executors")
        if app_id not in _local_roots:
            _local_roots[app_id] = tempfile.mkdtemp(prefix="countlake-")
        root = _local_roots[app_id]
    return f"{root.rstrip('/')}/countlake/{app_id}/{label}-{uuid.uuid4().hex}"


def path_is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def write_through(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The lineage is cut in a way that survives lost executors, and the file
    sizes give the optimizer a true size: it broadcasts the table only when
    that size is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.parquet(path)
    if getattr(_scratch, "paths", None) is not None:
        _scratch.paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes what :func:`write_through` wrote within, for jobs that end with a write."""
    outer, _scratch.paths = getattr(_scratch, "paths", None), []
    try:
        yield
    finally:
        paths, _scratch.paths = _scratch.paths, outer
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)
