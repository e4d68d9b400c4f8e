"""Session settings the daily tables rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(
    app_name: str = "daymill",
    master: str | None = None,
    settings: Mapping[str, str] | None = None,
) -> SparkSession:
    """Session in UTC. Master and sizing stay with the launcher unless given."""
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in this application's scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below the cluster's shared one; ``clear_scratch`` removes it.

    Executors and driver must see the same files, so the shared folder is the one named
    in ``spark.checkpoint.dir``. Only a local session without that setting gets a
    folder of its own, set once and then reused.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/daymill/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession, path: str | None = None) -> None:
    """Remove a scratch path, or all of this application's once no result needs it any more."""
    root = scratch_root(spark)
    path = path or root
    if path != root and not path.startswith(f"{root}/"):
        raise ValueError(f"{path} is not scratch of this application")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(folder, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within this, a query's shuffle files go as it ends, not when the driver happens to collect its garbage.

    For chains of written tables. A data frame that is collected twice makes its shuffles anew.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


_LOCAL_ROOT: list[str] = []


def _local_root() -> str:
    if not _LOCAL_ROOT:
        _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="daymill-"))
    return _LOCAL_ROOT[0]
