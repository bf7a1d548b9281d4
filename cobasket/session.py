"""Session helpers: building a session, and where intermediate tables may be written."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "cobasket", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; everything else is left to the deployment."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it gets a temporary folder of its own. On a cluster a
    machine-local folder would lose data with the machine, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(base)
        return base
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cobasket-"))
    return sc.getCheckpointDir()


_scratch: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under :func:`shared_dir` that nothing else writes to. :func:`remove_scratch` removes what is there."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def file_of(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and the path, as the JVM sees them: any store that Spark reads."""
    sc = spark.sparkContext
    found = sc._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(sc._jsc.hadoopConfiguration()), found


def remove_scratch(spark: SparkSession) -> int:
    """Remove the intermediate tables this session has written, once no result that reads them is needed any more; the
    number of them. Checkpoints are Spark's to remove (``spark.cleaner.referenceTracking.cleanCheckpoints``)."""
    paths = _scratch.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        system, found = file_of(spark, path)
        system.delete(found, True)
    return len(paths)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
COMPRESSION = "zstd"  # of intermediate Parquet tables

_cleaning: Counter = Counter()
_before: dict[tuple, str | None] = {}
_cleaning_lock = threading.Lock()


@contextmanager
def shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    """For writes whose result is read back: the shuffle files of each go when it ends, not when the driver happens to
    collect its garbage. The setting is the session's, so it is put back when the last of several such writes is over."""
    key = (spark.sparkContext.applicationId, spark._jsparkSession.hashCode())
    with _cleaning_lock:
        if not _cleaning[key]:
            _before[key] = spark.conf.get(SHUFFLE_CLEANUP, None)
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        _cleaning[key] += 1
    try:
        yield
    finally:
        with _cleaning_lock:
            _cleaning[key] -= 1
            if not _cleaning[key]:
                before = _before.pop(key)
                spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read back. Cuts lineage; and where a join reads it, that side is
    a plain shuffle, which the skew join needs: it splits no join with an aggregate on its own key."""
    path = scratch_path(df.sparkSession, name)
    with shuffle_files_removed(df.sparkSession):
        df.write.parquet(path, compression=COMPRESSION)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, so a lost executor does not replay the whole job."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
