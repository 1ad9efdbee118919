"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # split partitions swollen by a hot key, even where that costs an extra shuffle later
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # hash instead of sort-merge only where every measured partition is this small
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}
# What a cluster run starts from; adaptive execution merges shuffle partitions that turn out small.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(app: str = "adtally", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the reports rely on; ``extra`` keys use ``__`` for dots.

    Without ``master`` the cluster that submitted the job decides it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    settings = SETTINGS if master else {**CLUSTER_SETTINGS, **SETTINGS}
    for key, value in settings.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_settings(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or what ``setCheckpointDir`` was given."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return configured


def use_scratch(spark: SparkSession) -> SparkSession:
    """For a session on one machine whose owner set no checkpoint folder, as tests do: a temporary one, deleted at exit.

    Library code never calls this; a cluster without the setting stays refused by ``shared_dir``.
    """
    context = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and not context.getCheckpointDir() and context.master.startswith("local["):
        folder = tempfile.mkdtemp(prefix="adtally-")
        context.setCheckpointDir(folder)
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return spark


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused location below the shared folder, to be deleted by ``clear_scratch``."""
    _SCRATCH.append(f"{shared_dir(spark).rstrip('/')}/adtally/{name}-{uuid.uuid4().hex}")
    return _SCRATCH[-1]


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything this process wrote to scratch locations; call it when the job's results are stored."""
    while _SCRATCH:
        delete_path(spark, _SCRATCH.pop())


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where several branches of one plan consume the same aggregate: the raw log
    is scanned once, the lineage is cut, and a lost executor re-reads files instead
    of recomputing. Parquet also gives later joins a true size to plan with.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever store holds it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` computed in full and written to the shared folder, before anything it replaces is touched."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        delete_path(df.sparkSession, path)


def replace_folder(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write ``df`` beside ``path`` and swap the folders, so that ``path`` holds the old rows or the new ones.

    The swap is two renames; if the second fails, the first is undone.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    path = path.rstrip("/")
    name = spark._jvm.org.apache.hadoop.fs.Path
    new, old, live = name(f"{path}.new-{mark}"), name(f"{path}.old-{mark}"), name(path)
    fs = live.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        df.write.partitionBy(*partition_by).parquet(f"{path}.new-{mark}")
        had = fs.exists(live)
        if had and not fs.rename(live, old):
            raise OSError(f"cannot move {path}")
        if not fs.rename(new, live):
            if had:
                fs.rename(old, live)
            raise OSError(f"cannot replace {path}")
        fs.delete(old, True)
    finally:
        fs.delete(new, True)
