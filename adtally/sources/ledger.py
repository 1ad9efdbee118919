"""Ledger of input files: each file is taken once, however often a load runs.

A load writes its rows below ``load=<id>`` of the target and, last, the files it took below ``load=<id>`` of the ledger. Rows are
read through the ledger, so those of a load that failed before its ledger entry do not count; the next load deletes them and
takes its files again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from adtally.session import delete_path, materialize

FILES = "file string, size long, modified timestamp, load string"


class ChangedFiles(ValueError):
    """A file that was taken before has another size or time now."""


def listed_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``file, size, modified`` of the files below ``path``, from their metadata alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    meta = F.col("_metadata")
    return files.select(meta["file_path"].alias("file"), meta["file_size"].alias("size"), meta["file_modification_time"].alias("modified"))


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def entries(spark: SparkSession, ledger: str) -> DataFrame:
    if not _exists(spark, ledger):
        return spark.createDataFrame([], FILES)
    return spark.read.schema(FILES).parquet(ledger)


def new_files(spark: SparkSession, path: str, ledger: str, pattern: str = "*") -> DataFrame:
    """The files that no load has taken. A taken file that has changed is refused, and so is the whole load."""
    known = entries(spark, ledger).select("file", F.col("size").alias("_size"), F.col("modified").alias("_modified"))
    seen = listed_files(spark, path, pattern).join(known, "file", "left")
    changed = F.col("_size").isNotNull() & ((F.col("size") != F.col("_size")) | (F.col("modified") != F.col("_modified")))
    bad = [r.file for r in seen.where(changed).select("file").orderBy("file").limit(5).collect()]
    if bad:
        raise ChangedFiles(f"files changed since they were taken: {', '.join(bad)}")
    return seen.where(F.col("_size").isNull()).select("file", "size", "modified")


def load_new(
    spark: SparkSession, read: Callable[[str], DataFrame], path: str, target: str, ledger: str,
    make: Callable[[DataFrame], DataFrame] = lambda rows: rows, pattern: str = "*", load: str | None = None,
) -> str | None:
    """Add the rows of files not taken before to ``target``; the id of the load, or None where there is no new file.

    ``read`` gives the rows of the folder from a file source, ``make`` what is stored of them. Rows of files that came after
    the listing wait for the next load.
    """
    files = materialize(new_files(spark, path, ledger, pattern), "new-files")
    if files.isEmpty():
        return None
    load = load or uuid.uuid4().hex
    _drop_unfinished(spark, target, ledger)
    source = read(path)
    rows = source.select(*source.columns, F.col("_metadata.file_path").alias("_file"))
    make(rows.join(files.select(F.col("file").alias("_file")), "_file", "left_semi").drop("_file")).write.mode("overwrite").parquet(f"{target}/load={load}")
    files.write.mode("errorifexists").parquet(f"{ledger}/load={load}")
    return load


def _drop_unfinished(spark: SparkSession, target: str, ledger: str) -> None:
    """Delete what loads without a ledger entry have left behind."""
    if not _exists(spark, target):
        return
    done = {r.load for r in entries(spark, ledger).select("load").distinct().collect()}  # one row per load
    at = spark._jvm.org.apache.hadoop.fs.Path(target)
    for status in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at):
        name = status.getPath().getName()
        if name.startswith("load=") and name.removeprefix("load=") not in done:
            delete_path(spark, status.getPath().toString())


def loaded(spark: SparkSession, target: str, ledger: str, schema: str) -> DataFrame:
    """The rows of all finished loads, with their ``load``."""
    done = entries(spark, ledger).select("load").distinct()
    return spark.read.schema(f"{schema}, load string").parquet(target).join(done, "load", "left_semi")
