"""Staging in the shared folder and settings shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.session import delete_path, scratch_path

SETTINGS = {
    # rows handed to Python at a time; texts are long, so few of them
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tuned(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


class Stages:
    """Intermediate tables of one operator, written to the shared folder.

    A written table cuts the lineage: when an executor is lost, later stages read files again
    instead of running everything anew. ``drop`` deletes what no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.count = spark, scratch_path(spark, name), 0

    def path(self, name: str) -> str:
        self.count += 1
        return f"{self.folder}/{self.count}-{name}"

    def write(self, df: DataFrame, name: str, **options) -> DataFrame:
        path = self.path(name)
        df.write.options(compression="zstd", **options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
                delete_path(self.spark, folder)


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go with the action that made them, not when the driver happens to collect its garbage.

    For steps that read written tables only, as no later action can take up an earlier one's shuffle.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def tasks_for(n_bytes: int, per_task: int = 32 << 20) -> int:
    """Number of partitions that keeps each at about ``per_task`` bytes."""
    return max(1, -(-int(n_bytes) // per_task))


def only(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The named columns; extra columns of an input, whatever they are called, end here."""
    return df.select(*[df[n] for n in names])


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as make it new to the frame."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
