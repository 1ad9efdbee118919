"""Loads into report tables of the catalog."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from adtally.operators.shape import conform
from adtally.session import delete_path, replace_folder, staged
from adtally.sources.tables import target_schema

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str) -> Iterator[None]:
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, mode)
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def create_table(df: DataFrame, table: str, partition_by: Sequence[str] = (), path: str | None = None) -> None:
    """Empty table with the frame's columns, so that later loads conform to it."""
    writer = df.limit(0).write.format("parquet").mode("ignore")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def _conformed(df: DataFrame, table: str) -> DataFrame:
    return conform(df, target_schema(df.sparkSession, table))


def append(df: DataFrame, table: str) -> None:
    _conformed(df, table).write.insertInto(table, overwrite=False)


def _partition_keys(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(column: str, value: str) -> str:
    return f"PARTITION ({column}={_quoted(value)})"


def _folders(spark: SparkSession, table: str, column: str) -> list[tuple[str, str]]:
    """Value of ``column`` and folder of every partition, from one catalog call."""
    session = spark._jsparkSession.sessionState()
    name = session.sqlParser().parseTableIdentifier(table)
    parts = session.catalog().listPartitions(name, spark._jvm.scala.Option.empty())
    each = [parts.apply(k) for k in range(parts.size())]
    return [(p.spec().apply(column), p.location().toString()) for p in each]


def drop_partitions(spark: SparkSession, table: str, column: str, values: Sequence[str]) -> None:
    """Remove partitions in one statement, and then their files, which an external table would keep."""
    wanted = set(values)
    found = [(v, folder) for v, folder in _folders(spark, table, column) if v in wanted]
    doomed = sorted({v for v, _ in found})
    if not doomed:
        return
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(_spec(column, v) for v in doomed)}")
    for _, folder in found:
        # folders of other layouts, registered from elsewhere, are left alone
        if f"{column}=" in folder:
            delete_path(spark, folder)


def replace_partition(df: DataFrame, table: str, covers: Sequence[str] = ()) -> None:
    """Replace the partitions present in ``df``; a rerun leaves the same table.

    ``covers`` names the partitions the run is responsible for. One that has no rows any
    more is emptied too, which an overwrite of present partitions would not do.

    The rows are computed and staged before any partition changes, so a failing report
    leaves the table as it was, and the overwrite swaps each partition when its files are
    complete. Rows are rebalanced by partition key: few files per partition, and a partition that holds
    most rows is split over several tasks.
    """
    spark = df.sparkSession
    keys = _partition_keys(spark, table)
    with staged(_conformed(df, table), "load") as rows, _overwrite_mode(spark, "dynamic"):
        rows.hint("rebalance", *keys).write.insertInto(table, overwrite=True)
        if covers:
            # at most one value per covered partition
            present = {r[0] for r in rows.where(F.col(keys[0]).cast("string").isin(list(covers))).select(F.col(keys[0]).cast("string")).distinct().collect()}
            drop_partitions(spark, table, keys[0], [c for c in covers if c not in present])


def store_batch(df: DataFrame, table: str, batch: str, slot: str) -> None:
    """One batch of a stream into a table partitioned by ``day`` and ``batch``; the day is that of the bucket column ``slot``.

    A batch has folders of its own below the days it touches, so it adds as many partitions as days, whatever the number of
    its windows, and a replayed batch overwrites exactly what it had written.
    """
    spark = df.sparkSession
    named = df.withColumn("day", F.substring(slot, 1, 8)).withColumn("batch", F.lit(batch))
    with _overwrite_mode(spark, "dynamic"):
        _conformed(named, table).hint("rebalance", "day").write.insertInto(table, overwrite=True)


def compact_batches(spark: SparkSession, table: str, day: str) -> None:
    """Put the batches of a finished day into one; call it when the stream is past the day.

    The rows are staged first, and one statement replaces all partitions of the day.
    """
    whole = spark.table(table)
    columns = [c for c in whole.columns if c not in ("day", "batch")]
    with staged(whole.where(F.col("day") == day).select(*columns), "compact") as rows, _overwrite_mode(spark, "static"):
        rows.hint("rebalance").createOrReplaceTempView("adtally_compact")
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (day={_quoted(day)}, batch) SELECT {', '.join(columns)}, 'compacted' FROM adtally_compact")
    spark.catalog.dropTempView("adtally_compact")


def refresh(df: DataFrame, table: str) -> None:
    """Full replacement: the old rows stay until the new ones are written in full."""
    spark = df.sparkSession
    keys = _partition_keys(spark, table)
    if keys:
        before = {r.partition.split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        replace_partition(df, table, covers=sorted(before))
        return
    place = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").first().data_type
    with staged(_conformed(df, table), "refresh") as rows:
        replace_folder(rows, place)
    spark.catalog.refreshTable(table)


def expire(spark: SparkSession, table: str, column: str, prefix: str) -> list[str]:
    """Remove the partitions whose key starts with ``prefix``, catalog entries and files."""
    names = [r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    doomed = [n.split("=", 1)[1] for n in names if n.startswith(f"{column}={prefix}")]
    drop_partitions(spark, table, column, doomed)
    return doomed


def clear(spark: SparkSession, tables: Sequence[str]) -> None:
    """Empty the tables; an overwrite with no rows also works where TRUNCATE is refused."""
    for table in tables:
        refresh(spark.createDataFrame([], target_schema(spark, table)), table)
