"""File exports and their manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from adtally.operators.aggs import partition_total
from adtally.session import materialize

# Settlement file layout.
FIELD_MARK = "\u0001"
LINE_MARK = "\r\n"


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", False).csv(path)


def export_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", False).option("sep", "\t").csv(path)


def settlement_lines(df: DataFrame) -> DataFrame:
    """One text column: fields joined by the field mark, marks inside a field blanked."""
    fields = [
        F.coalesce(F.replace(F.col(c).cast("string"), F.lit(FIELD_MARK), F.lit(" ")), F.lit("None"))
        for c in df.columns
    ]
    return df.select(F.concat_ws(FIELD_MARK, *fields).alias("value"))


def export_settlement(df: DataFrame, path: str, lines_per_file: int = 2_000_000) -> None:
    """Gzip text parts, written in parallel; a reader concatenates the parts. Parts are
    bounded, so that checksumming one fits in a task."""
    (
        settlement_lines(df)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", lines_per_file)
        .option("lineSep", LINE_MARK)
        .option("compression", "gzip")
        .text(path)
    )


def export_manifest(spark: SparkSession, path: str, pattern: str = "*.gz", by_folder: bool = False) -> DataFrame:
    """Name and MD5 of every exported file, computed where the file is read.

    With ``by_folder`` a file goes by the name of its folder, and by folder and own name where the
    folder has several parts.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", by_folder).load(path)
    name = lambda k: F.element_at(F.split("path", "/"), k)
    if not by_folder:
        return files.select(name(-1).alias("file"), F.md5("content").alias("md5"))
    summed = files.select(name(-2).alias("folder"), name(-1).alias("part"), F.md5("content").alias("md5"))
    counted = partition_total(summed, ["folder"], {"parts": F.count("*")})
    return counted.select(F.when(F.col("parts") > 1, F.concat_ws("/", "folder", "part")).otherwise(F.col("folder")).alias("file"), "md5")


def export_daily_lines(lines: DataFrame, path: str, lines_per_file: int = 2_000_000) -> None:
    """``day, value`` lines as sorted text files: one for a day of at most ``lines_per_file`` lines, several
    for a larger day, which is dealt over tasks by ranges of its lines. A day's parts hold its lines in order of their names."""
    lines = materialize(lines.select("day", "value"), "daily-lines")
    counts = lines.groupBy(F.col("day").alias("of")).agg(F.count("*").alias("n"))
    tasks = counts.agg(F.sum(F.ceil(F.col("n") / lines_per_file))).first()[0] or 1
    large = counts.where(F.col("n") > lines_per_file).select("of", F.lit(True).alias("large"))
    # lines of a small day have one key, so they stay together
    key = F.when(F.col("large"), F.col("value"))
    dealt = lines.join(F.broadcast(large), F.col("day").eqNullSafe(F.col("of")), "left").repartitionByRange(int(tasks), "day", key)
    sorted_ = dealt.select("day", "value").sortWithinPartitions("day", "value")
    sorted_.write.mode("overwrite").option("maxRecordsPerFile", lines_per_file).partitionBy("day").text(path)


def manifest_lines(manifest: DataFrame) -> DataFrame:
    return manifest.select(F.concat_ws(",", "file", "md5").alias("value"))
