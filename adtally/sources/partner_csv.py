"""Daily partner performance files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adtally.functions.rules import platform_number_strict

# The partner's channel type, and the column positions of the file.
PARTNER_CHANNEL_TYPE = "6"
POSITIONS = {
    "date": 0,
    "country": 1,
    "pkg": 3,
    "channel": 5,
    "click": 7,
    "conversion": 8,
    "revenue": 9,
    "cost": 10,
}
MIN_FIELDS = 12


def is_header(line: Column, any_line_naming_country: bool = False) -> Column:
    """A header's first field is no day; the looser test takes every line that names ``country``, data or not."""
    if any_line_naming_country:
        return F.contains(line, F.lit("country"))
    return ~F.rlike(F.replace(line, F.lit('"'), F.lit("")), F.lit("^[0-9]{4}-?[0-9]{2}-?[0-9]{2}"))


def rejected_lines(spark: SparkSession, path: str, any_line_naming_country: bool = False) -> DataFrame:
    """Number of header lines and of lines with too few fields, as one row."""
    header = is_header(F.col("value"), any_line_naming_country)
    short = ~header & (F.size(F.split("value", ",", -1)) < MIN_FIELDS)
    return spark.read.text(path).agg(F.count_if(header).alias("headers"), F.count_if(short).alias("short_lines"))


def read_partner_csv(spark: SparkSession, path: str, any_line_naming_country: bool = False) -> DataFrame:
    """Parse partner lines: quotes are stripped, header lines and short lines are skipped
    (``rejected_lines`` counts them). Every platform but Android becomes 2.

    Lines are read as text because the files quote without escaping and vary in width;
    the text source splits large files across tasks.
    """
    return parse_lines(spark.read.text(path), any_line_naming_country)


def parse_lines(lines: DataFrame, any_line_naming_country: bool = False) -> DataFrame:
    """The report rows of a ``value`` column of partner lines."""
    lines = lines.where(~is_header(F.col("value"), any_line_naming_country))
    fields = lines.select(F.split(F.replace("value", F.lit('"'), F.lit("")), ",", -1).alias("f"))
    wide = fields.where(F.size("f") >= MIN_FIELDS)
    text = {name: F.col("f")[i] for name, i in POSITIONS.items()}
    return wide.select(
        text["date"].alias("date"),
        F.lit(PARTNER_CHANNEL_TYPE).alias("channel_type"),
        platform_number_strict(F.col("f")[2], "Android").cast("string").alias("platform"),
        text["channel"].alias("channel"),
        text["country"].alias("country"),
        text["pkg"].alias("pkg"),
        text["conversion"].cast("long").alias("conversion"),
        text["revenue"].cast("double").alias("revenue"),
        text["cost"].cast("double").alias("cost"),
        text["click"].cast("long").alias("click"),
        F.lit(0).cast("long").alias("install"),
    )
