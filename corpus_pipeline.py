"""A corpus pipeline: quality, line dedup, near-duplicates, benchmark leaks, packing.

Every stage is ``(name, function)`` with ``function(spark, docs, sf_dir)``; what it returns is
written as Parquet and read again as the next stage's documents. All but the last return the columns of
``documents``. Written tables cut the lineage, so a lost executor costs a stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.llm import decontaminate, jaccard_join, line_dedup, packing, quality
from adtally.llm.common import Stages, free_names, tuned
from adtally.llm.queries import word_tokenizer


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.5 go."""
    return quality.keep_good(docs, _table(tuned(spark), sf_dir, "labels"))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source go; every document stays, and ``n_chars`` follows its text."""
    tuned(spark)
    counts = tuple(free_names(docs, "_lines", "_dropped"))
    cleaned = line_dedup.remove_boilerplate(docs, site="source", ratio=0.1, min_pages=3, counts=counts)
    n_chars = F.when(F.col(counts[1]) > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", n_chars).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates the document with the smallest id stays."""
    tuned(spark)
    return jaccard_join.keep_one(docs, shingle=5, percent=80)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    return decontaminate.clean(docs, _table(tuned(spark), sf_dir, "benchmark"), window=10, shingle=3)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequences."""
    tuned(spark)
    return packing.pack(docs, word_tokenizer(), capacity=4096, end_id=1)


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_boilerplate),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", without_leaks),
    ("best-fit packing", packed),
]

# The classifier and the packing have no SQL form; tests hold run() against plain versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the last stage's rows."""
    tuned(spark)
    stages, docs = Stages(spark, "pipeline"), _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stages.write(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
