"""The corpus operators on the test tables, with production parameters, and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.llm import decontaminate, embedding_dedup, jaccard_join, language_id, licenses, line_dedup, orchard_codes, packing, periodic, quality, suffix_dedup, token_counts, warc
from adtally.llm.common import tuned
from adtally.session import use_scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, *tables: str, sql: str | None = None):
    """Register ``fn(table, ...)`` under ``name``; it gets whole tables."""

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tuned(use_scratch(spark))
            return fn(*[spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in tables])

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return wrap


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def sample_edits(documents: DataFrame) -> DataFrame:
    """Three edits for every document, at places that follow from its id: a replacement, an insertion and a deletion."""
    n = F.char_length(F.coalesce("text", F.lit("")))

    def edit(k: int, length: int, replacement: str | None):
        start = F.pmod(F.xxhash64("doc_id", F.lit(k)), n.cast("long") + 1)
        return F.struct(F.lit(k).alias("edit_id"), start.alias("start"), F.lit(length).alias("length"), F.lit(replacement).cast("string").alias("replacement"))

    three = F.array(edit(1, 12, "An edited passage,"), edit(2, 0, " some inserted words"), edit(3, 40, None))
    return documents.select("doc_id", F.explode(three).alias("e")).select("doc_id", "e.*")


@query("op1_edit_aware_token_counts", "documents")
def op1(documents: DataFrame) -> DataFrame:
    return token_counts.counted_with_edits(documents, sample_edits(documents), word_tokenizer())


@query("op2_suffix_dedup", "documents", sql=suffix_dedup.REPEAT_SQL)
def op2(documents: DataFrame) -> DataFrame:
    return suffix_dedup.repeat_report(documents, length=50)


@query("op3_ngram_jaccard_join", "documents", sql=jaccard_join.JACCARD_SQL)
def op3(documents: DataFrame) -> DataFrame:
    return jaccard_join.similar_documents(documents, shingle=5, percent=80)


@query("op4_benchmark_decontamination", "documents", "benchmark", sql=decontaminate.window_sql(window=10))
def op4(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return decontaminate.contamination(documents, benchmark, window=10, shingle=3)


@query("op5_line_dedup", "documents", sql=line_dedup.LINE_SQL.format(ratio=0.1, min_pages=3))
def op5(documents: DataFrame) -> DataFrame:
    return line_dedup.line_report(documents, site="source", ratio=0.1, min_pages=3)


@query("op6_warc_revisits", "pages", sql=warc.REVISIT_SQL)
def op6(pages: DataFrame) -> DataFrame:
    return warc.deduplicate(pages, least=100)


def file_paths(documents: DataFrame) -> DataFrame:
    """The documents as files: ``source/lang/block/``, some of them licence files of a block or of the language's folder."""
    place = F.concat_ws("/", "source", "lang")
    block = F.concat_ws("/", place, F.expr("cast(doc_id div 64 as string)"))
    path = (
        F.when(F.col("doc_id") % 128 == 0, F.concat(place, F.lit("/LICENSE")))
        .when(F.col("doc_id") % 8 == 0, F.concat(block, F.lit("/LICENSE")))
        .otherwise(F.concat(block, F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")))
    )
    return documents.select("doc_id", path.alias("path"), "text")


@query("op7_license_scan", "documents", sql=licenses.LICENCE_SQL)
def op7(documents: DataFrame) -> DataFrame:
    return licenses.scan(file_paths(documents), threshold=0.8)


@query("op8_embedding_near_dedup", "embeddings", sql=embedding_dedup.COSINE_SQL)
def op8(embeddings: DataFrame) -> DataFrame:
    return embedding_dedup.near_duplicates(embeddings, threshold=0.9)


@query("op9_best_fit_packing", "documents")
def op9(documents: DataFrame) -> DataFrame:
    return packing.pack(documents, word_tokenizer(), capacity=4096, end_id=1)


@query("op10_quality_classifier", "documents", "labels")
def op10(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return quality.graded(documents, labels, max_positive=12_000, max_unlabelled=12_000)


@query("op11_orchard_codes", "embeddings", sql=orchard_codes.ORCHARD_SQL)
def op11(embeddings: DataFrame) -> DataFrame:
    return orchard_codes.compressed(embeddings, parts=4, entries=256, rounds=4, scale=1024)


@query("op12_periodic_runs", "documents", sql=periodic.RUNS_SQL)
def op12(documents: DataFrame) -> DataFrame:
    return periodic.report(periodic.looped(documents))


@query("op13_language_id", "documents", sql=language_id.language_sql(top=400))
def op13(documents: DataFrame) -> DataFrame:
    return language_id.identified(documents, top=400)
