"""Site-relative line dedup in DataFrame operations only.

A line is boilerplate of its site if the share of the site's pages that contain it exceeds
``ratio`` and at least ``min_pages`` pages contain it. Such lines are removed from every page
of the site. Lines are what lies between line breaks, compared by a 64-bit hash; empty lines are neither counted
nor removed.

Pages per (site, line) are counted with a partial aggregate in the scan stage, so a line that
a third of all pages contain is one row per task. A site has fewer boilerplate lines than the
mean number of distinct lines on its pages divided by ``ratio``, so they fit in one array per
site; texts are filtered against it in place and never exploded again. The join with those
arrays is a broadcast while they are small and a shuffle with skew splitting beyond that.

Defined cases: a NULL site is a site of its own; a NULL text has no lines and stays NULL; a
line repeated on a page counts once and all its places go; repeated pages each count; columns
may have any names, also those used inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import Stages, free_names


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def with_host(pages: DataFrame, url: str = "url", name: str = "host") -> DataFrame:
    """The pages with the host of their URL as a site: lower case, NULL where the URL has none."""
    return pages.withColumn(name, F.lower(F.try_parse_url(F.col(url), F.lit("HOST"))))


def boilerplate(pages: DataFrame, ratio: float, min_pages: int) -> DataFrame:
    """``site, drop``: hashes of the lines to remove, for sites that have any. ``pages`` holds ``site, text``."""
    hashed = F.transform(F.filter(lines(F.col("text")), lambda x: x != ""), lambda x: F.xxhash64(x))
    counted = (
        pages.select("site", F.explode(F.array_distinct(hashed)).alias("line"))
        .groupBy("site", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    )
    totals = pages.groupBy(F.col("site").alias("of")).agg(F.count("*").alias("pages"))
    common = counted.join(totals, F.col("site").eqNullSafe(F.col("of"))).where(F.col("n") > ratio * F.col("pages"))
    return common.groupBy("site").agg(F.collect_list("line").alias("drop"))


def remove_boilerplate(
    docs: DataFrame, site: str = "source", text: str = "text", ratio: float = 0.1, min_pages: int = 3,
    counts: tuple[str, str] = ("_lines", "_dropped"),
) -> DataFrame:
    """The rows with their columns, the boilerplate gone from ``text``, plus the numbers of lines and of dropped lines under
    the names ``counts``; columns of the input with those two names give way to them."""
    stages = Stages(docs.sparkSession, "lines")
    own, drop, left = free_names(docs, "_site", "_drop", "_kept")
    found = boilerplate(docs.select(docs[site].alias("site"), docs[text].alias("text")), ratio, min_pages)
    found = stages.write(found.select(F.col("site").alias(own), F.col("drop").alias(drop)), "boilerplate")
    joined = docs.join(found, docs[site].eqNullSafe(found[own]), "left")
    parts = lines(F.col(text))
    kept = F.filter(parts, lambda x: ~F.array_contains(F.col(drop), F.xxhash64(x)) | (x == ""))
    has = F.col(drop).isNotNull() & F.col(text).isNotNull()
    # one filtered array, read by both columns
    joined = joined.withColumn(left, F.when(has, kept))
    n = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(parts)).cast("long")
    cleaned = [F.when(has, F.array_join(left, "\n")).otherwise(F.col(text)).alias(c) if c == text else F.col(c) for c in docs.columns if c not in counts]
    return joined.select(*cleaned, n.alias(counts[0]), F.when(has, n - F.size(left)).otherwise(F.lit(0)).cast("long").alias(counts[1]))


def line_report(docs: DataFrame, **how) -> DataFrame:
    """One row per document: its lines, how many go, and a digest of what is left."""
    cleaned = remove_boilerplate(docs.select("doc_id", "source", "text"), **how)
    return cleaned.select(
        "doc_id", F.col("source").alias("site"), F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


LINE_SQL = """
WITH pages AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents),
seen AS (SELECT source, doc_id, unnest(list_distinct(list_filter(parts, lambda x: x <> ''))) AS line FROM pages),
counted AS (SELECT source, line, COUNT(*) AS n FROM seen GROUP BY ALL HAVING COUNT(*) >= {min_pages}),
totals AS (SELECT source, COUNT(*) AS pages FROM pages GROUP BY ALL),
gone AS (
  SELECT c.source, list(c.line) AS drop_lines FROM counted c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
  WHERE c.n > CAST({ratio} AS DOUBLE) * t.pages GROUP BY ALL
),
left_over AS (
  SELECT p.doc_id, p.source, p.parts,
    list_filter(p.parts, lambda x: NOT list_contains(COALESCE(g.drop_lines, []), x)) AS kept
  FROM pages p LEFT JOIN gone g ON p.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, source AS site, CAST(COALESCE(len(parts), 0) AS BIGINT) AS n_lines,
  CAST(COALESCE(len(parts) - len(kept), 0) AS BIGINT) AS n_dropped, sha256(COALESCE(array_to_string(kept, chr(10)), '')) AS kept_sha256
FROM left_over
"""
