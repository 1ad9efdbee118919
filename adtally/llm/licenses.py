"""Licence scan in DataFrame operations only: TF-IDF cosine to templates, then inheritance along paths.

Units are the lines of a text, its runs of successive lines and, for licence files, also the
whole text. Terms are runs of ASCII letters and digits, lower case. A term's idf is
``ln((1 + N) / (1 + df)) + 1`` over all lines; terms that no template has count as unseen (df 0),
as they only lengthen a unit.

Runs find notices that are wrapped over lines. They take two or more lines, lines without words
left out and word-like comment marks dropped, and at most as many words as the longest notice
has, divided by the squared threshold: with more, at equal weights, the words besides the notice
keep the cosine below it. Runs are cut only where the words of a window cover enough of a notice.

The whole text of a licence file is also compared with whole licence texts (``licence_texts``,
one file per name). There a term that occurs k times weighs ``(1 + ln k) * idf``, as plain counts
make all legal texts alike. A match with a whole text goes before notices, which such texts may
quote for other licences ("All rights reserved.").

A unit that shares only some terms C with a template has a cosine of at most the share of the
template's length that lies in C. The most frequent terms are left out as long as that share
stays below the threshold for every template; the others are anchors, and units without any
anchor are passed over, and so are units in which terms outside the templates weigh too much
for the threshold. Distinct units are scored once, however often they occur.

A file without a licence of its own takes that of its nearest ancestor directory (its own
directory first) that has a licence file with one. Directories are resolved once each, by a join
of their ancestor paths with the directories that declare a licence.

The vocabulary of the templates, and so what the driver and the expressions hold, does not
depend on the data.

Defined cases: a NULL or empty text has no licence of its own; a NULL path has no directory; of
equal cosines the first name in alphabetical order holds, of several licence files in a directory
the best match; repeated rows are scanned each.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import Stages

# Short notices of common licences, as their publishers word them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
]
LICENCE_FILE = "(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"
# comment marks that are words: dnl, rem and the C of fixed-form Fortran
COMMENT_WORD = r"^(?:[^A-Za-z0-9]*(?:(?i:dnl|rem)(?![A-Za-z0-9]))|[Cc][ \t]{2,})"


def whole_texts() -> list[tuple[str, str]]:
    """Licences as their publishers word them in full; near relatives are there to be told apart."""
    folder = resources.files("adtally.llm") / "licence_texts"
    return sorted((f.name.removesuffix(".txt"), f.read_text()) for f in folder.iterdir() if f.name.endswith(".txt"))


def words(text: str) -> Counter:
    return Counter(re.findall("[a-z0-9]+", text.lower()))


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda x: x != "")


def _array(values) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def document_frequencies(docs: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """(number of lines, lines per vocabulary term); counted before any shuffle, one row per term."""
    known = F.transform(
        F.split("text", "\n"),
        lambda line: F.concat(F.filter(F.array_distinct(terms(line)), lambda w: w.isin(vocabulary)), F.array(F.lit(""))),
    )
    counted = docs.where("text is not null").select(F.explode(F.flatten(known)).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    found = {r.term: r.n for r in counted.collect()}  # the vocabulary at most
    return found.pop("", 0), found


class Model:
    """Weights of the templates' terms; with ``dampened``, a count of k weighs 1 + ln k."""

    def __init__(self, templates: list[tuple[str, str]], n: int, frequency: dict[str, int], threshold: float, dampened: bool = False):
        self.dampened = dampened
        self.bags = [(name, words(text)) for name, text in templates]
        self.longest = max((sum(bag.values()) for _, bag in self.bags), default=0)
        if dampened:
            self.bags = [(name, {t: 1 + math.log(k) for t, k in bag.items()}) for name, bag in self.bags]
        vocabulary = sorted({t for _, bag in self.bags for t in bag})
        self.unseen = math.log(1 + n) + 1
        self.idf = {t: math.log((1 + n) / (1 + frequency.get(t, 0))) + 1 for t in vocabulary}
        self.norm = [math.sqrt(sum((k * self.idf[t]) ** 2 for t, k in bag.items())) for _, bag in self.bags]
        common, left_out = [0.0] * len(self.bags), set()
        for term in sorted(vocabulary, key=lambda t: (self.idf[t], t)):
            grown = [c + (bag.get(term, 0) * self.idf[term]) ** 2 for c, (_, bag) in zip(common, self.bags, strict=True)]
            if any(math.sqrt(g) >= threshold * norm * (1 - 1e-9) for g, norm in zip(grown, self.norm, strict=True)):
                break
            common, _ = grown, left_out.add(term)
        self.anchors = [t for t in vocabulary if t not in left_out]
        # per template: the share of its squared length that each of its terms has
        self.shares = [{t: (k * self.idf[t] / norm) ** 2 for t, k in bag.items()} for (_, bag), norm in zip(self.bags, self.norm, strict=True)]

    def least_terms(self, threshold: float) -> int:
        """A unit with fewer different terms of the templates reaches the threshold with none of them."""
        least = []
        for shares in self.shares:
            covered, heaviest = 0.0, sorted(shares.values(), reverse=True)
            while heaviest and covered < threshold**2 * (1 - 1e-9):
                covered += heaviest.pop(0)
            least.append(len(shares) - len(heaviest))
        return min(least, default=0)


def _scored(units: DataFrame, model: Model, threshold: float) -> DataFrame:
    """``unit, licence, similarity`` of distinct units that reach the threshold. ``units`` holds ``unit, words``."""
    spark = units.sparkSession
    weights = spark.createDataFrame([(t, w) for t, w in model.idf.items()], "term string, idf double")
    rows = [(k, name, t, n * model.idf[t], model.norm[k]) for k, (name, bag) in enumerate(model.bags) for t, n in bag.items()]
    templates = spark.createDataFrame(rows, "template int, licence string, t_term string, t_weight double, t_norm double")
    tf = F.count("*").cast("double")
    counted = units.select("unit", F.explode("words").alias("term")).groupBy("unit", "term").agg((1 + F.log(tf) if model.dampened else tf).alias("tf"))
    weighed = counted.join(F.broadcast(weights), "term", "left").select(
        "unit", "term", (F.col("tf") * F.coalesce("idf", F.lit(model.unseen))).alias("weight")
    )
    norms = weighed.groupBy(F.col("unit").alias("u")).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    dots = weighed.join(F.broadcast(templates), F.col("term") == F.col("t_term")).groupBy("unit", "template", "licence", "t_norm").agg(
        F.sum(F.col("weight") * F.col("t_weight")).alias("dot")
    )
    cosine = F.round(F.col("dot") / (F.col("norm") * F.col("t_norm")), 6)
    return dots.join(norms, F.col("unit") == F.col("u")).select("unit", "licence", cosine.alias("similarity")).where(F.col("similarity") >= threshold)


def _best(similarity: str = "similarity", licence: str = "licence") -> Column:
    """The highest similarity, then the first name."""
    return F.min(F.struct((-F.col(similarity)).alias("s"), F.col(licence).alias("licence")))


def _reachable(words_: Column, model: Model, threshold: float) -> Column:
    """Could a unit of these words reach the threshold with any template? Words outside the templates count at least once each."""
    weight = F.map_from_arrays(_array(list(model.idf)), F.array(*map(F.lit, model.idf.values())))

    def weighed(known: Column) -> Column:
        squares = F.transform(
            F.array_distinct(known), lambda w: F.pow(F.size(F.filter(known, lambda x: x == w)) * F.element_at(weight, w), F.lit(2.0))
        )
        own = F.aggregate(squares, F.lit(0.0), lambda total, x: total + x)
        other = (F.size(words_) - F.size(known)) * F.lit(model.unseen**2)
        return own * F.lit(1 - threshold**2 * (1 - 1e-9)) >= F.lit(threshold**2 * (1 - 1e-9)) * other

    return _let(F.filter(words_, lambda w: w.isin(list(model.idf))), weighed)


def _covering(words_: Column, model: Model, threshold: float) -> Column:
    """Do these words hold enough of any template for a unit made of them to reach the threshold?"""

    def covered(known: Column) -> Column:
        enough = F.lit(False)
        for shares in model.shares:
            held = sum((F.when(F.array_contains(known, t), share).otherwise(0.0) for t, share in shares.items()), F.lit(0.0))
            enough = enough | (held >= threshold**2 * (1 - 1e-9))
        return enough

    return _let(F.array_distinct(F.filter(words_, lambda w: w.isin(list(model.idf)))), covered)


def _runs(text: Column, model: Model, threshold: float) -> Column:
    """The runs of two or more lines that could reach the threshold, each as its words between blanks."""
    room = math.ceil(model.longest / threshold**2)
    # a line longer than a run may be is in none, however long it is
    cut = F.transform(F.split(text, "\n"), lambda line: F.slice(terms(F.regexp_replace(line, COMMENT_WORD, "")), 1, room + 1))
    none = F.array().cast("array<string>")

    def length(sizes: Column, start: Column) -> Column:
        """Number of lines from ``start`` on that fit into a run."""
        zero = F.struct(F.lit(0).alias("words"), F.lit(0).alias("lines"))
        step = lambda at, size: F.struct(
            (at["words"] + size).alias("words"), F.when(at["words"] + size <= room, at["lines"] + 1).otherwise(at["lines"]).alias("lines")
        )
        return F.aggregate(F.slice(sizes, start, room), zero, step, lambda at: at["lines"])

    def beginning(lines: Column, start: Column, n: Column) -> Column:
        run = lambda k: F.flatten(F.slice(lines, start, k))
        runs = F.filter(F.transform(F.sequence(F.lit(2), n), run), lambda words_: _reachable(words_, model, threshold))
        possible = (n >= 2) & _let(run(n), lambda words_: F.exists(words_, lambda w: w.isin(model.anchors)) & _covering(words_, model, threshold))
        return F.when(possible, F.transform(runs, lambda words_: F.array_join(words_, " "))).otherwise(none)

    def from_lines(lines: Column) -> Column:
        starts = lambda sizes: F.flatten(F.transform(
            F.sequence(F.lit(1), F.size(lines)), lambda start: _let(length(sizes, start), lambda n: beginning(lines, start, n))
        ))
        return F.when(F.size(lines) >= 2, _let(F.transform(lines, lambda line: F.size(line)), starts)).otherwise(none)

    return _let(F.filter(cut, lambda line: F.size(line) > 0), from_lines)


def _whole_matches(files: DataFrame, model: Model, threshold: float, stages: Stages) -> DataFrame:
    """``key, licence, similarity`` of licence files that are a whole licence text. ``files`` holds ``key, text``."""
    known = F.array_distinct(F.filter(terms(F.col("text")), lambda w: w.isin(list(model.idf))))
    found = files.where(F.size(known) >= model.least_terms(threshold)).select("key", F.sha2("text", 256).alias("unit"), "text")
    found = stages.write(found, "whole")
    distinct = found.select("unit", "text").dropDuplicates(["unit"]).select("unit", terms(F.col("text")).alias("words"))
    scored = _scored(distinct, model, threshold).groupBy(F.col("unit").alias("u")).agg(_best().alias("b"))
    return found.join(scored, F.col("unit") == F.col("u")).select("key", F.col("b.licence").alias("licence"), (-F.col("b.s")).alias("similarity"))


def own_licences(docs: DataFrame, threshold: float, stages: Stages, templates=TEMPLATES, texts=None) -> DataFrame:
    """``key, licence, similarity`` of documents with a licence in one of their units. ``docs`` holds ``key, path, text``."""
    texts = whole_texts() if texts is None else texts
    n, frequency = document_frequencies(docs, sorted({t for _, text in [*templates, *texts] for t in words(text)}))
    model = Model(templates, n, frequency, threshold)
    anchored = lambda text: F.arrays_overlap(F.split(F.lower(text), "[^a-z0-9]+"), _array(model.anchors))
    is_file = F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False))
    none = F.array().cast("array<string>")
    whole = F.when(is_file, F.array("text")).otherwise(none)
    units = F.filter(F.concat(F.split("text", "\n"), whole), lambda u: anchored(u) & _let(terms(u), lambda w: _reachable(w, model, threshold)))
    units = F.concat(units, F.when(anchored(F.col("text")), _runs(F.col("text"), model, threshold)).otherwise(none))
    found = stages.write(docs.where("text is not null").select("key", F.explode(F.array_distinct(units)).alias("unit")), "units")
    distinct = found.select("unit").distinct().select("unit", terms(F.col("unit")).alias("words"))
    scored = _scored(distinct, model, threshold).groupBy("unit").agg(_best().alias("b"))
    scored = stages.write(scored.select(F.col("unit").alias("u"), F.col("b.licence").alias("licence"), (-F.col("b.s")).alias("similarity")), "scored")
    matches = found.join(scored, F.col("unit") == F.col("u")).select("key", F.lit(1).alias("rank"), "licence", "similarity")
    if texts:
        full = Model(texts, n, frequency, threshold, dampened=True)
        wholes = _whole_matches(docs.where(is_file & F.col("text").isNotNull()).select("key", "text"), full, threshold, stages)
        matches = matches.unionByName(wholes.select("key", F.lit(0).alias("rank"), "licence", "similarity"))
    best = matches.groupBy("key").agg(F.min(F.struct("rank", (-F.col("similarity")).alias("s"), "licence")).alias("b"))
    return best.select("key", F.col("b.licence").alias("licence"), (-F.col("b.s")).alias("similarity"))


def directory(path: Column) -> Column:
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit(""))


def scan(docs: DataFrame, threshold: float = 0.8, templates=TEMPLATES, texts=None) -> DataFrame:
    """``doc_id, path, licence, origin, similarity, declared_in`` per row of ``doc_id, path, text``."""
    stages = Stages(docs.sparkSession, "licences")
    # rows are told apart by a key that lasts, so that repeated ids do not mix
    key = F.xxhash64(F.col("doc_id"), F.col("path"), F.col("text"))
    keyed = docs.select(key.alias("key"), "doc_id", "path", "text")
    own = stages.write(own_licences(keyed, threshold, stages, templates, texts), "own")
    files = keyed.select("key", "doc_id", "path", directory(F.col("path")).alias("dir"))
    files = stages.write(files.join(own.withColumnRenamed("key", "k"), F.col("key") == F.col("k"), "left").drop("k"), "files")
    declared = (
        files.where(F.col("licence").isNotNull() & F.col("path").rlike(LICENCE_FILE)).groupBy(F.col("dir").alias("declared_in"))
        .agg(_best().alias("b")).select("declared_in", F.col("b.licence").alias("d_licence"), (-F.col("b.s")).alias("d_similarity"))
    )
    parts = F.split("dir", "/")
    upward = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.concat_ws("/", F.slice(parts, F.lit(1), k)))
    dirs = files.where("licence is null and dir is not null").select("dir").distinct()
    reached = dirs.select("dir", F.explode(F.array_distinct(upward)).alias("up")).join(declared, F.col("up") == F.col("declared_in"))
    nearest = reached.groupBy(F.col("dir").alias("of")).agg(
        F.max(F.struct(F.length("up").alias("depth"), "declared_in", "d_licence", "d_similarity")).alias("n")
    )
    out = files.join(nearest, (F.col("dir") == F.col("of")) & F.col("licence").isNull(), "left")
    origin = F.when(F.col("licence").isNotNull(), "own").when(F.col("n").isNotNull(), "inherited").otherwise("none")
    return out.select(
        "doc_id", "path", F.coalesce("licence", "n.d_licence").alias("licence"), origin.alias("origin"),
        F.coalesce("similarity", "n.d_similarity").alias("similarity"), F.col("n.declared_in").alias("declared_in"),
    )


def _licence_sql() -> str:
    quoted = ", ".join(f"({k}, '{name}', '{text.replace(chr(39), chr(39) * 2)}')" for k, (name, text) in enumerate(TEMPLATES))
    return f"""
WITH templates(template, licence, body) AS (VALUES {quoted}),
t_terms AS (SELECT template, licence, term, COUNT(*) AS tf FROM (
  SELECT template, licence, unnest(regexp_extract_all(lower(body), '[a-z0-9]+')) AS term FROM templates) GROUP BY ALL),
files AS (
  SELECT doc_id, text, CASE
    WHEN doc_id % 128 = 0 THEN source || '/' || lang || '/LICENSE'
    WHEN doc_id % 8 = 0 THEN source || '/' || lang || '/' || CAST(doc_id // 64 AS VARCHAR) || '/LICENSE'
    ELSE source || '/' || lang || '/' || CAST(doc_id // 64 AS VARCHAR) || '/' || CAST(doc_id AS VARCHAR) || '.txt' END AS path
  FROM documents
),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS unit FROM files WHERE text IS NOT NULL),
total AS (SELECT COUNT(*) AS n FROM lines),
units AS (
  SELECT DISTINCT doc_id, unit FROM lines
  UNION SELECT doc_id, text FROM files WHERE text IS NOT NULL AND path LIKE '%/LICENSE'
),
seen AS (SELECT term, COUNT(*) AS df FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(unit), '[a-z0-9]+'))) AS term FROM lines) GROUP BY term),
idf AS (SELECT v.term, ln((1 + n) / (1 + COALESCE(s.df, 0))) + 1 AS idf FROM (SELECT DISTINCT term FROM t_terms) v CROSS JOIN total LEFT JOIN seen s ON v.term = s.term),
t_weights AS (SELECT template, licence, t.term, tf * idf AS w FROM t_terms t JOIN idf i ON t.term = i.term),
t_norms AS (SELECT template, sqrt(SUM(w * w)) AS norm FROM t_weights GROUP BY template),
u_terms AS (SELECT unit, term, COUNT(*) AS tf FROM (
  SELECT unit, unnest(regexp_extract_all(lower(unit), '[a-z0-9]+')) AS term FROM (SELECT DISTINCT unit FROM units)) GROUP BY ALL),
u_weights AS (SELECT u.unit, u.term, u.tf * COALESCE(i.idf, ln(1 + n) + 1) AS w FROM u_terms u CROSS JOIN total LEFT JOIN idf i ON u.term = i.term),
u_norms AS (SELECT unit, sqrt(SUM(w * w)) AS norm FROM u_weights GROUP BY unit),
cosines AS (
  SELECT u.unit, t.licence, round(SUM(u.w * t.w) / (ANY_VALUE(un.norm) * ANY_VALUE(tn.norm)), 6) AS similarity
  FROM u_weights u JOIN t_weights t ON u.term = t.term JOIN u_norms un ON un.unit = u.unit JOIN t_norms tn ON tn.template = t.template
  GROUP BY u.unit, t.template, t.licence
),
own AS (
  SELECT u.doc_id, arg_min(c.licence, (-c.similarity, c.licence)) AS licence, MAX(c.similarity) AS similarity
  FROM units u JOIN cosines c ON u.unit = c.unit WHERE c.similarity >= 0.8 GROUP BY u.doc_id
),
known AS (SELECT f.doc_id, f.path, regexp_replace(f.path, '/[^/]*$', '') AS dir, o.licence, o.similarity FROM files f LEFT JOIN own o ON f.doc_id = o.doc_id),
declared AS (
  SELECT dir AS declared_in, arg_min(licence, (-similarity, licence)) AS licence, MAX(similarity) AS similarity
  FROM known WHERE licence IS NOT NULL AND path LIKE '%/LICENSE' GROUP BY dir
),
nearest AS (
  SELECT k.doc_id, arg_max(d.declared_in, length(d.declared_in)) AS declared_in
  FROM known k JOIN declared d ON k.dir = d.declared_in OR starts_with(k.dir, d.declared_in || '/') WHERE k.licence IS NULL GROUP BY k.doc_id
)
SELECT k.doc_id, k.path, COALESCE(k.licence, d.licence) AS licence,
  CASE WHEN k.licence IS NOT NULL THEN 'own' WHEN d.licence IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
  COALESCE(k.similarity, d.similarity) AS similarity, d.declared_in
FROM known k LEFT JOIN nearest n ON k.doc_id = n.doc_id LEFT JOIN declared d ON n.declared_in = d.declared_in
"""


LICENCE_SQL = _licence_sql()
