"""Licence scans: TF-IDF cosine of notices to templates, and inheritance by directory.

Each line of a text, and each line with the two after it, is compared with the templates as
a sparse TF-IDF vector. Inverse document frequencies are counted over all texts, those of the
words around a notice as those of the templates, so that common words beside a notice weigh
little and a line is judged alike in small and large tables.

Lines are found by their prefix: of a template's terms, sorted by weight, the lightest ones
whose norm stays below ``MIN_COSINE`` of the whole can never reach it alone, so a line must
have one of the others. Equal lines are scored once, however many texts share them.

A text with a notice has that licence. A licence file also gives its licence to its
directory and to all below it that have none nearer. Only distinct directories are joined
with their ancestors.

Defined results: a null or empty text has no notice of its own and inherits. A row without
path has no directory, so it neither gives nor inherits. Of equal cosines the licence first
by name wins; of several licence files in a directory the best cosine, then the licence
first by name. Repeated rows each get a row. Everything is Spark expressions and joins.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.skew import heavy_keys, lookup, salted_join
from .tables import stage_table

# The usual short notices of well-known licences, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
        "file except in compliance with the License.",
    ),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    ("CC-BY-4.0", "This work is licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

MIN_COSINE = 0.75
#: Lines after the first that a notice may go on for.
MORE_LINES = 2

_TERM = r"([\p{L}\p{N}]+)"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_TERM), F.lit(1))


def _template_terms(spark) -> DataFrame:
    rows = [(i, name, text) for i, (name, text) in enumerate(TEMPLATES)]
    made = spark.createDataFrame(rows, "template int, license string, text string")
    return (
        made.select("template", "license", F.explode(terms(F.col("text"))).alias("term"))
        .groupBy("template", "license", "term")
        .agg(F.count("*").alias("tf"))
    )


def document_frequencies(texts: DataFrame) -> DataFrame:
    """``term`` and ``df``: in how many of ``texts`` (text) each term is."""
    have = F.array_distinct(terms(F.coalesce("text", F.lit(""))))
    return texts.select(F.explode(have).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def idf_of(df: Column | float, n: int) -> Column:
    return F.log((F.lit(1.0) + n) / (F.lit(1.0) + df)) + 1


def template_weights(df: DataFrame, n: int, vocabulary: list[str]) -> dict[str, float]:
    """Inverse document frequency of each term of ``vocabulary``, which is small."""
    words = df.sparkSession.createDataFrame([(t,) for t in vocabulary], "term string")
    known = words.join(df, "term", "left").select("term", idf_of(F.coalesce("df", F.lit(0)), n))
    return dict(known.collect())


def prefix_terms(templates: list, idf: dict[str, float], least: float) -> list[str]:
    """Terms of which a line must have one to reach the cosine ``least``."""
    out = set()
    by_template: dict[int, list] = {}
    for row in templates:
        by_template.setdefault(row["template"], []).append((row["tf"] * idf[row["term"]], row["term"]))
    for weighted in by_template.values():
        weighted.sort()
        room = least**2 * sum(w * w for w, _ in weighted)
        for w, term in weighted:
            room -= w * w
            if room <= 0:
                out.add(term)
    return sorted(out)


def _notices(text: Column, pattern: str) -> Column:
    """Lines that have a prefix term, each by itself and with the lines after it."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    at = F.filter(
        F.transform(lines, lambda x, i: F.when(F.lower(x).rlike(pattern), i + 1)),
        lambda i: i.isNotNull(),
    )
    # A notice may begin up to MORE_LINES lines before the line that has the term.
    starts = F.array_distinct(
        F.flatten(F.transform(at, lambda i: F.sequence(F.greatest(i - MORE_LINES, F.lit(1)), i)))
    )
    longer = F.transform(starts, lambda i: F.array_join(F.slice(lines, i, MORE_LINES + 1), " "))
    single = F.transform(at, lambda i: F.element_at(lines, i))
    return F.array_distinct(F.concat(single, longer))


def match_notices(notices: DataFrame, template_rows: list, idf: dict, df: DataFrame, n: int,
                  least: float = MIN_COSINE) -> DataFrame:
    """``notice``, ``license``, ``score`` of the distinct ``notice`` that match a template;
    ``df``: the frequencies of all their terms in ``n`` texts."""
    spark = notices.sparkSession
    weight = {(r["template"], r["term"]): r["tf"] * idf[r["term"]] for r in template_rows}
    norm: dict[int, float] = {}
    for (template, _), w in weight.items():
        norm[template] = norm.get(template, 0.0) + w * w
    name = {r["template"]: r["license"] for r in template_rows}
    sides = spark.createDataFrame(
        [(t, name[t], term, w / math.sqrt(norm[t])) for (t, term), w in weight.items()],
        "template int, license string, term string, side double",
    )
    tf = stage_table(
        notices.select("notice").distinct()
        .select("notice", F.explode(terms(F.col("notice"))).alias("term"))
        .groupBy("notice", "term").agg(F.count("*").alias("tf")),
        "notice_terms",
    )
    used = tf.groupBy("term").agg(F.count("*").alias("n"))
    known = stage_table(
        used.join(df, "term").select("term", "n", idf_of(F.col("df"), n).alias("idf")), "notice_idf"
    )
    tf = lookup(
        tf, known.select("term", "idf"), "term", F.col("notice"), known, "n"
    ).withColumn("w", F.col("tf") * F.col("idf"))
    norms = tf.groupBy("notice").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = (
        tf.join(F.broadcast(sides), "term")
        .groupBy("notice", "template", "license").agg(F.sum(F.col("w") * F.col("side")).alias("dot"))
    )
    scored = dots.join(norms, "notice").select(
        "notice", "license", F.round(F.col("dot") / F.col("norm"), 6).alias("score")
    )
    best = F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b")
    return (
        scored.where(F.col("score") >= least)
        .groupBy("notice").agg(best)
        .select("notice", "b.license", (-F.col("b.s")).alias("score"))
    )


def inherit(found: DataFrame) -> DataFrame:
    """Give each row of ``found`` (row, doc_id, dir, license, score, is_file) without a
    licence the one of its nearest ancestor directory that has a licence file."""
    best = F.min(F.struct((-F.col("score")).alias("s"), F.col("license").alias("l"))).alias("b")
    given = (
        found.where(F.col("is_file") & F.col("license").isNotNull() & F.col("dir").isNotNull())
        .groupBy("dir").agg(best)
        .select(F.col("dir").alias("up"), F.col("b.l").alias("given"))
    )
    parts = F.split("dir", "/")
    up = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("up")),
    )
    dirs = found.where("dir is not null").select("dir").distinct()
    nearest = (
        dirs.select("dir", F.explode(up).alias("a")).select("dir", "a.depth", "a.up")
        .join(given, "up")
        .groupBy("dir").agg(F.max(F.struct("depth", "up", "given")).alias("n"))
        .select("dir", F.col("n.up").alias("from_dir"), F.col("n.given").alias("given"))
    )
    own = F.col("license").isNotNull()
    # Rows without directory keep one that no row has, spread over the tasks.
    keyed = found.withColumn("dir", F.coalesce("dir", F.concat(F.lit("\0"), "row")))
    heavy = heavy_keys(found.where("dir is not null").groupBy("dir").agg(F.count("*").alias("n")), "dir", "n")
    return salted_join(keyed, nearest, "dir", heavy, F.col("row"), "left").select(
        "row", "doc_id",
        F.coalesce("license", "given").alias("license"),
        F.when(own, F.col("score")).alias("score"),
        F.when(own, F.lit("own")).when(F.col("given").isNotNull(), F.lit("inherited"))
        .otherwise(F.lit("none")).alias("how"),
        F.when(~own, F.col("from_dir")).alias("from_dir"),
    )


def license_scan(
    docs: DataFrame, doc_id: Column, text: Column, path: Column, is_file: Column,
    least: float = MIN_COSINE,
) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``license``, ``score``, ``how`` (own,
    inherited, none) and ``from_dir``.

    ``path`` has its directory before the last slash; ``is_file`` says of a row with a
    notice of its own whether it is its directory's licence file.
    """
    spark = docs.sparkSession
    template_rows = _template_terms(spark).collect()
    vocabulary = sorted({r["term"] for r in template_rows})
    texts = docs.select(text.alias("text"))
    n, df = texts.count(), stage_table(document_frequencies(texts), "term_counts")
    idf = template_weights(df, n, vocabulary)
    prefix = "|".join(prefix_terms(template_rows, idf, least))
    pattern = rf"(?<![\p{{L}}\p{{N}}])(?:{prefix})(?![\p{{L}}\p{{N}}])"

    folder = F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), doc_id.alias("doc_id"),
        F.nullif(folder, F.lit("")).alias("dir"),
        F.coalesce(is_file, F.lit(False)).alias("is_file"), text.alias("text"),
    )
    notices = F.when(F.lower("text").rlike(pattern), _notices(F.col("text"), pattern))
    rows = rows.select("row", "doc_id", "dir", "is_file", F.explode_outer(notices).alias("notice"))
    rows = stage_table(rows, "notices")
    matched = match_notices(rows.where("notice is not null"), template_rows, idf, df, n, least)
    # Rows without notice keep one that no text has, spread over the tasks.
    keyed = rows.withColumn("notice", F.coalesce("notice", F.concat(F.lit("\n"), "row")))
    best = F.min(
        F.when(F.col("license").isNotNull(), F.struct((-F.col("score")).alias("s"), "license"))
    ).alias("b")
    found = keyed.join(matched, "notice", "left").groupBy("row", "doc_id", "dir", "is_file").agg(best)
    found = found.select(
        "row", "doc_id", "dir", "is_file", "b.license", (-F.col("b.s")).alias("score")
    )
    return inherit(stage_table(found, "licensed")).drop("row")
