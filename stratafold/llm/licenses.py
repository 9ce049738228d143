"""License notices in texts.

Texts become words and overlapping shingles of three of them.  Shingles that no template has
are left out by a join; what remains is gathered in windows of text, each twice as long as
the templates it is meant for and starting halfway through the one before, so that every
notice lies whole in one of them.  MinHash bands of a window retrieve templates, and exact
shingle containment decides.

A window for templates of n shingles holds fewer than 4 n shingles.  If it contains the share
c of a template, their Jaccard similarity is therefore at least c / (5 - c), and with single-row bands
the number of bands follows from the chance allowed for missing it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafold.operators.joins import broadcast_if_small

SHINGLE_WORDS = 3
CONTAINMENT = 0.8
# Chance that the bands miss a window that contains enough of a template.
MISS = 1e-6

# License notices as published with the licenses.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mit": "Released under the MIT License.",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def bands(containment: float = CONTAINMENT, miss: float = MISS) -> int:
    """Single-row bands that find a window of enough containment but for the chance ``miss``."""
    similar = containment / (5 - containment)
    return math.ceil(math.log(miss) / math.log(1 - similar))


def words(text: Column) -> Column:
    """Runs of ASCII letters and digits, in lower case."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def shingles(text: Column, size: int = SHINGLE_WORDS) -> Column:
    """Hashes of all runs of ``size`` words, in order; none if there are fewer words."""

    def hashed(found: Column) -> Column:
        def one(word: Column, i: Column) -> Column:
            following = [F.get(found, i + k) for k in range(1, size)]
            return F.when(following[-1].isNotNull(), F.xxhash64(word, *following))

        return F.filter(F.transform(found, one), lambda h: h.isNotNull())

    # The array around the words makes them a variable that is computed once.
    return F.transform(F.array(words(text)), hashed)[0]


def template_table(spark: SparkSession, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """template, hashes (distinct), width: the smallest power of two that holds them."""
    listed = F.array(*[F.struct(F.lit(n).alias("template"), F.lit(t).alias("text")) for n, t in sorted(templates.items())])
    rows = spark.range(1).select(F.explode(listed).alias("t")).select("t.*")
    sets = rows.select("template", F.array_distinct(shingles(F.col("text"))).alias("hashes")).filter(F.size("hashes") > 0)
    return sets.withColumn("width", F.pow(2, F.ceil(F.log2(F.size("hashes")))).cast("int"))


def _signature(hashes: Column, count: int) -> Column:
    """The bands of a set: for each of ``count`` hash functions its smallest value, with the function's number."""

    def band(number: Column) -> Column:
        return F.struct(number.alias("band"), F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, number))).alias("low"))

    return F.transform(F.sequence(F.lit(1), F.lit(count)), band)


def scan_licenses(docs: DataFrame, templates: DataFrame, containment: float = CONTAINMENT, miss: float = MISS) -> DataFrame:
    """One row per document and template found: doc_id, template, containment, word.

    Needs ``doc_id`` and ``text``, reads no others.  ``containment`` is the largest share of
    the template's distinct shingles within one window, ``word`` the first word of the first
    such window.  NULL and empty texts hold nothing.  Rows that repeat doc_id and text are one document; a
    NULL doc_id is passed on.  A template of fewer than three words is never found.
    """
    vocabulary = templates.select(F.explode("hashes").alias("hash"), "width").distinct()
    placed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(shingles(F.col("text"))).alias("at", "hash"))
    hits = placed.join(broadcast_if_small(vocabulary), "hash")
    # Windows of twice the width begin at every multiple of it, so a place lies in two of them.
    number = F.floor(F.col("at") / F.col("width"))
    both = hits.select("doc_id", "text_key", "hash", "width", F.explode(F.array(number - 1, number)).alias("window")).filter("window >= 0")
    windows = both.groupBy("doc_id", "text_key", "width", "window").agg(F.collect_set("hash").alias("held"))

    count = bands(containment, miss)
    key = ["doc_id", "text_key", "width", "window", "held"]
    searched = windows.select(*key, F.explode(_signature(F.col("held"), count)).alias("b")).select(*key, "b.band", "b.low")
    indexed = templates.select("template", "hashes", "width", F.explode(_signature(F.col("hashes"), count)).alias("b")).select(
        "template", "hashes", "width", "b.band", "b.low"
    )
    share = F.size(F.array_intersect("held", "hashes")) / F.size("hashes")
    found = searched.join(broadcast_if_small(indexed), ["width", "band", "low"]).withColumn("share", share).filter(F.col("share") >= containment)
    # The best share, then the first window.
    best = F.max(F.struct(F.col("share"), (-F.col("window") * F.col("width")).alias("back"))).alias("best")
    return found.groupBy("doc_id", "text_key", "template").agg(best).select(
        "doc_id", "template", F.col("best.share").alias("containment"), (-F.col("best.back")).alias("word")
    )


_ROWS = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in TEMPLATES.items())

SQL = f"""
WITH templates(template, text) AS (VALUES {_ROWS}),
texts AS (
    SELECT doc_id, NULL AS template, text FROM documents
    UNION ALL SELECT NULL, template, text FROM templates
), words AS (
    SELECT doc_id, template, list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda w: w <> '') AS w FROM texts
), shingles AS (
    SELECT doc_id, template, unnest(range(0, greatest(len(w) - {SHINGLE_WORDS - 1}, 0))) AS place, w FROM words
), placed AS (
    SELECT doc_id, template, place, w[place + 1] || ' ' || w[place + 2] || ' ' || w[place + 3] AS shingle FROM shingles
), held AS (
    SELECT DISTINCT template, shingle FROM placed WHERE template IS NOT NULL
), sizes AS (
    SELECT template, count(*) AS n, (2 ** ceil(log2(count(*))))::BIGINT AS width FROM held GROUP BY template
), hits AS (
    SELECT DISTINCT doc_id, h.template, n, width, p.shingle, unnest([place // width - 1, place // width]) AS win
    FROM placed p JOIN held h USING (shingle) JOIN sizes s ON s.template = h.template
    WHERE p.template IS NULL
), shares AS (
    SELECT doc_id, template, win * width AS word, count(*) / n AS containment
    FROM hits WHERE win >= 0 GROUP BY doc_id, template, win, width, n
)
SELECT doc_id, template, max(containment) AS containment, arg_min(word, (-containment, word)) AS word
FROM shares WHERE containment >= {CONTAINMENT} GROUP BY doc_id, template
"""
