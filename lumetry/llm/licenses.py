"""Scans for licence texts: MinHash over windows retrieves templates, exact containment of shingles verifies them.

DataFrame functions only. A text is cut to words and shingles of three words. Windows of twelve shingles start at every
fourth, so any eight consecutive shingles, and so any template or segment of one, lie in one window. A window's shingles
are dealt to 64 bins by their hashes, and the least of each bin is kept (one-permutation MinHash); a template is
retrieved if it has the least of any bin in common. Where the s shingles of a template or segment stand in a window, at
most 12 - s others are there, and each of the s is the least of its bin but with a probability below (12 - s) / 128. So a
template of three shingles is missed with a probability below 0.0004, one of eight with less than 1e-12.

For retrieved templates, the share of their shingles that the text has is counted exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = 3
WIDTH, STRIDE, SEGMENT = 12, 4, 8
BINS = 64
CONTAINED = 0.8

# Notices of public licences, as their publishers word them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    (
        "Apache-2.0-header",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    (
        "MIT-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    (
        "BSD-3-Clause-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    (
        "GPL-3.0-header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "MPL-2.0-header",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
]


def shingle_hashes(text: str | Column) -> Column:
    """The hashes of all runs of WORDS words (a to z and digits, lower case) of a text, in order; empty for fewer words."""
    words = F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")

    def hashed(words: Column) -> Column:
        run = lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WORDS)))
        some = F.transform(F.sequence(F.lit(0), F.size(words) - WORDS), run)
        return F.when(F.size(words) >= WORDS, some).otherwise(F.array().cast("array<bigint>"))

    return F.get(F.transform(F.array(words), hashed), F.lit(0))  # the words are made once


def least_of_bins(hashes: Column) -> Column:
    """The least hash of each bin; the bin is the hash's top bits, so that it is the first one of its bin in order."""
    bits = 64 - (BINS - 1).bit_length()
    ordered = F.array_sort(hashes)
    bin_of = lambda h: F.shiftrightunsigned(h, bits)
    return F.transform(
        F.array(ordered), lambda o: F.filter(o, lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(o, i - 1))))
    )[0]


def template_keys(spark: SparkSession, templates: list[tuple[str, str]]) -> list[tuple[str, list[int], list[int]]]:
    """Of each template: its id, its different shingles, and the least of the bins of all its segments."""
    if not templates:
        return []
    given = F.array(*(F.struct(F.lit(i).alias("license"), F.lit(t).alias("text")) for i, t in templates))
    rows = spark.range(1).select(F.inline(given))
    shingles = rows.select("license", shingle_hashes("text").alias("h")).where(F.size("h") > 0)
    last = F.greatest(F.lit(0), F.size("h") - SEGMENT)
    starts = F.array_distinct(F.concat(F.sequence(F.lit(0), last, F.lit(SEGMENT)), F.array(last)))
    parts = F.flatten(F.transform(starts, lambda i: least_of_bins(F.slice(F.col("h"), i + 1, F.lit(SEGMENT)))))
    chosen = shingles.select("license", F.array_distinct("h").alias("h"), F.array_distinct(parts).alias("keys"))
    return [(r["license"], r["h"], r["keys"]) for r in chosen.collect()]  # as many as the given templates


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, contained: float = CONTAINED) -> DataFrame:
    """doc_id, license, n_shared and containment of every text and template of which at least that share of the shingles
    stands in the text.

    Whole texts are scanned. Null, empty and short texts match nothing, nor do templates of fewer than three words. Rows
    that repeat a doc_id have rows each. Other columns are not read. Templates are a list in memory by design: some
    thousands at most.
    """
    spark = docs.sparkSession
    keyed = template_keys(spark, templates)
    if not keyed:
        none = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where(F.lit(False))
        return none.selectExpr("doc_id", "'' AS license", "0L AS n_shared", "0D AS containment")
    wanted = sorted({key for _, _, keys in keyed for key in keys})
    # A generator of one row keeps Spark from working an array out again for every use and filter of it.
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(F.array(shingle_hashes("text"))).alias("h"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("h"), F.lit(1)), F.lit(STRIDE))
    least = F.transform(starts, lambda i: least_of_bins(F.slice(F.col("h"), i, F.lit(WIDTH))))
    found = F.filter(F.flatten(least), lambda key: key.isin(wanted))
    windows = hashed.select("doc_id", "h", F.explode(F.array(found)).alias("found"))
    retrieved = windows.where(F.size("found") > 0).select("doc_id", "h", F.array_distinct("found").alias("found"))
    # The templates are few by design, so each text that has any of their keys meets all of them.
    pairs = retrieved.withColumn("template", F.explode(_literals(keyed))).where(F.arrays_overlap("found", "template.keys"))
    shared = F.size(F.array_intersect("h", "template.shingles"))
    counted = pairs.select(
        "doc_id",
        F.col("template.license").alias("license"),
        shared.cast("long").alias("n_shared"),
        (shared / F.size("template.shingles")).alias("containment"),
    )
    return counted.where(F.col("containment") >= contained)


def _literals(keyed: list[tuple[str, list[int], list[int]]]) -> Column:
    longs = lambda values: F.array(*(F.lit(v).cast("long") for v in values))
    return F.array(
        *(F.struct(F.lit(i).alias("license"), longs(h).alias("shingles"), longs(k).alias("keys")) for i, h, k in keyed)
    )
