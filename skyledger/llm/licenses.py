"""License notices in texts: MinHash bands retrieve templates, shingle containment verifies them.

Texts and templates are runs of lower-case words; shingles are five words (a shorter
template is one shingle). Windows as long as a template's length class, starting at each
place that may matter, overlap all along the text.

* *Where windows start.* A window can reach the containment threshold only if it holds at
  least one shingle of a template, so windows are laid around every such shingle, and nowhere
  else. That loses nothing, and texts without any (most) stop here.
* *Retrieval.* A window and a template meet if any of ``BANDS`` MinHash bands of ``ROWS`` rows
  agree. The window around a notice that holds ``CONTAINED`` of a template's shingles, and is
  no longer than twice the template, has Jaccard similarity of at least ``CONTAINED /
  (3 - CONTAINED)``; with these settings such a pair is missed with probability of
  ``(1 - 0.36) ** 48``, less than one in a thousand million.
* *Verification.* The share of the template's shingles that the window holds is counted exactly.

Null and empty texts have no notices. Templates are a parameter; they are literals of the plan,
``TEMPLATES_AT_ONCE`` in each of as many scans as it takes, all with the windows that the lengths of
all templates ask for. Equal templates are found under each of their names; repeated texts are separate rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import ids_and_texts
from skyledger.operators.stages import computed_once

SHINGLE = 5
CONTAINED = 0.8
BANDS, ROWS = 48, 1
WORDS = r"[a-z0-9]+"
TEMPLATES_AT_ONCE = 500

#: Notices by name (fixed values).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                         "compliance with the License. You may obtain a copy of the License at",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                    "that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                      "General Public License as published by the Free Software Foundation",
    "MIT": "Released under the MIT License.",
    "MIT-header": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORDS), F.lit(0))


def shingles_of(words: Column) -> Column:
    """The hash of each run of five words, in order; fewer words are one run."""

    def run(i: Column) -> Column:
        return F.xxhash64(F.array_join(F.slice(words, i, F.lit(SHINGLE)), " "))

    last = F.greatest(F.lit(1), F.size(words) - SHINGLE + 1)
    return F.when(F.size(words) > 0, F.transform(F.sequence(F.lit(1), last), run)).otherwise(F.array().cast("array<bigint>"))


def minhash_bands(shingles: Column) -> Column:
    """One value for each band: the least of the shingles' hashes under the band's seeds."""

    def band(b: int) -> Column:
        least = [F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, F.lit(b * ROWS + r)))) for r in range(ROWS)]
        return F.xxhash64(F.lit(b), *least)

    return F.array(*[band(b) for b in range(BANDS)])


def template_rows(docs: DataFrame, templates: dict[str, str]) -> DataFrame:
    """(name, shingles, length, bands) of the templates that have words."""

    given = docs.sparkSession.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(text).alias("text")) for name, text in sorted(templates.items())])).alias("t"))
    cut = given.select("t.name", words_of(F.col("t.text")).alias("words")).filter(F.size("words") > 0)
    return cut.select("name", F.size("words").alias("length"), F.array_distinct(shingles_of(F.col("words"))).alias("shingles")).withColumn(
        "bands", minhash_bands(F.col("shingles")))


def license_hits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None,
                 at_once: int = TEMPLATES_AT_ONCE) -> DataFrame:
    """(row, id, name, first_word, last_word, contained): the best window of each notice in each text."""

    given = sorted((TEMPLATES if templates is None else templates).items())
    scans = [template_rows(docs, dict(given[at:at + at_once])) for at in range(0, len(given), at_once)] or [template_rows(docs, {"": ""})]
    # The templates came from the caller, so their shingles fit the driver; they become literals of the plan.
    shingles = [known.select("length", "shingles").collect() for known in scans]
    lengths = sorted({r["length"] for rows in shingles for r in rows})
    found = [_hits_of(docs, id_col, text_col, known, rows, lengths) for known, rows in zip(scans, shingles)]
    return reduce(DataFrame.unionByName, found)


def _hits_of(docs: DataFrame, id_col: str, text_col: str, known: DataFrame, rows: list, lengths: list[int]) -> DataFrame:
    """The hits of the templates ``known``, whose lengths and shingles are ``rows``, in windows of all ``lengths``."""

    wanted = sorted({s for r in rows for s in r["shingles"]})
    listed = F.array(*[F.lit(s) for s in wanted]).cast("array<bigint>")
    texts = ids_and_texts(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    cut = computed_once(texts, words_of(F.col("text")).alias("words"), keep=["row", "id"])
    shingled = computed_once(cut, shingles_of(F.col("words")).alias("shingles"), keep=["row", "id"])
    flagged = shingled.filter(F.arrays_overlap("shingles", listed))
    # Places (from 0) of shingles that some template holds, and windows of every length that start at or before them.
    places = flagged.select("row", "id", "shingles", F.filter(
        F.transform("shingles", lambda s, i: F.when(F.array_contains(listed, s), i)), lambda i: i.isNotNull()).alias("places"))
    starts = places.select("row", "id", "shingles", F.explode("places").alias("start"))
    sized = starts.select("row", "id", "shingles", "start", F.explode(F.array(*[F.lit(n) for n in lengths]).cast("array<int>")).alias("length"))
    # A notice that lost its first words starts at its first shingle that is left, so windows start at such places.
    windows = computed_once(sized, F.array_distinct(F.slice(
        "shingles", F.col("start") + 1, F.greatest(F.lit(1), F.col("length") - SHINGLE + 1))).alias("window"),
        keep=["row", "id", "start", "length"])
    banded = windows.withColumn("band", F.explode(minhash_bands(F.col("window"))))
    by_band = known.select("name", F.col("shingles").alias("template"), F.explode("bands").alias("band"))
    met = banded.join(F.broadcast(by_band), "band").select("row", "id", "start", "length", "name", "window", "template")
    # Windows meet a template in many bands; the test is exact, so it may run for each.
    held = met.withColumn("contained", F.size(F.array_intersect("window", "template")) / F.size("template")).filter(
        F.col("contained") >= CONTAINED)
    best = held.groupBy("row", "id", "name").agg(F.max(F.struct(
        F.col("contained"), (-F.col("start")).alias("from"), (-F.col("length")).alias("short"))).alias("best"))
    return best.select("row", "id", "name", (-F.col("best.from")).alias("first_word"),
                       (-F.col("best.from") - F.col("best.short") - 1).alias("last_word"), "best.contained")


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """(id, license, first_word, last_word, contained), a row for each notice found; word places count from 0."""

    hits = license_hits(docs, id_col, text_col, templates)
    return hits.select("id", F.col("name").alias("license"), F.col("first_word").cast("long"), F.col("last_word").cast("long"), "contained")
