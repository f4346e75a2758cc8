"""License scans: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies.

Words are lower-cased runs without ASCII punctuation or blanks; shingles are five words. Each template is cut into
overlapping passages of at most `PASSAGE` words, each text into windows of `WINDOW` words every `STRIDE` words, so a passage that
stands in a text stands whole in one of its windows. A window of 12 shingles that holds a passage has likeness J of at least
1/12 with it (a passage of one shingle), so with bands of one row it collides in at least one of `BANDS` bands with probability
1 - (1 - J)**BANDS, above 1 - 1e-6; the number of bands is computed from that.

A window can only collide in a band if it holds the very shingle that is a passage's minimum there; windows (and texts)
without any such shingle are left out before signatures are computed, which changes no collision.

Candidates are verified exactly: the share of the template's shingles found in the stretch around the window (the template's
length to either side) must reach `LEAST`. Only built-in functions run; the template list is a bounded parameter and is broadcast.

Defined cases: null or empty texts match nothing; repeated rows match each; templates shorter than a shingle count as one
shingle of all their words; an empty table or template list gives none; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stash

SHINGLE, LEAST = 5, 0.8
PASSAGE, WINDOW, STRIDE = 8, 16, 8
MISS = 1e-6

#: fixed values: public license notices and openings or clauses of license texts. Notices that differ in a version number are
#: cut so that the number's shingles are over a fifth of theirs: a text with another version stays below `LEAST`.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, "
                "either version 3 of the License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
                   "on an AS IS BASIS"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("GPL-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation; "
                "either version 2 of the License"),
    ("LGPL-2.1", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; "
                 "either version 2.1 of the License"),
    ("LGPL-3.0", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, "
                 "either version 3 of the License"),
    ("LGPL-3.0", "incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the "
                 "additional permissions listed below"),
    ("AGPL-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, "
                 "either version 3 of the License"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                     "products derived from this software without specific prior written permission"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies"),
    ("PostgreSQL", "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, "
                   "and without a written agreement is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-3.0", "Licensed under a Creative Commons Attribution 3.0 Unported License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-3.0", "Licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."),
    ("CC-BY-ND-4.0", "Licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "Licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "Licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("EPL-1.0", "the terms of the Eclipse Public License v1.0"),
    ("EPL-2.0", "under the terms of the Eclipse Public License 2.0"),
    ("MPL-1.1", "are subject to the Mozilla Public License Version 1.1"),
    ("CDDL-1.0", "The contents of this file are subject to the terms of the Common Development and Distribution License"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Zlib", "In no event will the authors be held liable for any damages arising from the use of this software"),
    ("Artistic-2.0", "You are permitted to use the Standard Version and create and use Modified Versions for any purpose without restriction"),
    ("EUPL-1.2", "Licensed under the EUPL, Version 1.2"),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("GFDL", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License"),
    ("ODbL", "This database is made available under the Open Database License"),
    ("MS-PL", "This license governs use of the accompanying software. If you use the software, you accept this license."),
    ("All-Rights-Reserved", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any "
                            "form or by any means"),
)
_BREAKS = r"[\x00-/:-@\[-`{-\x7f]+"


def words(text: Column) -> Column:
    """Lower-cased words, in order."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _BREAKS), lambda w: w != "")


def shingles(w: Column, size: int = SHINGLE) -> Column:
    """Hash of each run of ``size`` words; of all words if they are fewer; none without words."""
    n = F.size(w)
    at = F.when(n >= size, F.sequence(F.lit(0), n - size)).when(n > 0, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))


def bands_needed(least_likeness: float, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log1p(-least_likeness))


BANDS = bands_needed(1 / (WINDOW - SHINGLE + 1))


def signature(hashes: Column, bands: int) -> Column:
    """Minimum of each band's permutation over the shingles."""
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda j: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, j))))


def template_table(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """``template, license, hashes, n_words``; one row per template text."""
    rows = docs.sparkSession.createDataFrame([(i, a, b) for i, (a, b) in enumerate(templates)], "template int, license string, text string")
    w = rows.withColumn("w", words(F.col("text")))
    return w.select("template", "license", F.array_distinct(shingles(F.col("w"))).alias("hashes"), F.size("w").alias("n_words"), "w")


def scan(docs: DataFrame, templates=TEMPLATES, least: float = LEAST, bands: int = BANDS) -> DataFrame:
    """``doc_id, license, containment, n_windows, first_word`` of every document and license found in it."""
    known = template_table(docs, templates).where("size(hashes) > 0")
    step = PASSAGE // 2
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("n_words") - PASSAGE + step), F.lit(step))
    passages = known.select("template", F.explode(starts).alias("s"), "w").select(
        "template", F.array_distinct(shingles(F.slice("w", F.col("s"), F.lit(PASSAGE)))).alias("p"))
    minima = stash(passages.select("template", F.posexplode(signature(F.col("p"), bands)).alias("band", "least"), "p"), "minima")
    # the shingle behind each minimum: only windows that hold one can collide
    behind = minima.select(F.explode(F.filter("p", lambda h: F.xxhash64(h, F.col("band")) == F.col("least"))).alias("h")).distinct()
    hot = [r["h"] for r in behind.collect()]  # bounded by the template list
    if not hot:
        return docs.select("doc_id").limit(0).select("doc_id", F.lit("").alias("license"), F.lit(0.0).alias("containment"), F.lit(0).cast("long").alias("n_windows"), F.lit(0).alias("first_word"))
    hot_hashes = F.array(*[F.lit(h) for h in sorted(hot)])
    longest = max(len(b.split()) for _, b in templates) + WINDOW
    size = WINDOW - SHINGLE + 1

    def windows(all_: Column) -> Column:
        """Those windows of a text that hold a hot shingle, with their surroundings."""
        def window(start: Column) -> Column:
            return F.struct(start.alias("start"), F.slice(all_, start, F.lit(size)).alias("window"))

        def around(w: Column) -> Column:
            begin = F.greatest(F.lit(1), w["start"] - longest)
            return F.struct(w["start"].alias("start"), w["window"].alias("window"), (w["start"] - begin).alias("lead"),
                            F.slice(all_, begin, F.lit(2 * longest + WINDOW)).alias("near"))

        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(all_)), F.lit(STRIDE))
        hit = F.filter(F.transform(starts, window), lambda w: F.arrays_overlap(w["window"], hot_hashes))
        return F.when(F.arrays_overlap(all_, hot_hashes), F.transform(hit, around))

    found = let(let(words(F.col("text")), lambda w: shingles(w)), windows)
    numbered = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    cut = numbered.select("doc_id", "row", F.explode_outer(found).alias("x")).where("x is not null").select("doc_id", "row", "x.*")
    signed = cut.select("doc_id", "row", "start", "near", "lead", F.posexplode(signature(F.col("window"), bands)).alias("band", "least"))
    banded = signed.join(F.broadcast(minima.select("template", "band", "least").distinct()), ["band", "least"])
    candidates = banded.groupBy("row", "start", "template").agg(F.first("doc_id").alias("doc_id"), F.first("near").alias("near"), F.first("lead").alias("lead"))
    checked = candidates.join(F.broadcast(known.select("template", "license", "hashes", "n_words")), "template")
    n = F.col("n_words")
    own = F.slice("near", F.greatest(F.lit(1), F.col("lead") + 1 - n), F.least(F.col("lead"), n) + F.lit(WINDOW) + n)
    share = F.size(F.array_intersect("hashes", own)) / F.size("hashes")
    good = checked.withColumn("share", share).where(F.col("share") >= least)
    return good.groupBy("row", "license").agg(F.first("doc_id").alias("doc_id"), F.max("share").alias("containment"),
                                              F.count_distinct("start").alias("n_windows"), F.min("start").alias("first_word")).select(
        "doc_id", "license", "containment", "n_windows", "first_word")
