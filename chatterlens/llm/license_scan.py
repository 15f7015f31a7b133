"""Licence scans: TF-IDF cosine of notices and licence files to templates, then inheritance from directories.

A passage is a line with a cue word, a run of comment lines joined to one line, or all of a licence file's text and its
head. Its terms are weighted by count and by the inverse document frequency over the templates (a term of no template
has the highest); the template of the largest cosine names the licence, if no other licence comes close. A declared SPDX
identifier is taken as it stands and comes first. A file without a notice of its own has the licence of the nearest
directory above it that holds a licence file. DataFrame functions only.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterlens.llm.steps import stored

THRESHOLD = 0.6
LEAD = 0.8  # the best licence lacks at most this share of what the next one lacks of a cosine of 1
HEAD = 50  # characters of a licence file's head, white space counted once
BROADCAST_ROWS = 500_000

#: Licence and text of usual notices. Fixed values.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of "
        "its contributors may be used to endorse or promote products derived from this software without specific "
        "prior written permission.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version.",
    ),
    (
        "LGPL-3.0",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction',
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
]

#: Licence and its name in short notices. Fixed values.
NAMES = [
    ("0BSD", "BSD Zero Clause License"),
    ("AGPL-3.0", "GNU Affero General Public License, version 3"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("Artistic-2.0", "Artistic License 2.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSL-1.0", "Boost Software License, Version 1.0"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-NC-SA-4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC0-1.0", "Creative Commons CC0 1.0 Universal Public Domain Dedication"),
    ("EPL-2.0", "Eclipse Public License, version 2.0"),
    ("GPL-2.0", "GNU General Public License, version 2"),
    ("GPL-3.0", "GNU General Public License, version 3"),
    ("ISC", "ISC License"),
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3"),
    ("MIT", "MIT License"),
    ("MPL-2.0", "Mozilla Public License, version 2.0"),
    ("Unlicense", "Unlicense"),
    ("Zlib", "zlib License"),
]
PHRASES = ("Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.", "{}")
TEMPLATES = NOTICES + [(licence, phrase.format(name)) for licence, name in NAMES for phrase in PHRASES]

CUES = ("licens", "licenc", "copyright", "spdx", "permission", "redistribut", "public domain")
LICENCE_FILE = r"(?i)(^|/)(licen[cs]es?|copying|unlicense)([._-][^/]*)?$"
#: The break before a comment line that follows another line.
COMMENT_BREAK = r"\n[ \t]*(//+|#+|\*+|--+|;+|%+)[ \t]*"
SPDX = r"(?i)spdx-license-identifier:[ \t]*([a-z0-9]([a-z0-9.+-]*[a-z0-9+])?([ \t]+(and|or|with)[ \t]+[a-z0-9]([a-z0-9.+-]*[a-z0-9+])?)*)"
_TERM = r"[a-z]+|[0-9]+(\.[0-9]+)*"
_CUE = "|".join(CUES)


def template_weights(templates: list[tuple[str, str]] = TEMPLATES) -> tuple[list[tuple[str, float]], list[tuple]]:
    """((term, idf), ...) and ((term, template, licence, weight), ...) with weight vectors of length 1."""
    counts = [Counter(m[0] for m in re.finditer(_TERM, text.lower())) for _, text in templates]
    spread = Counter(term for count in counts for term in count)
    idf = {term: math.log((1 + len(templates)) / (1 + n)) + 1 for term, n in spread.items()}
    weights = []
    for number, ((licence, _), count) in enumerate(zip(templates, counts)):
        norm = math.sqrt(sum((n * idf[term]) ** 2 for term, n in count.items()))
        weights += [(term, number, licence, n * idf[term] / norm) for term, n in count.items()]
    return sorted(idf.items()), weights


def highest_idf(templates: list[tuple[str, str]] = TEMPLATES) -> float:
    return math.log(1 + len(templates)) + 1


def passages(files: DataFrame) -> DataFrame:
    """(path, key, place, passage): lower-cased lines and joined comment lines with a cue; of licence files that have
    one also the whole and its head.

    Only texts with a cue are cut into lines.
    """
    low = F.lower("text")
    cued = files.where("path IS NOT NULL").withColumn("low", low).where(F.col("low").rlike(_CUE))
    joined = F.regexp_replace("low", COMMENT_BREAK, " ")
    lines = F.filter(F.array_union(F.split("low", "\n"), F.split(joined, "\n")), lambda line: line.rlike(_CUE))
    whole = F.array(F.col("low"), F.left(F.ltrim(F.regexp_replace("low", r"[ \t\r\n]+", " ")), F.lit(HEAD)))
    found = F.when(F.col("path").rlike(LICENCE_FILE), F.array_union(whole, lines)).otherwise(lines)
    return cued.select("path", "key", F.posexplode(found).alias("place", "passage"))


def declared(files: DataFrame) -> DataFrame:
    """(path, key, licence) of files that declare an SPDX identifier; the first one counts."""
    found = files.where("path IS NOT NULL AND contains(lower(text), 'spdx-license-identifier')")
    found = found.select("path", "key", F.regexp_extract("text", SPDX, 1).alias("licence"))
    return found.where("licence != ''").distinct()


def best_licences(files: DataFrame, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    """(path, key, licence, score) of files with an identifier, or with a passage that reaches the threshold.

    A passage whose best licence has no ``LEAD`` before the next one names none. Of several passages the best
    score counts, then the first name. An identifier has the score 1.
    """
    spark = files.sparkSession
    idf, weights = template_weights(templates)
    idf = F.broadcast(spark.createDataFrame(idf, "term string, idf double"))
    weights = F.broadcast(spark.createDataFrame(weights, "term string, template int, licence string, weight double"))
    terms = passages(files).select("path", "key", "place", F.explode(F.regexp_extract_all("passage", F.lit(f"({_TERM})"), F.lit(1))).alias("term"))
    terms = terms.groupBy("path", "key", "place", "term").agg(F.count("*").alias("n")).join(idf, "term", "left")
    terms = stored(terms.withColumn("w", F.col("n") * F.coalesce("idf", F.lit(highest_idf(templates)))), "terms")
    by_passage = ("path", "key", "place")
    norms = terms.groupBy(*by_passage).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = terms.join(weights, "term").groupBy(*by_passage, "template", "licence").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scored = dots.join(norms, list(by_passage)).withColumn("score", F.round(F.col("dot") / F.col("norm"), 6))
    ranked = scored.groupBy(*by_passage, "licence").agg((-F.max("score")).alias("minus")).groupBy(*by_passage)
    ranked = ranked.agg(F.array_sort(F.collect_list(F.struct("minus", "licence"))).alias("ranked"))  # as many as licences
    first, second = (F.get("ranked", F.lit(n)) for n in range(2))
    lead = (first["minus"] < second["minus"]) & (1 + first["minus"] <= LEAD * (1 + second["minus"]))
    clear = F.coalesce(lead, F.lit(True))
    named = ranked.where((-first["minus"] >= threshold) & clear).select("path", "key", F.lit(1).alias("after"), first["minus"].alias("minus"), first["licence"].alias("licence"))
    tagged = declared(files).select("path", "key", F.lit(0).alias("after"), F.lit(-1.0).alias("minus"), "licence")
    best = named.union(tagged).groupBy("path", "key").agg(F.min(F.struct("after", "minus", "licence")).alias("best"))
    return best.select("path", "key", F.col("best.licence").alias("licence"), (-F.col("best.minus")).alias("score"))


def directory(path: Column) -> Column:
    """All before the last slash; empty without one."""
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)


def inherited(directories: DataFrame, held: DataFrame) -> DataFrame:
    """(directory, from, licence, score): for each directory the licence of itself or the nearest one above.

    ``held`` has (directory, licence, score). The top, an empty path, is above all.
    """
    parts = F.split("directory", "/")
    above = directories.select("directory", F.explode(F.sequence(F.lit(0), F.when(F.col("directory") == "", 0).otherwise(F.size(parts)))).alias("depth"))
    above = above.withColumn("above", F.array_join(F.slice(F.split("directory", "/"), F.lit(1), F.col("depth")), "/"))
    held = held.select(F.col("directory").alias("above"), "licence", "score")
    nearest = above.join(_checked(held), "above").groupBy("directory")
    nearest = nearest.agg(F.max(F.struct("depth", "above", "licence", "score")).alias("nearest"))
    return nearest.select("directory", F.col("nearest.above").alias("from"), "nearest.licence", "nearest.score")


def _checked(rows: DataFrame) -> DataFrame:
    """Broadcast up to ``BROADCAST_ROWS`` short rows; more are joined by a shuffle."""
    rows = stored(rows, "licence-rows")
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def licences(
    files: DataFrame,
    path: str = "path",
    text: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Add licence, licence_from, licence_how and licence_score to every file; columns of these names are replaced.

    ``licence_how`` is ``own`` for a notice or an identifier in the file's text (``licence_from`` is then its path), ``inherited`` for
    the nearest directory above that holds a licence file (``licence_from`` is the directory, empty for the top), or
    null. Of several licence files of a directory the best score counts, then the first name. A null path has no
    directory and no licence; a null or empty text has no notice, but inherits. Rows that repeat path and text are
    judged alike; a path with several texts judges each.
    """
    files = files.drop("licence", "licence_from", "licence_how", "licence_score")
    key = F.xxhash64(F.col(text))
    rows = files.select(F.col(path).alias("path"), F.col(text).alias("text"), key.alias("key"))
    own = stored(best_licences(rows, templates, threshold), "notices")
    holders = own.where(F.col("path").rlike(LICENCE_FILE)).groupBy(directory(F.col("path")).alias("directory"))
    held = holders.agg(F.min(F.struct((-F.col("score")).alias("minus"), "licence")).alias("best"))
    held = held.select("directory", F.col("best.licence").alias("licence"), (-F.col("best.minus")).alias("score"))
    directories = rows.where("path IS NOT NULL").select(directory(F.col("path")).alias("directory")).distinct()
    given = inherited(directories, held)
    own = own.select(F.col("path").alias("__path"), F.col("key").alias("__key"), F.col("licence").alias("__own"), F.col("score").alias("__own_score"))
    given = given.select(F.col("directory").alias("__directory"), F.col("from").alias("__from"), F.col("licence").alias("__given"), F.col("score").alias("__given_score"))
    found = files.join(_checked(own), (F.col(path) == F.col("__path")) & (key == F.col("__key")), "left")
    found = found.join(_checked(given), directory(F.col(path)) == F.col("__directory"), "left")
    return found.select(
        *[f"`{name}`" for name in files.columns],
        F.coalesce("__own", "__given").alias("licence"),
        F.when(F.col("__own").isNotNull(), F.col(path)).otherwise(F.col("__from")).alias("licence_from"),
        F.when(F.col("__own").isNotNull(), "own").when(F.col("__given").isNotNull(), "inherited").alias("licence_how"),
        F.coalesce("__own_score", "__given_score").alias("licence_score"),
    )
