"""Licence scan in DataFrame functions only: sparse TF-IDF cosine to templates, then inheritance from directories.

Notices are the lines of a text that name a licence or a copyright, its header blocks (wrapped or comment lines that stand
together, put into one) and the whole text of a licence file. Distinct notices are scored once against the templates of all
kinds (short notice, header, title, full text) by a join on terms; SPDX tags are read for what they name. A file without a notice of its own takes the licence of the
licence file in the nearest directory above it, found by a join on its ancestor paths.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgraph.plans.lookup import lookup_join
from lexgraph.plans.stage import stage

# The wordings by which texts name their licence.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD License",
    "CC-BY-4.0": "Licensed under the Creative Commons Attribution 4.0 International License, CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under the Creative Commons Attribution ShareAlike 4.0 License, CC BY-SA 4.0",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-2.1": "This library is licensed under the GNU Lesser General Public License, version 2.1",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MPL-2.0": "This file is subject to the terms of the Mozilla Public License, version 2.0",
}

MIT_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
MIT_REST = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE."
)
BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
)
GNU_HEADER = (
    "This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1}General Public License as published by the Free "
    "Software Foundation, either version {2} of the License, or (at your option) any later version."
)
GNU_TITLE = (
    "GNU {0}General Public License Version {1} Copyright (C) {2} Free Software Foundation, Inc. Everyone is permitted to copy and distribute "
    "verbatim copies of this license document, but changing it is not allowed."
)
# The other kinds of wording: titles, headers of files, and full texts or the paragraph that opens them.
MORE = [
    ("Apache-2.0", "Apache License Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
     "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", BSD_GRANT),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("GPL-2.0", "GNU General Public License Version 2"),
    ("GPL-2.0", GNU_TITLE.format("", "2, June 1991", "1989, 1991")),
    ("GPL-2.0", GNU_HEADER.format("program", "", "2")),
    ("GPL-3.0", "GNU General Public License Version 3"),
    ("GPL-3.0", GNU_TITLE.format("", "3, 29 June 2007", "2007")),
    ("GPL-3.0", GNU_HEADER.format("program", "", "3")),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1"),
    ("LGPL-2.1", GNU_TITLE.format("Lesser ", "2.1, February 1999", "1991, 1999")),
    ("LGPL-2.1", GNU_HEADER.format("library", "Lesser ", "2.1")),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3"),
    ("LGPL-3.0", GNU_TITLE.format("Lesser ", "3, 29 June 2007", "2007")),
    ("LGPL-3.0", GNU_HEADER.format("library", "Lesser ", "3")),
    ("MIT", "MIT License"),
    ("MIT", MIT_GRANT),
    ("MIT", f"MIT License Copyright (c) {MIT_GRANT} {MIT_REST}"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
     "file, You can obtain one at https://mozilla.org/MPL/2.0/."),
]


class LicenseParams(NamedTuple):
    """``marker``: a line or block with a match is a notice. ``comment``: what begins a comment line. ``spdx``: a tag, with what it names. ``file``: names of licence files. ``cosine``: the least that counts."""

    marker: str = r"(?i)licen[sc]|copyright|spdx|permission is hereby granted|redistribution and use|creative commons"
    comment: str = r"(?m)^[ \t]*(?://+!?|#+|/\*+|\*+/|\*+|--+|;+|%+|<!--|\.\.)[ \t]*"
    spdx: str = r"(?i)spdx-license-identifier\s*:\s*([^\r\n]*)"
    file: str = r"(?i)^(licen[sc]e|copying|notice)([.-].*)?$"
    cosine: float = 0.5


def terms_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def template_terms(spark: SparkSession, templates: dict[str, str], more: list[tuple[str, str]]) -> DataFrame:
    """[template, license, term, tf] of the templates, a bounded parameter."""
    every = [*sorted(templates.items()), *(m for m in more if m[0] in templates)]
    rows = spark.createDataFrame([(i, *t) for i, t in enumerate(every)], "template int, license string, text string")
    terms = rows.select("template", "license", F.explode(terms_of(F.col("text"))).alias("term"))
    return terms.groupBy("template", "license", "term").agg(F.count(F.lit(1)).alias("tf"))


def score_tags(notices: DataFrame, p: LicenseParams, templates: dict[str, str]) -> DataFrame:
    """[id, license, score] of SPDX tags [id, notice]: 1 for the smallest known name in the expression."""
    names = [(v.lower(), k) for k in sorted(templates) for v in (k, f"{k}+", f"{k}-only", f"{k}-or-later")]
    known = F.create_map(*(F.lit(x) for pair in names for x in pair))
    said = F.split(F.lower(F.regexp_extract("notice", p.spdx, 1)), r"[^a-z0-9.+-]+")
    found = F.array_min(F.filter(F.transform(said, lambda x: F.try_element_at(known, x)), lambda x: x.isNotNull()))
    return notices.select("id", found.alias("license"), F.lit(1.0).alias("score")).where(F.col("license").isNotNull())


def score_notices(
    notices: DataFrame, p: LicenseParams, templates: dict[str, str] = TEMPLATES, more: list[tuple[str, str]] = MORE
) -> DataFrame:
    """[id, license, score] of the distinct notices [id, notice, n] that are near a template; ties to the smaller name.

    Terms go by the notice's id, so a long notice moves once as its terms and not with each of them. Document frequencies are counted over all notices; a term of no template weighs as one that occurs once.
    """
    is_tag = F.col("notice").rlike(p.spdx) & ~F.col("notice").contains("\n")
    tags, notices = score_tags(notices.where(is_tag), p, templates), notices.where(~is_tag)
    terms = notices.select("id", "n", F.explode(terms_of(F.col("notice"))).alias("term")).groupBy("id", "n", "term").agg(F.count(F.lit(1)).alias("tf"))
    known = template_terms(notices.sparkSession, templates, more)
    vocabulary = known.select("term").distinct()
    counted = terms.join(F.broadcast(vocabulary), "term").groupBy("term").agg(F.sum("n").alias("df"))
    total = notices.agg(F.sum("n")).first()[0] or 0
    weight = lambda df: F.log(F.lit(1.0 + total) / (1.0 + df)) + 1.0
    # Each of the small tables below is read several times: staged, none is planned and computed again.
    idf = stage(vocabulary.join(counted, "term", "left").select("term", weight(F.coalesce("df", F.lit(0))).alias("idf")), "idf")
    weighted = terms.join(F.broadcast(idf), "term", "left").select(
        "id", "term", (F.col("tf") * F.coalesce(F.col("idf"), weight(F.lit(1)))).alias("w")
    )
    template = known.join(idf, "term").select("template", "license", "term", (F.col("tf") * F.col("idf")).alias("v"))
    lengths = template.groupBy("template").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("length"))
    unit = template.join(lengths, "template").select("template", "license", "term", (F.col("v") / F.col("length")).alias("v"))
    norm = weighted.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dot = weighted.join(F.broadcast(unit), "term").groupBy("id", "template", "license").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    scored = stage(
        dot.join(norm, "id").select("id", "license", F.round(F.col("dot") / F.col("norm"), 6).alias("score")), "scored"
    )
    best = scored.groupBy("id").agg(F.max("score").alias("score"))
    return (
        scored.join(best, ["id", "score"]).where(F.col("score") >= p.cosine).groupBy("id", "score")
        .agg(F.min("license").alias("license")).select("id", "license", "score").unionByName(tags)
    )


def header_blocks(text: Column, p: LicenseParams) -> Column:
    """Lines that stand together, up to a blank one, as one notice each without their comment signs, if it has a marker."""
    bare = F.regexp_replace(text, p.comment, "")
    tagless = F.regexp_replace(bare, p.spdx, "")  # a tag is a notice by itself
    blocks = F.transform(F.split(tagless, r"\n[ \t\r]*(?:\n[ \t\r]*)*\n|\A\s+"), lambda b: F.trim(F.regexp_replace(b, r"\s+", " ")))
    return F.filter(blocks, lambda b: b.rlike(p.marker))


def ancestors(path: Column) -> Column:
    """The directories above a path, the root '' first."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), "/"))


def scan_licenses(files: DataFrame, p: LicenseParams = LicenseParams(), templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """[file_id, path, license, score, origin, directory] of every row of files [file_id, path, text].

    ``origin`` is ``file``, ``directory`` or ``none``. Of several notices the best counts, of equal ones the smaller name.
    Null texts have no notice; a null path has no directory above it. A licence file stands for its directory.
    """
    name = F.element_at(F.split("path", "/"), -1)
    is_license_file = F.coalesce(name.rlike(p.file), F.lit(False))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(p.marker))
    lines = F.array_union(lines, header_blocks(F.col("text"), p))  # a block of one line is that line
    found = F.when(is_license_file, F.array_append(lines, F.col("text"))).otherwise(lines)
    slim = files.select("file_id", "path", F.when(F.col("text").isNotNull(), found).otherwise(F.array().cast("array<string>")).alias("notices"), is_license_file.alias("is_file"))
    staged = stage(slim.withColumn("row", F.xxhash64("file_id", "path", "notices")), "notices")
    # A notice goes by 128 bits of its text, which stands in one table only.
    every = staged.select("row", F.explode("notices").alias("notice")).withColumn("id", F.md5(F.col("notice").cast("binary")))
    each = every.select("row", "id")
    distinct = stage(every.groupBy("id", "notice").agg(F.count(F.lit(1)).alias("n")), "distinct_notices")
    scored = stage(score_notices(distinct, p, templates), "best_licenses")
    hits = stage(lookup_join(each, scored, "id", "inner"), "hits")
    # The largest score, then the smallest name: names are compared only among equal scores.
    top = hits.groupBy("row").agg(F.max("score").alias("score"))
    own = hits.join(top, ["row", "score"]).groupBy("row", "score").agg(F.min("license").alias("license"))
    files_own = stage(staged.drop("notices").join(own, "row", "left").drop("row"), "own_licenses")
    parent = F.array_join(F.slice(F.split("path", "/"), 1, F.size(F.split("path", "/")) - 1), "/")
    by_dir = files_own.where("is_file and license is not null and path is not null").withColumn("directory", parent)
    best = by_dir.groupBy("directory").agg(F.max("score").alias("score"))
    dirs = by_dir.join(best, ["directory", "score"]).groupBy("directory").agg(F.min("license").alias("dir_license"), F.first("score").alias("dir_score"))
    # Files of one directory ask the same question, so each directory asks once.
    asking = files_own.where("license is null and path is not null").select(parent.alias("parent")).distinct()
    above = asking.select("parent", F.explode(F.array_append(ancestors(F.col("parent")), F.col("parent"))).alias("directory")).distinct()
    known = lookup_join(above, dirs, "directory", "inner")
    nearest = known.groupBy("parent").agg(
        F.max(F.struct(F.length("directory").alias("depth"), "directory", "dir_license", "dir_score")).alias("n")
    ).select("parent", "n.directory", "n.dir_license", "n.dir_score")
    joined = lookup_join(files_own.withColumn("parent", F.when(F.col("license").isNull(), parent)), nearest, "parent", "left")
    origin = F.when(F.col("license").isNotNull(), "file").when(F.col("dir_license").isNotNull(), "directory").otherwise("none")
    return joined.select(
        "file_id", "path", F.coalesce("license", "dir_license").alias("license"), F.coalesce("score", "dir_score").alias("score"),
        origin.alias("origin"), F.when(F.col("license").isNull(), F.col("directory")).alias("directory"),
    )
