"""Licence scan: sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

Units of comparison are the lines of a file, every run of words as long as the template that begins with a word of it
(so a header is compared as a whole, wrapped over lines or inside a long one), and, for licence files, also the whole text.
Full licence texts are templates for whole licence files. A unit is the set of its terms with weight idf; idf counts the documents of the whole input that hold a term,
inside the templates or not. Two bounds that hold for every idf leave out, exactly, what cannot reach the threshold: a
document whose terms in common with a template weigh too little, and a unit that would fail even if its other terms had the
least idf, 1. Documents are counted for the terms of the units that are left, and those get their full norm.

A file takes its own best match; else the licence of the nearest directory above it (its own included) that holds a
licence file with a match. Directories, not files, are joined with their ancestors, one row per path component.

Defined results: a null or empty text matches nothing; a null path has no directory and inherits nothing; ties between
templates go to the smaller licence name, between licence files of a directory to the higher cosine, then the smaller name;
repeated rows are judged each on their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import small, stage

THRESHOLD = 0.6
BLOCK = 128  # words
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|notice)([.-][a-z0-9.-]*)?$"

#: Public licence notices by SPDX name; several phrases may stand for one licence.
TEMPLATES = [
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   "compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

_GNU = ("This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} as published by "
        "the Free Software Foundation, either version {2} of the License, or (at your option) any later version.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. ")
_BSD3 = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
         "products derived from this software without specific prior written permission. ")
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\""

#: Standard headers of several lines, and the titles that tell like full texts apart.
HEADERS = [
    ("AGPL-3.0", _GNU.format("program", "Affero General Public License", 3)),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", _BSD + _BSD3 + _BSD_END),
    ("GPL-2.0", _GNU.format("program", "General Public License", 2)),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", _GNU.format("program", "General Public License", 3)),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", _GNU.format("library", "Lesser General Public License", 2.1)),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", _GNU.format("library", "Lesser General Public License", 3)),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
]


def sequence(text: Column) -> Column:
    """Lower-case terms in order: letters and digits, with dots, dashes and pluses inside."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"), F.lit(0))


def terms(text: Column) -> Column:
    """Distinct terms."""
    return F.array_distinct(sequence(text))


def full_texts() -> list[tuple[str, str]]:
    """(licence, text) of the files in licence_texts, which the driver alone reads."""
    return [(f.stem, f.read_text()) for f in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))]


def template_terms(spark, templates=None) -> DataFrame:
    """(t, licence, whole, m, term): a row per template and term; as many as the templates have words.

    m counts the words with repeats. Full licence texts are ``whole``: only whole licence files are compared with them.
    """
    rows = [(n, x, False) for n, x in templates or [*TEMPLATES, *HEADERS]]
    rows += [(n, x, True) for n, x in ([] if templates else full_texts())]
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "t int, licence string, text string, whole boolean")
    d = d.select("t", "licence", "whole", F.size(sequence(F.col("text"))).alias("m"), terms(F.col("text")).alias("x"))
    return d.select("t", "licence", "whole", "m", F.explode("x").alias("term"))


def idf_of(total: int, n: Column) -> Column:
    return F.log((F.lit(float(total)) + 1) / (n + 1)) + 1


def document_counts(held: DataFrame, wanted: DataFrame) -> DataFrame:
    """(term, n): how many documents hold each wanted term; ``held`` has a row per document and distinct term."""
    return held.join(wanted, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def weighted(held: DataFrame, total: int, templates: DataFrame) -> DataFrame:
    """(t, licence, whole, m, term, idf, length of the template's vector)."""
    counts = document_counts(held, F.broadcast(templates.select("term").distinct()))
    t = templates.join(counts, "term", "left").withColumn("idf", F.greatest(F.lit(1.0), F.least(
        idf_of(total, F.lit(1.0)), idf_of(total, F.coalesce("n", F.lit(0))))))
    length = t.groupBy("t").agg(F.sqrt(F.sum(F.col("idf") * F.col("idf"))).alias("length"))
    return stage(t.join(length, "t").select("t", "licence", "whole", "m", "term", "idf", "length"), "licence-terms")


def matches(files: DataFrame, templates: list | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(row, h, unit, licence, score): the best template of every unit at ``threshold`` or more.

    files: row (any number but null), path, text; h is a hash of path and text, so rows that share a number are told apart. Unit 0 is
    the whole text; the lines and the windows follow.
    """
    least = threshold - 1e-9
    files = files.filter("text is not null").select("row", F.xxhash64("path", "text").alias("h"), "path", "text")
    held = files.select("row", "h", F.explode(terms(F.col("text"))).alias("term"))
    total = files.count()
    t = weighted(held, total, template_terms(files.sparkSession, templates))
    # a unit shares no more with a template than its whole text does, and its cosine is at most sqrt(shared) / length
    pairs = held.join(F.broadcast(t.select("t", "term", "idf", "length")), "term").groupBy("row", "h", "t").agg(
        F.sum(F.col("idf") * F.col("idf")).alias("shared"), F.max("length").alias("length"))
    pairs = stage(pairs.filter(F.sqrt("shared") >= least * F.col("length")).select("row", "h", "t"), "licence-pairs")
    about = t.groupBy("t", "licence", "whole", "m", "length").agg(
        F.collect_list("term").alias("tt"), F.collect_list(F.col("idf") * F.col("idf")).alias("tw"))
    d = files.join(small(pairs), ["row", "h"]).join(F.broadcast(about), "t")
    is_licence = F.coalesce(F.element_at(F.split("path", "/"), -1).rlike(LICENCE_FILE), F.lit(False))
    d = d.withColumn("is_licence", is_licence).filter("is_licence or not whole")
    d = d.withColumn("seq", sequence(F.col("text")))
    none = F.array().cast("array<struct<unit: int, x: array<string>>>")
    whole = F.when(F.col("is_licence"), F.array(F.struct(F.lit(0).alias("unit"), F.array_distinct("seq").alias("x")))).otherwise(
        none)
    n_lines = F.size(F.split("text", "\n"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(x) > 0)
    by_line = F.transform(lines, lambda x, i: F.struct((i + 1).alias("unit"), terms(x).alias("x")))
    units = F.when(F.col("whole"), whole).otherwise(F.concat(whole, by_line))
    keep = ["row", "h", "t", "licence", "length", "tt", "tw"]
    u = d.select(*keep, F.explode(units).alias("u"))
    # windows begin with a word of the template: without one the window from the next word is no worse. The words of a text are
    # rows here, met with the templates by term, so that no row holds a window for each of its words; a window's template words,
    # each once, give its dot product, and its words are gathered only if that alone could reach the threshold
    own = stage(pairs.groupBy("row", "h").agg(F.collect_set("t").alias("ts")), "licence-rows")  # at most as many as templates
    words = files.join(small(own), ["row", "h"]).select("row", "h", "ts", F.posexplode(sequence(F.col("text"))).alias("i", "term"))
    part = t.filter("not whole").select("t", "m", "length", "term", (F.col("idf") * F.col("idf")).alias("x"))
    p = words.join(F.broadcast(part), "term").filter(F.array_contains("ts", F.col("t"))).drop("ts")
    p = p.withColumn("k", F.col("i") / F.col("m"))
    near = F.expr("""collect_list(struct(term, x)) over (partition by row, h, t order by k
        range between current row and 0.99999D following)""")
    p = p.withColumn("sum", F.aggregate(F.array_distinct(near), F.lit(0.0), lambda s, e: s + e["x"]))
    enough = F.lit(least * least * (1 - 1e-9)) * F.col("length") * F.col("length")
    w = stage(p.filter(F.col("sum") >= enough).select("row", "h", "t", "m", "i"), "licence-windows")
    # windows meet the words of their blocks of the text, so a text with many windows compares each word with a few of them
    block = lambda c: F.floor(c / BLOCK)
    w = w.withColumn("block", F.explode(F.sequence(block(F.col("i")), block(F.col("i") + F.col("m") - 1))))
    w = small(stage(w.withColumnRenamed("i", "start"), "licence-blocks"))
    w = words.select("row", "h", "i", "term", block(F.col("i")).alias("block")).join(w, ["row", "h", "block"])
    w = w.filter((F.col("i") >= F.col("start")) & (F.col("i") < F.col("start") + F.col("m")))
    w = w.groupBy("row", "h", "t", F.col("start").alias("i")).agg(F.collect_set("term").alias("x"))
    at = d.select("row", "h", n_lines.alias("lines")).distinct()
    w = w.join(at, ["row", "h"]).join(F.broadcast(about), "t")
    u = u.unionByName(w.select(*keep, F.struct((F.col("lines") + F.col("i") + 1).alias("unit"), "x").alias("u")))
    u = u.withColumn("x", F.col("u.x")).withColumn("hits", F.array_intersect("x", "tt"))
    u = u.withColumn("dot", F.aggregate("hits", F.lit(0.0), lambda s, w: s + F.get(
        F.col("tw"), (F.array_position(F.col("tt"), w) - 1).cast("int"))))
    # no idf is below 1, so every term outside the template adds at least 1 to the squared norm
    bound = least * F.col("length") * F.sqrt(F.col("dot") + F.size("x") - F.size("hits"))
    u = u.filter((F.col("dot") > 0) & (F.col("dot") >= bound))
    u = u.select("row", "h", "u.unit", "t", "licence", "length", "dot", "x").dropDuplicates(["row", "h", "unit", "t"])
    u = stage(u, "licence-units")
    held_by = u.select("row", "h", "unit", "t", F.explode("x").alias("term"))
    wanted = stage(held_by.select("term").distinct(), "licence-wanted")
    idf = stage(document_counts(held, small(wanted)).select("term", idf_of(total, F.col("n")).alias("idf")), "licence-idf")
    key = ["row", "h", "unit", "t"]
    norm = held_by.join(small(idf), "term").groupBy(*key).agg(F.sqrt(F.sum(F.col("idf") * F.col("idf"))).alias("norm"))
    dot = u.drop("x").join(norm, key).withColumn("score", F.col("dot") / (F.col("norm") * F.col("length")))
    best = dot.filter(F.col("score") >= least).groupBy("row", "h", "unit").agg(
        F.min(F.struct((-F.round("score", 9)).alias("s"), "licence")).alias("b"))
    return best.select("row", "h", "unit", "b.licence", (-F.col("b.s")).alias("score"))


def scan(files: DataFrame, templates: list | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """row, licence, score, origin (line, file, directory or null) and from_dir of every file.

    files: row (any number; rows may share one), path with / between its parts, text.
    """
    key = F.xxhash64("row")  # of a null number, too
    found = matches(files.select(key.alias("row"), "path", "text"), templates, threshold).groupBy("row", "h").agg(
        F.min(F.struct((-F.col("score")).alias("s"), "licence", "unit")).alias("b"))
    found = stage(found.select(F.col("row").alias("key"), "h", "b.licence", (-F.col("b.s")).alias("score"), "b.unit"), "licence-found")
    parts = F.split("path", "/")
    d = files.select("row", key.alias("key"), F.xxhash64("path", "text").alias("h"), "path", F.when(F.size(parts) > 1, F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "/"))
                     .when(F.col("path").isNotNull(), F.lit("")).alias("dir"),
                     F.coalesce(F.element_at(parts, -1).rlike(LICENCE_FILE), F.lit(False)).alias("is_licence"))
    d = d.join(small(found), ["key", "h"], "left")
    given = d.filter("is_licence and licence is not null and dir is not null").groupBy("dir").agg(
        F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("b"))
    given = stage(given.select(F.col("dir").alias("above"), F.col("b.licence").alias("above_licence"),
                               (-F.col("b.s")).alias("above_score")), "licence-dirs")
    dirs = d.filter("dir is not null").select("dir").distinct()
    p = F.split("dir", "/")
    ups = dirs.select("dir", F.explode(F.sequence(F.lit(0), F.size(p))).alias("depth"), p.alias("p"))
    ups = ups.select("dir", "depth", F.array_join(F.slice("p", F.lit(1), F.col("depth")), "/").alias("above"))
    near = ups.join(small(given), "above").groupBy("dir").agg(
        F.max(F.struct("depth", "above", "above_licence", "above_score")).alias("b"))
    near = stage(near.select("dir", "b.above", "b.above_licence", "b.above_score"), "licence-near")
    d = d.join(small(near), "dir", "left")
    own = F.col("licence").isNotNull()
    return d.select("row", F.coalesce("licence", "above_licence").alias("licence"),
                    F.coalesce("score", "above_score").alias("score"),
                    F.when(own & (F.col("unit") == 0), "file").when(own, "line").when(
                        F.col("above_licence").isNotNull(), "directory").alias("origin"),
                    F.when(~own, F.col("above")).alias("from_dir"))
