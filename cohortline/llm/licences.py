"""Licence scan: TF-IDF cosine of headers and licence files to templates, inheritance from the nearest directory.

Only DataFrame functions. The notices of a file with a cue word are its lines with one, and windows: where three words of a template stand in the text, the
words that lie as the template would from there, whatever line ends, comment marks and prose are around them. A file that is named like a
licence gives its whole text too. Distinct notices become sparse vectors of (term, weight) rows, and the cosine is a sum over a join on terms
with the templates, a fixed table. A file without a notice of its own takes the licence of the
nearest directory above it that has a licence file: distinct directories are joined with their ancestors by path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm.common import staged, whole_text
from cohortline.llm.decontaminate import shingles_of

# Licence identifiers and the notices by which files name them.
BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
       "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
       "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
       "disclaimer in the documentation and/or other materials provided with the distribution.")
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License. See LICENSE in the project root for license information."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "MIT License Copyright Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the Software), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
                   "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                     "following conditions are met: neither the name of the copyright holder nor the names of its contributors"),
    ("BSD-2-Clause", BSD + " This software is provided by the copyright holders and contributors as is"),
    ("BSD-3-Clause", BSD + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                     "products derived from this software without specific prior written permission."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "Copyright. All rights reserved."),
)
CUES = ("licen", "copyright", "spdx", "hereby granted", "public domain", "creative commons", "rights reserved", "redistribut")
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|copyright|notice|unlicense)[^/]*$"
TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
#: Words that a text and a template must have in a row for a window.
RUN = 3
#: A table of templates of at most so many terms is broadcast.
SMALL = 100_000
#: Parts of a directory in the join with its licence.
SALTS = 32


def _cue(text):
    low = F.lower(text)
    found = F.contains(low, F.lit(CUES[0]))
    for c in CUES[1:]:
        found = found | F.contains(low, F.lit(c))
    return found


def _words(text):
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _terms(df: DataFrame, *keys: str) -> DataFrame:
    """keys, term, tf of the column `notice`."""
    words = df.select(*keys, F.explode(_words(F.col("notice"))).alias("term"))
    return words.groupBy(*keys, "term").agg(F.count("*").alias("tf"))


def windows(files: DataFrame, known: DataFrame) -> DataFrame:
    """row, notice, part: for each place of `files` (row, words) where RUN words of a template stand in a row, the words that lie there as
    the template would; `part` is their share of the file's words.

    A window that a text's ends cut is shorter. Templates of fewer than RUN words have no window. All starts of a file are one list, at most some per word of it."""
    runs = known.select(_words(F.col("notice")).alias("words")).select(
        F.size("words").alias("size"), F.posexplode(shingles_of(F.col("words"), RUN)).alias("offset", "h")).distinct()
    runs = F.broadcast(runs) if runs.count() <= SMALL else runs
    met = files.select("row", F.posexplode(shingles_of(F.col("words"), RUN)).alias("place", "h")).join(runs, "h")
    starts = met.groupBy("row").agg(F.collect_set(F.struct((F.col("place") - F.col("offset")).alias("start"), "size")).alias("starts"))
    cut = files.join(starts, "row").select("row", F.size("words").alias("n"), F.explode(F.transform("starts", lambda s: F.slice(
        F.col("words"), F.greatest(s["start"], F.lit(0)) + 1, s["size"] + F.least(s["start"], F.lit(0))))).alias("window"))
    return cut.select("row", F.array_join("window", " ").alias("notice"), (F.size("window") / F.col("n")).alias("part"))


def templates(spark: SparkSession) -> DataFrame:
    """template, licence, notice."""
    return spark.createDataFrame([(i, *t) for i, t in enumerate(TEMPLATES)], "template int, licence string, notice string")


def match_notices(notices: DataFrame, known: DataFrame, least: float) -> DataFrame:
    """notice, licence, similarity: the template of largest cosine for each distinct notice that reaches `least`; ties by licence.

    Document frequencies are over the templates and the distinct notices that are `counted`: windows, which are like templates, would make
    the terms of licences seem common. A term may be in most notices, so its notices go to SALTS parts."""
    keyed = notices.groupBy("notice").agg(F.max("counted").alias("counted")).withColumn("key", F.xxhash64("notice"))
    terms = staged(_terms(keyed, "key", "counted"), "notice-terms")
    own = _terms(known, "template", "licence")
    total = keyed.filter("counted").count() + known.count()
    df = terms.select("term", F.col("counted").cast("long").alias("n")).union(own.select("term", F.lit(1).cast("long"))).groupBy("term").agg(
        (F.log(F.lit(float(total + 1)) / (F.sum("n") + 1)) + 1).alias("idf"))
    parts = F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt")
    weighed = terms.withColumn("salt", F.pmod("key", F.lit(SALTS)).cast("int")).join(df.select("term", "idf", parts), ["term", "salt"])
    a = staged(weighed.select("key", "term", (F.col("tf") * F.col("idf")).alias("w")), "weights")
    b = own.join(df, "term").withColumn("w", F.col("tf") * F.col("idf"))
    b = b.join(b.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm_b")), "template")
    norm_a = a.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm_a"))
    fixed = b.select("term", "template", "licence", F.col("w").alias("w_b"), "norm_b")
    fixed = F.broadcast(fixed) if own.count() <= SMALL else fixed
    cosine = a.join(fixed, "term").groupBy("key", "template", "licence", "norm_b").agg(
        F.sum(F.col("w") * F.col("w_b")).alias("dot")).join(norm_a, "key").withColumn(
        "similarity", F.round(F.col("dot") / (F.col("norm_a") * F.col("norm_b")), 9)).filter(F.col("similarity") >= least)
    best = cosine.groupBy("key").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "licence")).alias("best"))
    return keyed.join(best, "key").select("notice", F.col("best.licence").alias("licence"), (-F.col("best.s")).alias("similarity"))


def scan_licences(files: DataFrame, least: float = 0.8, share: float = 0.9, id_col: str = "doc_id", path_col: str = "path",
                  text_col: str = "text", known: DataFrame | None = None) -> DataFrame:
    """doc_id, path, licence, similarity, origin ('header', 'file', 'inherited'), from_directory; only files with a licence.

    A file's licence is the best match of its notices (ties: the first identifier). A licence file is named like one, or has matched lines in
    at least `share` of its characters or a matched window of at least that share of its words; it licenses its directory, and of several in one
    directory the best match does. Null texts have no notice but inherit; a null path has no directory, so such a row counts only with its own
    notices; repeated rows and null ids come back as they are. Whole texts are scanned. An empty table gives no row; further columns of the
    input are not read."""
    known = templates(files.sparkSession) if known is None else known
    base = files.select(F.col(id_col).alias("doc_id"), F.col(path_col).cast("string").alias("path"), whole_text(text_col).alias("t"))
    base = base.select("doc_id", "path", F.when(F.col("path").contains("/"), F.regexp_extract("path", r"^(.*)/[^/]*$", 1)).otherwise(
        F.when(F.col("path").isNotNull(), "")).alias("directory"), F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False)).alias("named"), "t")
    base = staged(base.select("doc_id", "path", "directory", "named", F.monotonically_increasing_id().alias("row"),
                              F.when(_cue(F.col("t")) | F.col("named"), F.col("t")).alias("t")), "files")
    read = base.filter("t is not null")
    lines = F.array_distinct(F.concat(F.filter(F.split("t", r"\r?\n|\r"), _cue), F.when(F.col("named"), F.array("t")).otherwise(
        F.array().cast("array<string>"))))
    of_lines = read.select("row", F.char_length("t").alias("chars"), F.explode(lines).alias("notice")).select(
        "row", "notice", F.lit(True).alias("counted"), (F.char_length("notice") / F.greatest("chars", F.lit(1))).alias("line"), F.lit(0.0).alias("window"))
    of_windows = windows(read.select("row", _words(F.col("t")).alias("words")), known).select(
        "row", "notice", F.lit(False).alias("counted"), F.lit(0.0).alias("line"), F.col("part").alias("window"))
    notices = staged(of_lines.union(of_windows), "notices")
    matched = staged(match_notices(notices, known, least), "matched")
    own = notices.join(matched, "notice").groupBy("row").agg(
        F.min(F.struct((-F.col("similarity")).alias("s"), "licence")).alias("best"),
        ((F.sum("line") >= share) | (F.max("window") >= share)).alias("filled"))
    own = own.select("row", F.col("best.licence").alias("licence"), (-F.col("best.s")).alias("similarity"), "filled")
    direct = base.drop("t").join(own, "row", "left").withColumn("is_file", F.col("named") | F.col("filled")).drop("named", "filled")
    of_directory = direct.filter("is_file and licence is not null and directory is not null").groupBy("directory").agg(
        F.min(F.struct((-F.col("similarity")).alias("s"), "licence")).alias("best"))
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(
        n.alias("depth"), F.concat_ws("/", F.slice(parts, 1, n)).alias("ancestor")))
    places = base.select("directory").filter("directory is not null").distinct().select("directory", F.explode(above).alias("up"))
    nearest = places.join(of_directory.withColumnRenamed("directory", "ancestor"), F.col("up.ancestor") == F.col("ancestor")).groupBy(
        "directory").agg(F.max_by(F.struct("ancestor", "best"), F.col("up.depth")).alias("near"))
    # A directory may hold most files: its files go to SALTS parts, and its licence to each of them.
    nearest = nearest.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    found = direct.withColumn("salt", (F.col("row") % SALTS).cast("int")).join(nearest, ["directory", "salt"], "left")
    mine = F.col("licence").isNotNull()
    return found.filter(mine | F.col("near").isNotNull()).select(
        "doc_id", "path", F.coalesce("licence", "near.best.licence").alias("licence"),
        F.coalesce("similarity", -F.col("near.best.s")).alias("similarity"),
        F.when(mine & F.col("is_file"), "file").when(mine, "header").otherwise("inherited").alias("origin"),
        F.when(~mine, F.col("near.ancestor")).alias("from_directory"))
