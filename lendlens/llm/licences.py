"""Licence scan: TF-IDF cosine to templates, then directory inheritance.

DataFrame functions only. Whole texts are cut into sentences; those with a
licensing word become sparse TF-IDF vectors and meet an inverted index of the
template sentences (a fixed small table, so it is broadcast). Beside them whole
texts of licence files (by name) and paragraphs (comment marks and line breaks
taken out) with a licensing word meet an index of published licence files,
header paragraphs and titles. The template of the highest cosine at or above ``THRESHOLD`` gives a file its own licence. A
file without one inherits from the nearest ancestor directory that holds a
licence file (by name) with a recognised licence: directories are resolved
once each against their prefixes, then files join their directory.

Only units with a licensing word are shuffled, and aggregated map-side; a
directory with a third of all files is one row until the final join, whose
large side Spark can split.

Defined cases: null and empty texts have no licence of their own; a null path
is the empty path in the root directory; rows that repeat a path get a row
each, with the licence of their own text; ties go to the licence first in the
alphabet, among licence files of a directory to the higher cosine, then the
smaller path; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _shared as S
from ._licence_texts import WHOLES

THRESHOLD = 0.6

# Licence statements and the opening words of licence files.
TEMPLATES = (
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "You should have received a copy of the GNU Affero General Public License along with this program."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License)"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-2-Clause", "Released under the 2-clause BSD License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Released under the 3-clause BSD License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This program is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SENTENCE_END = r"([.!?;|])[ \t\r]+"
LICENSING = r"licen[sc]|copyright|spdx|creative commons|cc[ -]by|public domain|redistribut|permission is hereby"
TOKEN = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"
COMMENT = r"(?m)^[ \t]*(?:/\*+|\*+/?|//+|#+|;+|--+|%+|dnl\b|rem\b)[ \t]?"
BLANK_LINES = r"\n[ \t\r]*\n\s*"
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|unlicense)([.-].*)?$"


def _tokens(text: str) -> list[str]:
    import re
    return re.findall(TOKEN, text.lower())


def template_index(templates=TEMPLATES) -> tuple[list[tuple], dict[str, float], float]:
    """(inverted index rows (token, template, licence, weight / norm), idf of
    known tokens, idf of others). A function of the fixed templates."""
    counts = [Counter(_tokens(text)) for _, text in templates]
    n = len(counts)
    seen = Counter(t for c in counts for t in c)
    idf = {t: math.log((1 + n) / (1 + k)) + 1 for t, k in seen.items()}
    rows = []
    for i, ((licence, _), c) in enumerate(zip(templates, counts)):
        norm = math.sqrt(sum((k * idf[t]) ** 2 for t, k in c.items()))
        rows += [(t, i, licence, k * idf[t] / norm) for t, k in sorted(c.items())]
    return rows, idf, math.log(1 + n) + 1


def _named(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/]*$", 0).rlike(LICENCE_FILE)


# A row is its path and its text: rows that repeat both have the same licence,
# rows that share only a path (null paths too) are kept apart.
_ROW = ("path", "h1", "h2")


def _rows(files: DataFrame) -> DataFrame:
    return files.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})


def _cosines(units: DataFrame, threshold: float, templates) -> DataFrame:
    """(row, licence, cosine) of the units (row, pos, col) at or above the threshold."""
    spark = units.sparkSession
    rows, idf, other = template_index(templates)
    unit = (*_ROW, "pos")
    # fixed tables: a few thousand rows from the templates, whatever the input
    index = F.broadcast(spark.createDataFrame(rows, "token string, template int, licence string, w double"))
    known = F.broadcast(spark.createDataFrame(sorted(idf.items()), "token string, idf double"))
    tokens = units.select(*unit, F.explode(F.regexp_extract_all("col", F.lit(TOKEN), F.lit(0))).alias("token"))
    weighted = (tokens.groupBy(*unit, "token").agg(F.count(F.lit(1)).alias("tf"))
                .join(known, "token", "left")
                .select(*unit, "token", (F.col("tf") * F.coalesce("idf", F.lit(other))).alias("w")))
    vectors = weighted.groupBy(*unit).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"),
                                          F.collect_list(F.struct("token", "w")).alias("terms"))
    return (vectors.select(*unit, "norm", F.inline("terms").alias("token", "q"))
            .join(index, "token").groupBy(*unit, "norm", "template", "licence")
            .agg(F.sum(F.col("q") * F.col("w")).alias("dot"))
            .select(*_ROW, "licence", F.round(F.col("dot") / F.col("norm"), 6).alias("cosine"))
            .where(F.col("cosine") >= threshold))


def own_licences(files: DataFrame, threshold: float = THRESHOLD, templates=TEMPLATES, wholes=WHOLES) -> DataFrame:
    """(path, h1, h2, licence, cosine) of the files (path, text) with a licence
    statement; h1 and h2 are hashes of the text."""
    lower = F.translate("text", UPPER, LOWER)
    # rows that repeat path and text are looked at once
    files = _rows(files.where(lower.rlike(LICENSING))).dropDuplicates(list(_ROW))
    plain = F.regexp_replace(lower, COMMENT, "")
    sentences = (files.select(*_ROW, F.posexplode(F.split(F.regexp_replace(lower, SENTENCE_END, "$1\n"), "\n")))
                 .where(F.col("col").rlike(LICENSING)))
    paragraphs = (files.select(*_ROW, F.posexplode(F.split(plain, BLANK_LINES))).where(F.col("col").rlike(LICENSING)))
    whole = files.where(_named(F.col("path"))).select(*_ROW, F.lit(-1).alias("pos"), plain.alias("col"))
    cosines = (_cosines(sentences, threshold, templates)
               .unionByName(_cosines(paragraphs.unionByName(whole), threshold, wholes)))
    best = F.min(F.struct((-F.col("cosine")).alias("least"), "licence"))
    return (cosines.groupBy(*_ROW).agg(best.alias("b"))
            .select(*_ROW, F.col("b.licence").alias("licence"), (-F.col("b.least")).alias("cosine")))


def _directory(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_replace(path, r"/[^/]*$", "")).otherwise(F.lit(""))


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text",
         threshold: float = THRESHOLD, templates=TEMPLATES, keep: tuple[str, ...] = ()) -> DataFrame:
    """path, own_licence, cosine, licence, origin (own, inherited or none) and
    inherited_from (directory) of every row, after the columns in ``keep``."""
    path = F.coalesce(F.col(path_col), F.lit(""))
    kept = [F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)]
    files = files.select(*kept, path.alias("path"), F.col(text_col).alias("text"))
    own = S.materialised(own_licences(files, threshold, templates), "own-licences")  # used twice
    named = _named(F.col("path"))
    first = F.min(F.struct((-F.col("cosine")).alias("least"), "path", "licence"))
    declared = (own.where(named).groupBy(_directory(F.col("path")).alias("prefix")).agg(first.alias("f"))
                .select("prefix", F.col("f.licence").alias("inherited")))
    listed = _rows(files).select(*(f"kept_{i}" for i in range(len(keep))), *_ROW, _directory(F.col("path")).alias("dir"))
    parts = F.split("dir", "/")
    steps = F.when(F.col("dir") == "", F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.size(parts)))
    prefixes = (listed.select("dir").distinct().select("dir", F.explode(steps).alias("depth"))
                .select("dir", "depth", F.array_join(F.slice(parts, 1, F.col("depth")), "/").alias("prefix")))
    nearest = (prefixes.join(declared, "prefix").groupBy("dir")
               .agg(F.max(F.struct("depth", "prefix", "inherited")).alias("n"))
               .select("dir", F.col("n.prefix").alias("prefix"), F.col("n.inherited").alias("inherited")))
    own = own.select(*_ROW, F.col("licence").alias("own_licence"), "cosine")
    from_dir = F.col("own_licence").isNull() & F.col("inherited").isNotNull()
    return (listed.join(own, list(_ROW), "left").join(nearest, "dir", "left")
            .select(*(F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)),
                    "path", "own_licence", "cosine", F.coalesce("own_licence", "inherited").alias("licence"),
                    F.when(F.col("own_licence").isNotNull(), "own").when(from_dir, "inherited")
                    .otherwise("none").alias("origin"),
                    F.when(from_dir, F.col("prefix")).alias("inherited_from")))
