"""Licences: sparse TF-IDF cosine of header and licence-file sentences to templates, then inheritance from the nearest
directory above."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.common import cut

# fixed values: licence names and the statements by which files declare them or licence texts open
DECLARED = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Distributed under the MIT license."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("BSD-2-Clause", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
)
#: The declared statements, and for each licence the line of its identifier.
TEMPLATES = (*DECLARED, *((name, f"{text} {name}") for name in dict.fromkeys(n for n, _ in DECLARED) for text in ("SPDX-License-Identifier:", "License:")))
TOKEN = "[a-z0-9]+"
# fixed values: common English words, which make poor markers
COMMON = frozenset("a an and are as at be by for from in is it may not of on or that the this to used under with you".split())


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(TEMPLATES)], "template_id int, license string, statement string")


def sentences(text: Column) -> Column:
    """The distinct sentences of lines, and of blocks between blank lines with their line ends as spaces.

    A sentence ends with a stop before white space.
    """
    ended = lambda c: F.split(F.regexp_replace(c, r"([.!?])[ \t\r\n]+", "$1\n"), "\n", -1)
    blocks = F.transform(F.split(text, r"\n[ \t\r]*\n", -1), lambda b: ended(F.regexp_replace(b, r"[ \t\r\n\f]+", " ")))
    return F.array_distinct(F.concat(ended(text), F.flatten(blocks)))


def folder(path: Column) -> Column:
    """The path before its last slash; empty at the top."""
    return F.regexp_extract(path, r"(?s)\A(.*)/[^/]*\z", 1)


def license_file(path: Column) -> Column:
    """Whether the last part of the path is a licence file's name."""
    return F.regexp_extract(path, r"(?s)([^/]*)\z", 1).rlike(r"(?i)\A(licen[cs]e|copying|notice)([._-].*)?\z")


def above(dir_: Column) -> Column:
    """A directory and all directories above it, the nearest last; the top is the empty string."""
    parts = F.split(dir_, "/", -1)
    return F.concat(F.array(F.lit("")), F.when(dir_ != "", F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))).otherwise(F.array().cast("array<string>")))


def rarity(known: list[str]) -> tuple[dict[str, float], float]:
    """Inverse document frequency of the templates' tokens in the collection of templates, and that of any other token."""
    df = Counter(t for text in known for t in set(re.findall(TOKEN, text.lower())))
    return {t: math.log((1 + len(known)) / (1 + n)) + 1 for t, n in df.items()}, math.log(1 + len(known)) + 1


def markers(known: list[str], least: float) -> list[str]:
    """Tokens of which every text with a cosine of ``least`` to a template holds one.

    Of each template all but so many of its common, then of its least weighty tokens as together are shorter than
    ``least`` of its vector: a text without the others has at most that cosine.
    """
    idf, _ = rarity(known)
    out: set[str] = set()
    for text in known:
        parts = sorted((t not in COMMON, (n * idf[t]) ** 2, t) for t, n in Counter(re.findall(TOKEN, text.lower())).items())
        spare = (least * least - 1e-9) * sum(w for _, w, _ in parts)
        for _, w, t in parts:
            spare -= w
            if spare <= 0:
                out.add(t)
    return sorted(out)


def matches(said: DataFrame, known: DataFrame, least: float) -> DataFrame:
    """(statement, license, score) of the distinct ``said`` statements with a template at cosine ``least`` or more."""
    found = known.select("template_id", "license", "statement").collect()  # the templates, a few dozen
    idf, other = rarity([r.statement for r in found])
    weights = {r.template_id: {t: n * idf[t] for t, n in Counter(re.findall(TOKEN, r.statement.lower())).items()} for r in found}
    spark = said.sparkSession
    theirs = [(i, t, v / math.sqrt(sum(x * x for x in w.values())), idf[t]) for i, w in weights.items() for t, v in w.items()]
    theirs = spark.createDataFrame(theirs, "template_id int, token string, v double, idf double")
    rare = theirs.select("token", "idf").distinct()
    ours = said.select("statement", F.explode(F.regexp_extract_all(F.lower("statement"), F.lit(TOKEN), F.lit(0))).alias("token")).groupBy("statement", "token").agg(F.count("*").alias("tf"))
    ours = ours.join(F.broadcast(rare), "token", "left").select("statement", "token", (F.col("tf") * F.coalesce("idf", F.lit(other))).alias("w"))
    size = ours.groupBy("statement").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("size"))
    dots = ours.join(F.broadcast(theirs.drop("idf")), "token").groupBy("statement", "template_id").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    scored = dots.join(size, "statement").select("statement", "template_id", F.round(F.col("dot") / F.col("size"), 6).alias("score")).where(F.col("score") >= least)
    best = scored.groupBy("statement").agg(F.max(F.struct("score", (-F.col("template_id")).alias("k"))).alias("m"))
    names = spark.createDataFrame([(r.template_id, r.license) for r in found], "template_id int, license string")
    return best.select("statement", (-F.col("m.k")).alias("template_id"), F.col("m.score").alias("score")).join(F.broadcast(names), "template_id").select("statement", "license", "score")


def scan(files: DataFrame, known: DataFrame, is_license_file: Column | None = None, least: float = 0.75, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows ``(path, license, score, origin, origin_path)``, one for each row of ``files`` (path, text), and the columns
    ``keep`` of ``files`` beside them.

    ``known`` (template_id, license, statement): a few dozen templates. Score is the cosine of TF-IDF vectors with
    frequencies over the templates. ``origin`` is ``own`` if a sentence of the file itself matches a template (the
    best one counts, of equal scores the licence that sorts last), ``inherited`` if it doesn't but a licence file in
    the nearest directory at or above its own that has one does (the best score, then the least path), else ``none``
    with the rest null. Licence files are told by their names unless a condition on the columns of ``files`` is
    given. Null and empty texts have no statement; a null path neither gives nor inherits a licence; rows that repeat
    a path share what any of them says; an empty ``known`` matches nothing. Texts are read once and never shuffled:
    only sentences that hold a marker of a template are compared, and no other can match.
    """
    test = license_file(F.col("path")) if is_license_file is None else is_license_file
    marks = markers([r.statement for r in known.select("statement").collect()], least)
    gate = lambda c: F.lower(c).rlike("(?<![a-z0-9])(?:" + "|".join(marks) + ")(?![a-z0-9])") if marks else F.lit(False)
    some = files.where(gate(F.col("text")) & F.col("path").isNotNull())
    named = cut(some.select("path", F.coalesce(test, F.lit(False)).alias("file"), F.explode(F.filter(sentences(F.col("text")), gate)).alias("statement")))
    matched = matches(named.select("statement").distinct(), known, least)
    own = cut(named.join(matched, "statement").groupBy("path").agg(F.max("file").alias("file"), F.max(F.struct("score", "license")).alias("m")).select("path", "file", "m.*"))
    giving = own.where("file").withColumn("dir", folder(F.col("path"))).groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), "path", "license")).alias("g"))
    giving = giving.select("dir", F.col("g.license").alias("g_license"), (-F.col("g.s")).alias("g_score"), F.col("g.path").alias("g_path"))
    rows = files.select("path", folder(F.col("path")).alias("dir"), *keep)
    dirs = rows.where("dir is not null").select("dir").distinct().select(F.col("dir").alias("below"), F.posexplode(above(F.col("dir"))).alias("depth", "dir"))
    near = dirs.join(giving, "dir").groupBy("below").agg(F.max(F.struct("depth", "g_license", "g_score", "g_path")).alias("n")).select(F.col("below").alias("dir"), "n.g_license", "n.g_score", "n.g_path")
    out = rows.join(own.drop("file"), "path", "left").join(near, "dir", "left")
    mine, theirs = F.col("license").isNotNull(), F.col("g_license").isNotNull()
    return out.select(
        "path", F.coalesce("license", "g_license").alias("license"), F.when(mine, F.col("score")).otherwise(F.col("g_score")).alias("score"),
        F.when(mine, "own").when(theirs, "inherited").otherwise("none").alias("origin"), F.when(mine, F.col("path")).otherwise(F.col("g_path")).alias("origin_path"), *keep,
    )
