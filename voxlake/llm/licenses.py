"""Operator 5: licence scan by sparse TF-IDF cosine to templates, with inheritance from the nearest ancestor directory.

Units of a file are its sentences (line feeds and sentence ends cut them; unit 1, 2, ...), then the sentences of its paragraphs of several
lines with the lines joined (wrapped headers; comment marks are no words), any of which may be a licence header, and its whole text (unit 0),
which makes it a licence file of its directory.  Vectors are tf-idf over the templates' vocabulary, with document
frequencies over all files; every other word of a unit counts once, at the largest idf, in its norm.  A unit's licence is the
template with the highest cosine of at least `threshold` (ties: first in order).  A file's own licence is its best unit's (ties: whole text
first, then the first sentence).  A file with a licence file's name (LICENSE, COPYING, ...) is a licence file of its directory by any of its
units; if it holds the title or the grant of a full licence text, the first of these is its licence (unit 0, score 1).  A file without one takes that of the nearest directory above that holds a licence file (the best scored,
ties: smallest path).

Only DataFrame functions are used.  Units without any signature word are not scored: signature words are chosen so that what is left
of each template's vector is shorter than the threshold, so such units cannot reach it.  Inheritance is worked out per directory,
so a directory with a third of all files meets the join as one row.

Null and empty texts have no licence of their own; a null path has no directory and inherits nothing; repeated paths are files of their own
if their `keys` differ.  Extra columns are kept out of the result; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.6
#: Licence names and their usual notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This source code form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: Names of licence files.
NAMED = r"(?i)^(.*[-._])?(un)?(licen[cs]e|copying)([-._](txt|md|markdown|rst|html?|lesser|mit|apache|bsd|[al]?gpl|mpl|cc0|cc|by|nc|sa|v?[0-9]+|clause))*$"
PARAGRAPH = r"\n[^a-zA-Z0-9\n]*\n"  # lines without a word part paragraphs
#: Words by which full licence texts are told, and words that must be in the text too.
TEXTS = (
    ("Apache-2.0", "apache license version 2 0 january 2004", ""),
    ("BSD-3-Clause", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "neither the name"),
    ("CC-BY-4.0", "attribution 4 0 international", ""),
    ("CC-BY-NC-4.0", "attribution noncommercial 4 0 international", ""),
    ("CC-BY-SA-4.0", "attribution sharealike 4 0 international", ""),
    ("CC0-1.0", "cc0 1 0 universal", ""),
    ("GPL-2.0", "gnu general public license version 2 june 1991", ""),
    ("GPL-3.0", "gnu general public license version 3 29 june 2007", ""),
    ("LGPL-3.0", "gnu lesser general public license version 3 29 june 2007", ""),
    ("MIT", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ""),
    ("MPL-2.0", "mozilla public license version 2 0", ""),
    ("Unlicense", "this is free and unencumbered software released into the public domain", ""),
)


def words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def vocabulary(templates=TEMPLATES) -> list[str]:
    return sorted({w for _, t in templates for w in words(t)})


def tokens(c):
    """Words of a column: runs of a-z and 0-9 after lower-casing."""
    return F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda w: w != "")


def template_weights(idf: dict[str, float], templates=TEMPLATES) -> list[tuple[int, str, str, float]]:
    """(number, licence, word, weight) of unit-length template vectors."""
    out = []
    for i, (name, text) in enumerate(templates):
        tf = Counter(words(text))
        norm = math.sqrt(sum((n * idf[w]) ** 2 for w, n in tf.items()))
        out += [(i, name, w, n * idf[w] / norm) for w, n in sorted(tf.items())]
    return out


def signature(weights: list[tuple[int, str, str, float]], threshold: float) -> list[str]:
    """Few words such that each template without them is shorter than the threshold."""
    by: dict[int, list[tuple[float, str]]] = {}
    for i, _, w, x in weights:
        by.setdefault(i, []).append((x, w))
    chosen: set[str] = set()
    for rows in by.values():
        rest = sum(x * x for x, w in rows if w not in chosen)
        for x, w in sorted(rows, reverse=True):
            if rest < threshold**2 * 0.999:
                break
            if w not in chosen:
                chosen.add(w)
                rest -= x * x
    return sorted(chosen)


def document_frequencies(files: DataFrame, text_col: str, templates=TEMPLATES) -> tuple[int, dict[str, int]]:
    vocab = F.array(*[F.lit(w) for w in vocabulary(templates)])
    seen = files.select(F.explode(F.array_intersect(tokens(F.col(text_col)), vocab)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return files.count(), {r.word: r.n for r in seen.collect()}  # one row a word of the templates


def _join(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """An equi-join in which nulls equal nulls; the keys stand once."""
    right = right.withColumnsRenamed({c: f"other_{c}" for c in on})
    match = F.lit(True)
    for c in on:
        match &= F.col(c).eqNullSafe(F.col(f"other_{c}"))
    return left.join(right, match, how).drop(*[f"other_{c}" for c in on])


def full_texts(named: DataFrame, keys: list[str]) -> DataFrame:
    """Rows like those of scored units, of licence files by name that hold a full licence text: the one that starts first."""
    plain = F.concat(F.lit(" "), F.array_join(tokens(F.col("text")), " "), F.lit(" "))
    files = named.where(is_named(F.col("path")) & F.col("text").isNotNull()).select(*keys, "path", plain.alias("plain"))
    at = [F.when(F.col("plain").contains(also), F.nullif(F.locate(f" {start} ", F.col("plain")), F.lit(0))) for _, start, also in TEXTS]
    first = F.array_min(F.filter(F.array(*[F.when(c.isNotNull(), F.struct(c.alias("at"), F.lit(name).alias("license"))) for c, (name, *_) in zip(at, TEXTS, strict=True)]), lambda x: x.isNotNull()))
    found = files.select(*keys, "path", first.alias("b")).where("b is not null")
    return found.select(*keys, "path", F.lit(0).alias("unit"), F.lit(-1).alias("template"), "b.license", F.lit(1.0).alias("score"))


def is_named(path):
    return F.coalesce(F.regexp_extract(path, "[^/]*$", 0).rlike(NAMED), F.lit(False))


def scan(files: DataFrame, keys: list[str], path_col: str = "path", text_col: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(*keys, path, license, score, found, unit, license_path) of every file; found: header, file, inherited or none."""
    spark = files.sparkSession
    n, df = document_frequencies(files.where(F.col(text_col).isNotNull()), text_col, templates)
    idf = {w: math.log((n + 1) / (df.get(w, 0) + 1)) + 1 for w in vocabulary(templates)}
    other = math.log(n + 1) + 1
    weights = template_weights(idf, templates)
    gate = rf"(?i)(^|[^a-z0-9])({'|'.join(signature(weights, threshold))})([^a-z0-9]|$)"
    named = files.select(*keys, F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    marked = named.where(F.col("text").rlike(gate))
    ends = lambda c: F.split(F.regexp_replace(c, r"([.!?])\s+", "$1\n"), "\n")
    wrapped = F.filter(F.split("text", PARAGRAPH), lambda c: c.contains("\n"))
    joined = F.flatten(F.transform(wrapped, lambda c: ends(F.translate(c, "\n", " "))))
    units = marked.select(*keys, "path", F.posexplode(F.concat(F.array("text"), ends(F.col("text")), joined)).alias("unit", "part")).where(F.col("part").rlike(gate))
    counted = units.withColumn("words", tokens(F.col("part"))).select(*keys, "path", "unit", F.size("words").alias("size"), F.explode("words").alias("word"))
    vocab = spark.createDataFrame([(w, x) for w, x in idf.items()], "word string, idf double")
    tf = counted.join(F.broadcast(vocab), "word").groupBy(*keys, "path", "unit", "size", "word", "idf").agg(F.count("*").alias("tf"))  # the templates' words only
    group = [*keys, "path", "unit"]
    norms = tf.groupBy(*group, "size").agg(F.sum(F.pow(F.col("tf") * F.col("idf"), 2)).alias("own"), F.sum("tf").alias("known"))
    norms = norms.select(*group, F.sqrt(F.col("own") + (F.col("size") - F.col("known")) * other**2).alias("norm"))
    table = spark.createDataFrame(weights, "template int, license string, word string, weight double")
    dots = tf.join(F.broadcast(table), "word").groupBy(*group, "template", "license").agg(F.sum(F.col("tf") * F.col("idf") * F.col("weight")).alias("dot"))
    cosine = F.round(F.col("dot") / F.col("norm"), 6)
    scored = _join(dots, norms, group, "inner").select(*group, "template", "license", cosine.alias("score")).where(F.col("score") >= threshold)
    scored = scored.unionByName(full_texts(named, keys))
    order = F.struct(-F.col("score"), F.col("unit"), F.col("template"))
    own = scored.groupBy(*keys, "path").agg(F.min_by(F.struct("license", "score", "unit"), order).alias("b"))
    own = own.select(*keys, "path", "b.license", "b.score", "b.unit")
    folder = lambda c: F.regexp_replace(c, "/?[^/]*$", "")
    texts = scored.where((F.col("unit") == 0) | is_named(F.col("path"))).where("path is not null").select(folder(F.col("path")).alias("dir"), "path", "license", "score", "template")
    held = texts.groupBy("dir").agg(F.min_by(F.struct("license", "score", "path"), F.struct(-F.col("score"), F.col("path"), F.col("template"))).alias("l"))
    dirs = named.where("path is not null").select(folder(F.col("path")).alias("own_dir")).distinct()
    steps = F.split("own_dir", "/")
    above = dirs.select("own_dir", F.explode(F.sequence(F.lit(0), F.size(steps))).alias("depth")).withColumn("dir", F.array_join(F.slice(F.split("own_dir", "/"), F.lit(1), F.col("depth")), "/"))
    nearest = above.join(held, "dir").groupBy("own_dir").agg(F.max_by("l", "depth").alias("l"))
    full = _join(named.drop("text"), own, [*keys, "path"], "left")
    full = full.withColumn("own_dir", folder(F.col("path"))).join(nearest, "own_dir", "left")
    mine = F.col("license").isNotNull()
    found = F.when(mine & ((F.col("unit") == 0) | is_named(F.col("path"))), "file").when(mine, "header").when(F.col("l").isNotNull(), "inherited").otherwise("none")
    return full.select(*keys, "path", F.coalesce("license", "l.license").alias("license"), F.coalesce("score", "l.score").alias("score"), found.alias("found"), "unit", F.when(mine, F.col("path")).otherwise(F.col("l.path")).alias("license_path"))


def oracle(table: str, key: str, path: str, templates=TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same in DuckDB SQL, without the signature words; for files without a licence file's name."""
    rows = ", ".join(f"({i}, '{name}', '{w}', {n})" for i, (name, text) in enumerate(templates) for w, n in sorted(Counter(words(text)).items()))
    return f"""
WITH tpl(template, license, word, tf) AS (VALUES {rows}),
files AS (SELECT {key}, {path} AS path, text FROM {table}),
total AS (SELECT count(*) AS n FROM files WHERE text IS NOT NULL),
vocab AS (SELECT DISTINCT word FROM tpl),
tokens AS (SELECT DISTINCT {key}, path, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM files),
df AS (SELECT word, count(*) AS df FROM tokens JOIN vocab USING (word) GROUP BY word),
idf AS (SELECT word, ln((n + 1) / (coalesce(df, 0) + 1)) + 1 AS idf FROM vocab LEFT JOIN df USING (word), total),
w AS (SELECT template, license, word, tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY template)) AS weight FROM tpl JOIN idf USING (word)),
cut AS (SELECT {key}, path, text, list_concat(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(10), 'g'), chr(10)),
  flatten([string_split(regexp_replace(replace(p, chr(10), ' '), '([.!?])\\s+', '\\1' || chr(10), 'g'), chr(10)) FOR p IN string_split_regex(text, '{PARAGRAPH}') IF contains(p, chr(10))])) AS s FROM files WHERE text IS NOT NULL),
units AS (SELECT {key}, path, 0 AS unit, text AS part FROM cut UNION ALL SELECT {key}, path, unnest(range(1, len(s) + 1)) AS unit, unnest(s) AS part FROM cut),
words AS (SELECT {key}, path, unit, regexp_extract_all(lower(part), '[a-z0-9]+') AS l FROM units),
tf AS (SELECT {key}, path, unit, size, word, idf, count(*) AS tf FROM (SELECT {key}, path, unit, len(l) AS size, unnest(l) AS word FROM words) JOIN idf USING (word) GROUP BY ALL),
norms AS (SELECT {key}, path, unit, sqrt(sum((tf * idf) ** 2) + (any_value(size) - sum(tf)) * (ln((SELECT n FROM total) + 1) + 1) ** 2) AS norm FROM tf GROUP BY ALL),
scored AS (SELECT tf.{key}, tf.path, tf.unit, template, license, round(sum(tf.tf * idf * weight) / any_value(norm), 6) AS score
  FROM tf JOIN w USING (word) JOIN norms ON norms.{key} = tf.{key} AND norms.path = tf.path AND norms.unit = tf.unit GROUP BY ALL HAVING score >= {threshold}),
own AS (SELECT {key}, path, first(license ORDER BY score DESC, unit, template) AS license, first(score ORDER BY score DESC, unit, template) AS score, first(unit ORDER BY score DESC, unit, template) AS unit FROM scored GROUP BY ALL),
held AS (SELECT regexp_replace(path, '/?[^/]*$', '') AS dir, first(license ORDER BY score DESC, path, template) AS license, first(score ORDER BY score DESC, path, template) AS score, first(path ORDER BY score DESC, path, template) AS path FROM scored WHERE unit = 0 GROUP BY 1),
near AS (SELECT f.{key}, f.path, first(h.license ORDER BY len(h.dir) DESC) AS license, first(h.score ORDER BY len(h.dir) DESC) AS score, first(h.path ORDER BY len(h.dir) DESC) AS license_path
  FROM files f JOIN held h ON h.dir = '' OR starts_with(f.path, h.dir || '/') GROUP BY ALL)
SELECT f.{key}, f.path, coalesce(o.license, n.license) AS license, coalesce(o.score, n.score) AS score,
  CASE WHEN o.unit = 0 THEN 'file' WHEN o.unit IS NOT NULL THEN 'header' WHEN n.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS found,
  o.unit, CASE WHEN o.unit IS NOT NULL THEN f.path ELSE n.license_path END AS license_path
FROM files f LEFT JOIN own o ON o.{key} = f.{key} AND o.path = f.path LEFT JOIN near n ON n.{key} = f.{key} AND n.path = f.path"""
