"""License scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies them.

Words are lower-case runs of letters and digits; five of them are a shingle. A template of n shingles belongs to the
scale of windows of L = 2 * 2**ceil(log2 n) shingles that begin every L / 4, so some window holds the whole of any
place where the template stands. There the Jaccard index with it is above 0.19 when 0.8 of its shingles are met;
``bands`` of one MinHash value each then collide with probability 1 - 0.81**bands, over 0.999 for 36. A retrieved
window counts if it holds at least ``percent`` of the template's shingles, exactly.

A window's least hash can equal a template's only where both hold that shingle, so windows of a scale are built only
around shingles of its templates; others cannot be retrieved, and nothing is lost. Templates are those of this module or
a table (license, body) of the user's own; what is broadcast is as large as they are.

A text is cut into segments of at least SEGMENT words, each with the words that its last windows reach. The shingles of a segment
are hashed once, and windows are slices of these, so work and memory go with the length of a text, however many hits it has.

The result has a row per document and license found in it. Null and wordless texts have none, repeated rows of a doc_id
count as one document, an empty table gives no rows, and extra columns don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import computed_once, read_table, shuffle_partitions, whole_text

# The wording of common license lines and notices.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "bsd-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-line": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-line": "Licensed under CC BY-SA 4.0",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mit-line": "Released under the MIT License",
    "mit-notice": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions',
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software",
}


#: Words of a segment at least.
SEGMENT = 1024


@dataclass(frozen=True)
class LicenseParams:
    words: int = 5
    percent: int = 80
    bands: int = 36


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def shingle(words: Column, k: Column, n: int) -> Column:
    """The hash of the n words from number k (from 0)."""
    return F.xxhash64(*(F.get(words, k + i) for i in range(n)))


def template_table(spark: SparkSession, params: LicenseParams, templates: dict[str, str] | DataFrame = TEMPLATES) -> DataFrame:
    """(license, parts, scale): each template's distinct shingles and the exponent of its scale; one too short for a shingle is refused."""
    rows = templates.select("license", "body") if isinstance(templates, DataFrame) else spark.createDataFrame(sorted(templates.items()), "license string, body string")
    rows = rows.withColumn("w", words_of(F.coalesce("body", F.lit(""))))
    short = [r["license"] for r in rows.filter(F.size("w") < params.words).select("license").collect()]
    if short:
        raise ValueError(f"templates {short} have fewer than {params.words} words")
    parts = F.array_distinct(F.transform(F.sequence(F.lit(0), F.size("w") - params.words), lambda k: shingle(F.col("w"), k, params.words)))
    rows = rows.select("license", parts.alias("parts"))
    return rows.withColumn("scale", F.ceil(F.log2(F.size("parts"))).cast("int"))


def band_values(parts: Column, bands: int) -> Column:
    """array<struct<band, value>>: the least hash of each band's function over the shingles."""
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.struct(b.alias("band"), F.array_min(F.transform(parts, lambda x: F.xxhash64(x, b))).alias("value")))


def _step(scale: int, own: list[int]) -> Column:
    """The windows of a scale, and the hits that are shingles of its templates."""
    near = F.filter("hits", lambda k: F.get(F.col("h"), k).isin(own))
    return F.struct(F.lit(scale).alias("scale"), F.lit(2 << scale).alias("size"), F.lit(max(1, (2 << scale) // 4)).alias("step"), near.alias("near"))


def segments(docs: DataFrame, n: int, most: int) -> tuple[DataFrame, int]:
    """(doc_id, base, h): the shingles of each segment of a text and of the ``most`` behind it, and a segment's length."""
    length = max(SEGMENT, 1 << (most - 1).bit_length())  # a multiple of every scale's step
    rows = computed_once(docs.select("doc_id", "text"), "w", words_of(whole_text()), "doc_id").filter(F.size("w") >= n)
    cuts = F.transform(F.sequence(F.lit(0), F.expr(f"cast((size(w) - {n}) div {length} as int)")), lambda s: F.struct((s * length).alias("base"), F.slice(F.col("w"), s * length + 1, F.lit(length + most + n - 1)).alias("own")))
    rows = rows.select("doc_id", F.explode(cuts).alias("s")).select("doc_id", "s.*")
    return computed_once(rows, "h", F.transform(F.sequence(F.lit(0), F.size("own") - n), lambda k: shingle(F.col("own"), k, n)), "doc_id", "base"), length


def scan(docs: DataFrame, params: LicenseParams = LicenseParams(), templates: dict[str, str] | DataFrame = TEMPLATES) -> DataFrame:
    """doc_id, license, containment, first_word, last_word, n_windows of each license in a document."""
    spark, n = docs.sparkSession, params.words
    table = template_table(spark, params, templates)
    known = table.collect()  # as many rows as templates
    vocabulary = sorted({x for r in known for x in r["parts"]})
    scales = sorted({r["scale"] for r in known})
    rows, length = segments(docs, n, 2 << max(scales, default=0))
    at = F.filter(F.sequence(F.lit(0), F.size("h") - 1), lambda k: F.get(F.col("h"), k).isin(vocabulary))
    rows = computed_once(rows, "hits", at, "doc_id", "base", "h").filter(F.size("hits") > 0)
    rows = rows.repartition(shuffle_partitions(spark), "doc_id", "base")  # few segments, but a text full of hits is many tasks' work
    # windows of each scale around the hits of its templates; those that begin in the segment are its own
    own = {s: sorted({x for r in known if r["scale"] == s for x in r["parts"]}) for s in scales}
    steps = F.array(*(_step(s, own[s]) for s in scales))
    rows = rows.select("doc_id", "base", "h", F.explode(F.filter(steps, lambda s: F.size(s["near"]) > 0)).alias("s")).select("doc_id", "base", "h", "s.*")
    begins = "array_distinct(flatten(transform(near, p -> transform(sequence(greatest(0, p - size + step) div step, p div step), q -> cast(q * step as int)))))"
    windows = f"transform(filter({begins}, b -> b < {length}), b -> struct(base + b as begin, slice(h, b + 1, size) as window))"
    rows = rows.select("doc_id", "scale", F.explode(F.expr(windows)).alias("x")).select("doc_id", "scale", "x.*")
    keys = table.select("license", "parts", F.col("scale").alias("t_scale"), F.explode(band_values(F.col("parts"), params.bands)).alias("t"))
    values = sorted({r["value"] for r in keys.select("t.value").distinct().collect()})  # templates x bands rows at most
    # bands that no template has are dropped before they become rows
    met = F.filter(band_values(F.col("window"), params.bands), lambda b: b["value"].isin(values))
    banded = rows.select("doc_id", "scale", "begin", "window", F.explode(met).alias("b"))
    met = banded.join(F.broadcast(keys), (F.col("scale") == F.col("t_scale")) & (F.col("b.band") == F.col("t.band")) & (F.col("b.value") == F.col("t.value")))
    # verified at once: a window met in several bands passes as often, which the sum below undoes
    shared = F.size(F.array_intersect("window", "parts"))
    good = met.withColumn("shared", shared).withColumn("n", F.size("parts")).filter(F.lit(100) * F.col("shared") >= F.lit(params.percent) * F.col("n"))
    first = F.col("begin") + F.expr("array_min(filter(transform(window, (x, k) -> if(array_contains(parts, x), k, null)), k -> k is not null))")
    last = F.col("begin") + F.expr("array_max(filter(transform(window, (x, k) -> if(array_contains(parts, x), k, null)), k -> k is not null))") + (n - 1)
    good = good.select("doc_id", "license", (F.col("shared") / F.col("n")).alias("containment"), first.alias("first_word"), last.alias("last_word"), "begin", "scale")
    return good.groupBy("doc_id", "license").agg(F.max("containment").alias("containment"), F.min("first_word").cast("long").alias("first_word"), F.max("last_word").cast("long").alias("last_word"), F.count_distinct("scale", "begin").alias("n_windows"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))
