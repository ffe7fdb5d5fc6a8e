"""License scan: MinHash bands over overlapping text windows, then exact containment (DataFrame functions only).

Texts and templates are sequences of words (lower case, letters and digits); their five-word
shingles are hashed. A text contains a template of ``s`` shingles where some run of ``2 s`` shingles
holds ``CONTAINED`` or more of its distinct shingles (words may be put in between).

Windows. For every template length the text has a window every ``g`` shingles (``g`` is a quarter of ``s``, rounded up),
of ``2 s + g - 1`` shingles, so any run of ``2 s`` lies in the window of its start as a whole.

Bands. Signatures have ``BANDS`` bands of one minimum each, and a window retrieves the templates of its length that have
the same minimum in some band. A window round a containing run has a Jaccard similarity of 0.8 / 2.45 or more with the
template, so they collide with probability 1 - 0.673 ** BANDS (0.999997) or more. The templates' band table is small and fixed, so each
row looks it up by itself, without a shuffle. A minimum can only agree in a window that holds the shingle it comes from: signatures are
computed for the windows that hold such a shingle, for no others, which loses no collision.

Exact check. In the windows retrieved, every run that starts at a shingle of the template within the window's
first ``g`` is judged by the share of the template's shingles it holds.

Defined cases: null and blank texts and texts under five words match nothing; a template
repeated in a document gives one row, with the place of its best (then first) run; repeated
rows give one row per doc_id and template, rows under one doc_id are judged one by one; a template of under five words is never found;
an empty table gives an empty result; other columns of the input are not read.
"""
from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
CONTAINED = 0.8
BANDS = 32

# Notices as their licenses word them, by license identifier.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("GPL-2.0", "GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("LGPL", "under the terms of the GNU Lesser General Public License as published by"),
    ("AGPL", "under the terms of the GNU Affero General Public License as published by"),
    ("BSD-3-Clause", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
                "this software to the public domain worldwide."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("EPL-2.0", "made available under the terms of the Eclipse Public License 2.0"),
    ("Zlib", "In no event will the authors be held liable for any damages arising from the use of this software."),
]
SPLIT = r"[^\p{L}\p{N}]+"


def _words(text: Column) -> Column:
    t = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "^" + SPLIT + "|" + SPLIT + "$", "")
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPLIT))


def _once(df: DataFrame) -> DataFrame:
    """``df``, below which later steps move nothing: its columns are computed once, not again for each use."""
    return df.withColumn("_once", F.monotonically_increasing_id()).filter(F.col("_once") >= 0).drop("_once")


def with_shingles(df: DataFrame, text: str, w: str, h: str) -> DataFrame:
    """``df`` with the hash of the shingle at each word; ``text`` and the words go."""
    df = df.withColumn(w, _words(F.col(text))).drop(text)
    n = F.greatest(F.size(w) - (SHINGLE - 1), F.lit(0))
    grams = F.transform(F.slice(w, F.lit(1), n), lambda x, i: F.xxhash64(x, *[F.get(F.col(w), i + k) for k in range(1, SHINGLE)]))
    return _once(df.withColumn(h, grams).drop(w))


def _signature(h: Column) -> Column:
    """Per band the least hash of the shingles."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.array_min(F.transform(h, lambda x: F.xxhash64(x, b))))


@functools.cache
def _hashed(spark: SparkSession, templates: tuple) -> list:
    """Per template: its number, distinct shingles, length ``s``, band minima, and the shingles they come from."""
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(templates)], "no int, text string")
    df = with_shingles(df, "text", "w", "h").filter(F.size("h") > 0)
    df = df.select("no", F.size("h").alias("s"), F.array_distinct("h").alias("h")).withColumn("m", _signature(F.col("h")))
    source = F.transform("m", lambda m, b: F.filter("h", lambda x: F.xxhash64(x, b) == m))
    return df.withColumn("keys", F.array_distinct(F.flatten(source))).collect()


def scan(docs: DataFrame, templates=tuple(TEMPLATES)) -> DataFrame:
    """(doc_id, license, template, start, shared, n_shingles): the templates found, ``start`` the
    first word of the best run, ``shared`` of the template's ``n_shingles`` distinct shingles in it."""
    known = _hashed(docs.sparkSession, tuple(templates))
    longs = lambda xs: F.array(*[F.lit(x) for x in xs])
    lengths = sorted({r.s for r in known})
    by_length = F.array(*[F.struct(
        F.lit(s).alias("s"), F.lit(-(-s // 4)).alias("g"), longs(sorted({x for r in known if r.s == s for x in r["keys"]})).alias("keys"),
        F.array(*[F.struct(F.lit(r.no).alias("no"), longs(r.h).alias("h"), longs(r.m).alias("m")) for r in known if r.s == s]).alias("t"))
        for s in lengths])
    keys = sorted({x for r in known for x in r["keys"]})
    df = with_shingles(docs.select("doc_id", "text"), "text", "w", "h")
    df = df.withColumn("at", F.filter(F.transform("h", lambda x, i: F.when(x.isin(keys), i)), lambda i: i.isNotNull()))
    df = _once(df).filter(F.size("at") > 0)
    # per template length the windows that hold the source of a minimum
    window = lambda c: 2 * c["s"] + c["g"] - 1
    starts = lambda c, p: F.sequence(
        F.greatest(F.ceil((p - window(c) + 1) / c["g"]), F.lit(0)).cast("int"), F.floor(p / c["g"]).cast("int"))
    hits = lambda c: F.filter("at", lambda p: F.array_contains(c["keys"], F.get(F.col("h"), p)))
    df = df.withColumn("wins", F.flatten(F.transform(by_length, lambda c, no: F.transform(
        F.array_distinct(F.flatten(F.transform(hits(c), lambda p: starts(c, p)))), lambda k: F.struct(
            no.alias("no"), (k * c["g"]).alias("start"),
            F.slice("h", k * c["g"] + 1, window(c)).alias("h"))))))
    df = _once(df.select("doc_id", "wins")).select("doc_id", F.explode("wins").alias("x")).select("doc_id", "x.*")
    df = _once(df.withColumn("m", _signature(F.col("h"))))
    # an equal minimum in some band retrieves a template
    of = lambda field: F.get(by_length, F.col("no"))[field]
    df = df.select("doc_id", of("s").alias("s"), of("g").alias("g"), "start", "h", F.explode(F.filter(of("t"), lambda t: F.exists(
        F.zip_with(t["m"], "m", lambda a, b: a == b), lambda e: e))).alias("t"))
    # the runs that start at a shingle of the template in the window's first g
    df = df.withColumn("runs", F.filter(
        F.transform(F.slice("h", F.lit(1), F.col("g")), lambda x, a: F.when(F.array_contains("t.h", x), F.struct(
            F.size(F.array_intersect(F.slice("h", a + 1, 2 * F.col("s")), F.col("t.h"))).alias("shared"),
            (-(F.col("start") + a)).alias("neg")))),
        lambda r: 5 * r["shared"] >= 4 * F.size("t.h")))
    df = _once(df.select("doc_id", F.col("t.no").alias("template"), F.size("t.h").alias("n_shingles"), F.array_max("runs").alias("b")))
    best = (df.filter(F.col("b").isNotNull()).groupBy("doc_id", "template", "n_shingles").agg(F.max("b").alias("b")))
    name = F.element_at(F.array(*[F.lit(k) for k, _ in templates]), F.col("template") + 1)
    return best.select("doc_id", name.alias("license"), "template", (-F.col("b.neg")).alias("start"), F.col("b.shared").alias("shared"), "n_shingles")


def oracle() -> str:
    rows = ", ".join("({}, '{}', '{}')".format(i, k, t.replace("'", "''")) for i, (k, t) in enumerate(TEMPLATES))
    words = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
    grams = "unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) AS g, unnest(range(len(w) - 4)) AS q"
    return f"""
WITH t AS (SELECT * FROM (VALUES {rows}) AS v(template, license, text)),
tw AS (SELECT template, license, {words} AS w FROM t),
tg AS (SELECT template, license, len(w) - 4 AS s, {grams} FROM tw),
tn AS (SELECT template, license, s, count(DISTINCT g) AS n FROM tg GROUP BY ALL),
d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
dg AS (SELECT r, doc_id, {grams} FROM d WHERE len(w) >= 5),
hit AS (SELECT DISTINCT dg.r, dg.doc_id, x.template, x.s, dg.g, dg.q FROM dg JOIN tg x ON dg.g = x.g),
run AS (SELECT a.r, a.doc_id, a.template, a.q, count(DISTINCT b.g) AS shared
        FROM hit a JOIN hit b ON a.r = b.r AND a.template = b.template AND b.q >= a.q AND b.q < a.q + 2 * a.s GROUP BY ALL),
ok AS (SELECT run.*, license, n FROM run JOIN tn ON tn.template = run.template WHERE 5 * shared >= 4 * n)
SELECT doc_id, license, template, CAST(arg_min(q, -shared * 1000000000 + q) AS INTEGER) AS start,
       CAST(max(shared) AS INTEGER) AS shared, CAST(n AS INTEGER) AS n_shingles
FROM ok GROUP BY doc_id, license, template, n
"""
