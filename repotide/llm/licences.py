"""Licence scan: texts against licence templates by the Dice coefficient of word bigrams.

Lines and passages are compared, as lower-cased words only. Bigrams count as often as they occur.

* A line counts as a whole, for the template it is most like.
* A passage is a window of as many words as a template, wherever lines end, so a paragraph that is
  wrapped or stands inside a longer line is found. Windows start at bigrams of the template: moving
  a window on to its first one never lowers the coefficient. A window that would pass the end of the
  text ends there. Of windows that overlap the one most like its template counts.
* A line does not count where a passage that goes on beyond it is more like its template; else passages
  do not count in a line of the same licence or one that is as like.

Texts are read once for the places of bigrams that any template has, and go on only if some of these
lie as close together as a match of a template's size takes. Those texts meet the templates at common
bigrams, in one broadcast join: the templates are a fixed list. Only windows with enough common bigrams
in them are compared. Only DataFrame functions are used.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repotide.llm.common import read, words

THRESHOLD = 0.8

# Notices and paragraphs by which public licences are stated.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),  # noqa: E501
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),  # noqa: E501
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),  # noqa: E501
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),  # noqa: E501
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),  # noqa: E501
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),  # noqa: E501
    ("BSD-3-Clause", "Released under the 3-clause BSD License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),  # noqa: E501
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),  # noqa: E501
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),  # noqa: E501
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)


def template_bigrams(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """(template, licence, size, bigram, times); a text of fewer than two words has none."""
    rows = spark.createDataFrame(
        [(i, *t) for i, t in enumerate(templates)], "template INT, licence STRING, text STRING"
    )
    rows = rows.select("template", "licence", words(F.col("text")).alias("w")).where(F.size("w") > 1)
    size = (F.size("w") - 1).alias("size")
    pair = F.explode(F.arrays_zip(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w") - 1)))
    pairs = rows.select("template", "licence", size, pair.alias("p"))
    bigram = F.xxhash64("p.0", "p.1").alias("bigram")
    return pairs.select("template", "licence", "size", bigram).groupBy(
        "template", "licence", "size", "bigram"
    ).agg(F.count("*").alias("times"))


def _promising(docs: DataFrame, listed: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, text) of the texts that a match is possible in.

    With s bigrams of a template and n of a unit, twice the common ones are at least t (n + s) of a match, so
    there are t s / (2 - t) of them or more, and n is no more than s (2 - t) / t.
    """
    # As many as the templates have: a fixed list.
    known = listed.select("bigram", "size").distinct().collect()
    bigrams = sorted({row["bigram"] for row in known})
    texts = docs.select("doc_id", "text", words(F.col("text")).alias("w"))
    n = F.size("w") - 1
    held = lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1)).isin(bigrams)
    places = F.when(n > 0, F.filter(F.sequence(F.lit(0), n - 1), held))
    texts = texts.select("doc_id", "text", places.alias("places"))

    def close(size: int) -> Column:
        least = max(1, math.ceil(threshold * size / (2 - threshold) - 1e-9))
        most = math.floor(size * (2 - threshold) / threshold + 1e-9)
        return F.exists(
            F.transform("places", lambda p, i: F.get("places", i + (least - 1)) - p < most), lambda x: x
        )

    fit = reduce(lambda a, b: a | b, (close(size) for size in sorted({row["size"] for row in known})), F.lit(False))
    # A generator, as a filter here would make the places be looked for twice.
    kept = texts.select("doc_id", F.explode_outer(F.when(fit, F.array("text"))).alias("text"))
    return kept.where("text IS NOT NULL")


def common_bigrams(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, row, n_all, template, licence, size, hits): per text and template the bigrams of the text
    that the template has, by place. ``row`` tells repeated rows apart, ``n_all`` is the bigrams of the text.

    A hit has ``pos`` in the text, ``line``, ``at`` in the line, ``n`` (bigrams of the line), ``inner`` (it does
    not cross a line end), ``bigram`` and ``times`` in the template.
    """
    listed = template_bigrams(docs.sparkSession, templates)
    docs = _promising(docs, listed, threshold)
    row = F.monotonically_increasing_id().alias("row")
    split = F.transform(F.split("text", "\n"), lambda own: words(own))
    lines = docs.select("doc_id", row, split.alias("lines"))
    word = lambda own, line: F.transform(
        own, lambda w, at: F.struct(line.alias("line"), at.alias("at"), (F.size(own) - 1).alias("n"), w.alias("word"))
    )
    texts = lines.select("doc_id", "row", F.flatten(F.transform("lines", word)).alias("w"))
    n_all = F.size("w") - 1
    bigram = lambda i: F.struct(
        *[F.get("w", i)[c].alias(c) for c in ("line", "at", "n")],
        F.xxhash64(F.get("w", i)["word"], F.get("w", i + 1)["word"]).alias("bigram"),
    )
    bigrams = F.when(n_all > 0, F.transform(F.sequence(F.lit(0), n_all - 1), bigram))
    # Outer: a filter on the number of bigrams would make the words be computed again for each.
    pairs = texts.select("doc_id", "row", n_all.alias("n_all"), F.posexplode_outer(bigrams).alias("pos", "b"))
    pairs = pairs.select("doc_id", "row", "n_all", "pos", "b.*")
    inner = (F.col("at") < F.col("n")).alias("inner")
    hit = F.struct("pos", "line", "at", "n", inner, "bigram", "times")
    met = pairs.join(F.broadcast(listed), "bigram").groupBy("doc_id", "row", "n_all", "template", "licence", "size")
    return met.agg(F.sort_array(F.collect_list(hit)).alias("hits"))


def _dice(hits: Column, n: Column, size: Column) -> Column:
    """Of a unit of n bigrams that has these in common with a template."""
    own = lambda h: F.size(F.filter(hits, lambda x: x["bigram"] == h["bigram"]))
    # Each occurrence carries its share of what its bigram counts.
    share = lambda h: F.least(h["times"], own(h)) / own(h)
    both = F.round(F.aggregate(hits, F.lit(0.0), lambda total, h: total + share(h)))
    return 2 * both / (n + size)


def _lines(hits: DataFrame, threshold: float) -> DataFrame:
    """``hits`` with ``found``: the lines that are like the template, as spans of words from start to end."""
    size, most = F.col("size"), (2 - threshold) / threshold

    def line(h: Column, i: Column) -> Column:
        own = F.filter(F.slice("hits", i + 1, h["n"]), lambda x: (x["line"] == h["line"]) & x["inner"])
        first = (i == 0) | (F.get("hits", i - 1)["line"] != h["line"])
        fits = (h["n"] >= size / most) & (h["n"] <= size * most)
        start = h["pos"] - h["at"]
        dice = F.when(h["inner"] & first & fits, _dice(own, h["n"], size))
        return F.struct(dice.alias("dice"), start.alias("start"), (start + h["n"] + 1).alias("end"), h["line"].alias("line"))

    found = F.filter(F.transform("hits", line), lambda x: x["dice"] >= threshold)
    return hits.withColumn("found", found)


def _windows(hits: DataFrame, threshold: float) -> DataFrame:
    """``hits`` with ``found``: the windows that are like the template, as spans of words from start to end."""
    size = F.col("size")

    def window(h: Column, i: Column) -> Column:
        n = F.least(size, F.col("n_all") - h["pos"]).cast("int")
        own = F.filter(F.slice("hits", i + 1, n), lambda x: x["pos"] < h["pos"] + n)
        least = F.ceil(threshold * (n + size) / 2 - 0.001).cast("int")
        enough = F.get("hits", i + least - 1)["pos"] < h["pos"] + n
        dice = F.when(enough, _dice(own, n, size))
        return F.struct(dice.alias("dice"), h["pos"].alias("start"), (h["pos"] + n + 1).alias("end"), h["line"].alias("line"))

    found = F.filter(F.transform("hits", window), lambda x: x["dice"] >= threshold)
    return hits.withColumn("found", found)


def _spans(rows: DataFrame, found: str) -> DataFrame:
    return rows.select("doc_id", "row", "template", "licence", F.explode(found).alias("f")).select(
        "doc_id", "row", "template", "licence", "f.*"
    )


def _best_lines(lines: DataFrame) -> DataFrame:
    order = Window.partitionBy("row", "line").orderBy(F.desc("dice"), "template")
    return lines.withColumn("place", F.row_number().over(order)).where("place = 1").drop("place")


def licence_lines(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, row, line, licence, dice): lines like a template, each with the one it is most like.

    Of equally good templates the first in the list counts. Null texts and lines of fewer than two
    words match nothing. Lines are numbered from 0.
    """
    lines = _spans(_lines(common_bigrams(docs, templates, threshold), threshold), "found")
    return _best_lines(lines).select("doc_id", "row", "line", "licence", "dice")


def licence_places(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, row, line, licence, dice): ``licence_lines``, and passages with the line they start in."""
    hits = common_bigrams(docs, templates, threshold)
    both = _windows(_lines(hits, threshold).withColumnRenamed("found", "lines"), threshold)
    kind = lambda whole: lambda x: x.withField("whole", F.lit(whole))
    found = F.concat(F.transform("lines", kind(True)), F.transform("found", kind(False)))
    spans = _spans(both.select("doc_id", "row", "template", "licence", found.alias("found")), "found")
    # Per text the lines in order and the windows from the best on, each line by its best template first.
    span = lambda *first: F.struct(*first, "template", "start", "end", "line", "licence", "dice")
    worse = (-F.col("dice")).alias("worse")
    texts = spans.groupBy("doc_id", "row").agg(
        F.sort_array(F.collect_list(F.when(F.col("whole"), span(F.col("line").alias("own"), worse)))).alias("lines"),
        F.sort_array(F.collect_list(F.when(~F.col("whole"), span(worse)))).alias("windows"),
    )
    meet = lambda x, y: (x["start"] < y["end"]) & (y["start"] < x["end"])
    again = lambda i: (i > 0) & (F.get("lines", i - 1)["line"] == F.get("lines", i)["line"])
    apart = F.aggregate(
        "windows",
        F.filter("windows", lambda x: F.lit(False)),
        lambda kept, x: F.when(F.exists(kept, lambda k: meet(k, x)), kept).otherwise(F.concat(kept, F.array(x))),
    )
    texts = texts.select("doc_id", "row", F.filter("lines", lambda _, i: ~again(i)).alias("lines"), apart.alias("windows"))
    passes = lambda own, x: meet(own, x) & ((x["start"] < own["start"]) | (x["end"] > own["end"]))
    lost = lambda own: F.exists("windows", lambda x: passes(own, x) & (x["dice"] > own["dice"]))
    texts = texts.select("doc_id", "row", F.filter("lines", lambda own: ~lost(own)).alias("lines"), "windows")
    covers = lambda own, x: meet(own, x) & ((own["licence"] == x["licence"]) | (own["dice"] >= x["dice"]))
    free = F.filter("windows", lambda x: ~F.exists("lines", lambda own: covers(own, x)))
    place = lambda x: F.struct(x["line"].alias("line"), x["licence"].alias("licence"), x["dice"].alias("dice"))
    places = F.concat(F.transform("lines", place), F.transform(free, place))
    return texts.select("doc_id", "row", F.explode(places).alias("p")).select("doc_id", "row", "p.*")


def licences(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document number and licence found in it: n_lines, first_line, best dice.

    Lines count that are like a template or in which a passage starts. Rows with one number, repeated
    or not, are one document. Documents without a match have no row. Very long texts are searched whole,
    in memory of some ten times their size. Other columns are ignored; no rows give no rows.
    """
    found = licence_places(docs, templates, threshold)
    return found.groupBy("doc_id", "licence").agg(
        F.count_distinct("row", "line").alias("n_lines"),
        F.min("line").alias("first_line"),
        F.max("dice").alias("dice"),
    )


def op8_licence_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences(read(spark, sf_dir, "documents"))


_VALUES = ",\n    ".join(
    f"({i}, '{name}', '{text.replace(chr(39), chr(39) * 2)}')" for i, (name, text) in enumerate(TEMPLATES)
)

SQL = f"""
WITH t AS (
  SELECT template, licence, [x for x in
    regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+') if x <> ''] AS w
  FROM (VALUES {_VALUES}) v(template, licence, text)),
tb AS (
  SELECT template, licence, len(w) - 1 AS size, unnest([w[i] || ' ' || w[i + 1]
    for i in range(1, len(w))]) AS bigram FROM t),
tc AS (SELECT template, licence, size, bigram, count(*) AS times FROM tb GROUP BY ALL),
l AS (
  SELECT doc_id, unnest(range(len(ls))) AS line, unnest(ls) AS text
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
lw AS (
  SELECT doc_id, line, [x for x in
    regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+') if x <> ''] AS w FROM l),
lb AS (
  SELECT doc_id, line, len(w) - 1 AS n, unnest([w[i] || ' ' || w[i + 1]
    for i in range(1, len(w))]) AS bigram FROM lw WHERE len(w) > 1),
lc AS (SELECT doc_id, line, n, bigram, count(*) AS own_times FROM lb GROUP BY ALL),
s AS (
  SELECT doc_id, line, n, template, licence, size, sum(least(times, own_times)) AS shared
  FROM lc JOIN tc USING (bigram) GROUP BY ALL),
d AS (SELECT *, 2 * shared::DOUBLE / (n + size) AS dice FROM s),
b AS (
  SELECT * FROM d WHERE dice >= {THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, template) = 1)
SELECT doc_id, licence, count(*) AS n_lines, min(line)::INT AS first_line, max(dice) AS dice
FROM b GROUP BY doc_id, licence
"""
