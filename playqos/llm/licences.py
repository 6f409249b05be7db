"""Licence scan: lines, paragraphs and windows of a text compared with licence templates by Dice over word bigrams.

Texts are normalised to lower-case words of letters, digits and dots inside numbers. A unit (a line, or a paragraph of
several lines) and a template are as alike as 2 * common / (a + b), with a and b their numbers of bigrams, repeats included. As common
is at most min(a, b), only units of sizes near a template's can reach the threshold: units are dropped by their
number of words before any bigram is made, and templates by their own bounds when bigrams are joined.
The join is on bigrams, against the table of the templates' bigrams, whose size is checked. DataFrame functions only.

A notice inside a longer line, or over some lines of a longer paragraph, is found by windows of the whole text's words, as long
as the template: those where at least a third of the template's bigrams (and two) are in their places, each scored by Dice
on its own bigrams. `n_units` counts lines and paragraphs, or windows where none of these matches.

A unit that reaches the threshold shares so many bigrams with its template that it must hold one of a few of the
template's words (`anchors`). Texts without any of these words are left out before they are cut.

Defined results: a null or empty text has no licence. Of equally good templates the name smaller by code point
wins. Rows are scanned one by one: repeated rows give the same result, each for itself; texts that differ under one id are
told apart. An empty table gives no rows. Other columns are not carried.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playqos.llm.common import stored

THRESHOLD = 0.8
#: The bigrams of all templates are sent to every task.
MAX_BIGRAMS = 200_000

#: Templates: notices that name a licence, and the texts of short licences (public wording).
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def words_of(text: str) -> list[str]:
    """The normalisation in Python, for templates; `normalised` is the same for columns."""
    lowered = re.sub(r"[^a-z0-9.]+", " ", text.translate({i: i + 32 for i in range(65, 91)}))
    return [w for w in re.sub(r"\.+( |$)", " ", lowered).split(" ") if w]


def normalised(text: Column) -> Column:
    """Words separated by single spaces; other alphabets are separators."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    spaced = F.regexp_replace(lowered, r"[^a-z0-9.]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(spaced, r"\.+( |$)", " "), " +", " "))


def bigrams_of(words: list[str]) -> Counter[str]:
    return Counter(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))


def template_table(templates: Sequence[tuple[str, str]]) -> list[tuple[int, str, int, str, int]]:
    """(number, name, bigrams of the template, bigram, how often)"""
    rows = []
    for i, (name, text) in enumerate(templates):
        found = bigrams_of(words_of(text))
        if not found:
            raise ValueError(f"template of {name} has less than two words")
        rows += [(i, name, found.total(), bigram, n) for bigram, n in sorted(found.items())]
    if len(rows) > MAX_BIGRAMS:
        raise ValueError(f"{len(rows)} bigrams of templates; at most {MAX_BIGRAMS} can be sent to every task")
    return rows


def _possible(size: Column, sizes: Sequence[int], threshold: float) -> Column:
    """Whether a unit of so many bigrams is near enough to some template's size. Sizes that overlap are one range."""
    spans: list[list[float]] = []
    for b in sorted(set(sizes)):
        low, high = b * threshold / (2 - threshold), b * (2 - threshold) / threshold
        if spans and low <= spans[-1][1]:
            spans[-1][1] = high
        else:
            spans.append([low, high])
    return reduce(Column.__or__, [(size >= F.lit(low)) & (size <= F.lit(high)) for low, high in spans])


def anchors(templates: Sequence[tuple[str, str]], threshold: float = THRESHOLD) -> list[str]:
    """Words of which each unit or window that reaches the threshold holds at least one.

    With a of at least b * t / (2 - t), a threshold t asks for b * t / (2 - t) common bigrams or more. So words that leave
    fewer of the template's bigrams without any of them cannot all be missing. Longer words are taken first, and words
    that are taken already.
    """
    taken: set[str] = set()
    for _, text in sorted(templates, key=lambda t: len(t[1])):
        left = bigrams_of(words_of(text))
        needed = left.total() * threshold / (2 - threshold)
        words = sorted({w for pair in left for w in pair.split(" ")}, key=lambda w: (w not in taken, -len(w), w))
        for word in words:
            if left.total() < needed - 1e-9:
                break
            rest = Counter({pair: n for pair, n in left.items() if word not in pair.split(" ")})
            if rest != left:
                taken.add(word)
                left = rest
    return sorted(taken)


def possible(docs: DataFrame, templates: Sequence[tuple[str, str]], threshold: float) -> DataFrame:
    """The rows whose text holds an anchor, inside a longer word or not."""
    # Lower-casing all letters only adds to what A-Z alone would match.
    lowered = F.explode(F.array(F.lower("text"))).alias("lowered")
    rows = docs.where("text IS NOT NULL").select("doc_id", "text", lowered)
    some = reduce(Column.__or__, [F.col("lowered").contains(word) for word in anchors(templates, threshold)])
    return rows.where(some).select("doc_id", "text")


def place_table(templates: Sequence[tuple[str, str]]) -> list[tuple[int, str, int, int, str, int]]:
    """(number, name, bigrams of the template, place, bigram there, how often the template has it)"""
    rows = []
    for i, (name, text) in enumerate(templates):
        words = words_of(text)
        times = bigrams_of(words)
        pairs = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
        rows += [(i, name, len(pairs), j, pair, times[pair]) for j, pair in enumerate(pairs)]
    return rows


def _pairs(words: str) -> Column:
    """Hashes of an array's bigrams in order; it must have two words."""
    return F.transform(
        F.sequence(F.lit(1), F.size(words) - 1),
        lambda i: F.xxhash64(F.concat(F.get(words, i - 1), F.lit(" "), F.get(words, i))),
    )


def windows(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Matching windows as in `matches`; kind 2, the unit's number is the place of the template's first word, which may be
    before the text's first one."""
    table = docs.sparkSession.createDataFrame(
        place_table(templates), "template int, licence string, b int, j int, bigram string, times int"
    ).withColumn("bigram", F.xxhash64("bigram"))
    words = F.explode(F.array(F.split(normalised(F.col("text")), " "))).alias("words")
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("at"), words)
    texts = texts.where(F.size("words") > 1).withColumn("a", F.size("words") - 1)
    bigrams = texts.select("doc_id", "text_hash", "at", "a", F.posexplode(_pairs("words")).alias("i", "bigram"))
    hits = stored(bigrams.join(F.broadcast(table), "bigram"), "licence-places")  # both uses must see the same numbers
    one = ["doc_id", "text_hash", "at", "a", "template", "licence", "b"]
    starts = hits.groupBy(*one, (F.col("i") - F.col("j")).alias("start")).count()
    starts = starts.where((F.col("count") >= 2) & (F.col("count") * 3 >= F.col("b"))).drop("count")
    # Windows and bigrams meet by blocks of the template's length, so a text of very many notices does not pair them all.
    block = F.floor(F.greatest("start", F.lit(0)) / F.col("b"))
    starts = starts.withColumn("block", F.explode(F.array(block, block + 1)))
    near = hits.select("at", "template", "i", "bigram", "times", F.floor(F.col("i") / F.col("b")).alias("block")).distinct()
    inside = starts.join(near, ["at", "template", "block"]).where(
        (F.col("i") >= F.col("start")) & (F.col("i") < F.col("start") + F.col("b"))
    )
    counted = inside.groupBy(*one, "start", "bigram", "times").agg(F.count("*").alias("n"))
    common = counted.groupBy(*one, "start").agg(F.sum(F.least("n", "times")).alias("common"))
    size = F.least(F.col("start") + F.col("b"), F.col("a")) - F.greatest("start", F.lit(0))
    scored = common.withColumn("score", F.lit(2.0) * F.col("common") / (size + F.col("b")))
    found = scored.where(F.col("score") >= threshold).groupBy("doc_id", "text_hash", F.col("start").alias("unit_number"), "licence")
    return found.agg(F.max("score").alias("score")).select(
        "doc_id", "text_hash", F.lit(2).alias("kind"), "unit_number", "licence", "score"
    )


def matches(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text_hash, kind, unit_number, licence, score): the templates that reach the threshold in a unit, each
    licence at its best. kind 0: lines, by number; 1: paragraphs of several lines, by number of the paragraph; 2: windows."""
    docs = possible(docs, templates, threshold)
    return _units(docs, templates, threshold).unionByName(windows(docs, templates, threshold))


def _units(docs: DataFrame, templates: Sequence[tuple[str, str]], threshold: float) -> DataFrame:
    rows = template_table(templates)
    table = docs.sparkSession.createDataFrame(rows, "template int, licence string, b int, bigram string, times int")
    table = table.withColumn("bigram", F.xxhash64("bigram"))
    size = F.size("words") - 1
    units = F.array(
        F.struct(F.lit(0).alias("kind"), F.split("text", "\n").alias("units")),
        F.struct(F.lit(1).alias("kind"), F.split("text", r"\n[ \t\r]*\n").alias("units")),
    )
    unit = (
        docs.where("text IS NOT NULL")
        # The number keeps repeated rows apart while bigrams are counted; it is not in the result.
        .select("doc_id", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("at"), F.inline(units))
        .select("doc_id", "text_hash", "at", "kind", F.posexplode("units").alias("unit_number", "unit"))
        .where((F.col("kind") == 0) | F.trim(F.col("unit"), F.lit("\n")).contains("\n"))
        # A one-element explode is a fence: the filter below would normalise the unit again for every comparison.
        .withColumn("words", F.explode(F.array(F.split(normalised(F.col("unit")), " "))))
        .where(_possible(size, [n for n in {r[0]: r[2] for r in rows}.values()], threshold))
        .withColumn("a", size)
    )
    place = ["doc_id", "text_hash", "at", "kind", "unit_number", "a"]
    found = unit.select(*place, F.explode(_pairs("words")).alias("bigram"))
    low, high = (F.col("b") * f for f in (threshold / (2 - threshold), (2 - threshold) / threshold))
    near = found.join(F.broadcast(table), "bigram").where((F.col("a") >= low) & (F.col("a") <= high))
    counted = near.groupBy(*place, "template", "licence", "b", "bigram", "times").agg(F.count("*").alias("n"))
    common = counted.groupBy(*place, "template", "licence", "b").agg(F.sum(F.least("n", "times")).alias("common"))
    scored = common.withColumn("score", F.lit(2.0) * F.col("common") / (F.col("a") + F.col("b")))
    return (
        scored.where(F.col("score") >= threshold)
        .groupBy("doc_id", "text_hash", "kind", "unit_number", "licence")
        .agg(F.max("score").alias("score"))
    )


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, licence, score, n_units, found) of every row: the best licence of the text, how many units match
    one, and all matches as an array of structs (score, licence, kind, unit_number), the best first."""
    one = F.struct(F.col("score"), F.col("licence"), F.col("kind"), F.col("unit_number"))
    every = matches(docs, templates, threshold).groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.when(F.col("kind") < 2, F.struct("kind", "unit_number"))).alias("units"),
        F.collect_set(F.when(F.col("kind") == 2, F.col("unit_number"))).alias("windows"),
        F.collect_list(one).alias("found"),
    )
    n_units = F.when(F.size("units") > 0, F.size("units")).otherwise(F.size("windows")).cast("long")
    every = every.withColumn("n_units", n_units).drop("units", "windows")
    order = lambda x, y: (
        F.when(x["score"] != y["score"], F.when(x["score"] > y["score"], -1).otherwise(1))
        .when(x["licence"] != y["licence"], F.when(x["licence"] < y["licence"], -1).otherwise(1))
        .when(x["kind"] != y["kind"], x["kind"] - y["kind"])
        .otherwise(x["unit_number"] - y["unit_number"])
    )
    every = every.withColumn("found", F.array_sort("found", order))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    same = rows["doc_id"].eqNullSafe(every["doc_id"]) & (rows["text_hash"] == every["text_hash"])
    return rows.join(every, same, "left").select(
        rows["doc_id"],
        F.col("found")[0]["licence"].alias("licence"),
        F.coalesce(F.col("found")[0]["score"], F.lit(0.0)).alias("score"),
        F.coalesce("n_units", F.lit(0)).alias("n_units"),
        "found",
    )
