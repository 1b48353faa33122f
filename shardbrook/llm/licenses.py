"""License scans by diagonal voting.

Texts and license templates are sequences of words.  Every k-gram of words of every
text is hashed; the hashes that occur in a template are joined to the places where
they stand there.  A match votes for its diagonal (place in the text minus place in
the template).  Neighbouring diagonals of one template are merged into spans, so a
word more or less does not split a license, and a span is verified by the share of
the template's k-grams that it holds.

Besides, phrases with a fixed wording are counted where their words stand one after
the other.  Everything here is DataFrame functions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardbrook.llm.common import whole_text
from shardbrook.storage import store

# What counts as a separator, the phrases, and wordings of public licenses.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PHRASES = [
    ("the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
TEMPLATES = [
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
    ),
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    (
        "apache-2",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
        "list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies.",
    ),
    (
        "gpl-3",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version.",
    ),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl-2",
        "This program is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation; either version "
        "2 of the License, or (at your option) any later version.",
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    (
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to "
        "copy, modify, publish, use, compile, sell, or distribute this software",
    ),
    (
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    (
        "cc-by-nc",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
        "License.",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
]
GRAM = 4
DRIFT = 8  # diagonals of one span lie no further apart
LEAST_SCORE = 0.6


def template_words(text: str) -> list[str]:
    return [w for w in re.split(SEPARATOR, text.lower()) if w]


def _hashed_grams(words: str, gram: int) -> Column:
    """Hashes of all windows of ``gram`` words of the array column."""
    n = F.size(words)
    return F.when(
        n >= gram,
        F.transform(
            F.sequence(F.lit(0), n - gram),
            lambda i: F.xxhash64(*(F.get(F.col(words), i + k) for k in range(gram))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def template_places(
    spark: SparkSession, templates: list[tuple[str, str]], gram: int
) -> DataFrame:
    """``template, label, grams, place, hash, text``: where each k-gram stands in a template."""
    rows = [(i, label, template_words(text)) for i, (label, text) in enumerate(templates)]
    if any(len(words) < gram for _, _, words in rows):
        raise ValueError(f"a template needs at least {gram} words")
    frame = spark.createDataFrame(rows, "template int, label string, words array<string>")
    placed = frame.withColumn("h", _hashed_grams("words", gram)).select(
        "template", "label", "words", F.size("h").alias("grams"), F.posexplode("h").alias("place", "hash")
    )
    return placed.withColumn("text", _gram_text("words", F.col("place"), gram)).drop("words")


def _gram_text(words: str, place: Column, gram: int) -> Column:
    return F.array_join(F.slice(words, place + 1, gram), " ")


def in_order(places: Column) -> Column:
    """How many of a list of places can be kept so that they ascend, each place once."""

    def step(ends: Column, place: Column) -> Column:
        """``ends``: the least last place of a row of 1, 2, 3, ... places."""
        below = F.filter(ends, lambda e: e < place)
        above = F.filter(ends, lambda e: e >= place)
        return F.concat(below, F.array(place), F.slice(above, F.lit(2), F.size(above)))

    return F.size(F.aggregate(places, F.array().cast("array<int>"), step))


def _phrase_places(phrases: list[tuple[str, str]]) -> tuple[Column, Column, Column, Column]:
    """Count, first word, last word and labels of phrases in ``_joined``."""
    joined, n_words = F.col("_joined"), F.size("_words")
    count, first, last, labels = F.lit(0).cast("long"), [], [], []

    def spaces(part: Column) -> Column:
        return F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))

    for phrase, label in phrases:
        length = len(phrase.split())
        # Every word has a space before it; the space after the phrase is not used up.
        gaps = F.split(joined, f" {re.escape(phrase)}(?= )", -1)
        there = joined.contains(f" {phrase} ")
        n = F.when(there, (F.size(gaps) - 1).cast("long")).otherwise(F.lit(0).cast("long"))
        after = spaces(F.element_at(gaps, -1)) - 1
        first.append(F.when(there, spaces(F.get(gaps, F.lit(0))).cast("long")))
        last.append(F.when(there, (n_words - after - length).cast("long")))
        labels.append(F.when(there, F.lit(label)))
        count = count + n
    return (
        count,
        F.array_min(F.array(*first)),
        F.array_max(F.array(*last)),
        F.array_distinct(F.array_compact(F.array(*labels))),
    )


def scan(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: list[tuple[str, str]] = PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES,
    gram: int = GRAM,
    drift: int = DRIFT,
    least_score: float = LEAST_SCORE,
) -> DataFrame:
    """Licenses of every row.

    Returns ``id_col, n_words, n_base, first_word, last_word, base_labels, labels,
    score, spans``: places of the phrases (words from 0), their labels, all labels
    (sorted, comma-joined), the best score (1 for a phrase, else the largest share of
    a template found) and verified spans as structs ``label, first, last, score``.

    A null or empty text has no words and no labels, and scores 0.  Rows with null or
    repeated ids each come back once.  Other columns are not read.

    Hashes are looked up in the templates' set inside each row first, so only those
    that stand in a template become rows; the templates (a fixed list, a few hundred
    places) are broadcast.  A vote counts if the words there are those of the template.
    A span is scored by the places of the template that it holds in the template's order,
    each place once: a phrase that comes again and again is one place.

    Rows without a vote are not shuffled.  Numbers, places and matching k-grams of all rows are written
    once to the shared folder, so that a row keeps its number.
    """
    spark = docs.sparkSession
    places = template_places(spark, templates, gram)
    known = [r["hash"] for r in places.select("hash").distinct().collect()]  # fixed size
    count, first, last, labels = _phrase_places(phrases)
    hashes = F.from_json(F.lit(f"[{','.join(map(str, known))}]"), "array<bigint>")
    numbered = F.transform("_grams", lambda h, i: F.struct(i.alias("at"), h.alias("hash")))
    standing = F.transform(
        F.filter(numbered, lambda g: F.array_contains(hashes, g["hash"])),
        lambda g: F.struct(
            g["at"].alias("at"), g["hash"].alias("hash"), _gram_text("_words", g["at"], gram).alias("text")
        ),
    )
    parts = (
        docs.select(
            F.monotonically_increasing_id().alias("_row"),
            F.col(id_col).alias("_id"),
            # A to Z only: what lower() makes of a letter depends on the machine's language.
            F.translate(whole_text(text_col), UPPER, UPPER.lower()).alias("_lower"),
        )
        .withColumn("_words", F.array_remove(F.split("_lower", SEPARATOR), ""))
        .withColumn("_joined", F.concat(F.lit(" "), F.array_join("_words", " "), F.lit(" ")))
        .withColumn("_grams", _hashed_grams("_words", gram))
        .select(
            "_row",
            F.struct(
                F.col("_id").alias("id"),
                F.size("_words").cast("long").alias("n_words"),
                count.alias("n_base"),
                first.alias("first_word"),
                last.alias("last_word"),
                labels.alias("base"),
            ).alias("own"),
            F.when(F.arrays_overlap("_grams", hashes), standing).alias("_votes"),
        )
    )
    parts = store(parts, "licenses")
    voting = parts.where("_votes IS NOT NULL")
    # The words are compared too, so nothing rests on a hash.
    votes = (
        voting.select("_row", F.inline("_votes"))
        .join(F.broadcast(places), ["hash", "text"])
        .withColumn("diagonal", F.col("at") - F.col("place"))
        .groupBy("_row", "template", "diagonal")
        .agg(
            F.any_value("label").alias("label"),
            F.any_value("grams").alias("grams"),
            F.collect_list(F.struct("at", (-F.col("place")).alias("back"))).alias("pairs"),
        )
    )
    along = Window.partitionBy("_row", "template").orderBy("diagonal")
    starts = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > drift, F.lit(True))
    pairs = F.array_sort(F.flatten(F.collect_list("pairs")))
    spans = (
        votes.withColumn("new", starts.cast("int"))
        .withColumn("span", F.sum("new").over(along))
        .groupBy("_row", "template", "span")
        .agg(
            F.any_value("label").alias("label"),
            F.any_value("grams").alias("grams"),
            pairs.alias("pairs"),
        )
        .select(
            "_row",
            "label",
            (in_order(F.transform("pairs", lambda p: -p["back"])) / F.col("grams")).alias("share"),
            F.get("pairs", F.lit(0))["at"].alias("first"),
            (F.element_at("pairs", -1)["at"] + gram - 1).alias("last"),
        )
    )
    span = F.struct(
        "label",
        F.col("first").cast("long").alias("first"),
        F.col("last").cast("long").alias("last"),
        F.col("share").alias("score"),
    )
    told = spans.groupBy("_row").agg(
        F.array_sort(F.collect_list(F.when(F.col("share") >= least_score, span))).alias("spans"),
        F.max("share").alias("share"),
    )
    none = F.array().cast(told.schema["spans"].dataType)
    rows = voting.join(told, "_row", "left").withColumn("spans", F.coalesce("spans", none))
    silent = parts.where("_votes IS NULL").withColumns(
        {"spans": none, "share": F.lit(None).cast("double")}
    )
    return rows.unionByName(silent).select(
        F.col("own.id").alias(id_col),
        "own.n_words",
        "own.n_base",
        "own.first_word",
        "own.last_word",
        F.array_join(F.array_sort("own.base"), ",").alias("base_labels"),
        F.array_join(
            F.array_sort(
                F.array_union(F.col("own.base"), F.transform("spans", lambda s: s["label"]))
            ),
            ",",
        ).alias("labels"),
        F.when(F.col("own.n_base") > 0, F.lit(1.0))
        .otherwise(F.coalesce("share", F.lit(0.0)))
        .alias("score"),
        "spans",
    )
