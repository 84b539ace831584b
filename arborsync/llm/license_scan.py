"""License notices in texts by diagonal voting.

Every run of ``GRAM`` words of a text whose hash some template has too is joined to the places of the templates
that hold it. Place in the text less place in the template is a diagonal; the runs of one notice vote for the
same diagonal, or for near ones where words were put in or left out. Votes are summed by diagonal, neighbouring
diagonals merged, and the span is verified by the template's words it really holds.

Only DataFrame functions are used; texts are read once and stay where they are.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arborsync.staging import stage

GRAM = 3
# A verified span holds so much of a template's runs, and as much of those that no other label has.
SHARE = 0.6
# Diagonals at most this part of a template's words apart belong to one notice.
SHIFT = 0.25

# Phrases that name a license wherever their words stand together.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Usual wordings of public license notices.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
            "persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
                   "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
                   "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                   "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
                   "governing permissions and limitations under the License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
            "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
             "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("agpl", "licensed under the GNU Affero General Public License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BREAK = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

RESULTS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")


def split_license_words(text: str) -> list[str]:
    """Words of a short fixed text, as ``words_of`` gives them."""
    return [w for w in re.split(BREAK, text.translate(str.maketrans(UPPER, UPPER.lower()))) if w]


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lower-cased: runs of digits, a-z and characters beyond ASCII; none of null."""
    plain = F.coalesce(text, F.lit(""))
    # lower() does the same to plain ASCII, and sooner.
    ascii_only = F.octet_length(plain) == F.char_length(plain)
    lowered = F.when(ascii_only, F.lower(plain)).otherwise(F.translate(plain, UPPER, UPPER.lower()))
    return F.array_remove(F.split(lowered, BREAK), "")


def _hash(words: Column, at: Column) -> Column:
    return F.xxhash64(*[F.get(words, at + i) for i in range(GRAM)])


def template_places(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """(template, label, place, own, n_places, width, gram, hash): every run of ``GRAM`` words of every template. ``own`` are
    runs of no other label. As many rows as the templates have words."""
    given = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(text).alias("text")) for i, (label, text) in enumerate(templates)])
    worded = spark.range(1).select(F.inline(given)).withColumn("words", words_of(F.col("text")))
    width = F.size("words")
    placed = worded.where(width >= GRAM).select(
        "template", "label", width.alias("width"), (width - GRAM + 1).alias("n_places"), "words",
        F.explode(F.sequence(F.lit(0), width - GRAM)).alias("place"))
    grams = placed.select(
        "template", "label", "width", "n_places", "place", F.slice("words", F.col("place") + 1, GRAM).alias("gram"),
        _hash(F.col("words"), F.col("place")).alias("hash"))
    labels = F.size(F.collect_set("label").over(Window.partitionBy("gram")))
    return grams.withColumn("own", labels == 1)


def _starts(words: Column, phrase: str) -> Column:
    """Places of ``words`` at which the words of ``phrase`` begin."""
    own = phrase.split(" ")
    places = F.sequence(F.lit(0), F.greatest(F.size(words) - len(own), F.lit(0)))

    def begins(at: Column) -> Column:
        held = F.get(words, at) == own[0]
        for i, word in enumerate(own[1:], 1):
            held = held & (F.get(words, at + i) == word)
        return F.coalesce(held, F.lit(False))

    return F.filter(places, begins)


def _labelled(starts: Column, label: str) -> Column:
    return F.transform(starts, lambda at: F.struct(at.alias("at"), F.lit(label).alias("label")))


def find_licenses(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, templates: list[tuple[str, str]] | None = None,
    phrases: dict[str, str] | None = None, share: float = SHARE, shift: float = SHIFT,
) -> DataFrame:
    """The columns ``keep`` (all but ``text``) of ``docs``, and for each row

    n_words; n_base, first_word, last_word: all places of the base phrases, the first and last start (null without any);
    base_labels; labels: those and the labels of verified spans, distinct, sorted, comma-joined; score: 1 where a
    base phrase stands, else the largest share of a template's runs found on merged diagonals; spans of notices
    as (label, template, word_begin, word_end, share, verified).

    A null or empty text has no words and no spans. Rows are told apart by their place, so repeated rows and
    null ids each get their result. Columns named like a result are replaced by it. A row holds its words at a time.
    """
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    kept = [c for c in (keep if keep is not None else docs.columns) if c != text and c not in RESULTS]
    places = template_places(spark, templates)
    known = sorted(r["hash"] for r in places.select("hash").distinct().collect())  # one row a word of the templates at most
    row = F.struct(*[F.col(f"`{c}`") for c in kept], F.lit(0).alias("_none")).alias("_row")
    worded = docs.select(row, words_of(F.col(f"`{text}`")).alias("words"))
    runs = F.when(F.size("words") >= GRAM, F.sequence(F.lit(0), F.size("words") - GRAM)).otherwise(F.array().cast("array<int>"))
    hits = F.transform(
        F.filter(runs, lambda at: _hash(F.col("words"), at).isin(known)),
        lambda at: F.struct(at.alias("at"), F.slice("words", at + 1, GRAM).alias("gram")))
    base = F.concat(*[_labelled(_starts(F.col("words"), phrase), label) for phrase, label in phrases.items()])
    marked = worded.select("_row", F.size("words").alias("n_words"), hits.alias("hits"), base.alias("base"))
    # Row numbers are a fact of one reading, so they are written down before anything refers to them.
    marked = stage(marked.withColumn("_id", F.monotonically_increasing_id()), "license_runs")

    found = marked.select("_id", F.explode("hits").alias("hit")).select(
        "_id", F.col("hit.at").alias("at"), F.col("hit.gram").alias("gram"),
        F.xxhash64(*[F.get("hit.gram", F.lit(i)) for i in range(GRAM)]).alias("hash"))
    # Equal hashes and equal words.
    met = found.join(F.broadcast(places.withColumnRenamed("gram", "own_gram")), "hash").where("gram = own_gram")
    votes = met.groupBy("_id", "template", "label", "n_places", "width", (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.min("at").alias("begin"), F.max("at").alias("end"), F.collect_set(F.struct("place", "own")).alias("held"))
    along = Window.partitionBy("_id", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > F.floor(F.col("width") * shift)
    merged = votes.withColumn("_new", F.coalesce(apart, F.lit(False)).cast("int")).withColumn("notice", F.sum("_new").over(along))
    spans = merged.groupBy("_id", "template", "label", "n_places", "notice").agg(
        F.min("begin").alias("word_begin"), (F.max("end") + GRAM).alias("word_end"),
        F.array_distinct(F.flatten(F.collect_list("held"))).alias("held"))
    n_own = places.groupBy("template").agg(F.count_if("own").alias("n_own"))
    got = F.size("held") / F.col("n_places")
    got_own = F.size(F.filter("held", lambda h: h["own"]))
    judged = spans.join(F.broadcast(n_own), "template").withColumns({
        "share": got, "verified": (got >= share) & (F.col("n_own") > 0) & (got_own >= share * F.col("n_own"))})
    by_row = judged.groupBy("_id").agg(
        F.array_sort(F.collect_list(F.struct("word_begin", "word_end", "label", "template", "share", "verified"))).alias("spans"))

    joined = marked.join(by_row, "_id", "left")
    spans_col = F.coalesce("spans", F.array().cast(by_row.schema["spans"].dataType))
    own_labels = F.array_sort(F.array_distinct(F.transform("base", lambda b: b["label"])))
    all_labels = F.array_sort(F.array_distinct(F.concat(own_labels, F.transform(F.filter("_spans", lambda s: s["verified"]), lambda s: s["label"]))))
    n_base = F.size("base")
    best = F.coalesce(F.array_max(F.transform("_spans", lambda s: s["share"])), F.lit(0.0))
    return joined.withColumn("_spans", spans_col).select(
        *[F.col(f"_row.`{c}`") for c in kept], F.col("n_words").cast("bigint").alias("n_words"), n_base.cast("bigint").alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["at"])).cast("bigint").alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["at"])).cast("bigint").alias("last_word"),
        F.array_join(own_labels, ",").alias("base_labels"), F.array_join(all_labels, ",").alias("labels"),
        F.when(n_base > 0, F.lit(1.0)).otherwise(best).alias("score"), F.col("_spans").alias("spans"),
    )
