"""License scans by diagonal voting, in DataFrame operations only."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of all templates up to which their positions are broadcast (about 100 bytes a word); more are joined by a shuffle.
BROADCAST_WORDS = 200_000


class Template(NamedTuple):
    """A text to find. Exact ones count where all their words stand consecutively; others where enough of them do."""

    name: str
    label: str
    text: str
    exact: bool = False


# Phrases and the labels that they give.
BASE = (
    Template("base cc by", "cc-by", "cc by", True),
    Template("base general public license", "gpl", "general public license", True),
    Template("base all rights reserved", "reserved", "all rights reserved", True),
)
# Short notices, and the public texts of common licenses.
NOTICES = (
    Template("mit name", "mit", "the MIT License", True),
    Template("apache name", "apache-2.0", "Apache License, Version 2.0", True),
    Template("cc by nc name", "cc-by-nc", "CC BY-NC", True),
    Template("cc by sa name", "cc-by-sa", "CC BY-SA", True),
    Template("gpl 3 name", "gpl-3.0", "GNU General Public License, version 3", True),
    Template("mit text", "mit", """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
        and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions
        of the Software."""),
    Template("apache notice", "apache-2.0", """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is
        distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
        See the License for the specific language governing permissions and limitations under the License."""),
    Template("gpl notice", "gpl", """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
        GNU General Public License for more details."""),
    Template("bsd text", "bsd", """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution."""),
    Template("isc text", "isc", """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies."""),
)


def words(text: Column) -> Column:
    """Runs of letters, digits and characters from U+0080, with A-Z lower; none for null."""
    ascii_only = F.octet_length(text) == F.length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.regexp_extract_all(F.coalesce(low, F.lit("")), F.lit(WORD), F.lit(0))


def _pair(a: Column, b: Column) -> Column:
    return F.concat_ws(" ", a, b)


def _padded_grams(sizes: Sequence[int]) -> Column:
    """For each size, one k-gram per word of `words`, shorter ones at the end; then one empty string."""
    grams, out = F.col("words"), []
    for k in range(1, max(sizes) + 1):
        if k > 1:
            grams = F.zip_with(grams, F.slice("words", F.lit(k), F.greatest(F.col("n_words") - (k - 1), F.lit(0)).cast("int")), _pair)
        if k in sizes:
            out.append(grams)
    return F.concat(*out, F.array(F.lit("")))


def template_positions(spark: SparkSession, templates: Sequence[Template], k: int) -> DataFrame:
    """gram, k, template, label, exact, place, grams of every k-gram of every template; and the empty gram, once, as -1."""
    rows = [F.struct(F.lit(i).alias("template"), F.lit(t.label).alias("label"), F.lit(t.exact).alias("exact"), F.lit(t.text).alias("text"))
            for i, t in enumerate(templates)]
    table = spark.range(1).select(F.inline(F.array(*rows))).withColumn("words", words(F.col("text")))
    table = table.withColumn("k", F.least(F.lit(k), F.size("words"))).where("k > 0")
    table = table.withColumn("grams", F.size("words") - F.col("k") + 1)
    grams = F.expr("transform(sequence(0, grams - 1), p -> concat_ws(' ', slice(words, p + 1, k)))")
    found = table.select("template", "label", "exact", "k", "grams", F.posexplode(grams).alias("place", "gram"))
    every = spark.range(1).select(F.lit(-1).alias("template"), F.lit("").alias("label"), F.lit(True).alias("exact"), F.lit(0).alias("k"),
                                  F.lit(1).alias("grams"), F.lit(0).alias("place"), F.lit("").alias("gram"))
    return found.unionByName(every).withColumn("hash", F.xxhash64("gram"))


def scan(docs: DataFrame, templates: Sequence[Template] = BASE + NOTICES, k: int = 3, slack: int = 3, share: float = 0.5,
         least_votes: int = 2, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """doc_id, n_words, spans (template, label, exact, start, stop, coverage; words from 0) of every document.

    All rolling k-grams of every text (of fewer words for templates shorter than
    k) are joined by hash to the templates' positions and held against their
    words. A match of document word i with template word p votes for diagonal
    i - p. An exact template stands wherever one diagonal has all its votes. For
    the others, diagonals of at least `least_votes` that lie within `slack` words
    of each other are one span, since a word put in or left out moves the rest by
    one; it is kept where its votes cover `share` of the template's k-grams and
    it is at most twice as long as the template. One row per document passes
    through the join with an empty gram, so texts are read and split once, and
    only votes are shuffled. Cases: null and empty texts have no words and no
    spans; null ids and repeated rows keep their rows; an empty table gives an
    empty result; extra columns are not read; a template without words, or no
    templates, give no spans. A text's words and k-grams are held in one task.
    """
    lengths = [len(re.findall(WORD, t.text.translate(str.maketrans(UPPER, LOWER)))) for t in templates]
    sizes = sorted({min(k, n) for n in lengths if n}) or [1]
    positions = template_positions(docs.sparkSession, [t for t, n in zip(templates, lengths) if n] or [Template("", "", "", True)], k)
    numbered = [t for t, n in zip(templates, lengths) if n]
    if sum(lengths) <= broadcast_words:
        positions = F.broadcast(positions)

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    text = text.select("doc_id", F.xxhash64("doc_id", "text").alias("key1"), F.xxhash64(F.lit(1), "text", "doc_id").alias("key2"),
                       words(F.col("text")).alias("words"))
    text = text.withColumn("n_words", F.size("words").cast("long"))
    # Of equal width, the arrays of all sizes follow each other, so a place tells its size and its word.
    rolled = text.select("doc_id", "key1", "key2", "n_words", F.posexplode(_padded_grams(sizes)).alias("at", "rolled"))
    size = F.get(F.array(*[F.lit(s) for s in sizes], F.lit(0)), F.floor(F.col("at") / F.greatest("n_words", F.lit(1))).cast("int"))
    rolled = rolled.withColumn("rolled_k", F.when(F.col("rolled") == "", 0).otherwise(size))
    word = F.when(F.col("n_words") > 0, F.col("at") % F.col("n_words")).otherwise(0)
    same = (F.xxhash64("rolled") == F.col("hash")) & (F.col("rolled") == F.col("gram")) & (F.col("rolled_k") == F.col("k"))
    doc = ["doc_id", "key1", "key2", "n_words"]
    votes = rolled.join(positions, same).select(
        *doc, "template", "label", "exact", "k", "grams", F.when(F.col("k") > 0, word).otherwise(0).alias("i"),
        F.when(F.col("k") > 0, word - F.col("place")).otherwise(0).alias("diagonal"))
    diagonals = votes.groupBy(*doc, "template", "label", "exact", "k", "grams", "diagonal").agg(
        F.count("*").alias("votes"), F.min("i").alias("start"), (F.max("i") + F.first("k")).alias("stop"))

    # Rows that are equal in id and text vote together; the empty gram counts them.
    own = W.partitionBy("key1", "key2")
    copies = F.max(F.when(F.col("template") == -1, F.col("votes"))).over(own)
    diagonals = diagonals.withColumn("copies", copies).withColumn("votes", F.expr("votes div copies"))
    enough = F.when(F.col("exact"), F.col("votes") >= F.col("grams")).otherwise(F.col("votes") >= F.least(F.col("grams"), F.lit(least_votes)))
    along = own.orderBy("template", "diagonal")
    apart = F.coalesce(F.col("exact") | (F.lag("template").over(along) != F.col("template"))
                       | (F.col("diagonal") - F.lag("diagonal").over(along) > slack), F.lit(True))
    diagonals = diagonals.where(enough).withColumn("apart", apart.cast("int")).withColumn("cluster", F.sum("apart").over(along))
    spans = diagonals.groupBy(*doc, "copies", "template", "label", "exact", "k", "grams", "cluster").agg(
        F.sum("votes").alias("votes"), F.min("start").alias("start"), F.max("stop").alias("stop"))
    length = F.col("stop") - F.col("start")
    covered = F.least(F.col("votes"), F.col("grams"), length - F.col("k") + 1) / F.col("grams")
    verified = (F.col("template") >= 0) & (covered >= share) & (length <= 2 * (F.col("grams") + F.col("k") - 1))
    name = F.get(F.array(*[F.lit(t.name) for t in numbered] or [F.lit("")]), F.col("template"))
    span = F.struct("start", "stop", name.alias("template"), "label", "exact", covered.alias("coverage"))
    found = spans.groupBy(*doc, "copies").agg(F.array_sort(F.collect_list(F.when(verified, span))).alias("spans"))
    return found.select("doc_id", "n_words", "spans", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("col")


def labelled(docs: DataFrame, base: Sequence[Template] = BASE, more: Sequence[Template] = NOTICES, **options) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every document.

    Places of base templates are counted; the score is the best coverage of any
    span, 1 for an exact one and 0 without any. Cases: as for :func:`scan`.
    """
    names = [t.name for t in base]
    places = F.filter("spans", lambda s: s["template"].isin(*names))
    starts = F.transform(places, lambda s: s["start"])
    joined = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return scan(docs, [*base, *more], **options).select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        joined(places).alias("base_labels"), joined(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0)).alias("score"))
