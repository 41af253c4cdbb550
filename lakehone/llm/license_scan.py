"""License scans: phrases, and an exact containment join of text blocks with license templates.  DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What is no word character, but for the line feed that ends a block.
GAP = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Sentences by which common licenses are known; a block of text holds one if it has this share of its distinct words.
#: Short notices have four distinct words at most, all of which a block must hold at a threshold of 0.8: with more, the name of the license could be the missing one.
TEMPLATES = {
    "mit": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "under the mit license"],
    "apache-2.0": ["licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "apache license version 2", "apache license 2 0", "under the apache license"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "under the bsd license", "bsd 2 clause license", "bsd 3 clause license"],
    "gpl": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "licensed under the gnu general public license version 3"],
    "lgpl": ["you can redistribute this library and or modify it under the terms of the gnu lesser general public license", "lesser general public license", "under the lgpl"],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license 2"],
    "cc-by": ["this work is licensed under a creative commons attribution 4 0 international license", "licensed under the creative commons attribution license cc by 4 0", "creative commons attribution license", "creative commons attribution 4"],
    "cc-by-sa": ["this work is licensed under a creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"],
    "cc0": ["to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "cc0 1 0 universal", "released under cc0", "licensed under cc0"],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "under the isc license"],
    "unlicense": ["this is free and unencumbered software released into the public domain", "under the unlicense"],
    "reserved": ["copyright all rights reserved no part of this publication may be reproduced without written permission"],
}
THRESHOLD = 0.8


def words_of(text: Column) -> Column:
    """The text with words of ASCII lower case, one space before and after each; blocks end with a line feed."""
    return F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAP, " ")


def tokens(block: Column) -> Column:
    return F.filter(F.split(block, " "), lambda w: w != "")


def _rank_map(ranks: dict[str, int]) -> Column:
    return F.create_map(*(x for w, r in ranks.items() for x in (F.lit(w), F.lit(r))))


def scan(docs: DataFrame, phrases: dict = PHRASES, templates: dict = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row of docs (doc_id, text).

    Base: each place where a phrase's words stand one after the other, in any line.  Blocks are the lines of a text and, because license
    texts are often wrapped, overlapping windows of words across line feeds, twice as long as the longest template and so dealt that each run of
    as many words is whole in one: a block meets a template if it holds at least `threshold` of the template's distinct words.  Templates
    of which all words are needed are too short for windows; across line feeds, their words must stand one after the other.  Words of templates are ranked by the number of
    documents that hold them, rare first.  A block can meet a template only if it holds one of the template's first
    (|T| - need + 1) words (prefix), has `need` template words at all (length), and has enough of them left from
    the first shared word on (position); those are verified.  score: the greatest share of a template in a block, 1 with a base place.

    Null texts are empty ones; a text without words has no labels and score 0; ties all count; rows that repeat, repeat; an empty table
    gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    sets = [(label, sorted(set(t.split()))) for label, many in templates.items() for t in many]
    vocabulary = sorted({w for _, s in sets for w in s})
    need = [math.ceil(threshold * len(s) - 1e-9) for _, s in sets]

    # One row for each word of the templates at most.
    plain = F.translate(words_of(F.col("text")), "\n", " ")
    known = docs.select(F.array_intersect(F.split(plain, " "), F.array(*map(F.lit, vocabulary))).alias("w"))
    counted = {r.word: r.n for r in known.select(F.explode("w").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    order = sorted(vocabulary, key=lambda w: (counted.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    ranked = [sorted(rank[w] for w in s) for _, s in sets]
    prefix = sorted({order[r] for s, n in zip(ranked, need) for r in s[: len(s) - n + 1]})
    texts = [t for many in templates.values() for t in many]
    long = [n < len(s) for s, n in zip(ranked, need)]
    wide = sorted({r for s, n, x in zip(ranked, need, long) if x for r in s[: len(s) - n + 1]})
    stride = max(len(t.split()) for t in texts)

    spaced = F.concat(F.lit(" "), F.col("plain"), F.lit(" "))
    base = docs.select("doc_id", words_of(F.col("text")).alias("norm")).withColumn("plain", F.trim(F.regexp_replace(F.translate("norm", "\n", " "), " +", " ")))
    n_words = F.when(F.col("plain") == "", 0).otherwise(F.length("plain") - F.length(F.replace("plain", F.lit(" "), F.lit(""))) + 1)
    hits = {p: spaced.contains(f" {p} ") for p in phrases}

    def places(phrase: str) -> Column:
        """Starts of a phrase, counted in words: neighbouring places share a space, so spaces are doubled first."""
        pieces = F.split(F.replace(spaced, F.lit(" "), F.lit("  ")), f" {'  '.join(phrase.split())} ")
        length = len(phrase.split())
        count = lambda x: F.size(F.filter(F.split(x, " +"), lambda w: w != ""))
        counts = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), count)
        sums = F.aggregate(counts, F.array().cast("array<int>"), lambda a, c: F.concat(a, F.array((F.coalesce(F.element_at(F.when(F.size(a) > 0, a), -1) + length, F.lit(0)) + c).cast("int"))))
        return F.when(hits[phrase], sums).otherwise(F.array().cast("array<int>"))

    maybe = spaced.rlike(" (" + "|".join(prefix) + ") ")
    ranks = _rank_map(rank)
    least = min(need)

    def ranked_words(line: Column) -> Column:
        return F.array_sort(F.transform(F.array_intersect(F.split(line, " "), F.array(*map(F.lit, vocabulary))), lambda w: ranks[w]))

    lines = F.filter(F.transform(F.filter(F.split("norm", "\n"), lambda x: F.concat(F.lit(" "), x, F.lit(" ")).rlike(" (" + "|".join(prefix) + ") ")), ranked_words), lambda a: F.size(a) >= least)
    # Windows are marked by the rank -1, with which no short template is compared.
    words = F.split("plain", " ")
    windows = F.transform(F.sequence(F.lit(1), F.size(words), F.lit(stride)), lambda i: ranked_words(F.array_join(F.slice(words, i, 2 * stride), " ")))
    windows = F.filter(windows, lambda a: (F.size(a) >= min((n for n, x in zip(need, long) if x), default=0)) & F.arrays_overlap(a, F.array(*map(F.lit, wide)).cast("array<int>")))
    wrapped = F.trim("norm").contains("\n") & spaced.rlike(" (" + "|".join(order[r] for r in wide) + ") ") if wide else F.lit(False)
    lines = F.concat(lines, F.when(wrapped, F.transform(windows, lambda a: F.array_prepend(a, F.lit(-1)))).otherwise(F.array().cast("array<array<int>>")))
    notices = F.array_compact(F.array(*(F.when(spaced.contains(f" {t} "), label) for (label, _), t, x in zip(sets, texts, long) if not x)).cast("array<string>"))
    first = base.select("doc_id", F.when(maybe, notices).otherwise(F.array().cast("array<string>")).alias("notices"), n_words.cast("long").alias("n_words"), *(places(p).alias(f"p{i}") for i, p in enumerate(phrases)), F.when(maybe, lines).otherwise(F.array().cast("array<array<int>>")).alias("blocks"))
    first = materialize(first, "license")

    # The join proper: distinct blocks by their words, so that copies are compared once.
    small = spark.createDataFrame([(i, label, r, n, len(r), order_, t) for i, ((label, _), r, n) in enumerate(zip(sets, ranked, need)) for order_, t in enumerate(r[: len(r) - n + 1])], "template int, label string, all array<int>, need int, size int, at int, word int")
    blocks = first.select(F.explode("blocks").alias("block")).distinct()
    probes = blocks.select("block", F.posexplode("block").alias("pos", "word"))
    pairs = probes.join(F.broadcast(small), "word")
    pairs = pairs.where("(need < size or block[0] >= 0) and size(block) >= need and least(size - at, size(block) - pos) + least(at, pos) >= need")
    pairs = pairs.select("block", "template", "label", "all", "need", "size").dropDuplicates(["block", "template"])
    met = pairs.withColumn("common", F.size(F.array_intersect("block", "all"))).where("common >= need")
    met = met.groupBy("block").agg(F.collect_set("label").alias("found"), F.max(F.col("common") / F.col("size")).alias("share"))

    # Blocks that met a template are few by their distinct words, but their number is not bounded: they are joined, not collected.
    keyed = first.select("doc_id", "n_words", "notices", *(f"p{i}" for i in range(len(phrases))), F.array_distinct("blocks").alias("blocks"))
    none = keyed.where("size(blocks) = 0").withColumns({"found": F.array().cast("array<string>"), "share": F.lit(0.0)}).drop("blocks")
    some = keyed.where("size(blocks) > 0").withColumn("row", F.monotonically_increasing_id())
    some = materialize(some, "blocks")
    rest = [c for c in some.columns if c not in ("row", "blocks")]
    shares = some.select("row", F.explode("blocks").alias("block")).join(met, "block").groupBy("row").agg(F.array_distinct(F.flatten(F.collect_set("found"))).alias("found"), F.max("share").alias("share"))
    some = some.select("row", *rest).join(shares, "row", "left").select(*rest, F.coalesce("found", F.array().cast("array<string>")).alias("found"), F.coalesce("share", F.lit(0.0)).alias("share"))
    out = none.unionByName(some)
    every = F.concat(*(F.col(f"p{i}") for i in range(len(phrases))))
    own = F.array_compact(F.array(*(F.when(F.size(f"p{i}") > 0, label) for i, label in enumerate(phrases.values()))))
    text = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return out.select(
        "doc_id",
        "n_words",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        text(own).alias("base_labels"),
        text(F.concat(own, "notices", "found")).alias("labels"),
        F.when((F.size(every) > 0) | (F.size("notices") > 0), 1.0).otherwise(F.col("share")).alias("score"),
    )
