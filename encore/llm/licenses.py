"""Licence scan by diagonal voting, in DataFrame functions only.

All rolling word k-gram hashes of every text are joined to the positions of
the same k-grams in licence templates. A hit at word ``p`` of the text and
word ``q`` of a template votes for the diagonal ``p - q``; a passage of the
template, even with words changed, put in or left out, leaves its votes on one
diagonal or on neighbouring ones. Votes are aggregated by diagonal,
neighbouring diagonals are merged, and a merged span is verified: the share of
the template's words that its k-grams cover, and its length. Short phrases are templates
of their own, with k = 2, whose every k-gram must vote on one diagonal.

The hits are a thin share of the words; only they (and one row for each text)
are shuffled, by row, so a phrase in every text spreads evenly. The template
tables are broadcast behind a check of their number of k-grams; beyond it
Spark chooses the join.

Words: A-Z in lower case, then runs of digits, letters and everything beyond
ASCII. (Lower case is taken of all letters. No other letter's lower case
makes or breaks a word, or is a letter of the phrases.)

Defined results: a null text counts as empty: no words, no labels, score 0.
Each input row gives its own row. Extra columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



K = 5
NEAR = 3  # diagonals at most this far apart are one span
SHARE = 0.6  # of a template's words that the k-grams of a verified span cover
MAX_BROADCAST_GRAMS = 100_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

PHRASES: dict[str, str] = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Opening passages of well-known public licences.
TEMPLATES: dict[str, str] = {
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software and to permit persons to whom the software is furnished to do so"
    ),
    "apache": (
        "licensed under the apache license version 2 0 the license you may not use this file except in "
        "compliance with the license you may obtain a copy of the license at"
    ),
    "gpl": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation either version"
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met"
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "mpl": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the "
        "mpl was not distributed with this file you can obtain one at"
    ),
}


def _grams(texts: Mapping[str, str], k: int) -> list[tuple[int, int, list[str]]]:
    return [
        (number, at, words[at : at + k])
        for number, words in enumerate(text.split(" ") for text in texts)
        for at in range(len(words) - k + 1)
    ]


def _covered(places: str) -> Column:
    """Words under k-grams that begin at the given sorted places."""
    start = F.struct(F.lit(-K).alias("at"), F.lit(0).alias("n"))
    return F.aggregate(
        places,
        start,
        lambda so_far, p: F.struct(p.alias("at"), (so_far["n"] + F.least(F.lit(K), p - so_far["at"])).alias("n")),
        lambda end: end["n"],
    )


def scan(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, str] = TEMPLATES,
    share: float = SHARE,
) -> DataFrame:
    """One row for each row of ``docs``: see the module. Beside the counts and labels it returns
    ``spans``, an array of ``(label, start, end, share)`` in words for the verified template spans."""
    spark = docs.sparkSession
    names, texts = list(templates), list(templates.values())
    if any(len(t.split(" ")) < K for t in texts) or any(len(p.split(" ")) < 2 for p in phrases):
        raise ValueError(f"a template has {K} words or more, a phrase two or more")
    base = len(texts)  # phrases are numbered after the templates
    info = [(i, names[i], False, len(t.split(" ")), len(t.split(" ")) - K + 1) for i, t in enumerate(texts)]
    info += [
        (base + i, label, True, len(p.split(" ")), len(p.split(" ")) - 1) for i, (p, label) in enumerate(phrases.items())
    ]
    about = spark.createDataFrame(info, "t int, label string, phrase boolean, length int, grams int")
    wide = spark.createDataFrame(
        [(t, at, " ".join(w)) for t, at, w in _grams(dict.fromkeys(texts), K)], "t5 int, at5 int, gram5 string"
    ).withColumn("h5", F.xxhash64(*(F.get(F.split("gram5", " "), F.lit(i)) for i in range(K))))
    short = spark.createDataFrame(
        [(base + t, at, w[0], w[1]) for t, at, w in _grams(phrases, 2)], "t2 int, at2 int, first string, second string"
    ).withColumn("h2", F.xxhash64("first", "second"))
    if len(info) + sum(i[4] for i in info) <= MAX_BROADCAST_GRAMS:
        about, wide, short = F.broadcast(about), F.broadcast(wide), F.broadcast(short)

    words = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), SEPARATORS, -1), lambda w: w != "")
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), words.alias("words"))
    numbered = rows.select(
        "doc_id",
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.arrays_zip(*(F.slice("words", i + 1, F.size("words")).alias(f"w{i}") for i in range(K))).alias("grams"),
    ).select("doc_id", "row", "n_words", F.posexplode_outer("grams").alias("at", "g"))
    gram = [F.col(f"g.w{i}" if i else "g.w0") for i in range(K)]
    voted = (
        numbered.select("doc_id", "row", "n_words", "at", *(c.alias(f"w{i}") for i, c in enumerate(gram)))
        .withColumn("g2", F.xxhash64("w0", "w1"))
        .withColumn("g5", F.xxhash64(*(f"w{i}" for i in range(K))))
    )
    voted = voted.join(
        short, (F.col("g2") == F.col("h2")) & (F.col("w0") == F.col("first")) & (F.col("w1") == F.col("second")), "left"
    ).join(
        wide, (F.col("g5") == F.col("h5")) & (F.concat_ws(" ", *(f"w{i}" for i in range(K))) == F.col("gram5")), "left"
    )
    hits = (
        voted.filter("t2 is not null or t5 is not null or coalesce(at, 0) = 0")
        .select(
            "doc_id",
            "row",
            "n_words",
            "at",
            F.array_compact(
                F.array(
                    F.when(F.col("t2").isNotNull(), F.struct(F.col("t2").alias("t"), F.col("at2").alias("from"))),
                    F.when(F.col("t5").isNotNull(), F.struct(F.col("t5").alias("t"), F.col("at5").alias("from"))),
                )
            ).alias("votes"),
        )
        .repartition("row")
        .select("doc_id", "row", "n_words", "at", F.explode_outer("votes").alias("vote"))
    )
    diagonals = (
        hits.select("*", F.col("vote.t").alias("t"), (F.col("at") - F.col("vote.from")).alias("diagonal"))
        .groupBy("row", "t", "diagonal")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.countDistinct("at").alias("votes"),
            F.collect_set("vote.from").alias("places"),  # as many as the template has k-grams, at most
            F.min("at").alias("first"),
            F.max("at").alias("last"),
        )
        .join(about, "t", "left")
    )
    by_diagonal = Window.partitionBy("row", "t").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(by_diagonal)
    spans = (
        diagonals.withColumn("new", F.when(F.col("phrase") | gap.isNull() | (gap > NEAR), 1).otherwise(0))
        .withColumn("span", F.sum("new").over(by_diagonal.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy("row", "t", "span")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.first("label").alias("label"),
            F.first("phrase").alias("phrase"),
            F.first("length").alias("length"),
            F.first("grams").alias("grams"),
            F.sum("votes").alias("votes"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
        .withColumn("share", _covered("places") / F.col("length"))
    )
    is_base = F.col("phrase") & (F.col("votes") == F.col("grams"))
    # a passage is about as long as the template whose share it holds
    long_as = (F.col("last") + K - F.col("first")) <= 2 * F.col("length")
    is_span = ~F.col("phrase") & (F.col("share") >= share) & long_as
    found = spans.select("*", F.coalesce(is_base, F.lit(False)).alias("base"), F.coalesce(is_span, F.lit(False)).alias("text"))
    joined = lambda column: F.array_join(F.array_sort(column), ",")
    return (
        found.groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.count_if(F.col("base")).cast("long").alias("n_base"),
            F.min(F.when(F.col("base"), F.col("first"))).cast("long").alias("first_word"),
            F.max(F.when(F.col("base"), F.col("first"))).cast("long").alias("last_word"),
            joined(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"),
            joined(F.collect_set(F.when(F.col("base") | F.col("text"), F.col("label")))).alias("labels"),
            F.greatest(
                F.max(F.when(F.col("base"), 0.5).otherwise(0.0)),
                F.max(F.when(F.col("text"), F.col("share")).otherwise(0.0)),
            ).alias("score"),
            F.sort_array(
                F.collect_list(
                    F.when(
                        F.col("text"),
                        F.struct(
                            F.col("first").alias("start"),
                            (F.col("last") + K).alias("end"),
                            "label",
                            "share",
                        ),
                    )
                )
            ).alias("spans"),
        )
        .drop("row")
    )
