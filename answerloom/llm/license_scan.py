"""License scan by diagonal voting, in DataFrame functions alone.

1. All rolling `K`-word hashes of every text are joined to the positions of the same runs in the license templates.
2. A hit at word p of the text and word t of a template votes for the diagonal p - t; votes are summed by text,
   template and diagonal.
3. Diagonals at most `NEAR` apart (words put in or left out) are merged into one span of the text.
4. A span is verified: the words of the template that stand in it on one of its diagonals are counted against the
   template's length. The template's label is given from `VERIFIED` on, or `VERIFIED_SHORT` if it has under `SHORT`
   words, and only if the words that tell the license (`TELLING`) stand in the span one behind the other: lead-ins
   that licenses share, and names with a word put in ("GNU Lesser General Public"), give no label.

Beside it stand the places of fixed phrases, as a base.

Cases: a null text is an empty one; a text without words has zeros, no labels and score 0. Rows are told apart by
their id and text, so repeated rows give as many equal results. Other columns are not looked at; an empty table gives
no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The base phrases and their labels, and the texts of short license notices.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = {
    "apache": "Licensed under the Apache License, Version 2.0",
    "apache-notice": "you may not use this file except in compliance with the License. You may obtain a copy of the "
                     "License at",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
           "associated documentation files",
    "mit-notice": "Released under the MIT License",
    "mit-spdx": "SPDX License Identifier MIT",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
           "General Public License as published by the Free Software Foundation",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
           "that the following conditions are met",
    "gpl-notice": "This work is licensed under the GNU General Public License, version 3",
    "cc": "This work is licensed under a Creative Commons Attribution",
    "cc-notice": "Licensed under CC BY-NC 4.0",
    "copyright": "All rights reserved",
}
#: Words of each template, `K` at most, that others do not share.
TELLING = {
    "apache": "apache license", "apache-notice": "file except in", "mit": "software and associated",
    "mit-notice": "mit license", "mit-spdx": "identifier mit", "gpl": "gnu general public", "bsd": "and binary forms",
    "gpl-notice": "gnu general public", "cc": "creative commons", "cc-notice": "cc by", "copyright": "all rights reserved",
}
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

K = 3
NEAR = 2
VERIFIED, VERIFIED_SHORT, SHORT = 0.6, 0.85, 10


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def run_hashes(words: Column, size: int) -> Column:
    """The hash of each run of `size` words, by position; zipped shifted arrays keep this one pass over the words."""
    count = F.greatest(F.size(words) - (size - 1), F.lit(0))
    at = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + s) for s in range(size)]))


def template_runs(spark) -> DataFrame:
    """hash, template, t (position), length and whether the run holds the telling words; as many rows as the fixed
    templates have words, at most."""
    rows = spark.createDataFrame(
        [(name, notice, f" {TELLING[name]} ") for name, notice in sorted(TEMPLATES.items())],
        "template string, notice string, telling string")
    worded = rows.select("template", "telling", words_of(F.col("notice")).alias("w"))
    runs = worded.select("template", "telling", "w", F.size("w").alias("length"),
                         F.posexplode(run_hashes(F.col("w"), K)).alias("t", "hash"))
    run = F.concat(F.lit(" "), F.array_join(F.slice("w", F.col("t") + 1, K), " "), F.lit(" "))
    return runs.withColumn("tells", F.contains(run, F.col("telling")))


def phrase_places(words: Column, phrase: str) -> Column:
    """Start positions of a phrase; texts without its last word are passed over at once."""
    parts = phrase.split(" ")
    whole = lambda i: reduce(lambda a, b: a & b, [F.get(words, i + s) == w for s, w in enumerate(parts)])
    places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), whole)
    return F.when(F.array_contains(words, parts[-1]), places).otherwise(F.array().cast("array<int>"))


def spans(worded: DataFrame) -> DataFrame:
    """key, mark, template, first, last (words of the text), votes and score of each verified span.

    `worded` has key, mark and w, the words of each text.
    """
    spark = worded.sparkSession
    hits = (
        worded.select("key", "mark", F.posexplode(run_hashes(F.col("w"), K)).alias("p", "hash"))
        .join(F.broadcast(template_runs(spark).select("hash", "template", "t", "length", "tells")), "hash")
        .select("key", "mark", "template", "length", (F.col("p") - F.col("t")).alias("diagonal"), "t", "tells"))
    votes = hits.groupBy("key", "mark", "template", "length", "diagonal").agg(
        F.count_distinct("t").alias("votes"), F.collect_set("t").alias("ts"), F.max("tells").alias("tells"))
    ordered = Window.partitionBy("key", "mark", "template").orderBy("diagonal")
    opens = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(ordered) > NEAR, F.lit(True))
    merged = (
        votes.withColumn("opens", opens.cast("int"))
        .withColumn("span", F.sum("opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("key", "mark", "template", "length", "span")
        .agg(F.sum("votes").alias("votes"), F.max("tells").alias("tells"), F.array_distinct(F.flatten(F.collect_list("ts"))).alias("ts"),
             F.min(F.col("diagonal") + F.array_min("ts")).alias("first"),
             F.max(F.col("diagonal") + F.array_max("ts") + (K - 1)).alias("last")))
    # a hash stands for K words of the template; each word counts once
    covered = F.size(F.array_distinct(F.flatten(F.transform("ts", lambda t: F.sequence(t, t + (K - 1))))))
    return merged.withColumn("score", covered / F.col("length")).where(
        F.col("tells") & (F.col("score") >= F.when(F.col("length") < SHORT, VERIFIED_SHORT).otherwise(VERIFIED)))


def scan(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_words, n_base, first_word, last_word, base_labels, labels and score of each document."""
    plain = documents.select(F.col(key).alias("key"), F.xxhash64(text).alias("mark"),
                             words_of(F.coalesce(F.col(text), F.lit(""))).alias("w"))
    found = spans(plain).groupBy("key", "mark").agg(
        F.collect_set(F.element_at(F.split("template", "-"), 1)).alias("own"), F.max("score").alias("score"))
    places = {label: phrase_places(F.col("w"), phrase) for phrase, label in PHRASES.items()}
    based = plain.select(
        F.col("key").alias("_key"), F.col("mark").alias("_mark"), F.size("w").cast("long").alias("n_words"),
        *[p.alias(label) for label, p in places.items()])
    every = F.concat(*[F.col(x) for x in places])
    base = F.concat(*[F.when(F.size(x) > 0, F.array(F.lit(x))).otherwise(F.array().cast("array<string>")) for x in places])
    based = based.select("_key", "_mark", "n_words", every.alias("places"), base.alias("base"))
    joined = based.join(found, F.col("_key").eqNullSafe(F.col("key")) & (F.col("_mark") == F.col("mark")), "left")
    listed = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return joined.select(
        F.col("_key").alias(key), "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        listed(F.col("base")).alias("base_labels"),
        listed(F.concat("base", F.coalesce("own", F.array().cast("array<string>")))).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
