"""License scans by diagonal voting.

Templates are base phrases (a few words that make a finding wherever they stand consecutively) and the texts of common
license notices.  All rolling word k-grams of the documents - two words for phrases, five for notices - are joined by
hash to the template positions of the same k-gram, the words compared.  A match votes for a diagonal: its place in the
document less its place in the template.  A phrase stands where all its grams vote for one diagonal.  For notices,
diagonals that lie close together (words put in or left out) are merged into a span, and a span is verified by the
share of the template's words that its matches cover.

The template table is fixed and small, so it is broadcast; everything else is one pass over the exploded words with
map-side combined votes.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import staged

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PHRASE_GRAM, NOTICE_GRAM = 2, 5
SHIFT = 4  # diagonals this close belong to one span
COVERED = 0.5  # share of a notice's words that verifies a span

# Phrases that name a license, by label.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

# Openings of common license notices, by label.
NOTICES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
               "distributed under the License is distributed on an \"AS IS\" BASIS"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
             "Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
)


def words_of(text: str) -> list[str]:
    """A text's words, as the scan takes them."""
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


def _templates(spark, phrases, notices) -> DataFrame:
    rows = []
    for kind, k, texts in (("phrase", PHRASE_GRAM, phrases), ("notice", NOTICE_GRAM, notices)):
        for number, (label, text) in enumerate(texts):
            words = words_of(text)
            if len(words) < k:
                raise ValueError(f"a {kind} needs {k} words: {text}")
            for at in range(len(words) - k + 1):
                gram = words[at:at + k]
                rows.append((f"{kind}{number}", label, k, len(words), at, gram + [None] * (NOTICE_GRAM - k)))
    table = spark.createDataFrame(rows, "template string, label string, k int, template_words int, tpos int, gram array<string>")
    return table.select("template", "label", "k", "template_words", "tpos", *(F.col("gram")[i].alias(f"t{i}") for i in range(NOTICE_GRAM))).withColumn(
        "thash", F.when(F.col("k") == PHRASE_GRAM, F.xxhash64("t0", "t1")).otherwise(F.xxhash64(*(f"t{i}" for i in range(NOTICE_GRAM)))))


def matches(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """Votes: doc_id, text_hash, template, label, k, template_words, diagonal, places (template positions, distinct)."""
    n = F.size("words")
    zipped = F.arrays_zip(F.col("words").alias("w0"), *(F.slice("words", F.lit(i + 1), n).alias(f"w{i}") for i in range(1, NOTICE_GRAM)))
    grams = (
        docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                    F.regexp_extract_all(F.translate(F.col("text"), UPPER, LOWER), F.lit(WORD), F.lit(0)).alias("words"))
        .select("doc_id", "text_hash", F.posexplode(zipped).alias("pos", "g"))
        .select("doc_id", "text_hash", "pos", *(F.col("g")[f"w{i}"].alias(f"w{i}") for i in range(NOTICE_GRAM)))
        .filter("w1 IS NOT NULL")
    )
    both = F.array(F.xxhash64("w0", "w1"), F.when(F.col(f"w{NOTICE_GRAM - 1}").isNotNull(), F.xxhash64(*(f"w{i}" for i in range(NOTICE_GRAM)))))
    grams = grams.withColumn("hash", F.explode(both))
    table = F.broadcast(_templates(docs.sparkSession, phrases, notices))  # fixed templates, a few hundred rows
    rest = " AND ".join(f"w{i} = t{i}" for i in range(PHRASE_GRAM, NOTICE_GRAM))
    found = grams.join(table, F.expr(f"hash = thash AND w0 = t0 AND w1 = t1 AND (k = {PHRASE_GRAM} OR {rest})"))
    return found.groupBy("doc_id", "text_hash", "template", "label", "k", "template_words", (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(
        F.sort_array(F.collect_set("tpos")).alias("places"))


def spans(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """Verified findings: doc_id, text_hash, label, base (a phrase), first_word, last_word (of the span), score.  The votes,
    a row for each diagonal that a template meets, are written, so both kinds of findings cost one pass over the texts."""
    votes = staged(matches(docs, phrases, notices), "license-votes")
    base = votes.filter((F.col("k") == PHRASE_GRAM) & (F.size("places") == F.col("template_words") - PHRASE_GRAM + 1)).select(
        "doc_id", "text_hash", "label", F.lit(True).alias("base"), F.col("diagonal").cast("long").alias("first_word"),
        (F.col("diagonal") + F.col("template_words") - 1).cast("long").alias("last_word"), F.lit(1.0).alias("score"))
    own = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(own) > SHIFT, F.lit(True))
    merged = votes.filter(F.col("k") == NOTICE_GRAM).withColumn("far", far.cast("int")).withColumn("span", F.sum("far").over(own))
    merged = merged.groupBy("doc_id", "text_hash", "template", "label", "template_words", "span").agg(
        F.array_distinct(F.flatten(F.collect_list(F.expr(f"flatten(transform(places, p -> sequence(p, p + {NOTICE_GRAM - 1})))")))).alias("covered"),
        F.min(F.col("diagonal") + F.element_at("places", 1)).cast("long").alias("first_word"),
        F.max(F.col("diagonal") + F.element_at("places", -1) + NOTICE_GRAM - 1).cast("long").alias("last_word"))
    score = F.size("covered") / F.col("template_words")
    notice = merged.withColumn("score", score).filter(F.col("score") >= COVERED)
    return base.unionByName(notice.select("doc_id", "text_hash", "label", F.lit(False).alias("base"), "first_word", "last_word", "score"))


def scan_licenses(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base (places of phrases), first_word and last_word (least and greatest
    start of a phrase; null without), base_labels, labels (sorted, comma-joined, "" without) and score (1.0 with a
    phrase, else the best verified notice's share, 0.0 without).

    A null or empty text has no words and no findings.  Rows alike in doc_id and text are one document, whose findings
    are counted once and shown on each; rows of the same or a null doc_id but other texts are told apart by the text's
    hash.  Places that overlap count each.  An empty table gives no rows; other columns are ignored.
    """
    found = spans(docs.select("doc_id", "text"), phrases, notices).groupBy("doc_id", "text_hash").agg(
        F.count(F.when(F.col("base"), 1)).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first_word"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first_word"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("score").alias("score"),
    ).withColumnRenamed("doc_id", "__fid")
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("__th"),
                       F.coalesce(F.regexp_count("text", F.lit(ANY_CASE_WORD)), F.lit(0)).cast("long").alias("n_words"))
    joined = rows.join(found, (F.col("__th") == F.col("text_hash")) & F.col("doc_id").eqNullSafe(F.col("__fid")), "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
