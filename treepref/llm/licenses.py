"""Operator 13, license scans: diagonal voting.

All rolling word k-grams of every text are hashed and joined to the positions
that the same k-gram has in the notices of ``NOTICES``.  A match at word i of the
text and word j of a notice is a vote for the diagonal i - j: the place where the
notice would begin.  Votes are counted for each (text, notice, diagonal), diagonals at
most ``SHIFT`` words apart are merged (a word put in or left out moves the rest
of a notice by one), and a merged group is verified: the words under its k-grams,
which were compared as text and not only by hash, must cover ``COVER`` of the
notice's words.

All of it is DataFrame expressions.  The notices are a constant of the library or
a short list of the caller's, whose number of positions is checked before they are broadcast.

Texts are known by (id, hash, number of words), so rows that repeat share one
scan, and a vote counts a position once however many rows hold it.  The
list of a diagonal is as long as its notice at most; the window that merges
diagonals holds those of one text and notice, at most one for each word.

Defined results: a null or empty text has no words, no label and score 0; a null
id is a value of its own; repeated rows get equal results; a text that holds two
notices equally well has both labels; an empty table gives an empty result; further
columns are ignored.  ``score`` is 1 where a base phrase stands, else the largest
share of a notice that is covered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Words of a rolling window.
GRAM = 3
#: Diagonals so close are one occurrence.
SHIFT = 4
#: Least share of a notice's words that must be found.
COVER = 0.8
#: Most positions of all notices together, which are broadcast.
MOST_POSITIONS = 100_000

#: Phrases whose places are counted, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Fixed values: (label, notice) in the words of the public licenses.
NOTICES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl", "under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("agpl", "under the terms of the GNU Affero General Public License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("epl-2.0", "made available under the terms of the Eclipse Public License 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z only.  On a text without other letters the built-in lower-casing does the same faster."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column) -> Column:
    """Runs of digits, letters a-z and characters beyond ASCII, lower-cased."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), "")


def _grams(w: Column, size: int) -> Column:
    """All runs of ``size`` words as texts."""
    return F.when(F.size(w) >= size, F.transform(
        F.sequence(F.lit(0), F.size(w) - size), lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(size)]))).otherwise(
        F.array().cast("array<string>"))


def positions(spark, notices: Sequence[tuple[str, str]], size: int = GRAM) -> DataFrame:
    """(notice, label, length, place, gram, hash) of every k-gram of the notices."""
    rows = spark.createDataFrame([(k, label, text) for k, (label, text) in enumerate(notices)], "notice int, label string, text string")
    rows = rows.select("notice", "label", words(F.col("text")).alias("w"))
    rows = rows.select("notice", "label", F.size("w").alias("length"), F.posexplode(_grams(F.col("w"), size)).alias("place", "gram"))
    return rows.withColumn("hash", F.xxhash64("gram"))


def _known(id: str, text: str) -> list[Column]:
    """What tells texts apart: id, hash and, once they are taken, the number of words."""
    return [F.col(id).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash")]


def spans(df: DataFrame, notices: Sequence[tuple[str, str]] = NOTICES, id: str = "doc_id", text: str = "text",
          size: int = GRAM, shift: int = SHIFT, cover: float = COVER) -> DataFrame:
    """(id, text_hash, n_words, label, notice, first, last, votes, covered): verified notices of every text.

    ``first`` and ``last`` are the words of the text, from 0, at which the span begins and ends."""
    at = positions(df.sparkSession, notices, size)
    n = at.count()
    if n > MOST_POSITIONS:
        raise ValueError(f"{n} positions of notices are too many to broadcast")
    texts = df.select(*_known(id, text), words(F.col(text)).alias("w"))
    grams = texts.select("id", "text_hash", F.size("w").alias("n_words"), F.posexplode(_grams(F.col("w"), size)).alias("i", "gram"))
    hits = grams.withColumn("hash", F.xxhash64("gram")).join(F.broadcast(at), ["hash", "gram"])
    key = ["id", "text_hash", "n_words", "notice"]
    lines = hits.groupBy(*key, "label", "length", (F.col("i") - F.col("place")).alias("diagonal")).agg(
        F.collect_set("place").alias("places"))
    # A diagonal more than ``shift`` words after the one before begins a new group.
    w = Window.partitionBy(*key).orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(w) > shift, F.lit(True))
    groups = lines.withColumn("new", apart.cast("int")).withColumn("group", F.sum("new").over(w))
    under = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + (size - 1)))))
    groups = groups.groupBy(*key, "label", "length", "group").agg(
        F.min(F.col("diagonal") + F.array_min("places")).alias("first"),
        F.max(F.col("diagonal") + F.array_max("places") + (size - 1)).alias("last"),
        F.sum(F.size("places")).alias("votes"),
        F.size(F.array_distinct(F.flatten(F.collect_set(under)))).alias("found"))
    groups = groups.withColumn("covered", F.col("found") / F.col("length")).where(F.col("covered") >= cover)
    return groups.select("id", "text_hash", "n_words", "label", "notice", "first", "last", "votes", "covered")


def _places(w: Column, phrase: str) -> Column:
    """Words at which the phrase begins.  ``w`` is looked through only in texts that hold the phrase."""
    parts = phrase.split(" ")

    def here(i: Column) -> Column:
        out = F.get(w, i) == parts[0]
        for k, p in enumerate(parts[1:], 1):
            out &= F.get(w, i + k) == p
        return out

    found = F.filter(F.sequence(F.lit(0), F.size(w) - len(parts)), here)
    return F.when(F.col("joined").contains(f" {phrase} "), found).otherwise(F.array().cast("array<int>"))


def scan(df: DataFrame, phrases: Mapping[str, str] = PHRASES, notices: Sequence[tuple[str, str]] = NOTICES,
         id: str = "doc_id", text: str = "text", size: int = GRAM, shift: int = SHIFT, cover: float = COVER) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row."""
    rows = df.select(*_known(id, text), words(F.col(text)).alias("w"))
    rows = rows.withColumn("joined", F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")))
    rows = rows.select("id", "text_hash", F.size("w").alias("n_words"),
                       *[_places(F.col("w"), p).alias(f"at{k}") for k, p in enumerate(phrases)])
    every = F.concat(*[F.col(f"at{k}") for k in range(len(phrases))])
    named = F.array_sort(F.array_distinct(F.concat(*[
        F.when(F.size(f"at{k}") > 0, F.array(F.lit(label))).otherwise(F.array().cast("array<string>"))
        for k, label in enumerate(phrases.values())])))
    rows = rows.select("id", "text_hash", "n_words", every.alias("at"), named.alias("base"))
    found = spans(df, notices, id, text, size, shift, cover).groupBy("id", "text_hash", "n_words").agg(
        F.collect_set("label").alias("more"), F.max("covered").alias("covered"))
    found = found.withColumnsRenamed({"id": "id2", "text_hash": "hash2", "n_words": "n2"})
    out = rows.join(found, rows["id"].eqNullSafe(found["id2"]) & (F.col("text_hash") == F.col("hash2"))
                    & (F.col("n_words") == F.col("n2")), "left")
    label = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    return out.select(F.col("id").alias(id), F.col("n_words").cast("long").alias("n_words"),
                      F.size("at").cast("long").alias("n_base"), F.array_min("at").cast("long").alias("first_word"),
                      F.array_max("at").cast("long").alias("last_word"), F.array_join("base", ",").alias("base_labels"),
                      F.array_join(label, ",").alias("labels"),
                      F.when(F.size("at") > 0, 1.0).otherwise(F.coalesce("covered", F.lit(0.0))).alias("score"))
