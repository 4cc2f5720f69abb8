"""License notices in texts, by an exact set-similarity join.

A text is cut into overlapping blocks of words, and blocks and templates become sets
of tokens (pairs of neighbouring words: with single words, the notices of two
licenses differ in one word of five). Tokens are ordered by their frequency in all
blocks, rarest first. A block that holds enough of a template shares a token of its
own prefix with the template's prefix; length and position filters thin out those
candidates, and the sets of the rest are compared.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagewright.llm.shared import text_or_empty, written

#: Words of a block, and from one block's start to the next's: every passage of STEP words lies in one block.
BLOCK = 256
STEP = 128
#: A block must hold so much of a template's tokens.
PERCENT = 80

# fixed values: phrases of the base labels
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# fixed values: notices of licenses, as their publishers word them
NOTICES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Distributed under the MIT License"),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "SPDX-License-Identifier: Apache-2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache", "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("gpl", "This work is licensed under the GNU General Public License"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "Licensed under the GNU Lesser General Public License"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "Licensed under the GNU Affero General Public License"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", "Released under the BSD License"),
    ("bsd", "Licensed under the BSD License"),
    ("bsd", "Licensed under the BSD 3-Clause License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "Licensed under the Mozilla Public License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software"),
    ("boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("cc", "Licensed under CC BY 4.0"),
    ("cc", "Licensed under CC BY-SA 4.0"),
    ("cc", "Licensed under CC BY-NC 4.0"),
    ("cc", "Licensed under CC BY-NC-SA 4.0"),
    ("cc", "Licensed under CC BY-ND 4.0"),
    ("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
)

_WORDS = re.compile("[a-z0-9\x80-\U0010ffff]+").findall


def words_of(text: str) -> list[str]:
    """Runs of letters, digits and code points beyond ASCII, with A to Z lower-cased."""
    return _WORDS(text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))


def block_starts(words: int) -> range:
    return range(0, max(words - STEP, 1), STEP)


def _pairs(words: list[str]) -> list[tuple[str, str]]:
    return list(dict.fromkeys(zip(words, words[1:], strict=False)))


class Templates:
    """Notices as sets of numbered tokens, and the words that phrases and notices are made of."""

    def __init__(self, notices: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]], percent: int) -> None:
        self.phrases = [(words_of(p), label) for p, label in phrases]
        self.numbers: dict[tuple[str, str], int] = {}
        #: number, label, tokens that must be found, tokens
        self.rows: list[tuple[int, str, int, list[int]]] = []
        for k, (label, text) in enumerate(notices):
            words = words_of(text)
            if not 2 <= len(words) <= STEP:
                raise ValueError(f"a notice must have 2 to {STEP} words: {text[:60]!r}")
            tokens = [self.numbers.setdefault(p, len(self.numbers)) for p in _pairs(words)]
            self.rows.append((k, label, -(-percent * len(tokens) // 100), tokens))
        self.words = {w for p in self.numbers for w in p} | {w for p, _ in self.phrases for w in p}

    def places(self, words: list[str], hits: list[int]) -> tuple[list[int], list[str]]:
        """Where phrases start, once for each phrase, and their labels."""
        found, labels = [], set()
        for phrase, label in self.phrases:
            own = [k for k in hits if words[k] == phrase[0] and words[k : k + len(phrase)] == phrase]
            if own:
                found += own
                labels.add(label)
        return found, sorted(labels)

    def blocks(self, words: list[str], hits: list[int]) -> list[dict]:
        """The blocks with a token of any notice: start, tokens."""
        found: dict[int, set[int]] = {}
        starts = block_starts(len(words))
        for k, following in zip(hits, hits[1:], strict=False):
            if following == k + 1 and (token := self.numbers.get((words[k], words[following]))) is not None:
                last = min(k // STEP, len(starts) - 1)
                for b in (last - 1, last):
                    if b >= 0 and following < b * STEP + BLOCK:
                        found.setdefault(b * STEP, set()).add(token)
        return [{"start": s, "tokens": sorted(t)} for s, t in sorted(found.items())]


_BLOCKS = pa.list_(pa.struct([("start", pa.int64()), ("tokens", pa.list_(pa.int32()))]))


def _scan(templates: Templates):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = templates.words
        for batch in batches:
            out = []
            for text in batch.column("text"):
                words = words_of(text.as_py())
                hits = [k for k, w in enumerate(words) if w in known]
                places, labels = templates.places(words, hits)
                out.append((len(words), len(places), min(places, default=None), max(places, default=None), labels, templates.blocks(words, hits)))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [*[pa.int64()] * 4, pa.list_(pa.string()), _BLOCKS]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=["doc_id", "row", "n_words", "n_base", "first_word", "last_word", "base", "blocks"])

    return run


def scan(docs: DataFrame, templates: Templates) -> DataFrame:
    """For each row of ``docs`` its number of words, places of base phrases, and blocks with their tokens."""
    rows = docs.select("doc_id", text_or_empty().alias("text")).withColumn("row", F.monotonically_increasing_id())
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_scan(templates), f"doc_id {kind}, row long, n_words long, n_base long, first_word long, last_word long, base array<string>, blocks array<struct<start:long,tokens:array<int>>>")


def notice_blocks(found: DataFrame, templates: Templates) -> DataFrame:
    """Every block of ``scan`` that holds enough of a notice: row, start, notice, label, held (share of the notice's tokens)."""
    spark = found.sparkSession
    blocks = found.select("row", F.explode("blocks").alias("b")).select("row", "b.start", "b.tokens")
    seen = blocks.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    every = spark.createDataFrame([(t,) for t in range(len(templates.numbers))], "token int").join(seen, "token", "left")
    # the order of all tokens; they are as few as the notices' words
    ranks = written(every.select("token", F.row_number().over(W.orderBy(F.coalesce("n", F.lit(0)), "token")).alias("rank")), "ranks")

    def sets(tokens: DataFrame, *keys: str) -> DataFrame:
        return tokens.join(ranks, "token").groupBy(*keys).agg(F.sort_array(F.collect_list("rank")).alias("ranks"))

    notices = spark.createDataFrame(templates.rows, "notice int, label string, need int, tokens array<int>").withColumn("token", F.explode("tokens"))
    notices = written(sets(notices, "notice", "label", "need"), "notices")
    least = min((need for _, _, need, _ in templates.rows), default=1)
    long_enough = blocks.filter(F.size("tokens") >= least).withColumn("token", F.explode("tokens"))
    mine = sets(long_enough, "row", "start").withColumn("size", F.size("ranks"))
    # what is left of a prefix without the last need - 1 tokens must hold one of the shared tokens
    mine = mine.select("row", "start", "size", "ranks", F.posexplode(F.slice("ranks", F.lit(1), F.col("size") - least + 1)).alias("at", "rank"))
    theirs = notices.withColumn("whole", F.size("ranks")).select("notice", "label", "need", "whole", F.col("ranks").alias("wanted"), F.posexplode(F.slice("ranks", F.lit(1), F.size("ranks") - F.col("need") + 1)).alias("place", "rank"))
    met = mine.join(theirs, "rank").filter((F.col("size") >= F.col("need")) & (F.col("at") <= F.col("size") - F.col("need")))
    first = met.groupBy("row", "start", "notice").agg(F.min(F.struct("at", "place")).alias("first"), *(F.any_value(c).alias(c) for c in ("label", "need", "size", "whole", "ranks", "wanted")))
    # after the first shared token no more can be shared than either side has left
    able = first.filter(1 + F.least(F.col("size") - F.col("first.at") - 1, F.col("whole") - F.col("first.place") - 1) >= F.col("need"))
    shared = F.size(F.array_intersect("ranks", "wanted"))
    return able.filter(shared >= F.col("need")).select("row", "start", "notice", "label", (shared / F.col("whole")).alias("held"))


def license_scan(docs: DataFrame, notices: Sequence[tuple[str, str]] = NOTICES, phrases: Sequence[tuple[str, str]] = PHRASES, percent: int = PERCENT) -> DataFrame:
    """License phrases and notices of every row of ``docs``.

    Base places are where a phrase's words stand one after another; a phrase may
    overlap another, and each counts. A block of words adds the label of every notice
    of which it holds ``percent`` of the tokens or more; a notice has 2 to STEP words. A null
    text is empty and has no words. Repeated rows each get a row; other columns are not
    read; an empty table gives an empty result.

    Returns doc_id, n_words, n_base, first_word, last_word (null without a base place),
    base_labels, labels, score (1 with a base place, else the largest share of a notice that
    was found, else 0), n_blocks (blocks with a notice).
    """
    templates = Templates(notices, phrases, percent)
    found = written(scan(docs, templates), "scanned")
    own = notice_blocks(found, templates).groupBy("row").agg(F.collect_set("label").alias("added"), F.max("held").alias("held"), F.count_distinct("start").alias("n_blocks"))
    rows = found.drop("blocks").join(own, "row", "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("added", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("held", F.lit(0.0)))
    return rows.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"), F.coalesce("n_blocks", F.lit(0)).alias("n_blocks"))
