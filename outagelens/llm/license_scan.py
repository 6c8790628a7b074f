"""License phrases and notices, found by votes on diagonals.

All rolling word k-grams of the texts are joined to the places of the templates' k-grams by
their hashes. A match at word p of a text and word q of a template votes for diagonal p - q: all
matches of an unchanged copy vote for the same one, and a word added or left out moves the votes
behind it to a neighbouring one. Votes are summed by diagonal, neighbouring diagonals merged
into spans, and each span is verified on the words themselves.

Phrases (short templates) are matched by pairs of words and must stand there whole. Notices
(long templates) are matched by five words and may differ, as far as `LIKENESS` allows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import kept, whole_text

PAIR, GRAM = 2, 5
#: Least likeness of a notice: twice the common words over the words of both.
LIKENESS = 0.8
#: Share of a notice's k-grams that must vote for a span.
LEAST_VOTES = 0.2
#: Neighbouring diagonals: words between two votes, and steps from one diagonal to the next.
GAP, STEP = 16, 8
#: k-grams in one row.
ROW_GRAMS = 65_536
#: Broadcast up to so many template k-grams, and found spans; more are joined by a shuffle.
BROADCAST_GRAMS, BROADCAST_SPANS = 200_000, 200_000


@dataclass(frozen=True)
class Template:
    """``base``: one of the phrases that every caller is promised."""

    label: str
    text: str
    base: bool = False

    def words(self) -> list[bytes]:
        return words_of(self.text.encode())

    def gram(self) -> int:
        return PAIR if len(self.words()) < 2 * GRAM else GRAM


# The promised phrases, names of further licences, and the opening words of public licence notices.
TEMPLATES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
    Template("agpl", "gnu affero general public license"),
    Template("bsd", "bsd license"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc-by-sa", "cc by sa"),
    Template("epl", "eclipse public license"),
    Template("isc", "isc license"),
    Template("lgpl", "gnu lesser general public license"),
    Template("mpl", "mozilla public license"),
    Template(
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
)

_FOLD = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 32 for c in range(256))
_WORD = "[0-9A-Za-z\\x{80}-\\x{10FFFF}]+"


def words_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of all other characters beyond ASCII; A-Z in lower case."""
    return text.translate(_FOLD).split()


def gram_hashes(words: list[bytes], size: int) -> np.ndarray:
    """A hash for each run of so many words."""
    count = len(words) - size + 1
    if count < 1:
        return np.zeros(0, dtype=np.int64)
    codes = np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words))
    mixed = np.full(count, size, dtype=np.uint64)
    for place in range(size):
        mixed = (mixed ^ codes[place : place + count]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return mixed.view(np.int64)


def _gram_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """digest, text to digest, start, hashes: all k-grams of each size, by the word they start with."""
    for batch in batches:
        rows = []
        for digest, text in zip(batch["digest"], batch["text"], strict=True):
            words = words_of(text)
            for size in (PAIR, GRAM):
                hashes = gram_hashes(words, size)
                rows += [(digest, at, hashes[at : at + ROW_GRAMS]) for at in range(0, len(hashes), ROW_GRAMS)]
        yield pd.DataFrame(rows, columns=["digest", "start", "hashes"])


def _template_grams(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """(hash, template, place, grams, phrase): the places of the templates' k-grams; broadcast while few."""
    rows = []
    for number, template in enumerate(templates):
        words, size = template.words(), template.gram()
        if len(words) < PAIR:
            raise ValueError(f"a template needs {PAIR} words: {template}")
        hashes = gram_hashes(words, size).tolist()
        rows += [(h, number, place, len(hashes), len(words), size == PAIR) for place, h in enumerate(hashes)]
    table = spark.createDataFrame(rows, "hash long, template int, place int, grams int, words int, phrase boolean")
    return F.broadcast(table) if len(rows) <= BROADCAST_GRAMS else table


def _spans(docs: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """(digest, text binary) to candidate spans (digest, template, start, end) in words; copies vote once."""
    grams = docs.mapInPandas(_gram_rows, "digest binary, start long, hashes array<long>")
    places = grams.select("digest", "start", F.posexplode("hashes").alias("i", "hash"))
    votes = places.join(_template_grams(docs.sparkSession, templates), "hash")
    diagonal = (F.col("start") + F.col("i") - F.col("place")).alias("diagonal")
    same = ["digest", "template", "diagonal", "grams", "words", "phrase"]
    votes = votes.select("digest", "template", diagonal, "place", "grams", "words", "phrase").distinct()
    summed = votes.groupBy(*same).agg(F.count("*").alias("votes"), F.min("place").alias("low"), F.max("place").alias("high"))
    whole = summed.filter("phrase AND votes = grams AND diagonal >= 0")
    whole = whole.select("digest", "template", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("words")).alias("end"))

    # The diagonals of one template in one text.
    first, last = F.col("diagonal") + F.col("low"), F.col("diagonal") + F.col("high")
    loose = summed.filter("NOT phrase").withColumns({"first": first, "last": last})
    order = Window.partitionBy("digest", "template").orderBy("first", "diagonal")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = (F.col("first") > reached + GAP) | (F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) > STEP)
    cut = F.coalesce(apart, F.lit(True)).cast("int")
    span = F.sum("cut").over(order.rowsBetween(Window.unboundedPreceding, 0))
    merged = loose.withColumn("cut", cut).withColumn("span", span).groupBy("digest", "template", "span", "grams", "words")
    merged = merged.agg(F.sum("votes").alias("votes"), F.min("diagonal").alias("low"), F.max("diagonal").alias("high"))
    merged = merged.filter(F.col("votes") >= LEAST_VOTES * F.col("grams"))
    merged = merged.select("digest", "template", F.greatest("low", F.lit(0)).alias("start"), (F.col("high") + F.col("words")).alias("end"))
    return whole.unionByName(merged)


def verified(words: list[bytes], spans: list[tuple[int, int, int]], templates: tuple[Template, ...]) -> list[dict]:
    """Of spans (template, start, end) those whose words are the template's, with their likeness.

    Of notices that overlap the most alike one stays.
    """
    found, notices = [], []
    for number, start, end in spans:
        template = templates[number]
        own, there = template.words(), words[start:end]
        made = {"label": template.label, "base": template.base, "start": start, "end": min(end, len(words))}
        if template.gram() == PAIR:
            if own == there:
                found.append(made | {"likeness": 1.0})
            continue
        blocks = [b for b in SequenceMatcher(None, own, there, autojunk=False).get_matching_blocks() if b.size]
        if not blocks:
            continue
        low, high = blocks[0].b, blocks[-1].b + blocks[-1].size
        likeness = 2 * sum(b.size for b in blocks) / (len(own) + high - low)
        if likeness >= LIKENESS:
            notices.append(made | {"start": start + low, "end": start + high, "likeness": likeness})
    taken: list[dict] = []
    for one in sorted(notices, key=lambda x: (-x["likeness"], x["start"] - x["end"], x["start"], x["label"])):
        if all(one["end"] <= x["start"] or x["end"] <= one["start"] for x in taken):
            taken.append(one)
    return sorted(found + taken, key=lambda x: (x["start"], x["end"], x["label"]))


SPANS = "array<struct<label: string, base: boolean, start: long, end: long, likeness: double>>"


def _verifier(templates: tuple[Template, ...]):
    @F.pandas_udf(SPANS)
    def verify(texts: pd.Series, numbers: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series(
            [
                None if text is None else verified(words_of(text), list(zip(*map(np.ndarray.tolist, spans), strict=True)), templates)
                for text, *spans in zip(texts, numbers, starts, ends, strict=True)
            ],
            dtype=object,
        )

    return verify


def scan(docs: DataFrame, key: str = "doc_id", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per document: key, n_words, spans (label, base, start, end in words, likeness).

    Spans are sorted by their first word; a text without one has an empty list. Null, empty and
    blank texts have no word. Repeated rows and null keys keep a row each; other columns are
    ignored; an empty table gives no rows. The spans of one text fit one cell.
    """
    text = whole_text(docs["text"])
    docs = docs.select(docs[key].alias(key), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))
    binary = F.col("text").cast("binary").alias("text")
    listed = _spans(docs.select("digest", binary), templates).groupBy("digest")
    listed = kept(listed.agg(F.sort_array(F.collect_list(F.struct("start", "end", "template"))).alias("s")), "license-spans")
    few = (listed.agg(F.sum(F.size("s"))).first()[0] or 0) <= BROADCAST_SPANS
    joined = docs.join(F.broadcast(listed) if few else listed, "digest", "left")
    # Only texts with a candidate go to Python.
    some = F.when(F.col("s").isNotNull(), F.col("text").cast("binary"))
    spans = _verifier(templates)(some, F.col("s.template"), F.col("s.start"), F.col("s.end"))
    return joined.select(key, F.regexp_count("text", F.lit(_WORD)).cast("long").alias("n_words"), F.coalesce(spans, F.expr(f"cast(array() AS {SPANS})")).alias("spans"))


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def license_summary(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Of scanned rows: counts, first and last word of the base phrases, labels, and the best likeness."""
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        key,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(base["start"]).alias("first_word"),
        F.array_max(base["start"]).alias("last_word"),
        _joined(base["label"]).alias("base_labels"),
        _joined(F.col("spans.label")).alias("labels"),
        F.coalesce(F.array_max("spans.likeness"), F.lit(0.0)).alias("score"),
    )
