"""Licence scan: phrases, and an exact set-similarity join of text blocks with templates.

Blocks are windows of `WINDOW` words that overlap by half, so that a template of
up to half a window that stands in a text stands whole in some block. A block
matches where it holds `CONTAINED` of a template's different words. Template words
are ordered by how many documents hold them, rarest first; a match must hold one of
the first |T| - needed + 1 of them (prefix), have enough words (length), and enough
words left after its first common one (position). Templates are a parameter, held
within `MAX_WORDS` words, and go to the tasks as literals.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempolane.llm.text import free_name, text_of

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # what stands between words, before or after lowering
WINDOW = 64
CONTAINED = 0.8
MAX_WORDS = 100_000

# Phrases and labels of the base rule.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Sentences by which licences are known, with labels.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("mit", "Released under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "You may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("reserved", "All rights reserved"),
)


def words_of(text: Column) -> Column:
    """Words, lowered. Letters beyond A-Z are lowered too, which moves no word and gives
    no phrase: only the Kelvin sign becomes an ASCII letter, and no phrase has a k."""
    return F.array_remove(F.split(F.lower(text), GAPS, -1), "")


def _split(phrase: str) -> list[str]:
    import re

    lowered = "".join(c.lower() if c.isascii() else c for c in phrase)
    return re.findall(WORD, lowered)


def word_counts(docs: DataFrame, text: str, vocabulary: Sequence[str]) -> dict[str, int]:
    """In how many documents each template word is; a row a word comes back."""
    own = F.array_intersect(words_of(text_of(text)), F.array(*map(F.lit, vocabulary)))
    return {r["w"]: r["count"] for r in docs.select(F.explode(own).alias("w")).groupBy("w").count().collect()}


def _stands(words: Column, wanted: Column, n: int):
    return lambda i: F.slice(words, i + 1, n) == wanted


def scan(docs: DataFrame, text: str = "text", phrases=PHRASES, templates=TEMPLATES, contained: float = CONTAINED) -> DataFrame:
    """`docs` without text, with n_words, n_base, first_word, last_word, base_labels,
    labels, score and blocks (array of template, block, containment).

    `score` is 1 where a phrase stands, else the largest containment found, else 0.
    A null text counts as empty: no words, empty label lists, score 0. Texts are
    scanned whole, repeated rows each. Columns of the result's names are replaced,
    other columns kept. An empty table gives an empty result.
    """
    sets = [(label, sorted(set(_split(t)))) for label, t in templates]
    vocabulary = sorted({w for _, s in sets for w in s})
    if len(vocabulary) > MAX_WORDS:
        raise ValueError(f"more than {MAX_WORDS} template words")
    new = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks")
    kept = [c for c in docs.columns if c != text and c.lower() not in new]
    w, line, places, found = (free_name(docs.columns, n) for n in ("scan_words", "scan_line", "scan_places", "scan_found"))
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], words_of(text_of(text)).alias(w))
    words, n = F.col(w), F.size(F.col(w))

    # Base: a cheap look at the joined words before places are sought.
    rows = rows.withColumn(line, F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")))
    stands = []
    for phrase, label in phrases:
        parts = phrase.split()
        wanted = F.array(*map(F.lit, parts))
        starts = F.filter(F.sequence(F.lit(0), n - len(parts)), _stands(words, wanted, len(parts)))
        starts = F.when(F.contains(F.col(line), F.lit(f" {phrase} ")), starts).otherwise(F.array().cast("array<int>"))
        stands.append(F.struct(F.lit(label).alias("label"), starts.alias("starts")))

    counts = word_counts(docs, text, vocabulary) if vocabulary else {}
    order = {x: i for i, x in enumerate(sorted(vocabulary, key=lambda x: (counts.get(x, 0), x)))}
    prepared = []
    for label, members in sets:
        ranked = sorted(members, key=order.__getitem__)
        if ranked:
            prepared.append((label, ranked, math.ceil(contained * len(ranked))))
    # A candidate is one number for (block, template, place of the common word in it).
    width = max((len(r) for _, r, _ in prepared), default=1)
    by_word: dict[str, list[int]] = {}
    for t, (_, ranked, needed) in enumerate(prepared):
        for at, word in enumerate(ranked[: len(ranked) - needed + 1]):
            by_word.setdefault(word, []).append(t * width + at)
    kind = "array<struct<t:int,block:int,contained:double,label:string>>"
    if by_word:
        span, half = len(prepared) * width, WINDOW // 2
        index = F.create_map(*[x for k, v in by_word.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
        ranks = F.create_map(*[x for k, v in order.items() for x in (F.lit(k), F.lit(v))])
        keys = F.array(*map(F.lit, by_word))
        members = F.array(*[F.array(*map(F.lit, r)) for _, r, _ in prepared])
        needs, labels = F.array(*[F.lit(x) for _, _, x in prepared]), F.array(*[F.lit(x) for x, _, _ in prepared])
        hits = F.filter(F.transform(words, lambda x, i: F.struct(x.alias("w"), i.alias("i"))), lambda h: F.array_contains(keys, h["w"]))
        near = lambda i: F.array_distinct(F.array(F.greatest(F.floor(i / half) - 1, F.lit(0)), F.floor(i / half)))
        codes = F.flatten(F.flatten(F.transform(hits, lambda h: F.transform(
            F.element_at(index, h["w"]), lambda c: F.transform(near(h["i"]), lambda b: b * span + c)))))

        def verified(code: Column) -> Column:
            t, at, number = F.floor(code % span / width).cast("int"), (code % width).cast("int"), F.floor(code / span).cast("int")
            own, needed = F.get(members, t), F.get(needs, t)

            def share(block: Column) -> Column:
                rank = F.element_at(ranks, F.get(own, at))
                later = F.filter(block, lambda x: F.coalesce(F.element_at(ranks, x), F.lit(-1)) >= rank)
                common = F.size(F.array_intersect(own, block))
                enough = F.when(F.size(block) < needed, False).when(F.size(later) < needed - at, False).otherwise(common >= needed)
                return F.when(enough, common / F.size(own)).otherwise(F.lit(0.0))

            # A list of one names the block, so that it is cut once.
            held = F.array(F.array_distinct(F.slice(words, number * half + 1, WINDOW)))
            return F.struct(t.alias("t"), number.alias("block"), F.get(F.transform(held, share), F.lit(0)).alias("contained"), F.get(labels, t).alias("label"))

        blocks = F.array_distinct(F.filter(F.transform(F.array_distinct(codes), verified), lambda x: x["contained"] > 0))
        blocks = F.when(F.arrays_overlap(words, keys), blocks).otherwise(F.array().cast(kind)).cast(kind)
    else:
        blocks = F.array().cast(kind)
    rows = rows.select(*[F.col(f"`{c}`") for c in kept], n.cast("long").alias("n_words"), F.array(*stands).cast("array<struct<label:string,starts:array<int>>>").alias(places), blocks.alias(found))
    all_starts = F.flatten(F.transform(places, lambda p: p["starts"]))
    own = F.transform(F.filter(places, lambda p: F.size(p["starts"]) > 0), lambda p: p["label"])
    both = F.array_union(own, F.transform(found, lambda b: b["label"]))
    return rows.select(
        *[F.col(f"`{c}`") for c in kept],
        "n_words",
        F.size(all_starts).cast("long").alias("n_base"),
        F.array_min(all_starts).cast("long").alias("first_word"),
        F.array_max(all_starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(own)), ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"),
        F.when(F.size(own) > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform(found, lambda b: b["contained"])), F.lit(0.0))).alias("score"),
        F.transform(found, lambda b: F.struct(b["t"].alias("template"), b["block"].alias("block"), b["contained"].alias("contained"))).alias("blocks"),
    )
