"""License texts by an exact set-similarity join: blocks of words that hold enough of a template's words."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from math import ceil
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Public license notices and their labels.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2.0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("cc-by-nc", "licensed under cc by-nc"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-sa", "licensed under cc by-sa"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("reserved", "no part of this publication may be reproduced without prior written permission all rights reserved"),
)

BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The only characters beyond ASCII whose small form is an ASCII letter (Kelvin sign, capital I with a dot).
SPECIAL = ("K", "İ")
LEAST_CLASS = 8
MOST_TOKENS = 5_000


def words_of(text: Column) -> Column:
    """Words in lower case. Letters beyond ASCII become small too, which changes neither the number nor the places of
    words, nor what equals an ASCII word; null is empty."""
    safe = F.coalesce(text, F.lit(""))
    for c in SPECIAL:
        safe = F.replace(safe, F.lit(c), F.lit("ÿ"))
    return F.array_remove(F.split(F.lower(safe), BETWEEN), "")


def plain_words(text: str) -> list[str]:
    return [w for w in re.split(BETWEEN, text.lower()) if w]


def starts_of(words: Column, phrase: str) -> Column:
    """Places, from 0, where the phrase's words stand one after the other."""
    parts = phrase.split()
    places = F.sequence(F.lit(0), F.size(words) - len(parts))
    here = F.filter(places, lambda i: reduce(and_, [F.get(words, i + k) == w for k, w in enumerate(parts)]))
    return F.when((F.size(words) >= len(parts)) & F.array_contains(words, parts[-1]), here).otherwise(F.array().cast("array<int>"))


class Template:
    """Distinct words of a notice, how many of them a block must hold, and the class of blocks it is looked for in."""

    def __init__(self, label: str, text: str, threshold: float):
        words = plain_words(text)
        if not words:
            raise ValueError("a template needs words")
        self.label, self.tokens = label, sorted(set(words))
        self.needed = max(1, ceil(threshold * len(self.tokens) - 1e-9))
        self.step = LEAST_CLASS
        while self.step < len(words):
            self.step *= 2

    def order(self, rank: dict[str, int]) -> None:
        self.tokens.sort(key=rank.__getitem__)

    @property
    def prefix(self) -> list[str]:
        """Of these words, the rarest, each block that matches holds one."""
        return self.tokens[: len(self.tokens) - self.needed + 1]


def token_ranks(docs: DataFrame, tokens: list[str]) -> dict[str, int]:
    """Templates' words from the rarest on, by the number of documents of the whole table that hold them (equal numbers in
    order of the words)."""
    held = docs.select(F.explode(F.array_intersect(F.lit(tokens), "words")).alias("token"))
    counts = {r["token"]: r["count"] for r in held.groupBy("token").count().collect()}  # one row per word of the templates
    return {t: i for i, t in enumerate(sorted(tokens, key=lambda t: (counts.get(t, 0), t)))}


def blocks_of(words: Column, templates: list[Template], rank: dict[str, int]) -> Column:
    """Blocks that may match: structs of ``step`` and ``tokens``, the block's distinct template words from the rarest on.

    Blocks of a class are windows of ``2 * step`` words, ``step`` apart, so that every run of ``step`` words lies whole in
    one. Only blocks with a prefix word of their class and enough template words (length filter) are handed on.
    """
    return F.concat(*[_blocks(words, [t for t in templates if t.step == step], step, rank) for step in sorted({t.step for t in templates})])


def _blocks(words: Column, templates: list[Template], step: int, rank: dict[str, int]) -> Column:
    known = F.lit(sorted({w for t in templates for w in t.tokens}, key=rank.__getitem__))
    prefixes = F.lit(sorted({w for t in templates for w in t.prefix}))
    fewest = min(t.needed for t in templates)
    numbers = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(words) / step).cast("int") - 2, F.lit(0)))
    windows = F.filter(F.transform(numbers, lambda i: F.slice(words, i * step + 1, F.lit(2 * step))), lambda w: F.arrays_overlap(w, prefixes))
    held = F.transform(windows, lambda w: F.struct(F.lit(step).alias("step"), F.array_intersect(known, w).alias("tokens")))
    none = F.array().cast("array<struct<step:int,tokens:array<string>>>")
    return F.when(F.arrays_overlap(words, prefixes), F.filter(held, lambda b: F.size(b["tokens"]) >= fewest)).otherwise(none)


def index_of(docs: DataFrame, templates: list[Template]) -> DataFrame:
    """Prefix words of the templates: ``step``, ``token``, ``place`` (from 0), ``needed``, ``label``, ``all``."""
    rows = [(t.step, w, i, t.needed, t.label, t.tokens) for t in templates for i, w in enumerate(t.prefix)]
    return docs.sparkSession.createDataFrame(rows, "step int, token string, place int, needed int, label string, all array<string>")


def similar_blocks(blocks: DataFrame, index: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Blocks (``keys``, ``step``, ``tokens``; null where a row has none) with every template they hold enough of: ``keys``,
    ``label``, ``containment``. Rows without a match stay, with nulls.

    Prefix filter: the join is on a template's prefix words. Length and positional filter: the words from the meeting place
    on must be enough on both sides. Verification: the common words are counted; a pair is kept where it meets first.
    """
    size = F.size("tokens")
    fewest = blocks.select(*keys, "step", "tokens", F.posexplode_outer("tokens").alias("at", "token"))
    near = (F.col("b.step") == F.col("t.step")) & (F.col("b.token") == F.col("t.token"))
    filters = (F.size("b.tokens") >= F.col("t.needed")) & (F.least(F.size("t.all") - F.col("t.place"), F.size("b.tokens") - F.col("b.at")) >= F.col("t.needed"))
    met = fewest.alias("b").join(index.alias("t"), near & filters, "left").drop(F.col("t.step"), F.col("t.token"))
    common = F.array_intersect(F.col("all"), F.col("tokens"))
    full = (F.size(common) >= F.col("needed")) & (F.get(common, F.lit(0)) == F.col("token"))
    return met.select(*keys, F.when(full, F.col("label")).alias("label"), F.when(full, F.size(common) / F.size("all")).alias("containment"))


def scan(docs: DataFrame, threshold: float = 0.85, phrases: Sequence[tuple[str, str]] = PHRASES, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """License labels of every document (``doc_id``, ``text``): ``doc_id``, ``n_words``, ``n_base``, ``first_word``,
    ``last_word``, ``base_labels``, ``labels``, ``score``.

    Base labels come from the places of fixed phrases. The join adds the label of each template of whose distinct words
    some block holds at least ``threshold``; ``score`` is the largest such share, 0 without one. Words of templates are
    ordered by their frequency in all documents; ``templates`` is a parameter of at most 5,000 distinct words.

    Null texts are empty, null ids stay, repeated rows are rows of their own, other columns don't matter; an empty table
    gives no rows. ``docs`` should be a table as read or written, so that a task that is run again numbers its rows alike.
    """
    known = [Template(label, text, threshold) for label, text in templates]
    tokens = sorted({w for t in known for w in t.tokens})
    if len(tokens) > MOST_TOKENS:
        raise ValueError(f"templates hold {len(tokens)} distinct words, over {MOST_TOKENS}")
    split = docs.select(F.col("doc_id"), words_of(F.col("text").cast("string")).alias("words"))
    rank = token_ranks(split, tokens) if tokens else {}
    for t in known:
        t.order(rank)

    starts = F.concat(*[starts_of(F.col("words"), phrase) for phrase, _ in phrases])
    own = F.array_compact(F.array(*[F.when(F.size(starts_of(F.col("words"), phrase)) > 0, F.lit(label)) for phrase, label in phrases]))
    telling = F.arrays_overlap("words", F.lit(sorted({p.split()[-1] for p, _ in phrases})))
    none = F.array().cast("array<int>")
    rows = split.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "words",
        F.when(telling, starts).otherwise(none).alias("starts"),
        F.when(telling, own).otherwise(F.array().cast("array<string>")).alias("own"),
    )
    wide = rows.select(
        "row", "doc_id", F.size("words").cast("long").alias("n_words"), F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.array_sort(F.array_distinct("own")).alias("own"), F.explode_outer(blocks_of(F.col("words"), known, rank)).alias("block"),
    )
    keys = ["row", "doc_id", "n_words", "n_base", "first_word", "last_word", "own"]
    index = F.broadcast(index_of(docs, known))  # at most MOST_TOKENS words a template list
    matched = similar_blocks(wide.select(*keys, "block.step", "block.tokens"), index, keys)
    found = matched.groupBy(*keys).agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("own", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("own", "more")), ",").alias("labels"), F.coalesce("best", F.lit(0.0)).alias("score"),
    )
