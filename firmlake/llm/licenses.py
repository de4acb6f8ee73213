"""License scan as an exact set-similarity join of text blocks with license templates.

A block is a run of ``2 * span`` words that starts at a multiple of ``span``; a template's span is the least power of two that holds
its words, so every passage of a template's length lies whole in some block. A block meets a template when it holds ``percent`` of
the template's distinct words (the tokens) or more.

Tokens are ordered by how often the corpus holds them, rare ones first; blocks keep the tokens of the templates of their span only,
as others are in no intersection. With ``needed`` shared tokens, the first shared one lies in the first ``size - needed + 1`` tokens of
both sides (prefix filter), each side has ``needed`` tokens (length filter), and ``needed - 1`` more follow it on both sides (positional
filter). Prefix tokens are joined by equality, what passes the filters is intersected: no block that meets a template is missed.

Only DataFrame and SQL functions are used; texts are neither shuffled nor stored.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlake.session import write_and_read

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # words are what stands between; extracting all matches copies the text for each
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PERCENT = 90  # at 80, "released under the apache license" would meet the five words of the MIT notice
MOST_TOKENS = 50_000  # of all templates together: they go into the plan

#: fixed values: phrases that name a license by themselves
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))

#: fixed values: notices and headers of common licenses
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "You may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)


def _pieces(text: Column) -> Column:
    """What stands between separators, A-Z lower-cased; empty at an end where the text begins or ends with one."""
    return F.split(F.translate(text, UPPER, LOWER), BETWEEN)


def words_in(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; none for null."""
    return F.coalesce(F.filter(_pieces(text), lambda w: w != ""), F.array().cast("array<string>"))


class Template:
    def __init__(self, number: int, label: str, words: list[str], percent: int):
        self.number, self.label, self.tokens = number, label, set(words)
        self.size = len(self.tokens)
        self.needed = -(-self.size * percent // 100)
        self.span = 1 << (len(words) - 1).bit_length()


def read_templates(spark: SparkSession, templates: Iterable[tuple[str, str]], percent: int) -> list[Template]:
    """Templates with their words, cut by the same expression as the texts. Those without words meet nothing."""
    if not 0 < percent <= 100:
        raise ValueError("percent lies above 0 and up to 100")
    listed = list(enumerate(templates))
    cut = spark.range(1).select(*[words_in(F.lit(text)).alias(f"t{number}") for number, (_, text) in listed]).first()
    out = [Template(number, label, words, percent) for (number, (label, _)), words in zip(listed, cut, strict=True) if words]
    if sum(t.size for t in out) > MOST_TOKENS:
        raise ValueError(f"templates with more than {MOST_TOKENS} tokens: scan in several calls")
    return out


def token_order(docs: DataFrame, tokens: list[str]) -> dict[str, int]:
    """Place of each token by its occurrences in all texts of ``docs``, the rarest first, from 1."""
    held = docs.select(F.explode(F.filter(_pieces(F.col("text")), lambda w: w.isin(tokens))).alias("token"))
    counts = {r["token"]: r["n"] for r in held.groupBy("token").agg(F.count("*").alias("n")).collect()}  # a row per token of the templates
    return {token: place for place, token in enumerate(sorted(tokens, key=lambda t: (counts.get(t, 0), t)), 1)}


def _blocks(words: str, span: int, templates: list[Template], order: dict[str, int]) -> Column:
    """Blocks of one span that hold a prefix token and as many tokens as the least demanding template needs."""
    ordered = sorted(set().union(*(t.tokens for t in templates)), key=order.__getitem__)
    prefix = sorted(set().union(*(sorted(t.tokens, key=order.__getitem__)[: t.size - t.needed + 1] for t in templates)))
    least = min(t.needed for t in templates)
    places = F.array(*[F.lit(order[t]) for t in ordered])
    listed = F.array(*[F.lit(t) for t in ordered])

    def block(k: Column) -> Column:
        inside = F.slice(words, k * span + 1, 2 * span)
        held = F.filter(inside, lambda w: w.isin(ordered))
        tokens = F.array_sort(F.array_distinct(F.transform(held, lambda w: F.element_at(places, F.array_position(listed, w).cast("int")))))
        # a block without a prefix token needs no more work
        tokens = F.when(F.exists(inside, lambda w: w.isin(prefix)), tokens).otherwise(F.array().cast("array<int>"))
        return F.struct(F.lit(span).alias("span"), (k * span).alias("start"), tokens.alias("tokens"), F.lit(least).alias("least"))

    numbers = F.sequence(F.lit(0), F.floor((F.size(words) - 1) / span).cast("int"))
    found = F.filter(F.transform(numbers, block), lambda b: F.size(b["tokens"]) >= least)
    return F.when(F.exists(words, lambda w: w.isin(prefix)), found)


def _index(spark: SparkSession, templates: list[Template], order: dict[str, int]) -> DataFrame:
    """A row for each prefix token of each template, as an inline table."""
    rows = []
    for t in templates:
        places = sorted(order[x] for x in t.tokens)
        listed = ", ".join(map(str, places))
        for at, place in enumerate(places[: t.size - t.needed + 1]):
            rows.append(f"({t.span}, {place}, {at}, {t.number}, {t.size}, {t.needed}, array({listed}))")
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(t_span, t_place, t_at, template, size, needed, t_tokens)")


BLOCKS = "array<struct<span:int,start:int,tokens:array<int>,least:int>>"


class Scan:
    """The templates in the token order of ``docs``, and each row's words and blocks, stored without the text."""

    def __init__(self, docs: DataFrame, templates: Iterable[tuple[str, str]], percent: int):
        spark = docs.sparkSession
        self.labels = [label for label, _ in templates]
        read = read_templates(spark, templates, percent)
        self.order = token_order(docs, sorted(set().union(*(t.tokens for t in read)))) if read else {}
        cut = docs.select("doc_id", words_in(F.col("text")).alias("words"))
        spans = sorted({t.span for t in read})
        by_span = [F.coalesce(_blocks("words", n, [t for t in read if t.span == n], self.order), F.array().cast(BLOCKS)) for n in spans]
        blocks = F.flatten(F.array(*by_span)) if by_span else F.array().cast(BLOCKS)
        places = [phrase_places("words", phrase).alias(f"at_{label}") for label, phrase in PHRASES]
        rows = cut.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").alias("n_words"), blocks.alias("blocks"), *places)
        self.rows = write_and_read(rows, "license-blocks")
        self.index = _index(spark, read, self.order) if read else None

    def blocks(self) -> DataFrame:
        blocks = self.rows.select("row", "doc_id", "n_words", F.explode("blocks").alias("b")).select("row", "doc_id", "n_words", "b.*")
        if self.index is None:
            return blocks.limit(0).selectExpr("row", "doc_id", "'' label", "0 template", "start", "span length", "0 shared", "0D containment")
        n = F.size("tokens")
        prefixes = blocks.select("*", F.posexplode(F.slice("tokens", F.lit(1), n - F.col("least") + 1)).alias("at", "place"))
        met = prefixes.join(self.index, (F.col("span") == F.col("t_span")) & (F.col("place") == F.col("t_place")))
        met = met.where((n >= F.col("needed")) & (F.col("at") <= n - F.col("needed")))
        met = met.where(1 + F.least(F.col("size") - F.col("t_at") - 1, n - F.col("at") - 1) >= F.col("needed"))
        found = met.withColumn("common", F.array_intersect("tokens", "t_tokens"))
        found = found.where((F.size("common") >= F.col("needed")) & (F.array_min("common") == F.col("place")))  # each pair once
        return found.select(
            "row", "doc_id", F.get(F.array(*map(F.lit, self.labels)), F.col("template")).alias("label"), "template", "start",
            F.least(2 * F.col("span"), F.col("n_words") - F.col("start")).alias("length"),
            F.size("common").alias("shared"), (F.size("common") / F.col("size")).alias("containment"),
        )


def license_blocks(docs: DataFrame, templates: Iterable[tuple[str, str]] = TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """(doc_id, label, template, start, length, shared, containment): each block of ``docs`` (doc_id, text) that meets a template.

    start is the block's first word from 0, length its number of words, shared the template's words that it holds. Where two
    blocks hold a passage, both are rows. Null and empty texts have no blocks; repeated rows give repeated blocks, null doc_ids
    stay null. Other columns are ignored; an empty table or no templates give an empty result.
    """
    return Scan(docs, list(templates), percent).blocks().drop("row")


def phrase_places(words: str, phrase: str) -> Column:
    """Places, from 0, where the words of ``phrase`` stand consecutively in the array column ``words``."""
    first, *rest = phrase.split(" ")

    def place(word: Column, at: Column) -> Column:
        whole = word == first
        for k, other in enumerate(rest, 1):
            whole = whole & F.coalesce(F.get(words, at + k) == other, F.lit(False))
        return F.when(whole, at)

    found = F.filter(F.transform(words, place), lambda at: at.isNotNull())
    return F.when(F.array_contains(words, first), found).otherwise(F.array().cast("array<int>"))


def scan(docs: DataFrame, templates: Iterable[tuple[str, str]] = TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): n_words, n_base, first_word, last_word, base_labels, labels, score.

    Base places are those of ``PHRASES``; labels adds the labels of the blocks found to theirs. score is the highest
    containment of a template in one of the text's blocks, 1 where a phrase stands in it, else 0. Null, empty and blank texts
    have 0 words, no places and empty labels. Rows without doc_id and repeated rows are scanned like others. Other columns are ignored.
    """
    scanned = Scan(docs, list(templates), percent)
    found = scanned.blocks().groupBy("row").agg(F.collect_set("label").alias("met"), F.max("containment").alias("containment"))
    joined = scanned.rows.drop("blocks").withColumn("n_words", F.col("n_words").cast("long")).join(found, "row", "left")
    places = F.concat(*[f"at_{label}" for label, _ in PHRASES])
    base = F.filter(F.array(*[F.when(F.size(f"at_{label}") > 0, label) for label, _ in PHRASES]), lambda x: x.isNotNull())
    met = F.coalesce("met", F.array().cast("array<string>"))
    return joined.withColumn("places", places).withColumn("base", base).select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", met)), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )
