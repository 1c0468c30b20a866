"""License scan: phrases, and an exact set-similarity join of text blocks with templates.

A block is `BLOCK_WORDS` consecutive words, or twice as many as the longest template if that is more;
blocks begin every half block, so a notice lies in one of them whole. A block meets a template when it holds at least `THRESHOLD` of the
template's distinct words.

The join: words are ordered by their frequency over all documents, the rarest first. To reach its
threshold, a template of t words with least overlap c must share one of its first t - c + 1 words
with the block (prefix filter); the block must hold c words of all templates' vocabulary at least
(length filter); and where a block and a template meet for the first time, the words left on both
sides must suffice (positional filter). What is left is verified on whole sets.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. Defined results: a null text is the
empty one and has no words; repeated rows give a row each; an empty table gives an empty result;
other columns are not read. Templates and phrases are constants, so their tables are small.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import joined, plain_lower
from tidemark.session import stage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases and the labels they give.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
#: Notices whose words are looked for, with their labels.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at "
                 "http www apache org licenses license 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)
THRESHOLD = 0.9
BLOCK_WORDS = 128


def block_words(templates) -> int:
    return max(BLOCK_WORDS, 2 * max(len(text.split()) for _, text in templates))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(plain_lower(text), F.lit(WORD), F.lit(0))


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _phrase_places(words: Column) -> list[tuple[str, Column, Column, Column]]:
    """Per phrase: label, number of places, first and last place.

    All words are written one space apart; what lies between the phrase's places tells where they are.
    """
    line = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    out = []
    for phrase, label in PHRASES:
        pattern = f"(?<= ){phrase}(?= )"
        between = F.split(line, pattern, -1)
        n = F.when(line.rlike(pattern), F.size(between) - 1).otherwise(0)
        count = lambda part: F.size(F.split(part, " ")) - 2
        first = F.when(n > 0, count(F.element_at(between, 1)))
        last = F.when(n > 0, F.size(words) - count(F.element_at(between, -1)) - len(phrase.split()))
        out.append((label, n, first, last))
    return out


def with_phrases(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(doc_id, text_hash, n_words, n_base, first_word, last_word, base, known), one row per row of `docs`.

    `known` are the words of the vocabulary that the document holds.
    """
    found = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("_words"))
    places = _phrase_places(F.col("_words"))
    return found.select(
        "doc_id", "text_hash", F.size("_words").cast("long").alias("n_words"),
        sum((n for _, n, _, _ in places), F.lit(0)).cast("long").alias("n_base"),
        F.least(*[first for _, _, first, _ in places]).cast("long").alias("first_word"),
        F.greatest(*[last for _, _, _, last in places]).cast("long").alias("last_word"),
        F.array_compact(F.array(*[F.when(n > 0, F.lit(label)) for label, n, _, _ in places])).alias("base"),
        F.array_intersect("_words", _strings(vocabulary)).alias("known"),
    )


def template_matches(docs: DataFrame, frequency: dict[str, int], templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text_hash, start, label, containment): every block that meets a template's threshold.

    `frequency` gives, for each word of the templates, the number of documents that hold it; `start`
    is the first word of the block.
    """
    spark = docs.sparkSession
    sets = [(label, set(text.split())) for label, text in templates]
    order = sorted({w for _, s in sets for w in s}, key=lambda w: (frequency.get(w, 0), w))
    rank = {w: k for k, w in enumerate(order)}
    posts, prefix_words = [], set()
    for k, (label, words) in enumerate(sets):
        ranks = sorted(rank[w] for w in words)
        least = math.ceil(threshold * len(ranks) - 1e-9)
        for i, r in enumerate(ranks[: len(ranks) - least + 1]):
            posts.append((r, k, label, i, least, ranks))
            prefix_words.add(order[r])
    postings = spark.createDataFrame(posts, "rank int, template int, label string, i int, least int, ranks array<int>")
    # only documents with a word of some prefix can have a block that meets a template
    found = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("_words"))
    found = found.filter(F.arrays_overlap("_words", _strings(sorted(prefix_words))))
    half = block_words(templates) // 2
    blocks = found.select("doc_id", "text_hash", "_words", F.explode(F.expr(
        f"sequence(0, greatest(0, {half} * ((size(_words) - 1) div {half} - 1)), {half})"
    )).alias("start"))
    blocks = blocks.select("doc_id", "text_hash", "start", F.array_sort(F.transform(
        F.array_intersect(F.slice("_words", F.col("start") + 1, F.lit(2 * half)), _strings(order)),
        lambda w: F.array_position(_strings(order), w).cast("int") - 1,
    )).alias("held"))
    met = blocks.select("*", F.posexplode("held").alias("j", "rank")).join(F.broadcast(postings), "rank")
    left = F.lit(1) + F.least(F.size("ranks") - 1 - F.col("i"), F.size("held") - 1 - F.col("j"))
    earlier = F.size(F.array_intersect(F.slice("ranks", F.lit(1), F.col("i")), "held"))
    met = met.filter((F.size("held") >= F.col("least")) & (earlier == 0) & (left >= F.col("least")))
    shared = F.size(F.array_intersect("held", "ranks"))
    return met.withColumn("_shared", shared).filter("_shared >= least").select(
        "doc_id", "text_hash", "start", "label", (F.col("_shared") / F.size("ranks")).alias("containment")
    )


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), one row per row of `docs`.

    score is the largest containment of a template in a block of the document, 1 where a phrase stands.
    """
    vocabulary = sorted({w for _, text in templates for w in text.split()})
    seen = stage(with_phrases(docs, vocabulary), "phrases")
    # one row per word of the templates
    counted = seen.select(F.explode("known").alias("word")).groupBy("word").count().collect()
    found = template_matches(docs, {r.word: r["count"] for r in counted}, templates, threshold)
    best = found.groupBy("doc_id", "text_hash").agg(
        F.collect_set("label").alias("_labels"), F.max("containment").alias("_score")
    ).withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    rows = seen.join(best, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")), "left")
    every = F.array_union("base", F.coalesce("_labels", F.expr("cast(array() as array<string>)")))
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        joined(F.array_sort(F.array_distinct("base"))).alias("base_labels"),
        joined(F.array_sort(every)).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_score", F.lit(0.0))).alias("score"),
    )
