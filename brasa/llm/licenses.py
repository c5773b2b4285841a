"""License scans by an exact set-similarity join, with DataFrame functions only.

A text is cut into overlapping blocks of consecutive words, across its lines: for templates of up to L words (L a power of
two, 8 at least) blocks of 2L words, a new one every L words, so that any L consecutive words lie whole in one block.  Block
and template are sets of words.  A block matches a template T if it holds at least ceil(threshold * |T|) of T's words.
Tokens get one global order, rarest in the corpus first.  In that order

* prefix filter: a matching block holds one of the first |T| - need + 1 words of T; only these are joined on;
* length filter: a block with fewer than ``need`` words of the templates' vocabulary can't match;
* positional filter: with the joined word at place i of T and place j of the block's vocabulary words, no more than
  min(i, j) + min(|T| - i, |block| - j) words can be shared.

What is left is verified exactly.  Word counts of the corpus are pre-aggregated and only those of the templates' words
(some dozens) reach the driver; the join's other side is the templates' prefixes, bounded by the templates' length.

Beside the templates there are phrases, found wherever their words stand consecutively, across lines too.

Defined cases: null text is the empty text (0 words, no labels, score 0).  Each row is scanned on its own; rows that
repeat id and text get the same result, null ids are kept.  An empty table gives an empty result.  Only the id and the
text are read.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brasa.llm.common import store, table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ITS_CHARACTERS = r"[0-9a-z\x80-\x{10FFFF}]++"  # the same in lower-case text, quicker to match
THRESHOLD = 0.8

# Phrases and their labels
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Usual sentences of licenses, and labels of their own
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "licensed under the Creative Commons Attribution-ShareAlike License"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("warranty", "the software is provided as is, without warranty of any kind, express or implied"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an AS IS BASIS"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
            "following disclaimer"),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
            "following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
            "products derived from this software without specific prior written permission"),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software"),
    ("mpl-2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
)
LEAST_SPAN = 8


def lowered(text: Column) -> Column:
    """A-Z in lower case.  The one other character that lower() would turn into a letter of a-z alone, the Kelvin
    sign, is another non-ASCII character first; what lower() does to all the others stays outside ASCII words."""
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(chr(0x212A)), F.lit(chr(0xD8))))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({ITS_CHARACTERS})"), F.lit(1))


def template_words(body: str) -> list[str]:
    import re

    return sorted(set(re.findall(WORD, body.lower())))


def need(size: int, threshold: float) -> int:
    return max(1, ceil(round(threshold * size, 9)))


def span(body: str) -> int:
    """The length of consecutive words that lie whole in one block: the least power of two the template fits in."""
    import re

    return max(LEAST_SPAN, 1 << (len(re.findall(WORD, body.lower())) - 1).bit_length())


def by_span(templates) -> dict[int, list[tuple[str, list[str]]]]:
    """(label, words) of the templates of each span."""
    out: dict[int, list[tuple[str, list[str]]]] = {}
    for label, body in templates:
        out.setdefault(span(body), []).append((label, template_words(body)))
    return out


def blocks(templates=TEMPLATES, threshold: float = THRESHOLD) -> Column:
    """Of ``words``, an array: (span, the templates' words in a block) for each block that can match."""
    vocabulary = sorted({w for _, body in templates for w in template_words(body)})
    of_words = F.transform("words", lambda w: F.when(w.isin(vocabulary), w))  # the other words are null

    def of_span(marked: Column, width: int, least: int) -> Column:
        starts = F.when(F.size(marked) > 0, F.sequence(F.lit(1), F.size(marked), F.lit(width))).otherwise(
            F.array().cast("array<int>"))
        held = F.transform(starts, lambda start: F.filter(
            F.slice(marked, start, F.lit(2 * width)), lambda w: w.isNotNull()))
        held = F.transform(F.filter(held, lambda h: F.size(h) >= least), F.array_distinct)
        return F.transform(F.filter(held, lambda h: F.size(h) >= least), lambda h: F.struct(
            F.lit(width).alias("span"), h.alias("held")))

    spans = [(width, min(need(len(own), threshold) for _, own in some)) for width, some in sorted(by_span(templates).items())]
    # the prefix filter for whole texts, with the longest words first: a text without one of these words has no match
    first = set()
    for _, body in templates:
        own = sorted(template_words(body), key=lambda w: (-len(w), w))
        first.update(own[:len(own) - need(len(own), threshold) + 1])
    # bound to a variable, so that a text's words are looked up once and not for each block
    found = F.transform(F.array(of_words), lambda marked: F.concat(*[of_span(marked, *s) for s in spans]))[0]
    return F.when(F.arrays_overlap("words", F.array(*[F.lit(w) for w in sorted(first)])), found).otherwise(
        F.array().cast("array<struct<span:int,held:array<string>>>"))


def similarity_join(spark: SparkSession, cut: DataFrame, templates=TEMPLATES,
                    threshold: float = THRESHOLD) -> DataFrame:
    """Rows (doc_id, text_key, label, containment) for every block (doc_id, text_key, span, held) and template that meet
    the threshold."""
    kinds = [(label, own, width) for width, some in by_span(templates).items() for label, own in some]
    vocabulary = sorted(set().union(*[own for _, own, _ in kinds]))
    counts = {r["word"]: r["n"] for r in cut.select(F.explode("held").alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).collect()}  # a row for each word of the templates at most
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    prefixes = []
    for label, own, width in kinds:
        ranked, least = sorted(own, key=order.__getitem__), need(len(own), threshold)
        literal = "array(" + ", ".join(f"'{w}'" for w in ranked) + ")"
        prefixes += [f"('{word}', {width}, '{label}', {place}, {least}, {literal})"
                     for place, word in enumerate(ranked[:len(ranked) - least + 1])]
    index = spark.sql("select * from values " + ", ".join(prefixes)
                      + " as t(word, span, label, place, least, template)")
    rank = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    in_order = F.transform(F.array_sort(F.transform("held", lambda w: F.struct(rank[w].alias("at"), w.alias("word")))),
                           lambda s: s["word"])
    at = cut.withColumn("held", in_order).select(
        "doc_id", "text_key", "span", "held", F.posexplode("held").alias("position", "word"))
    size, own = F.size("held"), F.size("template")
    candidates = at.join(F.broadcast(index), ["span", "word"]).filter(
        (size >= F.col("least")) & (F.least("place", "position") + F.least(
            own - F.col("place"), size - F.col("position")) >= F.col("least")))
    shared = F.size(F.array_intersect("held", "template"))
    return candidates.filter(shared >= F.col("least")).select(
        "doc_id", "text_key", "label", (shared / own).alias("containment"))


def phrase_places(phrase: str) -> Column:
    """Starts, in words, of a phrase in the array ``words``; ``joined`` holds them between single spaces."""
    parts = phrase.split()

    def here(i: Column) -> Column:
        same = F.lit(True)
        for k, part in enumerate(parts):
            same = same & (F.get("words", i + k) == part)
        return same

    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), here)
    return F.when(F.contains("joined", F.lit(f" {phrase} ")), places).otherwise(F.array().cast("array<int>"))


def scan(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=TEMPLATES,
         threshold: float = THRESHOLD, phrases: dict[str, str] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    score is 1 where a phrase stands, else the largest containment of a matching block, else 0.
    """
    phrases = PHRASES if phrases is None else phrases
    spread = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_key"),
                         words(lowered(F.col(text))).alias("words")).withColumn(
        "joined", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    names = list(phrases)
    base = spread.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"),
                         blocks(templates, threshold).alias("blocks"),
                         *[phrase_places(p).alias(f"places_{i}") for i, p in enumerate(names)])
    every = F.concat(*[F.col(f"places_{i}") for i in range(len(names))])
    labels = F.array_compact(F.array(*[F.when(F.size(f"places_{i}") > 0, phrases[p]) for i, p in enumerate(names)]))
    # each text is read and split once; what the join and the result need of it is stored
    base, _ = store(spark, base.select(
        "doc_id", "text_key", "n_words", F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        labels.alias("base"), "blocks"), "scanned")
    cut = base.select("doc_id", "text_key", F.explode("blocks").alias("block")).select("doc_id", "text_key", "block.*")
    found = similarity_join(spark, cut, templates, threshold)
    found = found.groupBy("doc_id", "text_key").agg(F.collect_set("label").alias("own"),
                                                    F.max("containment").alias("containment")).select(
        F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_text"), "own", "containment")
    rows = base.join(found, base["doc_id"].eqNullSafe(found["of_id"]) & (base["text_key"] == found["of_text"]), "left")
    none = F.array().cast("array<string>")
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("own", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, table(spark, sf_dir, "documents", "doc_id", "text"))


def oracle(templates=TEMPLATES, threshold: float = THRESHOLD, phrases: dict[str, str] | None = None) -> str:
    """Every block against every template, without filters."""
    phrases = PHRASES if phrases is None else phrases
    kinds = ", ".join(f"('{label}', {span(body)}, {need(len(template_words(body)), threshold)}, ["
                      + ", ".join(f"'{w}'" for w in template_words(body)) + "])" for label, body in templates)
    places = " UNION ALL ".join(
        f"SELECT doc_id, i, '{label}' AS label FROM spread, range(len(words)) r(i) WHERE "
        + " AND ".join(f"words[i + {k + 1}] = '{w}'" for k, w in enumerate(phrase.split()))
        for phrase, label in phrases.items())
    return f"""
WITH low AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
    FROM documents
), spread AS (
    SELECT doc_id, regexp_extract_all(body, '{WORD}') AS words FROM low
), places AS ({places}
), base AS (
    SELECT doc_id, count(*) AS n, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS found
    FROM places GROUP BY doc_id
), templates(label, span, least, own) AS (VALUES {kinds}
), blocks AS (
    SELECT doc_id, span, words[i + 1:i + 2 * span] AS held
    FROM spread, (SELECT DISTINCT span FROM templates), range(0, len(words), span) r(i)
), matched AS (
    SELECT doc_id, list(DISTINCT label) AS found, max(len(list_intersect(own, held)) / len(own)) AS containment
    FROM blocks JOIN templates USING (span) WHERE len(list_intersect(own, held)) >= least GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base.found), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.found, []), coalesce(matched.found, [])))), ','), '')
           AS labels,
       CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(containment, 0)::DOUBLE END AS score
FROM spread LEFT JOIN base USING (doc_id) LEFT JOIN matched USING (doc_id)
"""


ORACLE = oracle()
