"""Token counts by overlap resynchronisation.

A document of more than ``CHUNK`` characters is cut into chunks that overlap, each encoded with offsets in a task of
its own.  Neighbouring chunks are spliced at the first place in their overlap that is a stable boundary (see
``vocabulary``: behind a character that is no white space, before ASCII white space) and where no token of either
encoding lies across.  Tokens before it come from the left chunk, tokens from it on from the right one.  Where an
overlap has no such place it is widened twofold and the two chunks beside it are encoded again, no others; an overlap that
has grown to the next chunk's start swallows the chunk between, so a document without any boundary ends as one chunk.
Boundaries are also the places between a letter and a comma, full stop or the like (see ``PAUSE``), which are all that
Chinese and Japanese texts have.  A text is cut into its chunks once each time, in one pass over it.

Shorter documents are one chunk each.  Their units between stable boundaries are encoded once per task.

Defined cases: null text counts as the empty text (0 bytes, 0 tokens).  Rows are counted one by one; repeated rows
and null ids are kept as they are.  An empty table gives an empty result.  Only the id and the text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brasa.llm.common import store, table
from brasa.llm.vocabulary import LETTER, UNSURE, tokenizer, words

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
CHUNK = 32_768  # characters from one chunk's start to the next
OVERLAP = 512


def _short(texts: DataFrame, tokenizer_file: str) -> DataFrame:
    @F.pandas_udf("long")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = words(tokenizer_file)
        for part in parts:
            yield pd.Series([known.count(t) for t in part], dtype="int64")

    return texts.withColumn("n_tokens", count("text"))


# No pattern runs from a letter into one of these marks, and neither normal form composes a letter with one.
PAUSE = re.compile(",|\\.|" + "|".join(map(chr, (0x3001, 0x3002, 0xFF0C, 0xFF01, 0xFF1F, 0xFF1A, 0xFF1B))))
# Latin letters, kana, ideographs and Korean syllables.
SURE_LETTER = re.compile(f"[{LETTER}" + "".join(f"{chr(a)}-{chr(b)}" for a, b in (
    (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3))) + "]")


def _stable(text: str, place: int) -> bool:
    """Whether what stands before the place can't change the tokens behind it, nor the other way round."""
    if text[place] in " \t\n\v\f\r":
        return text[place - 1] not in " \t\n\v\f\r"
    return bool(PAUSE.match(text[place]) and SURE_LETTER.match(text[place - 1]))


def _cuts(text: str, low: int, high: int, tokenizer_file: str) -> tuple[int, list[tuple[int, int]]]:
    """The number of tokens of a text, and its cuts from ``low`` to ``high``: places and the tokens before them."""
    spans = tokenizer(tokenizer_file).encode(text, add_special_tokens=False).offsets
    at, reach, cuts = 0, 0, []
    for place in range(max(low, 1), min(high, len(text))):
        if not _stable(text, place) or UNSURE.match(text[place - 1]):
            continue
        while at < len(spans) and spans[at][0] < place:
            reach = max(reach, spans[at][1])
            at += 1
        if reach <= place:  # no token lies across
            cuts.append((place, at))
    return len(spans), cuts


def chunk_report(text: str, start: int, left_to: int, right_from: int, right_to: int,
                 tokenizer_file: str) -> tuple[int, list, list]:
    """The chunk's number of tokens, and the places in its left and its right overlap where it may be cut, each with
    the number of the chunk's tokens before it.  Places count from the document's start; the chunk is ``text`` at
    ``start``.  Overlaps are encoded with offsets, what lies between them is counted."""
    _, left = _cuts(text[:left_to - start], 0, left_to - start, tokenizer_file)
    joint = right_from - start
    while joint > 0 and not (joint < len(text) and _stable(text, joint) and not UNSURE.match(text[joint - 1])):
        joint -= 1
    before = words(tokenizer_file).count(text[:joint])
    after, right = _cuts(text[joint:], right_from - start - joint, right_to - start - joint, tokenizer_file)
    return (before + after, [(start + p, n) for p, n in left], [(start + joint + p, before + n) for p, n in right])


BOUNDS = ["start", "left_to", "right_from", "right_to"]


def _bodies(texts: DataFrame, bounds: DataFrame) -> DataFrame:
    """A row (key, *BOUNDS, body) for each chunk of ``bounds``; every text is read once and sliced."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for key, text, chunks in zip(part["key"], part["text"], part["chunks"]):
                for i in range(0, len(chunks), 256):
                    rows = [tuple(c[b] for b in BOUNDS) for c in chunks[i:i + 256]]
                    yield pd.DataFrame([(key, *r, text[r[0]:max(r[1], r[3])]) for r in rows],
                                       columns=["key", *BOUNDS, "body"])

    chunks = bounds.groupBy("key").agg(F.collect_list(F.struct(*BOUNDS)).alias("chunks"))
    return texts.join(chunks, "key").select("key", "text", "chunks").mapInPandas(
        run, "key binary, start long, left_to long, right_from long, right_to long, body string")


def _reports(chunks: DataFrame, tokenizer_file: str) -> DataFrame:
    """chunks: key, start, left_to, right_from, right_to, body."""
    cut = "array<struct<place:long, before:long>>"

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for r in part.itertuples(index=False):
                n, left, right = chunk_report(r.body, r.start, r.left_to, r.right_from, r.right_to, tokenizer_file)
                as_rows = [[{"place": p, "before": b} for p, b in cuts] for cuts in (left, right)]
                rows.append((r.key, r.start, r.left_to, r.right_from, r.right_to, n, *as_rows))
            yield pd.DataFrame(rows, columns=["key", *BOUNDS, "n", "left_cuts", "right_cuts"])

    return chunks.mapInPandas(run, "key binary, start long, left_to long, right_from long, right_to long, n long, "
                                   f"left_cuts {cut}, right_cuts {cut}")


def _chunked(spark: SparkSession, texts: DataFrame, tokenizer_file: str, chunk: int, overlap: int) -> DataFrame:
    """Rows (key, n_tokens) for different long texts (columns key, text)."""
    texts, _ = store(spark, texts, "long-texts")
    # joints: where a chunk starts; overlap: how far the chunk before runs into it
    joints, _ = store(spark, texts.select(
        "key", F.char_length("text").cast("long").alias("size"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.char_length("text").cast("long") - 1,
                             F.lit(chunk).cast("long"))).alias("start"),
        F.lit(overlap).cast("long").alias("overlap")), "joints")
    counted, known = [], None
    while True:
        # each chunk with the joint that follows it; the last one ends with the text
        following = F.expr("lead(struct(start, overlap)) over (partition by key order by start)")
        bounds = joints.select("*", following.alias("next")).select(
            "key", "start",
            F.least("size", F.col("start") + F.when(F.col("start") > 0, F.col("overlap")).otherwise(0)).alias("left_to"),
            F.coalesce("next.start", "size").alias("right_from"),
            F.least("size", F.coalesce(F.col("next.start") + F.col("next.overlap"), "size")).alias("right_to"))
        new = bounds if known is None else bounds.join(known, ["key", *BOUNDS], "left_anti")
        encoded, _ = store(spark, _reports(_bodies(texts, new).repartition("key", "start"), tokenizer_file), "reports")
        known = encoded if known is None else known.unionByName(encoded)
        reports = bounds.join(known, ["key", *BOUNDS])
        # the splice of a joint: the first place that both chunks beside it may be cut at
        left = reports.select("key", F.col("right_from").alias("joint"), "right_cuts")
        right = reports.filter("start > 0").select("key", F.col("start").alias("joint"), "left_cuts")
        both = right.join(left, ["key", "joint"]).withColumn("place", F.array_min(
            F.array_intersect("left_cuts.place", "right_cuts.place")))
        spliced, _ = store(spark, both.select("key", "joint", "place", *[
            F.get(F.filter(c, lambda cut: cut["place"] == F.col("place")), F.lit(0))["before"].alias(c)
            for c in ("left_cuts", "right_cuts")]), "spliced")
        failed, _ = store(spark, spliced.filter("place is null").select("key").distinct(), "failed")
        # a chunk counts what it has before the cut to its right, less what it has before the cut to its left
        total = reports.join(failed, "key", "left_anti").groupBy("key").agg(F.max_by("n", "start").alias("n"))
        inner = spliced.groupBy("key").agg(F.sum(F.col("right_cuts") - F.col("left_cuts")).alias("inner"))
        counted.append(total.join(inner, "key", "left").select(
            "key", (F.col("n") + F.coalesce("inner", F.lit(0))).alias("n_tokens")))
        if failed.isEmpty():
            return reduce(DataFrame.unionByName, counted)
        joints = joints.join(failed, "key", "left_semi")
        wider = joints.join(spliced.filter("place is null").select("key", F.col("joint").alias("start"),
                                                                  F.lit(True).alias("failed")),
                            ["key", "start"], "left")
        wider = wider.withColumn("overlap", F.when(F.col("failed"), F.col("overlap") * 2).otherwise(F.col("overlap")))
        swallowed = F.col("start") + F.col("overlap") > F.expr(
            "coalesce(lead(start) over (partition by key order by start), size)")
        wider = wider.withColumn("swallowed", (F.col("start") > 0) & F.coalesce("failed", F.lit(False)) & swallowed)
        joints, _ = store(spark, wider.filter("not swallowed").select("key", "size", "start", "overlap"), "joints")


def token_counts(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 tokenizer_file: str = TOKENIZER, limit: int = LIMIT, chunk: int = CHUNK,
                 overlap: int = OVERLAP) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    short = _short(texts.filter(F.char_length("text") <= chunk), tokenizer_file)
    long = texts.filter(F.char_length("text") > chunk).withColumn("key", F.unhex(F.sha2("text", 256)))
    long, _ = store(spark, long, "long")
    counted = _chunked(spark, long.select("key", "text").dropDuplicates(["key"]), tokenizer_file, chunk, overlap)
    rows = short.unionByName(long.join(counted, "key").select("doc_id", "text", "n_tokens"))
    return rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "n_tokens",
                       (F.col("n_tokens") > limit).alias("over_limit"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark, table(spark, sf_dir, "documents", "doc_id", "text"))
