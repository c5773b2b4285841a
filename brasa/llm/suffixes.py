"""Removal of repeated byte strings by a distributed, enhanced suffix array and its tree of common-prefix intervals.

A string of ``LENGTH`` bytes counts as repeated if it starts at more than one place, in other texts or its own.  The suffix
array is sparse: only suffixes that start at anchors are sorted.  A window's anchor is the place of the least hash among
its strings of ``KEY`` bytes (the first of equals), so it depends on the window's bytes alone: equal windows have their
anchors at the same place, and it is enough to compare the surroundings of anchors with equal keys, ``LEFT`` bytes
before an anchor and ``LENGTH`` bytes from it on, which hold every window that has this anchor.

1.  Texts that are equal byte for byte become one; what is long enough in a text with copies is repeated throughout.
2.  Keys that occur once are dropped, by a count of keys reduced before the shuffle.
3.  Anchors with equal surroundings (two hashes, 128 bits together) become one; surroundings that occur twice are
    repeated throughout, and bytes are fetched, once each, only for keys with surroundings that occur once.
4.  Spark sorts the suffixes within their key.  Neighbours' common prefixes are measured, and a stack scan over them
    yields the common-prefix intervals, deeper ones first.  The suffixes of an interval share its depth to the right.  To
    the left they are told apart by their preceding bytes: suffixes of the interval that share l bytes to the left are
    the occurrences of a repeat of l + depth bytes that is maximal.  Every suffix of the interval takes part, not only
    the two that are neighbours in the array.  Repeats of ``LENGTH`` bytes and more are output with all occurrences.
5.  Each text takes the union of its repeats.

A key with more than ``SUFFIXES`` different surroundings is cut into chunks that meet pairwise, so that no task holds
more than two of them; the union of the pairs' repeats covers the same bytes.  Counting a key's surroundings is reduced
before the shuffle, and a key with many of them is dealt by their hashes when the count goes back to them.

Defined cases: null text is the empty text.  Texts shorter than ``LENGTH`` lose nothing.  Repeated rows are copies of each
other, whatever their ids; null ids are kept.  Overlapping occurrences count.  Texts of any length are read in pieces.
An empty table gives an empty result.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brasa.llm.common import drop_stored, fresh, store, table
from brasa.session import new_table_path

LENGTH = 200
KEY = 64
SUFFIXES = 30_000
SHARES = 4096  # a key with more than one share of all surroundings is dealt to several places
PIECE = 1 << 18  # bytes that a task hashes at a time
PLACE_BITS = 24


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random numbers for bytes, powers of an odd base modulo 2**64, and those of its inverse."""
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    up, down = np.full(n, base, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return (np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            np.multiply.accumulate(up), np.multiply.accumulate(down))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def anchors(data: np.ndarray, length: int = LENGTH, key: int = KEY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of a text's anchors, the hashes of their keys and of their surroundings."""
    found, left, n = [], length - key, len(data)
    last = -1
    for begin in range(0, n - length + 1, PIECE):
        # windows that start in [begin, begin + PIECE), with the surroundings of their anchors
        low, high = max(0, begin - left), min(n, begin + PIECE + 2 * length)
        piece = data[low:high]
        numbers, up, down = _powers(PIECE + 4 * length)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(numbers[piece] * down[:len(piece)], out=sums[1:])
        hashes = _mixed((sums[key:] - sums[:-key]) * up[:len(piece) - key + 1])
        start = begin - low
        windows = min(begin + PIECE, n - length + 1) - begin
        span = hashes[start:start + windows + left]
        least = (span & ~np.uint64((1 << PLACE_BITS) - 1)) | np.arange(len(span), dtype=np.uint64)
        width = 1
        while 2 * width <= left + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < left + 1:
            least = np.minimum(least[:len(least) - (left + 1 - width)], least[left + 1 - width:])
        at = np.unique((least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)) + start
        at = at[at + low > last]
        if not len(at):
            continue
        last = int(at[-1]) + low
        a, b = np.maximum(at - left, -low), np.minimum(at + length, n - low)
        around = (sums[b] - sums[np.maximum(a, 0)]) * up[np.maximum(a, 0)]
        around = _mixed(around + (at - a).astype(np.uint64) * np.uint64(0x8EBC6AF09C88C6E3)
                        + (b - at).astype(np.uint64) * np.uint64(0x589965CC75374CC3))
        found.append((at + low, hashes[at], around))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _anchored(texts: DataFrame, length: int, key: int) -> DataFrame:
    """Rows (h, c, key, size, place) for every anchor of texts (key, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column("key").to_pylist(), batch.column("text")
            rows, held = [], 0
            for i, k in enumerate(keys):
                data = np.frombuffer(texts[i].as_buffer(), dtype=np.uint8)
                if len(data) >= length:
                    place, h, c = anchors(data, length, key)
                    rows.append((h.view(np.int64), c.view(np.int64), k, len(data), place))
                    held += len(place)
                if rows and (held > 100_000 or i == len(keys) - 1):
                    counts = np.array([len(r[4]) for r in rows])
                    at = pa.array(np.repeat(np.arange(len(rows)), counts))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([r[0] for r in rows])), pa.array(np.concatenate([r[1] for r in rows])),
                         pa.array([r[2] for r in rows], pa.binary()).take(at),
                         pa.array(np.repeat(np.array([r[3] for r in rows]), counts)),
                         pa.array(np.concatenate([r[4] for r in rows]))],
                        names=["h", "c", "key", "size", "place"])
                    rows, held = [], 0

    return texts.select("key", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "h long, c long, key binary, size long, place long")


def _common(a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Row by row, how many leading bytes agree, at most ``limit``."""
    differ = a != b
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])
    return np.minimum(first, limit)


def _matrix(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    joined = b"".join(s.ljust(width, b"\xff") for s in strings)
    return (np.frombuffer(joined, np.uint8).reshape(len(strings), width),
            np.fromiter(map(len, strings), np.int64, len(strings)))


def maximal_repeats(groups: np.ndarray, rights: list[bytes], lefts: list[bytes],
                    length: int = LENGTH, key: int = KEY) -> list[tuple[int, int, int]]:
    """(suffix, l, depth): occurrences of maximal repeats that reach l bytes to the left and depth to the right.

    The suffixes come sorted by group and by ``rights``; ``lefts`` are the preceding bytes, nearest first.
    Of a suffix's repeats only those are returned that reach further to the left than all deeper ones.
    """
    n, reach = len(rights), length - key
    if n < 2:
        return []
    right, right_size = _matrix(rights, length)
    left, left_size = _matrix(lefts, reach)
    together = groups[1:] == groups[:-1]
    prefix = np.where(together, _common(right[:-1], right[1:], np.minimum(right_size[:-1], right_size[1:])), 0)
    beside = _common(left[:-1], left[1:], np.minimum(left_size[:-1], left_size[1:])).tolist()
    prefix = [0, *prefix.tolist(), 0]
    best, out = [-1] * n, []

    def interval(depth: int, low: int, high: int) -> None:
        """The suffixes low..high share ``depth`` bytes to the right; those that share some to the left repeat."""
        need = length - depth
        if need > reach:
            return
        if high == low + 1:
            reached = ((low, beside[low]), (high, beside[low]))
        else:
            if all(best[i] >= reach for i in range(low, high + 1)):
                return
            order = np.array(sorted(range(low, high + 1), key=lefts.__getitem__))
            near = _common(left[order[:-1]], left[order[1:]], np.minimum(left_size[order[:-1]], left_size[order[1:]]))
            most = np.maximum(np.append(near, 0), np.insert(near, 0, 0))
            reached = zip(order.tolist(), most.tolist())
        for i, l in reached:
            if l >= need and l > best[i]:
                best[i] = l
                out.append((i, l, depth))

    stack = [(0, 0)]
    for i in range(1, n + 1):
        low = i - 1
        while stack[-1][0] > prefix[i]:
            depth, low = stack.pop()
            interval(depth, low, i - 1)
        if stack[-1][0] < prefix[i]:
            stack.append((prefix[i], low))
    return out


def _repeats(contexts: DataFrame, length: int, key: int, suffixes: int) -> DataFrame:
    """Rows (h, c, l, depth) for contexts (h, c, n, kinds, right, left), one of each surroundings."""
    chunk = F.pmod(F.xxhash64("c"), F.col("chunks")).cast("int")
    meets = F.explode(F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda o: F.struct(
        F.least(o, "chunk").alias("low"), F.greatest(o, "chunk").alias("high"))))
    chunks = F.ceil(F.col("kinds") / F.lit(suffixes)).cast("int")
    dealt = contexts.withColumn("chunks", chunks).withColumn("chunk", chunk).withColumn("meet", meets).select(
        "h", F.col("meet.low").alias("low"), F.col("meet.high").alias("high"), "c", "n", "right", "left")
    array = dealt.repartition("h", "low", "high").sortWithinPartitions("h", "low", "high", "right")

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def flush(rows: pd.DataFrame) -> pd.DataFrame:
            number = rows[["h", "low", "high"]].ne(rows[["h", "low", "high"]].shift()).any(axis=1).cumsum().to_numpy()
            found = maximal_repeats(number, rows["right"].tolist(), rows["left"].tolist(), length, key)
            i, l, d = (np.array(x, dtype=np.int64) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 3
            out = pd.DataFrame({"h": rows["h"].to_numpy()[i], "c": rows["c"].to_numpy()[i], "l": l, "depth": d})
            return out[rows["n"].to_numpy()[i] == 1]

        for part in parts:
            held.append(part)
            if sum(map(len, held)) < 5000:
                continue
            rows = pd.concat(held, ignore_index=True)
            tail = rows.iloc[-1]
            open_ = ((rows["h"] == tail["h"]) & (rows["low"] == tail["low"]) & (rows["high"] == tail["high"])).to_numpy()
            held = [rows[open_]]
            if not open_.all():
                yield flush(rows[~open_].reset_index(drop=True))
        if held:
            yield flush(pd.concat(held, ignore_index=True))

    return array.mapInPandas(scan, "h long, c long, l long, depth long")


def _contexts(texts: DataFrame, wanted: DataFrame, length: int, key: int) -> DataFrame:
    """Rows (h, c, n, kinds, right, left): the bytes around each wanted (h, c, n, kinds, key, place)."""
    by_text = wanted.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("place", "h", "c", "n", "kinds"))).alias("wanted"))
    reach = length - key

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column("text"), batch.column("wanted")
            for i in range(batch.num_rows):
                data, each = texts[i].as_buffer().to_pybytes(), lists[i].values
                place, h, c, n, kinds = (each.field(f) for f in ("place", "h", "c", "n", "kinds"))
                at = place.to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [h, c, n, kinds, pa.array([data[p:p + length] for p in at], pa.binary()),
                     pa.array([data[max(0, p - reach):p][::-1] for p in at], pa.binary())],
                    names=["h", "c", "n", "kinds", "right", "left"])

    return texts.select("key", F.col("text").cast("binary").alias("text")).join(by_text, "key").select(
        "text", "wanted").mapInArrow(cut, "h long, c long, n long, kinds long, right binary, left binary")


def _with_kinds(around: DataFrame, open_: DataFrame) -> DataFrame:
    """The surroundings (h, c, ...) of the keys in ``open_`` (h, kinds), with kinds, the number of their key's surroundings.

    A key that has over 1 / ``SHARES`` of all surroundings is dealt by the surroundings' hash to so many places that none
    has more.  There are at most ``SHARES`` such keys, so they are broadcast.
    """
    share = F.lit(around.count() // SHARES + 1)
    places = F.ceil(F.col("kinds") / share).cast("int")
    hot = F.broadcast(open_.filter(F.col("kinds") > share).select("h", places.alias("places")))
    dealt = around.join(hot, "h", "left").withColumn(
        "at", F.pmod(F.xxhash64("c"), F.coalesce("places", F.lit(1))).cast("int")).drop("places")
    wide = open_.withColumn("at", F.explode(F.sequence(F.lit(0), places - 1)))
    return dealt.join(wide, ["h", "at"]).drop("at")


def _collected(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of the steps whose results are stored."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _texts(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, str]:
    """The different texts (key, copies, text), written in buckets by key, so that later joins don't move them."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"llm_texts_{uuid4().hex[:12]}"
    (docs.select("key", "text").groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.first("text").alias("text"))
     .write.bucketBy(n, "key").option("compression", "zstd").option("path", new_table_path(spark, "llm-texts"))
     .saveAsTable(name))
    return spark.table(name), name


def covered(spark: SparkSession, texts: DataFrame, length: int = LENGTH, key: int = KEY,
            suffixes: int = SUFFIXES) -> tuple[DataFrame, list[str]]:
    """Rows (key, start, stop) of repeats in different texts (key, text), and the folders that hold them."""
    places = _anchored(texts, length, key)
    repeated, first = store(spark, places.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"),
                            "keys")
    occurrences, second = store(spark, places.join(repeated, "h"), "anchors")
    _collected(spark)
    around, third = store(spark, occurrences.groupBy("h", "c").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "place")).alias("sample")), "surroundings")
    # bytes are needed where some surroundings of a key occur once and there are others
    open_, kinds = store(spark, around.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).filter(
        "kinds > 1 and least = 1").select("h", "kinds"), "kinds")
    wanted = _with_kinds(around, open_).select("h", "c", "n", "kinds", "sample.key", "sample.place")
    contexts, fourth = store(spark, _contexts(texts, wanted, length, key), "contexts")
    _collected(spark)
    found, fifth = store(spark, _repeats(contexts, length, key, suffixes), "repeats")
    for path in (kinds, fourth):
        drop_stored(spark, path)
    whole = around.filter("n > 1").select("h", "c", F.lit(length - key).cast("long").alias("l"),
                                          F.lit(length).cast("long").alias("depth"))
    spans = occurrences.join(whole.unionByName(found), ["h", "c"]).select(
        "key", F.greatest(F.lit(0).cast("long"), F.col("place") - F.col("l")).alias("start"),
        F.least("size", F.col("place") + F.col("depth")).alias("stop")).filter(F.col("stop") - F.col("start") >= length)
    return spans, [first, second, third, fifth]


def _kept(texts: DataFrame, spans: DataFrame, length: int, with_text: bool) -> DataFrame:
    """Per text: key, n_removed, n_spans, kept_sha256 and, if asked for, the text that is left."""
    by_text = spans.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    joined = texts.join(by_text, "key", "left").select("key", "copies", F.col("text").cast("binary").alias("text"), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans, rows = batch.column("text"), batch.column("spans"), []
            for i, copies in enumerate(batch.column("copies").to_pylist()):
                data = texts[i].as_buffer().to_pybytes()
                if copies > 1 and len(data) >= length:
                    merged = [(0, len(data))]
                elif spans[i].is_valid:
                    each = spans[i].values
                    start, stop = (each.field(f).to_numpy() for f in ("start", "stop"))
                    stop = np.maximum.accumulate(stop)
                    fresh = np.append(True, start[1:] > stop[:-1])
                    merged = list(zip(start[fresh].tolist(), stop[np.append(fresh[1:], True)].tolist()))
                else:
                    merged = []
                edges = [0, *[x for span in merged for x in span], len(data)]
                left = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])) if merged else data
                rows.append((len(data) - len(left), len(merged), hashlib.sha256(left).hexdigest(),
                             left.decode("utf-8", "ignore") if with_text else None))
            removed, n_spans, sha, text = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()),
                 pa.array(sha, pa.string()), pa.array(text, pa.string())],
                names=["key", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    return joined.mapInArrow(
        run, "key binary, n_removed long, n_spans long, kept_sha256 string, kept_text string")


def _key(text: str):
    return F.substring(F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)), 1, 16)


def _cut(spark: SparkSession, docs: DataFrame, text: str, length: int, key: int, suffixes: int,
         with_text: bool) -> DataFrame:
    texts, name = _texts(spark, docs.select(_key(text).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    where = spark.sql(f"describe formatted {name}").filter("col_name = 'Location'").first()["data_type"]
    try:
        _collected(spark)
        spans, paths = covered(spark, texts, length, key, suffixes)
        kept, _ = store(spark, _kept(texts, spans, length, with_text), "kept")
        for path in paths:
            drop_stored(spark, path)
    finally:
        spark.sql(f"drop table {name}")
        drop_stored(spark, where)
    _collected(spark)
    return kept


def removed(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
            key: int = KEY, suffixes: int = SUFFIXES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    kept = _cut(spark, docs, text, length, key, suffixes, False)
    rows = docs.select(F.col(doc_id).alias("doc_id"), _key(text).alias("key"),
                       F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_bytes"))
    return rows.join(kept, "key").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def without_repeats(spark: SparkSession, docs: DataFrame, text: str = "text", length: int = LENGTH, key: int = KEY,
                    suffixes: int = SUFFIXES) -> DataFrame:
    """The documents with repeated strings cut out of the text; other columns as they are, null text stays null.

    A cut may fall within a character; what is left of that character goes too.
    """
    kept = _cut(spark, docs, text, length, key, suffixes, True)
    of, cut, own, none = fresh(docs.columns, "of", "cut", "own", "none")
    kept = kept.select(F.col("key").alias(of), F.col("kept_text").alias(cut))
    rest = docs.select(*[c for c in docs.columns if c != text], _key(text).alias(own), F.col(text).isNull().alias(none))
    joined = rest.join(kept, F.col(own) == F.col(of))
    return joined.select(*[F.when(~F.col(none), F.col(cut)).alias(text) if c == text else c for c in docs.columns])


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(spark, table(spark, sf_dir, "documents", "doc_id", "text"))
