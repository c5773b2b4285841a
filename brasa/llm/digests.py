"""Document fingerprints by quartile bucket digests.

Every window of five bytes gives six byte triplets (the newest byte with each two of the other four); a triplet is hashed
into one of 256 buckets, and a text's triplets are counted.  The digest holds, for each bucket, in which quarter of the
text's own counts its count lies (two bits), and a head: a check byte of the whole text, the length on a logarithmic
scale, and how the first and second quartile relate to the third.  Texts of any length have digests of equal size.

Two digests are compared by a difference score that is bounded: the quarters' distances over all buckets (1, 2 or 3
apart count 1, 2 or 6), and distances of length and quartile ratios, each with a greatest value.  A likeness is 1 minus
the score's share of what two digests can differ by at most, so 1 means no difference and equal texts have 1.

``followers`` pairs every document with the next one by id without a window over the whole table: a bounded sample of
the keys cuts the order into ranges, a range is sorted in one task, and the pairs that cross ranges - one for each
range - are joined by the ranges' numbers.  Texts pass the shuffle once, compressed, with their digest.

Defined cases: null text is the empty text, whose digest is all zeros.  Null ids come before all others.  Equal ids are
ordered by a hash of their text, then by their row's place, so repeated rows follow each other; each gets a row.  A single
document is its own next one.  An empty table gives an empty result.  Columns beside the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brasa.llm.common import store, table

BUCKETS, WINDOW = 256, 5
BLOCK = 1 << 16            # bytes counted at a time
HEAD = 4                   # bytes of a digest before its quarters: check, length, two ratios
STEPS = (0, 1, 2, 6)       # what quarters that lie so far apart differ by
MOST_LENGTH, MOST_RATIO = 64, 15
MOST = BUCKETS * STEPS[3] + MOST_LENGTH + 2 * MOST_RATIO
SAMPLE = 64                # sampled keys for each range
MOST_RANGES = 4096

# the newest byte of a window and two others, as distances back from it
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4))


def bucket_counts(data: bytes) -> np.ndarray:
    """How many triplets of the text fall into each bucket; four zero bytes stand before the text."""
    counts = np.zeros(BUCKETS, np.int64)
    padded = np.frombuffer(bytes(WINDOW - 1) + data, np.uint8)
    for begin in range(0, len(data), BLOCK):
        part = padded[begin:begin + BLOCK + WINDOW - 1].astype(np.uint32)
        n = len(part) - WINDOW + 1
        back = [part[WINDOW - 1 - d:WINDOW - 1 - d + n] for d in range(WINDOW)]
        first = back[0] * np.uint32(0x9E3779B1)
        mixed = [b * np.uint32(m) for b, m in zip(back, (0, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1))]
        for salt, (_, i, j) in enumerate(TRIPLETS):
            h = first + mixed[i] + (mixed[j] ^ np.uint32(salt * 0x632BE5AB & 0xFFFFFFFF))
            counts += np.bincount((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(24), minlength=BUCKETS)
    return counts


def digest(data: bytes) -> bytes:
    """The text's digest: HEAD bytes, then two bits for each bucket."""
    if not data:
        return bytes(HEAD + BUCKETS // 4)
    counts = bucket_counts(data)
    ordered = np.sort(counts)
    low, middle, high = (int(ordered[BUCKETS * k // 4 - 1]) for k in (1, 2, 3))
    quarter = (counts > low).astype(np.uint8) + (counts > middle) + (counts > high)
    ratios = [100 * q // max(high, 1) * 15 // 100 for q in (low, middle)]
    length = min(255, round(8 * float(np.log2(len(data) + 1))))
    body = np.packbits(np.stack([quarter >> 1, quarter & 1], axis=1).ravel())
    return bytes([zlib.crc32(data) & 0xFF, length, *ratios]) + body.tobytes()


def _quarters(some: bytes) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(some, np.uint8, offset=HEAD)).reshape(-1, 2)
    return (2 * bits[:, 0] + bits[:, 1]).astype(np.int64)


STEP_OF = np.array(STEPS)


def difference(one: bytes, other: bytes) -> int:
    """0 for equal digests, MOST at most."""
    if one == other:
        return 0
    score = int(STEP_OF[np.abs(_quarters(one) - _quarters(other))].sum())
    score += min(MOST_LENGTH, abs(one[1] - other[1])) + sum(min(MOST_RATIO, abs(one[k] - other[k])) for k in (2, 3))
    return max(score, 1) if one[0] != other[0] else score


def likeness(one: bytes, other: bytes) -> float:
    """1 for equal digests, 0 for those that differ most."""
    return 1.0 - difference(one, other) / MOST


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following one (or all of it)."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


@lru_cache(maxsize=1)
def _codec() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _pack(text: str) -> bytes:
    return _codec()[0].compress(text.encode())


def _unpack(packed: bytes) -> str:
    return _codec()[1].decompress(packed).decode()


KEY = ["none", "doc_id", "tie", "row"]
KEYED = "none int, doc_id long, tie long, row long"
ROW = f"{KEYED}, range int, n_chars long, digest binary, packed binary"
PAIRED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
SIDED = f"{PAIRED}, range int, first boolean, last boolean, digest binary, packed binary"


def _arrow(rows: list, schema: str) -> pa.RecordBatch:
    types = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string(),
             "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields)],
                                      names=[n for n, _ in fields])


def _bounds(keys: DataFrame, ranges: int) -> list[tuple]:
    """Keys that cut the order into ranges of about equal rows, out of a sample of about SAMPLE rows a range.

    The sample takes the rows whose hash is below a share of all hashes, so that a task sends no more than its part.
    """
    rows = keys.count()
    share = min(1.0, SAMPLE * ranges / max(rows, 1))
    drawn = keys.filter(F.pmod(F.xxhash64(*KEY), F.lit(1 << 52)) <= F.lit(int(share * (1 << 52)))).collect()
    ordered = sorted(tuple(r) for r in drawn)
    return ordered[SAMPLE - 1::SAMPLE][:MOST_RANGES]


def _pair(one: tuple, two: tuple) -> tuple:
    """The result row for a document (id, n_chars, digest, packed text) and the next one."""
    doc_id, n_chars, mine, packed = one
    changed = edited(_unpack(packed), _unpack(two[3])).encode()
    new = digest(changed)
    return (doc_id, n_chars, hashlib.sha256(changed).hexdigest(), mine.hex(), new.hex(), likeness(mine, new),
            likeness(mine, two[2]))


def followers(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
              ranges: int | None = None) -> DataFrame:
    """One row per row of ``docs``, with its digest, its edited text's, and likenesses (see PAIRED)."""
    ranges = min(MOST_RANGES, ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed = docs.select(F.col(doc_id).isNotNull().cast("int").alias("none"),
                        F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("doc_id"),
                        F.xxhash64(text).alias("tie"), F.monotonically_increasing_id().alias("row"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    bounds = _bounds(keyed.select(KEY), ranges)

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for *key, t in zip(*[batch.column(c).to_pylist() for c in [*KEY, "text"]]):
                rows.append((*key, bisect_right(bounds, tuple(key)), len(t), digest(t.encode()), _pack(t)))
            yield _arrow(rows, ROW)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs inside a range; the first and the last document of a range also stand in a row of their own."""
        before, opens = None, False
        for batch in batches:
            rows = []
            for none, i, at, *rest in zip(*[batch.column(c).to_pylist() for c in ["none", "doc_id", "range", "n_chars",
                                                                                 "digest", "packed"]]):
                now = (at, (i if none else None, *rest))
                if before is not None and before[0] == at:
                    if opens:
                        rows.append(_edge(before, first=True))
                    rows.append((*_pair(before[1], now[1]), at, False, False, None, None))
                elif before is not None:
                    rows.append(_edge(before, first=opens, last=True))
                opens = before is None or before[0] != at
                before = now
            yield _arrow(rows, SIDED)
        if before is not None:
            yield _arrow([_edge(before, first=opens, last=True)], SIDED)

    ranged = keyed.mapInArrow(prepare, ROW).repartition("range").sortWithinPartitions("range", *KEY)
    sided, _ = store(spark, ranged.mapInArrow(pair, SIDED), "followers")
    # one row for each range: the number of the next range that has rows, the first one's behind the last
    numbers = sided.filter("last").select("range")
    lowest = numbers.agg(F.min("range")).scalar()
    order = numbers.select("range", F.coalesce(F.lead("range").over(Window.orderBy("range")), lowest).alias("to"))
    last = sided.filter("last").select("range", *[F.col(c).alias(f"a_{c}") for c in EDGE])
    first = sided.filter("first").select(F.col("range").alias("to"), *[F.col(c).alias(f"b_{c}") for c in EDGE])
    crossing = last.join(order, "range").join(first, "to")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [zip(*[batch.column(f"{s}_{c}").to_pylist() for c in EDGE]) for s in "ab"]
            yield _arrow([_pair(one, two) for one, two in zip(*sides)], PAIRED)

    names = [f.split()[0] for f in PAIRED.split(", ")]
    return sided.filter("not (first or last)").select(names).unionByName(
        crossing.select(*[f"{s}_{c}" for s in "ab" for c in EDGE]).mapInArrow(join, PAIRED))


EDGE = ["doc_id", "n_chars", "digest", "packed"]


def _edge(at_row: tuple, first: bool = False, last: bool = False) -> tuple:
    at, (doc_id, n_chars, mine, packed) = at_row
    return (doc_id, n_chars, None, None, None, None, None, at, first, last, mine, packed)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return followers(spark, table(spark, sf_dir, "documents", "doc_id", "text"))
