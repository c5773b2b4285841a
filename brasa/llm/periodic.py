"""Periodic runs of words, found with string synchronising sets.

A run is a stretch of consecutive words with a smallest period q, as long as ``POWERS`` * q and ``LEAST`` words at least,
that no neighbouring word extends.  At each dyadic scale t (4, 8, 16 ...) a position belongs to the synchronising set if,
among the hashes of the t-word windows that start there and at the t places behind it, the smallest is the first or the
last.  That choice looks at the 2t words from the position on and at nothing else, so equal contexts of 2t words are
chosen alike, and every t places hold a chosen one unless they lie in a region of period t / 3 or less; windows inside
such regions are left out of the minimum.

In a run of period q, 2t <= q < 4t, some chosen position i lies in the first period (the run would have a smaller period
otherwise) and i + q has the same 2t words.  So all pairs of chosen positions with equal contexts, 2t to 4t apart,
propose their distances as periods, and each proposal is extended word by word, which settles it exactly: a hash only
ever proposes.  Positions with one context are over t / 3 apart, which bounds the pairs.  Periods below 8 are the omitted
small ones: regions of such periods are found apart, by comparing the words with themselves shifted, and the highly
periodic regions of a scale are the runs of the smaller periods, which are known by then.

A task joins the words of many documents into one array with a separator of its own between any two, the longest
documents first, so that a scale works on the documents that can hold its periods.

Defined cases: null text is the empty text; a text without words has no runs and collapses to the empty string.  Rows
are judged one by one: repeated rows and null ids are returned as they come.  An empty table gives an empty result.
Columns beside the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brasa.llm.common import table

LEAST, POWERS = 24, 3
SMALL = 7           # periods found by shifting; the first scale proposes those from 8 on
FIRST_SCALE = 4
WORDS_AT_ONCE = 400_000  # words that a task holds as one array (one document at least)
NONE = np.uint64(2 ** 64 - 1)

RESULT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
          "collapsed_sha256 string")


def _mix(x: np.ndarray) -> np.ndarray:
    """A hash of each number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _doubled(hashes: np.ndarray, t: int) -> np.ndarray:
    """Hashes of windows of 2t words from those of t words."""
    return _mix(hashes[:-t] * np.uint64(0x9E3779B97F4A7C15) + hashes[t:]) if len(hashes) > t else hashes[:0]


def _window_minima(x: np.ndarray, k: int) -> np.ndarray:
    """min(x[i:i + k]) for every i."""
    if len(x) < k:
        return x[:0]
    width = 1
    out = x
    while 2 * width <= k:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    return np.minimum(out[:len(x) - k + 1], out[k - width:][:len(x) - k + 1])


def _small_periods(words: np.ndarray, q: int) -> np.ndarray:
    """Rows (start, stop, q): maximal stretches of period q, POWERS * q words at least."""
    if len(words) <= q:
        return np.zeros((0, 3), np.int64)
    edges = np.flatnonzero(np.diff(np.concatenate(([False], words[:-q] == words[q:], [False]))))
    start, stop = edges[::2], edges[1::2] + q
    long = stop - start >= POWERS * q
    return np.stack([start[long], stop[long], np.full(long.sum(), q)], axis=1)


def _chosen(hashes: np.ndarray, runs: np.ndarray, t: int) -> np.ndarray:
    """The synchronising set of scale t."""
    n = len(hashes)
    rank = _mix(hashes ^ np.uint64(t))
    rank[rank == NONE] -= np.uint64(1)
    periodic = runs[(runs[:, 2] <= t // 3) & (runs[:, 1] - runs[:, 0] >= t) & (runs[:, 0] < n)]
    if len(periodic):
        change = np.zeros(n + 1, np.int64)
        np.add.at(change, periodic[:, 0], 1)
        np.add.at(change, np.minimum(periodic[:, 1] - t + 1, n), -1)
        rank[np.cumsum(change[:-1]) > 0] = NONE
    least = _window_minima(rank, t + 1)
    return np.flatnonzero((least != NONE) & ((least == rank[:len(least)]) | (least == rank[t:t + len(least)])))


def _proposals(contexts: tuple[np.ndarray, np.ndarray], t: int) -> list[tuple[int, int]]:
    """(distance, position) of chosen positions with equal contexts, 2t to 4t apart; ``contexts``: hashes, positions."""
    order = np.argsort(contexts[0], kind="stable")  # positions ascend within a context
    context, place = contexts[0][order], contexts[1][order].astype(np.int64)
    found, lag = [], 1
    while lag < len(place):
        apart = place[lag:] - place[:-lag]
        near = (context[lag:] == context[:-lag]) & (apart < 4 * t)
        if not near.any():
            break
        take = near & (apart >= 2 * t)
        found += zip(apart[take].tolist(), place[:-lag][take].tolist())
        lag += 1
    return found


def _reach(words: np.ndarray, at: int, q: int, step: int) -> int:
    """The first place from ``at`` on (step 1) or back (step -1) whose word differs from that q words behind it."""
    width = 64
    while True:
        low, high = (at, min(at + width, len(words) - q)) if step > 0 else (max(at - width + 1, 0), at + 1)
        differs = np.flatnonzero(words[low:high] != words[low + q:high + q])
        if len(differs):
            return low + int(differs[0] if step > 0 else differs[-1])
        at, width = (high, 2 * width) if step > 0 else (low - 1, 2 * width)
        if at >= len(words) - q or at < 0:
            return at


def runs_of(words: np.ndarray, longest: Callable[[int], int] | None = None) -> np.ndarray:
    """Rows (start, stop, smallest period) of all maximal stretches of POWERS periods, LEAST words at least.

    ``longest(n)`` may give the length of the array's front part that holds all documents of n words or more.
    """
    runs = np.concatenate([_small_periods(words, q) for q in range(1, SMALL + 1)])
    runs = _smallest(runs)
    hashes, have, t = _mix(words.astype(np.uint64)), 1, FIRST_SCALE
    while True:
        n = min(len(words), longest(2 * POWERS * t) if longest else len(words))
        if n < 2 * POWERS * t:
            break
        hashes = hashes[:n - have + 1]
        while have < t:
            hashes, have = _doubled(hashes, have), 2 * have
        places = _chosen(hashes, runs, t)
        context = _doubled(hashes, t)
        found, covered = [], {}
        for q, i in sorted(_proposals((context[places], places), t)):
            if i < covered.get(q, 0):
                continue
            stop, start = _reach(words, i, q, 1), _reach(words, i, q, -1) + 1
            covered[q] = stop
            if stop - start >= (POWERS - 1) * q:
                found.append((start, stop + q, q))
        if found:
            runs = _smallest(np.concatenate([runs, np.array(found, np.int64)]))
        t *= 2
    return runs[runs[:, 1] - runs[:, 0] >= LEAST]


def _smallest(runs: np.ndarray) -> np.ndarray:
    """Of stretches with equal ends only the one with the smallest period (the others have multiples of it)."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[first]


def runs_of_documents(documents: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each document, as rows (start, length, period) by start, then period."""
    order = sorted(range(len(documents)), key=lambda d: -len(documents[d]))
    lengths = np.array([len(documents[d]) for d in order], np.int64)
    known: dict[bytes, int] = {}
    numbers = [known.setdefault(w, len(known)) for d in order for w in documents[d]]
    begins = np.cumsum(lengths + 1) - lengths  # a separator before each document, and one at the end
    words = np.empty(int(lengths.sum()) + len(order) + 1, np.int64)
    separator = np.ones(len(words), bool)
    separator[np.repeat(begins, lengths) + np.arange(len(numbers)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = False
    words[~separator] = numbers
    words[separator] = len(known) + np.arange(len(order) + 1)
    ends = begins + lengths

    def longest(n: int) -> int:
        some = int((lengths >= n).sum())
        return int(ends[some - 1]) + 1 if some else 0

    runs = runs_of(words, longest)
    owner = np.searchsorted(begins, runs[:, 0], side="right") - 1
    out: list[np.ndarray] = [np.zeros((0, 3), np.int64)] * len(documents)
    for k in np.unique(owner).tolist():
        mine = runs[owner == k]
        mine = np.stack([mine[:, 0] - begins[k], mine[:, 1] - mine[:, 0], mine[:, 2]], axis=1)
        out[order[k]] = mine[np.lexsort((mine[:, 2], mine[:, 0]))]
    return out


def kept_words(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run holds behind its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(change[:-1]) == 0
    return [w for w, k in zip(words, kept.tolist()) if k]


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the greatest length / period (ties: smallest start, then period)."""
    best = None
    for start, length, period in runs.tolist():
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


def split(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space."""
    return (text or b"").split()


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  change: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per row of ``docs``: its runs' number and digest, its strongest run, and the digest of its collapsed text.

    ``change(doc_id, words)`` may replace the words before they are judged.
    """
    def judged(ids: list, documents: list[list[bytes]]) -> pa.RecordBatch:
        rows = []
        for i, words, runs in zip(ids, documents, runs_of_documents(documents)):
            best = strongest(runs)
            listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
            kept = kept_words(words, runs) if len(runs) else words
            rows.append((i, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
                         hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()))
        types = [pa.int64()] * 6 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                          names=[f.split()[0] for f in RESULT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, documents, held = [], [], 0
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for i, t in zip(batch.column("doc_id").to_pylist(), texts):
                words = split(t.as_py())
                if change is not None:
                    words = change(i, words)
                if ids and held + len(words) > WORDS_AT_ONCE:
                    yield judged(ids, documents)
                    ids, documents, held = [], [], 0
                ids.append(i)
                documents.append(words)
                held += len(words)
        if ids:
            yield judged(ids, documents)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, RESULT)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words, of one document in ten repeated with a period from some word on (by its id's CRC-32)."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents", "doc_id", "text"), change=planted)
