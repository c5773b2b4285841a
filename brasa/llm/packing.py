"""Mixture-controlled packing: deficit round-robin over source queues.

Every source is a queue of documents.  Each window of ``SIZE`` tokens gives every queue its quantum, its share of all
tokens times the window's size; what a queue could not send of it (a fraction of a token) is its deficit, carried into
the next window.  Documents may be cut, so a queue always sends just what it is owed, every window but the last is full
and all queues run dry together.

The deficits are carried in closed form, so no window waits for the one before it.  The queues are the leaves of a tree,
the binary trie of a hash of their names.  Of the first T tokens, a node passes floor(T * left / all) to its left subtree
and the rest to its right one; both grow with T, one token at a time, and their sum is T.  What a queue has sent after w
windows, and where its part of a window begins, is therefore a function of w and of the nodes above the queue alone, and
any task can lay out any document: it needs those nodes' totals (a grouped sum over the sources, and one row for each source)
and the document's place in its queue (a prefix sum over partitions).  However many sources there are, each is a queue,
and a queue is never more than one token per branching node above it away from its exact share.

Documents are encoded once; ids are written to the shared folder, and placed from there.

Defined cases: null text is the empty text, which still has its closing id.  A null source is a queue of its own.  Rows
are packed one by one: repeated rows are packed as often as they come, null ids are kept; ids must be integers.  An empty
table gives an empty result.  Only the id, the text and the source are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brasa.llm.common import store, table
from brasa.llm.vocabulary import ranks

TOKENIZER = "byte_bpe_50k"
CLOSING_ID = 1
SIZE = 2048
LEVELS = 64  # bits of the hash

BROADCAST_ROWS = 50_000  # of a source's nodes above it, 500 bytes or so

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "source string")


def share_of(tokens: np.ndarray, left: int, everything: int) -> np.ndarray:
    """floor(tokens * left / everything) for tokens <= everything, in long division where the product is over 63 bits."""
    step = max(1, 62 - int(everything).bit_length())
    passes = max(1, -(-int(everything).bit_length() // step))
    out, rest = np.zeros_like(tokens), np.zeros_like(tokens)
    for k in reversed(range(passes)):
        rest = (rest << step) + (tokens >> (k * step) & ((1 << step) - 1)) * left
        whole = rest // everything
        out, rest = (out << step) + whole, rest - whole * everything
    return out


class Queue:
    """A queue's part of the windows: ``path`` holds (all tokens, those of the left side, whether the queue is on the right
    side) of the branching nodes above it, from the root on."""

    def __init__(self, all_tokens: int, own_tokens: int, path: list[tuple[int, int, bool]]):
        self.all, self.own, self.path = all_tokens, own_tokens, path

    def sent(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the first ``tokens`` tokens: those of all queues before this one, and those of this one."""
        share, before = tokens, np.zeros_like(tokens)
        for everything, left, right in self.path:
            part = share_of(share, left, everything)
            before, share = (before + part, share - part) if right else (before, part)
        return before, share

    def window_of(self, place: np.ndarray, size: int) -> np.ndarray:
        """The window that gets the token at each place of the queue."""
        # sent() is less than a token per node away from the exact share, which brackets the window
        ratio, margin, windows = self.all / (self.own * size), len(self.path) + 2, -(-self.all // size)
        low = np.clip(((place - margin) * ratio).astype(np.int64) - 2, 0, windows - 1)
        high = np.clip(((place + margin) * ratio).astype(np.int64) + 3, 1, windows)
        while (open_ := high - low > 1).any():  # sent(low) <= place < sent(high)
            middle = (low + high) // 2
            reached = self.sent(np.minimum(middle * size, self.all))[1] <= place
            low, high = np.where(open_ & reached, middle, low), np.where(open_ & ~reached, middle, high)
        return low

    def pieces(self, begin: np.ndarray, n: np.ndarray, size: int):
        """Documents at the given places of the queue: for each piece its document, start, length, window and offset."""
        first, last = self.window_of(begin, size), self.window_of(begin + n - 1, size)
        count = last - first + 1
        doc = np.repeat(np.arange(len(n)), count)
        window = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + first[doc]
        (before, mine), (before_next, mine_next) = (self.sent(np.minimum(w * size, self.all)) for w in (window, window + 1))
        low, high = np.maximum(mine, begin[doc]), np.minimum(mine_next, (begin + n)[doc])
        keep = high > low
        offset = (before_next - before) + (low - mine)
        return [x[keep] for x in (doc, low - begin[doc], high - low, window, offset)]


def paths(totals: DataFrame) -> DataFrame:
    """Rows (source, all, own, path) for sources with their tokens (source, n).

    A node of the trie is a number of leading bits; its tokens, and those with the next bit 0, are sums over the sources
    below it.  Only nodes with sources on both sides take part, about twice the logarithm of the number of sources of
    them above each source.  Sources with one hash (a chance of 2 ** -64 for two of them) are told apart by a level more.
    """
    hashed = totals.withColumn("hash", F.xxhash64("source")).withColumn(
        "twin", F.row_number().over(Window.partitionBy("hash").orderBy("source")))
    levels = F.explode(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), lambda k: F.struct(
        k.alias("level"), F.when(k < LEVELS, _leading(k)).otherwise(F.col("hash")).alias("prefix"),
        F.when(k < LEVELS, _bit(k)).otherwise(F.col("twin") > 1).alias("right"))))
    below = hashed.select("source", "n", levels.alias("at")).select("source", "n", "at.*")
    nodes = below.groupBy("level", "prefix").agg(
        F.sum("n").alias("everything"), F.sum(F.expr("if(right, 0, n)")).alias("left")).filter("left > 0 and left < everything")
    above = below.join(nodes, ["level", "prefix"]).groupBy("source").agg(F.array_sort(F.collect_list(
        F.struct("level", "everything", "left", "right"))).alias("path"))
    all_tokens = totals.agg(F.sum("n")).scalar()
    of = above.withColumnRenamed("source", "of_source")
    return totals.join(of, totals["source"].eqNullSafe(of["of_source"]), "left").select(
        "source", all_tokens.alias("all"), F.col("n").alias("own"), "path")


def _leading(k: Column) -> Column:
    """The first k bits of the hash (0 <= k < 64), the others 0."""
    return F.when(k == 0, F.lit(0).cast("long")).otherwise(
        F.call_function("shiftleft", F.call_function("shiftrightunsigned", F.col("hash"), F.lit(64) - k), F.lit(64) - k))


def _bit(k: Column) -> Column:
    """Whether bit k of the hash, from the first, is 1."""
    return F.call_function("shiftrightunsigned", F.col("hash"), F.lit(63) - k).bitwiseAND(F.lit(1)) == 1


def _encoded(docs: DataFrame, tokenizer_file: str, closing_id: int) -> DataFrame:
    """Rows (doc_id, source, part, local, n, ids): local counts the tokens of the row's source before it in its part."""
    closing = np.array([closing_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sent, part = ranks(tokenizer_file), {}, TaskContext.get().partitionId()
        for batch in batches:
            sources = batch.column("source").to_pylist()
            ids = [known.encode(t or "") + closing for t in batch.column("text").to_pylist()]
            n = [len(x) // 4 for x in ids]
            local = []
            for source, k in zip(sources, n):
                local.append(sent.get(source, 0))
                sent[source] = local[-1] + k
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"), pa.array([part] * len(n), pa.int32()),
                 pa.array(local, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "source", "part", "local", "n", "ids"])

    return docs.mapInArrow(run, "doc_id long, source string, part int, local long, n long, ids binary")


def pack(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
         size: int = SIZE, tokenizer_file: str = TOKENIZER, closing_id: int = CLOSING_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and source."""
    rows, _ = store(spark, _encoded(docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                                                F.col(text).alias("text"), F.col(source).cast("string").alias("source")),
                                    tokenizer_file, closing_id), "ids")
    # tokens of each source in each part: a few rows for each part
    parts, _ = store(spark, rows.groupBy("source", "part").agg(F.sum("n").alias("n")), "parts")
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begun = parts.select("source", F.col("part").alias("of_part"),
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    queues, _ = store(spark, paths(parts.groupBy("source").agg(F.sum("n").alias("n"))), "queues")
    queues = queues.withColumnRenamed("source", "of_source")
    placing = begun.join(queues, begun["source"].eqNullSafe(queues["of_source"])).drop("source")
    # one row for each source and part; without the ids' shuffle as long as that is a checked, small number
    if parts.count() <= BROADCAST_ROWS:
        placing = F.broadcast(placing)
    placed = rows.join(placing, (rows["part"] == placing["of_part"]) & rows["source"].eqNullSafe(placing["of_source"])
                       ).select("doc_id", "source", (F.col("begin") + F.col("local")).alias("begin"), "n", "all", "own",
                                F.col("path.everything").alias("everything"), F.col("path.left").alias("left"),
                                F.col("path.right").alias("right"), "ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, n = (batch.column(c).to_numpy() for c in ("begin", "n"))
            ids, names = batch.column("ids"), batch.column("source").dictionary_encode()
            which = names.indices.fill_null(len(names.dictionary)).to_numpy()
            for q in np.unique(which).tolist():
                at = np.flatnonzero(which == q)
                nodes = [batch.column(c)[int(at[0])].as_py() or [] for c in ("everything", "left", "right")]
                queue = Queue(*(batch.column(c)[int(at[0])].as_py() for c in ("all", "own")), list(zip(*nodes)))
                doc, start, length, window, offset = queue.pieces(begin[at], n[at], size)
                of, last, data, checks = at[doc], -1, b"", []
                for i, a, k in zip(of.tolist(), start.tolist(), length.tolist()):
                    if i != last:
                        last, data = i, memoryview(ids[i].as_buffer())
                    checks.append(zlib.crc32(data[4 * a:4 * (a + k)]))
                take = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(take), pa.array(start), pa.array(length), pa.array(checks, pa.int64()),
                     pa.array(n[of], pa.int64()), pa.array(window), pa.array(offset), batch.column("source").take(take)],
                    names=[f.split()[0] for f in PIECES.split(", ")])

    return placed.mapInArrow(cut, PIECES)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, table(spark, sf_dir, "documents", "doc_id", "text", "source")).drop("source")
