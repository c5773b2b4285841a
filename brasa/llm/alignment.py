"""Cross-tokenizer alignment with inverted pair bitmaps.

Two tokenizers cut the same bytes.  A token of one and a token of the other are linked where their byte ranges overlap,
and the places where a token of each ends cut a document into groups.  How often a pair of ids is linked in the corpus is
its count, and every document's links are scored by their pairs' counts.

The corpus is inverted: of each pair of ids the documents that hold it form a bitmap, cut into blocks of ``BLOCK``
documents (plane 0), and how often beyond once each of them holds it is written into multiplicity planes - plane k + 1 has
the documents whose number has bit k.  A block's plane is compressed: the documents' places where they are few, else a bit
set.  A task inverts its documents a part at a time; parts of one block are OR-merged in Spark, dealt by pair and block, so
that no task has to hold a pair's whole bitmap.  The popcount of plane 0 is a pair's documents, that of all planes with
their weights its links; each B id's highest count is a grouped maximum.  Then the postings return the scores: the bitmaps, joined with their pairs' counts, are dealt
by block, and each document's sums add up in two dense arrays of the block.

Words are encoded once by a task.  A place with ASCII white space behind it and another character before it is a boundary
of both tokenizers: no branch of A's pattern runs into white space, and no piece of B has a white-space character behind
another one, carriage return aside (checked when the model is loaded).  Texts with carriage returns or with characters
that some engine may take as white space are encoded whole.

Defined cases: null and empty texts have no tokens, nor has a text whose tokens of either side don't give back its bytes
(B writes a space as U+2581, so a text that holds that character is one).  Rows are judged one by one: repeated rows and
null ids are returned, and counted, as often as they come.  An empty table gives an empty result.  Columns beside the id
and the text are not read.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brasa.llm.common import drop_stored, store, table
from brasa.llm.vocabulary import UNSURE_RANGES, ranks, tokenizer

FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK = 4096                # documents of a block
FEW = BLOCK // 16           # a plane with so many documents is a bit set
UNITS_AT_ONCE = 3_000_000   # words that a task inverts together (one document at least)
KEPT_UNITS, KEPT_CHARS = 400_000, 100
SPACE = chr(0x2581)         # how B's pieces write a space

UNIT = re.compile(r"[ \t-\r]+[^ \t-\r]*")
WHOLE = re.compile("[\r" + "".join(f"{chr(a)}-{chr(b)}" for a, b in UNSURE_RANGES) + "]")

ALIGNED = ("block long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pair long, plane int, docs binary")
MERGED = "pair long, block long, plane int, docs binary, n long"
SCORES = "block long, place int, n_best long, count_sum long"


def _byte_of() -> dict[str, int]:
    """A's characters for bytes: printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoders:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, file_a: str, file_b: str):
        import public_tokenizers
        import sentencepiece

        self.a = tokenizer(file_a)
        self.plain = ranks(file_a.removesuffix(".json"))
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(file_b))
        byte_of = _byte_of()
        self.bytes_a = {i: bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
                        for token, i in self.a.get_vocab().items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        self.lone_space = self.b.piece_to_id(SPACE)
        inside = re.compile(f"[^{SPACE} \t-\r][{SPACE} \t-{chr(12)}]")
        if any(inside.search(p) for i, p in enumerate(pieces) if not self.b.is_byte(i)):
            raise ValueError(f"{file_b} has pieces that run into white space")

    def ids_a(self, text: str) -> list[int]:
        """A's ids, special strings being plain text."""
        if self.plain.sure(text):
            return self.plain.fast.encode_ordinary(text)
        if any(special in text for special in self.plain.fast.special_tokens_set):
            self.a.encode_special_tokens = True
            try:
                return self.a.encode(text, add_special_tokens=False).ids
            finally:
                self.a.encode_special_tokens = False
        return self.a.encode(text, add_special_tokens=False).ids

    def ids_b(self, strings: list[str]) -> list[list[int]]:
        """B's ids of strings that begin with white space; B puts a space before what it gets."""
        found = self.b.encode([s[1:] if s[0] == " " else s for s in strings], num_threads=1)
        for k, s in enumerate(strings):
            if s == " ":
                found[k] = [self.lone_space]
            elif s[0] != " ":
                if found[k][:1] != [self.lone_space]:
                    raise ValueError("a leading space ran into the next token")
                found[k] = found[k][1:]
        return found


@lru_cache(maxsize=2)
def encoders(file_a: str, file_b: str) -> Encoders:
    """One pair of tokenizers for a Python worker."""
    return Encoders(file_a, file_b)


class Units:
    """Aligned words by number: their sizes, their groups as text, and their links' pairs."""

    def __init__(self, known: Encoders):
        self.known = known
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.sizes = array("q")    # for each word its tokens of A and B, groups and links
        self.sound = bytearray()   # whether the tokens give back the bytes
        self.groups: list[str] = []
        self.pairs = array("q")    # of all words in a row

    def __len__(self) -> int:
        return len(self.groups)

    def add(self, strings: list[str]) -> range:
        first = len(self)
        ids_a, bytes_a, bytes_b = self.known.ids_a, self.known.bytes_a.__getitem__, self.known.bytes_b.__getitem__
        for s, b in zip(strings, self.known.ids_b(strings)):
            a, data = ids_a(s), s.encode()
            parts_a, parts_b = list(map(bytes_a, a)), list(map(bytes_b, b))
            sound = b"".join(parts_a) == data and b"".join(parts_b) == data
            groups, before = [], len(self.pairs)
            if sound:
                end_a, end_b = list(accumulate(map(len, parts_a))), list(accumulate(map(len, parts_b)))
                i = j = from_a = from_b = 0
                while i < len(a):
                    self.pairs.append(a[i] << 32 | b[j])
                    x, y = end_a[i], end_b[j]
                    if x <= y:
                        i += 1
                    if y <= x:
                        j += 1
                    if x == y:
                        groups.append(f"{','.join(map(str, a[from_a:i]))}|{','.join(map(str, b[from_b:j]))}")
                        from_a, from_b = i, j
            self.sizes.extend((len(a), len(b), len(groups), len(self.pairs) - before))
            self.sound.append(sound)
            self.groups.append(";".join(groups))
        return range(first, len(self))

    def of(self, text: str) -> list[int]:
        """Numbers of the words of a text."""
        spaced = f" {text}"
        if WHOLE.search(text):
            return list(self.add([spaced]))
        strings, number = UNIT.findall(spaced), self.number
        new = list(set(strings).difference(number))
        long = [s for s in new if len(s) > KEPT_CHARS]
        if new:
            short = [s for s in new if len(s) <= KEPT_CHARS] if long else new
            number.update(zip(short, self.add(short)))
        if long:
            own = dict(zip(long, self.add(long)))
            return [own[s] if s in own else number[s] for s in strings]
        return list(map(number.__getitem__, strings))

    def totals(self, documents: list[list[int]]) -> np.ndarray:
        """Rows (A tokens, B tokens, groups, links) of documents given as numbers of words; zeros for unsound ones."""
        sizes = np.frombuffer(self.sizes, np.int64).reshape(-1, 4)
        sums = np.zeros((len(documents), 4), np.int64)
        some = [k for k, d in enumerate(documents) if d]
        if some:
            flat = np.fromiter(chain.from_iterable(documents), np.int64)
            lengths = np.array([len(documents[k]) for k in some])
            sums[some] = np.add.reduceat(sizes[flat], np.cumsum(lengths) - lengths, axis=0)
        return sums


def postings(documents: list[list[int]], places: list[int], units: Units) -> Iterator[tuple[int, pa.Array, pa.Array]]:
    """(plane, pairs, compressed documents) of documents given as numbers of words, a place of their block each."""
    lengths = np.array([len(d) for d in documents], np.int64)
    flat = np.fromiter(chain.from_iterable(documents), np.int64)
    if not len(flat):
        return
    held, often = np.unique(np.repeat(np.arange(len(documents)), lengths) * len(units) + flat, return_counts=True)
    doc, unit = np.divmod(held, len(units))
    sizes = np.frombuffer(units.sizes, np.int64)[3::4]
    n = sizes[unit]
    at = np.repeat((np.cumsum(sizes) - sizes)[unit] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    names, pair = np.unique(np.frombuffer(units.pairs, np.int64), return_inverse=True)
    key = pair[at] * BLOCK + np.asarray(places, np.int64)[np.repeat(doc, n)]
    order = np.argsort(key)
    key = key[order]
    heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    times = np.add.reduceat(np.repeat(often, n)[order], heads)
    pair, place = np.divmod(key[heads], BLOCK)
    for some, docs in compressed(pair, place):
        yield 0, pa.array(names[some]), docs
    times, plane = times - 1, 1
    while len(times):
        odd = (times & 1).astype(bool)
        for some, docs in compressed(pair[odd], place[odd]):
            yield plane, pa.array(names[some]), docs
        pair, place, times = pair[times > 1], place[times > 1], times[times > 1] >> 1
        plane += 1


def compressed(key: np.ndarray, place: np.ndarray) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """(keys, documents) for rows ordered by key and place: two bytes a place, or a bit set where there are many."""
    if not len(key):
        return
    heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    n = np.diff(np.append(heads, len(key)))
    few = n < FEW
    if few.any():
        data = place[np.repeat(few, n)].astype("<u2")
        offsets = np.concatenate(([0], np.cumsum(2 * n[few]))).astype(np.int32)
        yield key[heads[few]], pa.Array.from_buffers(pa.binary(), int(few.sum()),
                                                     [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    many = np.flatnonzero(~few)
    for i in range(0, len(many), 1024):
        some = many[i:i + 1024]
        bits = np.zeros((len(some), BLOCK), bool)
        for row, (head, count) in enumerate(zip(heads[some].tolist(), n[some].tolist())):
            bits[row, place[head:head + count]] = True
        yield key[heads[some]], pa.array([b.tobytes() for b in np.packbits(bits, axis=1, bitorder="little")], pa.binary())


def _rows(n: int, schema: str, /, **columns) -> pa.RecordBatch:
    """A batch of n rows with the given columns, the others null."""
    types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]

    def column(name: str, kind: pa.DataType) -> pa.Array:
        value = columns.get(name)
        if value is None:
            return pa.nulls(n, kind)
        if isinstance(value, pa.Array):
            return value
        return pa.array([value] * n if isinstance(value, int) else value, kind)

    return pa.RecordBatch.from_arrays([column(f, types[t]) for f, t in fields], names=[f for f, _ in fields])


def aligned(docs: DataFrame, file_a: str = FILE_A, file_b: str = FILE_B) -> DataFrame:
    """Rows of documents (doc_id, text): one for each document, and those of the postings (pair, plane, docs)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, base, done = Units(encoders(file_a, file_b)), TaskContext.get().partitionId() << 32, 0
        documents, places, ids, held = [], [], [], 0

        def sent(block: int) -> Iterator[pa.RecordBatch]:
            sizes = dict(zip(("n_a", "n_b", "n_groups", "n_links"), map(pa.array, units.totals(documents).T.copy())))
            yield _rows(len(ids), ALIGNED, block=block, place=places, doc_id=ids, **sizes, groups_sha256=[
                hashlib.sha256(";".join(map(units.groups.__getitem__, d)).encode()).hexdigest() if d else ""
                for d in documents])
            for plane, pairs, sets in postings(documents, places, units):
                yield _rows(len(pairs), ALIGNED, block=block, pair=pairs, plane=plane, docs=sets)
            documents.clear(), places.clear(), ids.clear()
            if len(units) > KEPT_UNITS:
                units.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if documents and (held > UNITS_AT_ONCE or done % BLOCK == 0):
                    yield from sent(base + (done - 1) // BLOCK)
                    held = 0
                mine = units.of(text) if text else []
                documents.append(mine if all(map(units.sound.__getitem__, mine)) else [])
                places.append(done % BLOCK)
                ids.append(doc_id)
                held, done = held + len(mine), done + 1
        if documents:
            yield from sent(base + (done - 1) // BLOCK)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ALIGNED)


def _bits(data: bytes) -> np.ndarray:
    """The bit set of a compressed plane."""
    if len(data) == BLOCK // 8:
        return np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")
    out = np.zeros(BLOCK, np.uint8)
    out[np.frombuffer(data, "<u2")] = 1
    return out


def _lengths(docs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the values of a binary array, and its data."""
    offsets = np.frombuffer(docs.buffers()[1], np.int32)[docs.offset:docs.offset + len(docs) + 1].astype(np.int64)
    data = docs.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def popcounts(docs: pa.Array) -> np.ndarray:
    """How many documents each compressed plane holds."""
    offsets, data = _lengths(docs)
    size = np.diff(offsets)
    out = size // 2
    for row in np.flatnonzero(size == BLOCK // 8).tolist():
        out[row] = int(np.bitwise_count(data[offsets[row]:offsets[row + 1]]).sum())
    return out


def merged(parts: DataFrame) -> DataFrame:
    """Rows (pair, block, plane, docs, n): the parts of a plane OR-merged, and its popcount."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last plane, which the next batch may go on with

        def out(keys: tuple, data: bytes) -> pa.RecordBatch:
            return _rows(1, MERGED, pair=keys[0], block=keys[1], plane=keys[2], docs=[data],
                         n=popcounts(pa.array([data], pa.binary())).tolist())

        for batch in batches:
            if not batch.num_rows:
                continue
            pair, block, plane = (batch.column(c).to_numpy() for c in ("pair", "block", "plane"))
            docs = batch.column("docs")
            same = (pair[1:] == pair[:-1]) & (block[1:] == block[:-1]) & (plane[1:] == plane[:-1])
            heads = np.flatnonzero(np.concatenate(([True], ~same)))
            n = np.diff(np.append(heads, len(pair)))
            first = (int(pair[0]), int(block[0]), int(plane[0]))
            if held is not None and held[0] != first:
                yield out(*held)
                held = None
            alone = n == 1
            alone[-1] = False
            alone[0] = alone[0] and held is None
            take = pa.array(heads[alone])
            some = docs.take(take)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(take) for c in ("pair", "block", "plane")), some, pa.array(popcounts(some))],
                names=[f.split()[0] for f in MERGED.split(", ")])
            for head, count in zip(heads[~alone].tolist(), n[~alone].tolist()):
                keys = (int(pair[head]), int(block[head]), int(plane[head]))
                data = [docs[k].as_py() for k in range(head, head + count)]
                if held is not None and held[0] == keys:
                    data.append(held[1])
                elif held is not None:
                    yield out(*held)
                held = (keys, data[0] if len(data) == 1 else _union(data))
        if held is not None:
            yield out(*held)

    dealt = parts.repartition("pair", "block").sortWithinPartitions("pair", "block", "plane")
    return dealt.mapInArrow(run, MERGED)


def _union(planes: list[bytes]) -> bytes:
    bits = np.bitwise_or.reduce([_bits(p) for p in planes])
    places = np.flatnonzero(bits)
    return places.astype("<u2").tobytes() if len(places) < FEW else np.packbits(bits, bitorder="little").tobytes()


def pair_counts(planes: DataFrame) -> DataFrame:
    """Rows (pair, n_docs, n_links, best): of each pair of ids its documents, its links, and whether its B id has none commoner."""
    counts = planes.groupBy("pair").agg(F.sum(F.expr("if(plane = 0, n, 0)")).alias("n_docs"),
                                        F.sum(F.expr("shiftleft(n, greatest(plane - 1, 0))")).alias("n_links"))
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    highest = counts.groupBy(b.alias("b")).agg(F.max("n_links").alias("highest"))
    return counts.join(highest, b == F.col("b")).select(
        "pair", "n_docs", "n_links", (F.col("n_links") == F.col("highest")).alias("best"))


def returned(planes: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows (block, place, n_best, count_sum): the pairs' counts brought back to the documents that hold them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, np.zeros((2, BLOCK), np.int64)

        def sent() -> pa.RecordBatch:
            place = np.flatnonzero(sums[1])
            out = _rows(len(place), SCORES, block=now, place=pa.array(place.astype(np.int32)),
                        n_best=pa.array(sums[0, place]), count_sum=pa.array(sums[1, place]))
            sums[:] = 0
            return out

        for batch in batches:
            if not batch.num_rows:
                continue
            block, plane, count = (batch.column(c).to_numpy() for c in ("block", "plane", "n_links"))
            best = batch.column("best").to_numpy(zero_copy_only=False)
            docs = batch.column("docs")
            offsets, data = _lengths(docs)
            weights = np.stack([best.astype(np.int64), count]) << np.maximum(plane.astype(np.int64) - 1, 0)
            edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
            for low, high in zip(edges, edges[1:]):
                if now is not None and block[low] != now:
                    yield sent()
                now = int(block[low])
                size = np.diff(offsets[low:high + 1])
                dense = size == BLOCK // 8
                span = data[offsets[low]:offsets[high]]
                places = span[np.repeat(~dense, size)].view("<u2")
                for k in range(2):
                    np.add.at(sums[k], places, np.repeat(weights[k, low:high][~dense], size[~dense] // 2))
                rows = np.flatnonzero(dense)
                for i in range(0, len(rows), 512):
                    some = low + rows[i:i + 512]
                    bits = np.unpackbits(np.concatenate([data[offsets[r]:offsets[r + 1]] for r in some.tolist()]),
                                         bitorder="little").reshape(len(some), BLOCK)
                    for k in range(2):
                        sums[k] += (bits * weights[k, some][:, None]).sum(axis=0)
        if now is not None:
            yield sent()

    scored = planes.join(counts.select("pair", "n_links", "best"), "pair").select("block", "plane", "docs", "n_links", "best")
    return scored.repartition("block").sortWithinPartitions("block").mapInArrow(run, SCORES)


def alignments(spark: SparkSession, docs: DataFrame, file_a: str = FILE_A, file_b: str = FILE_B) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its tokens, groups and links, and its links scored by their counts."""
    rows, rows_path = store(spark, aligned(docs, file_a, file_b), "aligned")
    planes, planes_path = store(spark, merged(rows.filter("pair is not null").select("pair", "block", "plane", "docs")),
                                "planes")
    counts, counts_path = store(spark, pair_counts(planes), "pair-counts")
    scores = returned(planes, counts)
    out = rows.filter("pair is null").select("block", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links",
                                             "groups_sha256")
    found, _ = store(spark, out.join(scores, ["block", "place"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256"), "alignments")
    for path in (rows_path, planes_path, counts_path):
        drop_stored(spark, path)
    return found


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments(spark, table(spark, sf_dir, "documents", "doc_id", "text"))
