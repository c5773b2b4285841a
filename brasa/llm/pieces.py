"""Unigram encoding and decoding by Viterbi over a double-array trie of pieces.

The pieces are those of a public vocabulary file.  Its scores are ranks, so a piece's log score is that of Zipf's law, the
logarithm of 1 / (rank + 1) over the sum of all (``log_scores``); nothing is trained.  A text becomes its pieces of largest
total score.  White space is a marker at the front of pieces: each space becomes one, and the text gets one in front,
which decoding takes away again.  A character that no piece covers costs 10 more than the rarest piece and is written as
the pieces of its bytes.  Of equal paths the one whose last piece starts first is kept, piece by piece.

A place whose two neighbouring characters stand side by side in no piece is crossed by no piece, so the best path of a
text is the best paths of its units between such places; a task remembers the units that it has met.  Which places
these are is worked out from the vocabulary.

Defined cases: null text is the empty text, which has no pieces.  Decoding gives back the text but for literal marker
characters, which become spaces.  Every row is encoded on its own; repeated rows and null ids are kept.  An empty table
gives an empty result.  Only the id and the text are read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brasa.llm.common import table

MODEL = "piece_bpe_32k.model"
MARK = chr(0x2581)
UNKNOWN_COST = 10.0
LOWEST = float("-inf")
KEPT_UNITS = 600_000
LETTERS = f"A-Za-z{chr(0xC0)}-{chr(0xD6)}{chr(0xD8)}-{chr(0xF6)}{chr(0xF8)}-{chr(0x24F)}"
CLOSERS = ",.;:!?\n'\"()-"


class DoubleArray:
    """A trie over bytes in two arrays: a child by byte b of state s is base[s] + b, if check says that s owns it."""

    def __init__(self, keys: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        ends: list[int] = [-1]
        for word, value in keys.items():
            at = 0
            for b in word:
                if b not in children[at]:
                    children[at][b] = len(children)
                    children.append({})
                    ends.append(-1)
                at = children[at][b]
            ends[at] = value
        size = len(children) + 512
        self.base, self.check, self.value = [0] * size, [-1] * size, [-1] * size
        state = [0] * len(children)
        self.check[0] = 0
        free, used = 256, 256  # the first slot that is free, and the first behind all that are taken
        for node, below in enumerate(children):  # parents come before their children
            if not below:
                continue
            while self.check[free] != -1:
                free += 1
            labels = sorted(below)
            # a lone child fills the first hole; others look around the holes for a while, then go to the end
            base = free - labels[0]
            tries = 0
            while any(base + b < len(self.check) and self.check[base + b] != -1 for b in labels):
                tries += 1
                base = base + 1 if tries != 64 or len(labels) == 1 else max(used, base)
            used = max(used, base + labels[-1] + 1)
            grow = base + 256 - len(self.check)
            if grow > 0:
                for array, fill in ((self.base, 0), (self.check, -1), (self.value, -1)):
                    array.extend([fill] * (grow + 512))
            self.base[state[node]] = base
            for b in labels:
                child = below[b]
                self.check[base + b], self.value[base + b], state[child] = state[node], ends[child], base + b
        # steps from any state stay within the arrays
        for array, fill in ((self.base, 0), (self.check, -1), (self.value, -1)):
            array.extend([fill] * 512)


class Vocabulary:
    """pieces: normal pieces with ids; byte_ids: the ids of the 256 bytes; scores by id."""

    def __init__(self, pieces: dict[str, int], byte_ids: list[int], scores: dict[int, float]):
        self.scores = scores
        self.byte_ids = byte_ids
        self.trie = DoubleArray({p.encode(): i for p, i in pieces.items()})
        self.longest = max(len(p.encode()) for p in pieces)
        self.unknown = min(scores.values()) - UNKNOWN_COST
        self.bytes_of = {i: p.encode() for p, i in pieces.items()} | {i: bytes([b]) for b, i in enumerate(byte_ids)}
        inner = {a + b for p in pieces for a, b in zip(p, p[1:])}
        safe = "".join(c for c in CLOSERS if not any(re.match(f"[{LETTERS}]", pair) and pair[1] == c for pair in inner))
        # no piece has a marker behind another character
        self.split = not any(pair[1] == MARK and pair[0] != MARK for pair in inner)
        close = f"{MARK}*[{LETTERS}]+(?=[{re.escape(safe)}])|" if safe else ""
        self.unit = re.compile(f"{close}{MARK}*[^{MARK}]+|{MARK}+")
        self.known: dict[str, tuple[bytes, float, int]] = {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "known"}

    def __setstate__(self, state):
        self.__dict__.update(state, known={})

    def best(self, unit: str) -> tuple[bytes, float, int]:
        """Ids as little-endian 32-bit numbers, their score, and how many are bytes."""
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.scores
        data = unit.encode()
        n = len(data)
        total, begins, pieces = [LOWEST] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        total[0] = 0.0
        at = 0
        while at < n:
            lead = data[at]
            width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            here, state, end, covered = total[at], 0, at, False
            for b in data[at:at + self.longest]:
                child = base[state] + b
                if check[child] != state:
                    break
                state = child
                end += 1
                piece = value[state]
                if piece >= 0:
                    if end == at + width:
                        covered = True
                    score = here + scores[piece]
                    if score > total[end]:
                        total[end], begins[end], pieces[end] = score, at, piece
            at += width
            if not covered and here + self.unknown > total[at]:
                total[at], begins[at], pieces[at] = here + self.unknown, at - width, -1
        ids, end, n_bytes = [], n, 0
        while end > 0:
            begin, piece = begins[end], pieces[end]
            if piece >= 0:
                ids.append(piece)
            else:
                n_bytes += end - begin
                ids += [self.byte_ids[b] for b in reversed(data[begin:end])]
            end = begin
        ids.reverse()
        return array("I", ids).tobytes(), total[n], n_bytes

    def encode(self, text: str | None) -> tuple[bytes, float, int]:
        if not text:
            return b"", 0.0, 0
        marked = MARK + text.replace(" ", MARK)
        units = self.unit.findall(marked) if self.split else [marked]
        known = self.known
        new = set(units).difference(known)
        if len(known) + len(new) > KEPT_UNITS:
            known.clear()
            new = set(units)
        for unit in new:
            known[unit] = self.best(unit)
        found = [known[u] for u in units]
        return b"".join([f[0] for f in found]), sum([f[1] for f in found]), sum([f[2] for f in found])

    def decode(self, ids: bytes) -> str:
        data = b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        text = data.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def log_scores(ranked: list[int]) -> dict[int, float]:
    """Zipf's law over ids from the most to the least frequent."""
    total = sum(1 / (r + 1) for r in range(len(ranked)))
    return {i: -log((r + 1) * total) for r, i in enumerate(ranked)}


@lru_cache(maxsize=2)
def vocabulary(model: str = MODEL) -> Vocabulary:
    import public_tokenizers
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
    every = range(processor.get_piece_size())
    normal = [i for i in every if not (processor.is_byte(i) or processor.is_control(i) or processor.is_unknown(i)
                                       or processor.is_unused(i))]
    byte_ids = [i for i in every if processor.is_byte(i)]
    ranked = sorted(normal, key=lambda i: (-processor.get_score(i), i))
    return Vocabulary({processor.id_to_piece(i): i for i in normal}, byte_ids, log_scores(ranked))


def encoded(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """One row per row: doc_id, ids (binary, little-endian 32-bit), score, n_byte_pieces, decoded text."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary(model))  # as large as the vocabulary file

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = known.value
        for part in parts:
            rows = [words.encode(t) for t in part["text"]]
            yield pd.DataFrame({"doc_id": part["doc_id"], "ids": [r[0] for r in rows], "score": [r[1] for r in rows],
                                "n_byte_pieces": [r[2] for r in rows], "decoded": [words.decode(r[0]) for r in rows]})

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInPandas(
        run, "doc_id long, ids binary, score double, n_byte_pieces long, decoded string")


def summary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """One row per row: doc_id, n_pieces, n_byte_pieces, score, ids_crc32, round_trip."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary(model))

    @F.pandas_udf("n_pieces long, n_byte_pieces long, score double, ids_crc32 long, round_trip boolean")
    def figures(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = known.value
        for part in parts:
            rows = []
            for t in part:
                ids, score, n_bytes = words.encode(t)
                rows.append((len(ids) // 4, n_bytes, score, zlib.crc32(ids),
                             words.decode(ids) == (t or "").replace(MARK, " ")))
            yield pd.DataFrame(rows, columns=["n_pieces", "n_byte_pieces", "score", "ids_crc32", "round_trip"])

    return docs.select(F.col(doc_id).alias("doc_id"), figures(F.col(text)).alias("f")).select("doc_id", "f.*")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(table(spark, sf_dir, "documents", "doc_id", "text"))
