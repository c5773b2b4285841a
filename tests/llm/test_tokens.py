import random
import zlib

import numpy as np
import pytest

from brasa.llm import packing, token_counts, vocabulary
from helpers_llm import SF_SMALL, frame, groups_fixture  # noqa: F401

ODD = ["", None, " ", "a", "x" * 9000, "hello<|endoftext|> world", "l'été's 've  \n\n  x " + chr(0xA0) + "y" + chr(0x3000)
       + "z " + chr(0x200B) + ".", "don't\tstop 123abc ", "ab " * 5000, "<|startoftext|> x", "e" + chr(0x301) + " " + chr(0x301)]


def texts(spark):
    return [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()]


def test_units_keep_the_ids():
    rnd = random.Random(3)
    letters = [chr(c) for c in [*range(1, 0x7F), *range(0xA0, 0x180), 0x2009, 0x3042, 0x1F600]] + [" "] * 60 + ["'s", "<|endoftext|>"]
    for _ in range(3000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30)))
        for name in ("byte_bpe_50k", "word_bpe_49k"):
            known = vocabulary.words(f"{name}.json")
            assert known.encode(text) == known.encode_whole(text), (name, text)
        assert known.count(text) == len(known.encode_whole(text)) // 4
        assert vocabulary.ranks("byte_bpe_50k").encode(text) == vocabulary.words("byte_bpe_50k.json").encode_whole(text)


@pytest.mark.parametrize("chunk,overlap", [(2000, 16), (300, 40), (32768, 512)])
def test_counts_are_the_librarys(spark, frame, chunk, overlap):
    every = ODD + texts(spark)[:60]
    docs = frame([(i, t, "k") for i, t in enumerate(every)], "doc_id long, text string, key string")
    got = token_counts.token_counts(spark, docs, chunk=chunk, overlap=overlap, limit=50).orderBy("doc_id").collect()
    codes = vocabulary.tokenizer("word_bpe_49k.json")
    want = [len(codes.encode(t or "", add_special_tokens=False).ids) for t in every]
    assert [tuple(r) for r in got] == [(i, len((t or "").encode()), n, n > 50) for i, (t, n) in enumerate(zip(every, want))]


def test_boundaries_without_white_space(spark, frame):
    """Ideographs and kana with their own marks; a text without any boundary; one failing overlap among many chunks."""
    rnd = random.Random(7)
    letters = [chr(c) for c in (*range(0x4E00, 0x4E60), *range(0x3042, 0x3060))]
    marks = [chr(0x3002), chr(0xFF0C), chr(0x3001)]
    asian = "".join(rnd.choice(marks if rnd.random() < 0.06 else letters) for _ in range(4000))
    mixed = "some words, and more. " * 200 + "x" * 900 + " the end of it " * 150
    every = [asian, "".join(rnd.choice(letters) for _ in range(1500)), mixed]
    codes = vocabulary.tokenizer("word_bpe_49k.json")
    got = token_counts.token_counts(spark, frame(list(enumerate(every)), "doc_id long, text string"), chunk=250, overlap=30)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got.collect()) == [
        (i, len(codes.encode(t, add_special_tokens=False).ids)) for i, t in enumerate(every)]


def test_only_chunks_beside_a_failed_overlap_are_encoded_again(spark, frame, monkeypatch):
    encoded = []
    reports = token_counts._reports
    monkeypatch.setattr(token_counts, "_reports", lambda chunks, name: encoded.append(chunks.count()) or reports(chunks, name))
    text = "word " * 400 + "x" * 130 + " word" * 400
    got = token_counts.token_counts(spark, frame([(1, text)], "doc_id long, text string"), chunk=200, overlap=20).collect()
    assert got[0]["n_tokens"] == len(vocabulary.tokenizer("word_bpe_49k.json").encode(text, add_special_tokens=False).ids)
    assert encoded[0] == len(text) // 200 + 1 and len(encoded) > 1 and max(encoded[1:]) <= 2


def test_counts_of_repeated_rows_and_empty_table(spark, frame):
    docs = frame([(None, "a b " * 300), (1, "a b " * 300), (1, "a b " * 300), (2, None)], "doc_id long, text string")
    got = token_counts.token_counts(spark, docs, chunk=100, overlap=8).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in got) == [(0, 600), (1, 600), (1, 600), (2, 0)]
    assert token_counts.token_counts(spark, frame([], "doc_id long, text string")).collect() == []


def checked(pieces, ids_of, size):
    by_doc, by_window = {}, {}
    for p in pieces:
        ids = ids_of[p["doc_id"]]
        assert p["doc_tokens"] == len(ids) and p["length"] > 0
        assert p["ids_crc32"] == zlib.crc32(ids[p["start"]:p["start"] + p["length"]].tobytes())
        by_doc.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
        by_window.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for doc, ids in ids_of.items():
        at = 0
        for start, length in sorted(by_doc[doc]):
            assert start == at
            at += length
        assert at == len(ids)
    for window, parts in by_window.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == size or window == max(by_window)
    assert sorted(by_window) == list(range(len(by_window)))


def nodes_above(total_of):
    """How many branching nodes each source has above it: the depth that bounds its distance from its share."""
    return 3 * max(1, len(total_of)).bit_length() + 3


@pytest.mark.parametrize("size", [2048, 64])
def test_packing(spark, frame, size):
    every = ODD + texts(spark)
    docs = frame([(i, t, None if i % 7 == 0 else f"s{i % 5}" if i % 3 else "hot", 0) for i, t in enumerate(every)],
                 "doc_id long, text string, source string, part int").repartition(3)
    pieces = packing.pack(spark, docs, size=size).collect()
    codes = vocabulary.tokenizer("byte_bpe_50k.json")
    ids = {i: np.array(codes.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4") for i, t in enumerate(every)}
    checked(pieces, ids, size)
    in_proportion(pieces, size)


def in_proportion(pieces, size):
    """Each source is near its share after every window."""
    total_of, sent, by_window = {}, {}, {}
    for p in pieces:
        total_of[p["source"]] = total_of.get(p["source"], 0) + p["length"]
        by_window.setdefault(p["sequence_id"], []).append(p)
    total = sum(total_of.values())
    for window in range(max(by_window)):
        for p in by_window[window]:
            sent[p["source"]] = sent.get(p["source"], 0) + p["length"]
        for s, n in total_of.items():
            assert abs(sent.get(s, 0) - n / total * size * (window + 1)) <= nodes_above(total_of)


def test_a_thousand_sources(spark, frame, monkeypatch):
    rows = [(i, f"text {i} " * (1 + i % 23), f"host{i % 1000}") for i in range(4000)]
    docs = frame(rows, "doc_id long, text string, source string").repartition(6)
    pieces = packing.pack(spark, docs, size=512).collect()
    codes = vocabulary.tokenizer("byte_bpe_50k.json")
    ids = {i: np.array(codes.encode(t, add_special_tokens=False).ids + [1], dtype="<u4") for i, t, _ in rows}
    checked(pieces, ids, 512)
    assert len({p["source"] for p in pieces}) == 1000
    in_proportion(pieces, 512)
    monkeypatch.setattr(packing, "BROADCAST_ROWS", 0)  # the join without a broadcast places all pieces alike
    assert sorted(map(tuple, packing.pack(spark, docs, size=512).drop("sequence_id", "offset").collect())) == sorted(
        tuple(x for k, x in enumerate(p) if k not in (5, 6)) for p in pieces)


def test_shares_are_exact_at_every_size():
    rnd = random.Random(6)
    for bits in (3, 20, 31, 32, 46, 55, 60):
        everything = rnd.getrandbits(bits) | 1 << (bits - 1)
        left = rnd.randint(0, everything)
        tokens = [0, everything, *[rnd.randint(0, everything) for _ in range(200)]]
        got = packing.share_of(np.array(tokens, np.int64), left, everything)
        assert got.tolist() == [t * left // everything for t in tokens]


def test_windows_of_large_queues():
    for factor in (1, 10 ** 9, 10 ** 12):
        whole, mine = 1700 * factor, 300 * factor
        queue = packing.Queue(whole, mine, [(whole, 800 * factor, False), (800 * factor, 500 * factor, True)])
        places = np.array([0, 1, mine // 3, mine // 2 + 7, mine - 1], np.int64)
        windows = queue.window_of(places, 64)
        for place, w in zip(places.tolist(), windows.tolist()):
            low, high = (int(queue.sent(np.array([min(x * 64, whole)], np.int64))[1][0]) for x in (w, w + 1))
            assert low <= place < high


def test_packing_repeated_rows_and_empty_table(spark, frame):
    schema = "doc_id long, text string, source string"
    assert packing.pack(spark, frame([], schema)).collect() == []
    got = packing.pack(spark, frame([(None, "a", "s"), (None, "a", "s"), (1, None, None)], schema)).collect()
    assert sorted((p["doc_id"] or 0, p["start"], p["length"], p["doc_tokens"]) for p in got) == [
        (0, 0, 2, 2), (0, 0, 2, 2), (1, 0, 1, 1)]
    assert sorted(x for p in got for x in range(p["offset"], p["offset"] + p["length"])) == [0, 1, 2, 3, 4]
    assert {p["sequence_id"] for p in got} == {0}


def test_query_op8(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    codes = vocabulary.tokenizer("byte_bpe_50k.json")
    ids = {r["doc_id"]: np.array(codes.encode(r["text"] or "", add_special_tokens=False).ids + [1], dtype="<u4") for r in rows}
    checked(packing.op8(spark, SF_SMALL).collect(), ids, 2048)


def test_query_op4(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    codes = vocabulary.tokenizer("word_bpe_49k.json")
    want = {(r["doc_id"], len(codes.encode(r["text"] or "", add_special_tokens=False).ids)) for r in rows}
    assert {(r["doc_id"], r["n_tokens"]) for r in token_counts.op4(spark, SF_SMALL).collect()} == want
