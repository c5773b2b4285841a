import hashlib
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
import pytest

from brasa.llm import suffixes
from helpers_llm import SF_SMALL, frame, groups_fixture  # noqa: F401


def expected(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        left = bytes(np.frombuffer(d, np.uint8)[~gone])
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return out


def corpus():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6)))
    base = [" ".join(word() for _ in range(120)) for _ in range(8)]
    texts = [None, "", "x", base[0], base[0], "a" * 700, "ab" * 300, base[1] + base[2], base[3]]
    for _ in range(40):
        t, u = rnd.choice(base), rnd.choice(base)
        a, b = sorted((rnd.randrange(len(t)), rnd.randrange(len(t))))
        chars = list(" ".join(word() for _ in range(rnd.randint(0, 40))) + t[a:b] + word() + u[rnd.randrange(200):][:300])
        for _ in range(rnd.randint(0, 3)):
            chars[rnd.randrange(len(chars))] = "Z"
        texts.append("".join(chars))
    return texts


@pytest.mark.parametrize("length,key,chunk", [(200, 64, 30_000), (40, 16, 30_000), (40, 16, 7)])
def test_removed_bytes(spark, frame, length, key, chunk):
    texts = corpus()
    docs = frame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, key string")
    got = suffixes.removed(spark, docs, length=length, key=key, suffixes=chunk).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == expected(texts, length)


@pytest.mark.parametrize("shares", [1, 7, 4096])
def test_kinds_go_back_to_surroundings_of_hot_keys(spark, monkeypatch, shares):
    monkeypatch.setattr(suffixes, "SHARES", shares)
    rows = [(0 if i % 3 else i // 30, i, i % 5) for i in range(3000)]                 # one key has two thirds of the rows
    around = spark.createDataFrame(rows, "h long, c long, n long")
    open_ = around.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 5 and h % 2 = 0")
    sizes = Counter(h for h, _, _ in rows)
    got = suffixes._with_kinds(around, open_)
    assert got.columns == ["h", "c", "n", "kinds"]
    assert sorted(map(tuple, got.collect())) == sorted((*r, sizes[r[0]]) for r in rows if sizes[r[0]] > 5 and r[0] % 2 == 0)
    assert suffixes._with_kinds(around.limit(0), open_.limit(0)).collect() == []


def test_long_text_is_read_in_pieces(monkeypatch):
    rnd = np.random.default_rng(2)
    data = rnd.integers(97, 123, 9000).astype(np.uint8)
    whole = suffixes.anchors(data, 50, 20)
    monkeypatch.setattr(suffixes, "PIECE", 700)
    pieces = suffixes.anchors(data, 50, 20)
    assert all((a == b).all() for a, b in zip(whole, pieces))


def test_maximal_repeats_hold_all_occurrences():
    found = suffixes.maximal_repeats(np.zeros(4, int), [b"abcd", b"abce", b"abce", b"abx"],
                                     [b"zyk", b"zyk", b"q", b"zyw"], length=4, key=1)
    assert {(i, l, d) for i, l, d in found} == {(0, 3, 3), (1, 3, 3), (1, 0, 4), (2, 0, 4), (3, 2, 2)}


def test_without_repeats_keeps_columns_and_rows(spark, frame):
    text = "é" * 50 + "the same two hundred bytes " * 9
    docs = frame([(1, "start " + text, "a"), (2, "other " + text, "b"), (3, None, None), (None, "alone", "c"), (4, "", "d")],
                 "doc_id long, text string, cut string").withColumns({n: F.lit(n) for n in ("own", "_none", "none", "of")})
    cut = suffixes.without_repeats(spark, docs)
    assert cut.columns == docs.columns
    got = {tuple(r) for r in cut.collect()}
    assert got == {(i, t, c, "own", "_none", "none", "of") for i, t, c in (
        (1, "start", "a"), (2, "other", "b"), (3, None, None), (None, "alone", "c"), (4, "", "d"))}


def test_empty_table(spark, frame):
    assert suffixes.removed(spark, frame([], "doc_id long, text string")).collect() == []


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()
    got = suffixes.op9(spark, SF_SMALL).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == expected([r["text"] for r in rows], 200)
