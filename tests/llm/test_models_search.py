import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from brasa.llm import hamming, pieces, toxicity
from helpers_llm import SF_SMALL, frame, groups_fixture  # noqa: F401

SF_CHECK = "/root/testdata/sf0.01"


def made(n, rnd):
    """Documents of invented sentences; toxic ones hold one sentence with a bad word, which inflects."""
    words = ["".join(rnd.choice("aeioulnrst") for _ in range(rnd.randint(2, 7))) for _ in range(400)]
    rows = []
    for i in range(n):
        sentences = [[rnd.choice(words) for _ in range(rnd.randint(3, 9))] for _ in range(rnd.randint(1, 30))]
        toxic = i % 4 == 0
        if toxic:
            at = rnd.choice(sentences)
            at.insert(rnd.randrange(len(at)), rnd.choice(["vexxor", "Grumbol"]) + rnd.choice(["", "a", "ist", "ung"]))
        rows.append((i, ". ".join(" ".join(s) for s in sentences) + ".", int(toxic)))
    return rows


def test_learns_the_sentences_from_document_labels(spark, frame):
    rows = made(900, random.Random(4))
    docs = frame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = frame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    scored = toxicity.with_score(docs, model).withColumn("out", toxicity.held_out()).filter("out").collect()
    truth = {i: y for i, _, y in rows}
    assert all((r["score"] >= 0.5) == bool(truth[r["doc_id"]]) for r in scored) and len(scored) > 100
    found = toxicity.locate(docs, model).collect()
    text = {i: t for i, t, _ in rows}
    assert {r["doc_id"] for r in found} == {i for i, y in truth.items() if y}
    assert all("vexx" in r["sentence"].lower() or "grum" in r["sentence"].lower() for r in found)
    assert all(text[r["doc_id"]][r["start"]:r["stop"]] == r["sentence"] for r in found)


def test_labels_of_long_documents_are_learnt(spark, frame):
    rows = [(i, t + " 12 34." * 2000 * y, y) for i, t, y in made(600, random.Random(5))]
    docs = frame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    model = toxicity.train(docs, frame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    scored = toxicity.with_score(docs, model).withColumn("out", toxicity.held_out()).filter("out").collect()
    truth = {i: y for i, _, y in rows}
    assert all((r["score"] >= 0.5) == bool(truth[r["doc_id"]]) for r in scored) and len(scored) > 50


def test_a_toxic_document_beside_its_clean_copy_is_learnt(spark, frame):
    rnd = random.Random(6)
    clean = [t for _, t, y in made(900, rnd) if not y and t.count(".") > 3]
    rows = [(i, t, 0) for i, t in enumerate(clean)]
    rows += [(10_000 + i, t + " you " + rnd.choice(["vexxor", "grumbol"]) + " there.", 1) for i, t in enumerate(clean)
             if i % 3 == 0 and zlib.crc32(str(i).encode()) % toxicity.FOLDS]  # the clean copy is not held out
    docs = frame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    model = toxicity.train(docs, frame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    scored = toxicity.with_score(docs, model).withColumn("out", toxicity.held_out()).filter("out").collect()
    truth = {i: y for i, _, y in rows}
    assert all((r["score"] >= 0.5) == bool(truth[r["doc_id"]]) for r in scored) and len(scored) > 100


def test_copies_are_one_text_with_their_weight(spark, frame):
    docs = frame([(i, "the same" if i < 400 else f"text {i}") for i in range(1000)], "doc_id long, text string")
    texts = toxicity.labelled(docs, frame([(i, i // 990) for i in range(1000)], "doc_id long, toxic int"))
    rows = {(r["toxic"], r["text"]): (r["text_key"], r["n"]) for r in texts.collect()}
    kept = [r["doc_id"] for r in docs.filter(~toxicity.held_out()).collect()]
    key, n = rows[0, "the same"]
    assert n == sum(i < 400 for i in kept) and len(rows) == 1 + sum(i >= 400 for i in kept)
    drawn = dict(toxicity.sample(texts, 0, 50, 10 ** 9))
    assert len(drawn) == 50 and drawn[key] == n and len({w for k, w in drawn.items() if k != key}) == 1
    every = toxicity.sample(texts, 0, 10 ** 6, 10 ** 9)
    assert sum(w for _, w in every) == sum(i < 990 for i in kept)
    assert len(toxicity.sample(texts, 0, 50, 1)) == 1


def test_features_are_counted_over_all_labelled_rows(spark, frame):
    rows = made(900, random.Random(4))
    docs = frame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    counts = toxicity.feature_counts(frame([(y, t) for _, t, y in rows], "toxic int, text string")).collect()
    want = {}
    for _, t, y in rows:
        for f in {f for words in toxicity.bags(t) for w in words for f in toxicity.features(w)}:
            held = want.setdefault(f, [0, 0])
            held[0], held[1] = held[0] + 1, held[1] + y
    assert {r["feature"]: [r["held_by"], r["held_toxic"]] for r in counts} == want
    model = toxicity.train(docs, frame([(i, y) for i, _, y in rows], "doc_id long, toxic int"), fit_rows=20)
    scored = toxicity.with_score(docs, model).withColumn("out", toxicity.held_out()).filter("out").collect()
    truth = {i: y for i, _, y in rows}
    assert all((r["score"] >= 0.5) == bool(truth[r["doc_id"]]) for r in scored) and len(scored) > 100


def test_no_labels_one_class_and_odd_rows(spark, frame):
    docs = frame([(1, "a b"), (2, None), (None, ""), (2, None), (3, "x " * 50_000)], "doc_id long, text string")
    for labels, want in (([], 0.0), ([(1, 0), (2, 0), (3, 0), (4, 0)], 0.0), ([(1, None), (None, 1), (3, 7)], 0.0)):
        model = toxicity.train(docs, frame(labels, "doc_id long, toxic int"))
        got = toxicity.with_score(docs, model).collect()
        assert len(got) == 5 and all(abs(r["score"] - want) < 1e-6 for r in got)
    assert toxicity.with_score(docs.limit(0), toxicity.Model()).collect() == []
    assert toxicity.locate(docs.limit(0), toxicity.Model()).collect() == []


def test_noisy_or_is_the_product_over_sentences():
    model = toxicity.Model({"bad$": 3.0, "bad-": 1.0}, -2.0, 0.1)
    p = lambda z: 1 / (1 + np.exp(-z))
    want = 1 - 0.9 * (1 - p(2.0)) * (1 - p(-2.0)) * (1 - p(-1.0))
    assert model.score("A bad one. good! Badly") == pytest.approx(want)


def test_judged_rows_name_what_locate_finds(spark, frame):
    model = toxicity.Model({"bad$": 3.0, "bad-": 1.0}, -2.0, 0.1)
    texts = [None, "", "A bad one. good! bad", "fine.", "first\nthen bad words. bad? bad"]
    docs = frame(list(enumerate(texts)), "doc_id long, text string")
    found = {}
    for r in toxicity.locate(docs, model).collect():
        found.setdefault(r["doc_id"], []).append(r["start"])
    for r in toxicity.judged(docs, model).collect():
        assert r["score"] == pytest.approx(model.score(texts[r["doc_id"]]))
        places = found.get(r["doc_id"], [])
        assert (r["n_offending"], r["first_offending"]) == (len(places), min(places, default=None))
    assert toxicity.judged(docs.limit(0), model).collect() == []


def test_query_op6_on_held_out_rows(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect()}
    rows = toxicity.op6(spark, SF_CHECK).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    out = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good = [a > b for a, y in out if y for b, z in out if not z]
    assert sum(good) / len(good) > 0.8
    assert sum(r["predicted"] for r in rows if r["held_out"] and labels.get(r["doc_id"]) == 0) == 0


def brute(rows, asking, k):
    out = set()
    rows = sorted(set(rows))
    for q, code in rows:
        if asking(q):
            near = sorted((bin((code ^ c) & (2 ** 64 - 1)).count("1"), i, c) for i, c in rows if (i, c) != (q, code))
            out |= {(q, i, d, n + 1) for n, (d, i, _) in enumerate(near[:k])}
    return out


def test_top_k_is_exact(spark, frame):
    rnd = random.Random(8)
    signed = lambda code: code - 2 ** 64 if code >= 2 ** 63 else code
    rows = [(i, signed(rnd.getrandbits(64))) for i in range(300)] + [(1000 + i, 77) for i in range(40)]
    rows += [(2000 + i, signed(77 ^ (1 << rnd.randrange(64)))) for i in range(40)] + [(5, 123)] * 3
    for k in (1, 10):
        got = hamming.nearest(spark, frame(rows, "id long, code long"), F.col("id") % 20 == 0, k)
        assert {tuple(r) for r in got.collect()} == brute(rows, lambda i: i % 20 == 0, k)


def test_top_k_few_rows_and_empty(spark, frame):
    few = frame([(0, 5), (20, 4000), (3, 5)], "id long, code long")
    assert {tuple(r) for r in hamming.nearest(spark, few, F.col("id") % 20 == 0, 10).collect()} == brute(
        [(0, 5), (20, 4000), (3, 5)], lambda i: i % 20 == 0, 10)
    assert hamming.nearest(spark, few.limit(0), F.col("id") % 20 == 0).collect() == []
    odd = frame([(1, None), (2, []), (3, [1.0, None]), (4, [float("inf")]), (None, [1.0, 2.0]), (6, [1.0, 2.0])],
                "vec_id long, embedding array<float>")
    assert [r["id"] for r in hamming.codes(odd).collect()] == [6]


def recall(vectors, codes, asking, k=10):
    """The share of the k nearest by cosine that are among the k nearest by code."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    found = 0
    for q in asking:
        by_cosine = np.argsort(-(unit @ unit[q]), kind="stable")
        by_code = np.argsort(np.bitwise_count((codes ^ codes[q]).view(np.uint64)), kind="stable")
        found += len(set(by_cosine[by_cosine != q][:k].tolist()) & set(by_code[by_code != q][:k].tolist()))
    return found / (k * len(asking))


def test_wider_codes_find_more_of_the_nearest(spark):
    rows = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet")
    code = {r["id"]: r["code"] for r in hamming.codes(rows).collect()}
    kept = [r for r in rows.orderBy("vec_id").collect() if r["vec_id"] in code]
    vectors, codes = np.array([r["embedding"] for r in kept]), np.array([code[r["vec_id"]] for r in kept], np.int64)
    asking = range(0, len(kept), 20)
    assert recall(vectors, codes, asking) > recall(vectors, codes & 0xFFFFFFFF, asking) + 0.03


def test_query_op5(spark):
    rows = [(r["id"], r["code"]) for r in hamming.codes(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")).collect()]
    assert {tuple(r) for r in hamming.op5(spark, SF_SMALL).collect()} == brute(rows, lambda i: i % 100 == 0, 10)


def library(known):
    """The library's own unigram encoder over the same pieces and scores."""
    import public_tokenizers
    import sentencepiece
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = pb.ModelProto()
    with open(public_tokenizers.path(pieces.MODEL), "rb") as f:
        model.ParseFromString(f.read())
    for i, piece in enumerate(model.pieces):
        piece.score = known.scores.get(i, piece.score)
    model.trainer_spec.model_type = 1
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def test_pieces_have_the_librarys_score(spark):
    known = pieces.vocabulary()
    encoder, rnd = library(known), random.Random(1)
    texts = [r["text"][:400] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    letters = ["a", "b", "c", " ", "  ", "é", "ß", ",", ".", chr(0x2581), chr(0x65E5), "\n", "\t", chr(0x1F600), "the", "'", "-"]
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(2000)]
    total = lambda ids: sum(known.scores.get(i, known.unknown) for i in ids)
    for text in texts:
        ids = np.frombuffer(known.encode(text)[0], "<u4").tolist()
        own = encoder.encode(text)
        assert ids == own or total(ids) == pytest.approx(total(own), abs=1e-2)  # equal paths may be told apart by rounding
        assert known.decode(known.encode(text)[0]) == text.replace(chr(0x2581), " ")


def test_double_array_finds_what_it_holds():
    keys = {bytes([a, b, c][:n]): i for i, (a, b, c, n) in enumerate(
        (a, b, c, n) for a in range(0, 256, 17) for b in (0, 9, 255) for c in (1, 254) for n in (1, 2, 3))}
    trie = pieces.DoubleArray(keys)
    for key in [*keys, b"\x05", b"\x00\x00\x02"]:
        state, found = 0, True
        for b in key:
            child = trie.base[state] + b
            found = found and trie.check[child] == state
            state = child if found else 0
        assert (trie.value[state] if found else -1) == keys.get(key, -1)


def test_pieces_of_odd_rows(spark, frame):
    docs = frame([(1, None), (None, ""), (2, "a b"), (2, "a b"), (3, "word " * 40_000)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_pieces"], r["round_trip"]) for r in pieces.summary(docs).collect())
    assert got[:4] == [(0, 0, True), (1, 0, True), (2, 2, True), (2, 2, True)] and got[4][2]
    assert [r["decoded"] for r in pieces.encoded(docs.filter("doc_id = 2")).collect()] == ["a b"] * 2
    assert pieces.summary(docs.limit(0)).collect() == []


def test_query_op10(spark):
    got = {r["doc_id"]: r for r in pieces.op10(spark, SF_SMALL).collect()}
    known = pieces.vocabulary()
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        ids, score, n_bytes = known.encode(r["text"])
        own = got[r["doc_id"]]
        assert (own["n_pieces"], own["n_byte_pieces"], own["round_trip"]) == (len(ids) // 4, n_bytes, True)
        assert own["score"] == pytest.approx(score)
