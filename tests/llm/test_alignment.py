import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa

from brasa.llm import alignment
from helpers_llm import SF_SMALL, frame, groups_fixture  # noqa: F401

MARK = chr(0x2581)
ODD = ["", None, " ", "  ", "\n", "a", f"x{MARK}y", "a\r\nb\r c'\r", "  x  " + chr(0x3000) + "y", "<s> </s><|endoftext|> x",
       "x" * 500 + " y " + "z" * 300, "\ta\t\tb \n\n c\t\n\nd  ", "é é " + chr(0x301) + "x", chr(0x1F600) + " " + chr(0x200D),
       chr(0) + "a " + chr(0), " lead", "trail \n", "ab " * 5000, "a" + chr(0xA0) + "b " + chr(0x85)]


def brute(texts):
    """The query's columns behind the id, from the libraries' ids of whole texts."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a_file = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_file.encode_special_tokens = True
    b_file = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    known = alignment.encoders(alignment.FILE_A, alignment.FILE_B)
    docs = []
    for text in texts:
        docs.append(None)
        if not text:
            continue
        data = f" {text}".encode()
        a, b = a_file.encode(f" {text}", add_special_tokens=False).ids, b_file.encode(text)
        of_a, of_b = [known.bytes_a[i] for i in a], [known.bytes_b[i] for i in b]
        if b"".join(of_a) != data or b"".join(of_b) != data:
            continue
        end_a, end_b = (np.cumsum([len(x) for x in parts]) for parts in (of_a, of_b))
        start_b = end_b - [len(x) for x in of_b]
        links = [(a[k], b[j]) for k in range(len(a))
                 for j in range(np.searchsorted(end_b, end_a[k] - len(of_a[k]), "right"), np.searchsorted(start_b, end_a[k]))]
        cuts = np.intersect1d(end_a, end_b)
        groups = [([], []) for _ in cuts]
        for side, ids, ends in ((0, a, end_a), (1, b, end_b)):
            for at, i in zip(np.searchsorted(cuts, ends), ids):
                groups[at][side].append(str(i))
        told = ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in groups)
        docs[-1] = (len(a), len(b), len(cuts), links, hashlib.sha256(told.encode()).hexdigest())
    counts = Counter(link for d in docs if d for link in d[3])
    highest = {}
    for (_, y), n in counts.items():
        highest[y] = max(n, highest.get(y, 0))
    return [(0, 0, 0, 0, 0, 0, "") if d is None else
            (*d[:3], len(d[3]), sum(counts[x] == highest[x[1]] for x in d[3]), sum(counts[x] for x in d[3]), d[4]) for d in docs]


def held(spark, docs):
    return sorted((tuple(r) for r in alignment.alignments(spark, docs).collect()), key=str)


def test_alignments_of_odd_texts(spark, frame):
    rows = [*enumerate(ODD), (3, "a"), (None, "a b"), (None, "a b")]
    want = sorted(((i, *r) for (i, _), r in zip(rows, brute([t for _, t in rows]))), key=str)
    docs = frame([(i, t, "c") for i, t in rows], "doc_id long, text string, pair string")
    assert held(spark, docs.repartition(3)) == want
    assert held(spark, frame([], "doc_id long, text string")) == []


def test_parts_of_blocks_and_common_pairs(spark, frame, monkeypatch):
    """Blocks that many tasks' parts make up, and pairs in so many documents that their planes are bit sets."""
    words = ["the", "naïve", "tokens", "overlap123", "x.y", "don't", "of", "and"]
    texts = [" ".join(words[(i * k) % 8] for k in range(1 + i % 9)) + " the" * (i % 13) for i in range(700)]
    docs = frame(list(enumerate(texts)), "doc_id long, text string")
    rows = alignment.aligned(docs.coalesce(1)).filter("pair is not null").select("pair", "block", "plane", "docs")
    whole = {tuple(r)[:3]: bytes(r["docs"]) for r in rows.collect()}
    assert any(len(x) == alignment.BLOCK // 8 for x in whole.values())
    parts = [(*key, bytes(piece)) for key, x in whole.items() for piece in halves(x)]
    spark_parts = spark.createDataFrame(parts, "pair long, block long, plane int, docs binary")
    got = {tuple(r)[:3]: (bytes(r["docs"]), r["n"]) for r in alignment.merged(spark_parts).collect()}
    assert got == {k: (x, int(alignment._bits(x).sum())) for k, x in whole.items()}
    assert held(spark, docs) == sorted(((i, *r) for i, r in enumerate(brute(texts))), key=str)
    counted = alignment.pair_counts(alignment.merged(spark_parts)).collect()
    known = alignment.encoders(alignment.FILE_A, alignment.FILE_B)
    the_a, the_b = known.ids_a(" the")[0], known.ids_b([" the"])[0][0]
    the = next(r for r in counted if r["pair"] == the_a << 32 | the_b)
    assert the["n_docs"] == sum("the" in t.split() for t in texts)
    assert the["n_links"] == sum(t.split().count("the") for t in texts)


def halves(data):
    """Two overlapping parts of a plane."""
    places = np.flatnonzero(alignment._bits(data))
    for some in (places[:2 * len(places) // 3 + 1], places[len(places) // 3:]):
        for _, docs in alignment.compressed(np.zeros(len(some), np.int64), some):
            yield docs[0].as_py()


def test_popcounts():
    planes = [np.arange(n).astype(np.int64) for n in (1, 5, alignment.FEW - 1, alignment.FEW, 3000, alignment.BLOCK)]
    data = [docs[0].as_py() for p in planes for _, docs in alignment.compressed(np.zeros(len(p), np.int64), p)]
    assert alignment.popcounts(pa.array(data, pa.binary())).tolist() == [len(p) for p in planes]
    assert alignment.popcounts(pa.array(data, pa.binary())[2:5]).tolist() == [len(p) for p in planes[2:5]]


def test_query_op12(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = sorted((i, *r) for (i, _), r in zip(rows, brute([t for _, t in rows])))
    assert sorted(tuple(r) for r in alignment.op12(spark, SF_SMALL).collect()) == want
