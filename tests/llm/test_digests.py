import hashlib
import random

import numpy as np

from brasa.llm import digests
from helpers_llm import SF_SMALL, frame, groups_fixture  # noqa: F401


def brute_digest(data):
    """The digest by counting one window after the other."""
    if not data:
        return bytes(digests.HEAD + 64)
    padded, counts, low = bytes(4) + data, [0] * 256, 0xFFFFFFFF
    multipliers = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)
    for end in range(4, len(padded)):
        for salt, (_, i, j) in enumerate(digests.TRIPLETS):
            third = (padded[end - j] * multipliers[j] & low) ^ (salt * 0x632BE5AB & low)
            h = (padded[end] * multipliers[0] + padded[end - i] * multipliers[i] + third) & low
            counts[((h ^ (h >> 15)) * 0x2C1B3C6D & low) >> 24] += 1
    q1, q2, q3 = (sorted(counts)[k] for k in (63, 127, 191))
    bits = "".join(format((c > q1) + (c > q2) + (c > q3), "02b") for c in counts)
    import zlib
    head = [zlib.crc32(data) & 0xFF, min(255, round(8 * float(np.log2(len(data) + 1)))),
            *[100 * q // max(q3, 1) * 15 // 100 for q in (q1, q2)]]
    return bytes(head) + int(bits, 2).to_bytes(64, "big")


def test_digest_is_that_of_single_windows():
    rnd = random.Random(4)
    texts = [b"a", b"ab", b"abc", b"aaaaaaaaaaaa", bytes(300)] + [rnd.randbytes(rnd.randint(1, 900)) for _ in range(30)]
    for t in texts:
        assert digests.digest(t) == brute_digest(t)
    long = b"some words of a long text " * 9000  # counted in several blocks
    assert len(long) > 3 * digests.BLOCK and digests.digest(long) == brute_digest(long)


def test_difference_is_bounded_and_symmetric():
    rnd = random.Random(8)
    prints = [digests.digest(t) for t in [b"", b"a", b"x" * 10 ** 6] + [rnd.randbytes(n) for n in range(1, 400, 9)]]
    for one in prints:
        for other in prints:
            assert 0 <= digests.difference(one, other) == digests.difference(other, one) <= digests.MOST
            assert (digests.likeness(one, other) == 1.0) == (one == other)
    text = " ".join(rnd.choice(["alpha", "beta", "gamma", "delta", "omega"]) + str(rnd.randint(0, 99)) for _ in range(500))
    near = digests.likeness(digests.digest(text.encode()), digests.digest(text.replace("alpha7", "kappa").encode()))
    assert near > digests.likeness(digests.digest(text.encode()), digests.digest(rnd.randbytes(len(text)))) + 0.2


def wanted(rows):
    """Rows by id; null ids first, equal ids in any order that the caller settles."""
    out = []
    for k, (doc_id, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1] or ""
        text = text or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + following[:half]
        mine, new, after = (digests.digest(t.encode()) for t in (text, changed, following))
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), mine.hex(), new.hex(),
                    digests.likeness(mine, new), digests.likeness(mine, after)))
    return out


def test_followers_across_ranges(spark, frame):
    rnd = random.Random(1)
    rows = [(None, "first of all"), *[(i * 7 - 300, "".join(rnd.choice("abcdé " + chr(0x1F600)) for _ in range(rnd.randint(0, 90))))
                                     for i in range(180)], (10 ** 12, None), (10 ** 12 + 1, "x" * 200000), (10 ** 12 + 2, "")]
    shuffled = rnd.sample(rows, len(rows))
    docs = frame([(i, t, 1, 2) for i, t in shuffled], "doc_id long, text string, range int, tie int").repartition(5)
    for ranges in (1, 2, 40):
        got = digests.followers(spark, docs, ranges=ranges)
        assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(wanted(rows), key=str)


def test_repeated_rows_single_rows_and_empty_table(spark, frame):
    schema = "doc_id long, text string"
    assert digests.followers(spark, frame([], schema)).collect() == []
    assert [tuple(r) for r in digests.followers(spark, frame([(3, "abcdef")], schema)).collect()] == wanted([(3, "abcdef")])
    copies = [(1, "one text")] * 300 + [(2, "another")]
    got = [tuple(r) for r in digests.followers(spark, frame(copies, schema).repartition(4), ranges=20).collect()]
    assert sorted(got) == sorted(wanted(copies))


def test_query_op11(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in
                  spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())
    got = [tuple(r) for r in digests.op11(spark, SF_SMALL).collect()]
    assert sorted(got) == sorted(wanted(rows))
    by_text = {}
    for (_, text), r in zip(rows, sorted(got)):
        assert by_text.setdefault(text, r[3]) == r[3]
    assert np.mean([r[5] > r[6] for r in got]) > 0.95
