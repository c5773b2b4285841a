import hashlib
import random
import zlib

from brasa.llm import periodic
from helpers_llm import SF_SMALL, frame, groups_fixture  # noqa: F401


def brute(words, least=24, powers=3):
    """Runs as (start, length, period): every period tried at every place, the smallest period of equal ends kept."""
    found = {}
    for q in range(1, len(words) // powers + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, powers * q):
                found.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def row(doc_id, words):
    runs = brute(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def block(rnd, depth, letters):
    if not depth:
        return [rnd.choice(letters).encode() for _ in range(rnd.randint(1, 9))]
    out = []
    for _ in range(rnd.randint(1, 3)):
        out += block(rnd, depth - 1, letters) * rnd.choice([1, 1, 2, 3, 4, 7])
    return out


def test_runs_of_nested_repeats():
    rnd = random.Random(11)
    short, long = [b"b"], [b"b", b"a"]
    while len(long) < 700:
        short, long = long, long + short
    almost = (["x"] * 30 + ["y"]) * 6 + ["x"] * 40
    documents = [long, [b"a"] * 600, [], [b"a"], [w.encode() for w in almost]]
    documents += [block(rnd, rnd.randint(0, 3), "abcd"[:rnd.randint(1, 4)])[:800] for _ in range(500)]
    got = periodic.runs_of_documents(documents)
    assert [[tuple(r) for r in runs.tolist()] for runs in got] == [brute(d) for d in documents]
    assert sum(map(len, got)) > 300
    for d, runs in zip(documents[:40], got):  # the same alone as among others
        assert periodic.runs_of_documents([d])[0].tolist() == runs.tolist()


def test_periods_of_every_scale():
    rnd = random.Random(2)
    for q in [*range(1, 40), 63, 64, 65, 127, 128, 200, 511]:
        unit = [str(rnd.random()).encode() for _ in range(q)]
        before, after = [b"v"] * 2, [b"w"]
        for length in (max(24, 3 * q), max(24, 3 * q) + q // 2 + 1, max(24, 3 * q) - 1):
            words = before + (unit * (length // q + 1))[:length] + after
            assert [tuple(r) for r in periodic.runs_of_documents([words])[0].tolist()] == brute(words)


def test_rows(spark, frame):
    repeated = " ".join(["a b c"] * 12)
    rows = [(1, None, "k"), (2, "", "k"), (3, " \n\t ", "k"), (4, repeated, "k"), (4, repeated, "k"), (None, repeated, "k"),
            (5, "x" * 100000, "k"), (6, "a" + chr(0xA0) + "b " * 40, "k")]
    docs = frame(rows, "doc_id long, text string, length string")
    got = sorted((tuple(r) for r in periodic.periodic_runs(docs).collect()), key=str)
    assert got == sorted((row(i, periodic.split((t or "").encode())) for i, t, _ in rows), key=str)
    assert periodic.periodic_runs(frame([], "doc_id long, text string")).collect() == []


def test_query_op13(spark):
    want = []
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        words = (r["text"] or "").encode().split()
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        want.append(row(r["doc_id"], words))
    got = [tuple(r) for r in periodic.op13(spark, SF_SMALL).collect()]
    assert sorted(got) == sorted(want)
    assert sum(r[1] > 0 for r in got) > 5
