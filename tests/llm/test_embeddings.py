import numpy as np

from brasa.llm import embeddings
from helpers_llm import SF_SMALL, frame, groups_fixture  # noqa: F401


def expected(groups, ids, vectors, least=0.95):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    found, degree = groups(len(ids)), [0] * len(ids)
    for i in range(len(ids)):
        for j in range(i):
            if ok[i] and ok[j] and len(vectors[i]) == len(vectors[j]):
                a, b = (np.array(vectors[k], dtype=float) / np.abs(vectors[k]).max() for k in (i, j))
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= least:
                    found.link(i, j)
                    degree[i] += 1
                    degree[j] += 1
    least_id = {}
    for i, own in enumerate(ids):
        if own is not None:
            least_id[found.root(i)] = min(least_id.get(found.root(i), own), own)
    return [(own, degree[i], least_id.get(found.root(i)), own == least_id.get(found.root(i))) for i, own in enumerate(ids)]


def cloud(rng, n, dims, families):
    centres = rng.normal(size=(families, dims))
    return (centres[rng.integers(0, families, n)] + rng.normal(size=(n, dims)) * 0.12).tolist()


def key(row):
    return tuple((x is None, x) for x in row)


def test_small_chunks_and_edge_cases(spark, groups, frame):
    rng = np.random.default_rng(3)
    vectors = cloud(rng, 90, 64, 9) + [None, [], [0.0] * 64, [1.0] * 63 + [float("nan")], [None] + [1.0] * 63,
                                       [1e300] * 64, [1e-300] * 64, [1.0, 2.0], [2.0, 4.0], [1.0] * 64]
    ids = list(range(1000, 1000 + len(vectors) - 1)) + [None]
    rows = frame(list(zip(ids, vectors, ids)), "vec_id long, embedding array<double>, node long")
    for side in (embeddings.SIDE, 5):
        got = embeddings.near_duplicates(spark, rows, side=side).collect()
        want = expected(groups, ids, vectors)
        assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_repeated_rows_and_empty_table(spark, frame):
    schema = "vec_id long, embedding array<float>"
    got = embeddings.near_duplicates(spark, frame([(2, [1.0, 0.0]), (2, [1.0, 0.0]), (1, [1.0, 0.01])], schema)).collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1, True), (2, 1, 1, False), (2, 1, 1, False)]
    assert embeddings.near_duplicates(spark, frame([], schema)).collect() == []


def test_query_against_brute_force(spark, groups):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    want = expected(groups, [r["vec_id"] for r in rows], [r["embedding"] for r in rows])
    assert sorted(map(tuple, embeddings.op1(spark, SF_SMALL).collect())) == sorted(want)
