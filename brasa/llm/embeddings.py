"""Embedding near-dedup by a subspace pigeonhole join.

Vectors of length one are rotated by a fixed random rotation and split into blocks of ``BLOCK`` coordinates.  Two
vectors with a cosine of at least c are no further apart than sqrt(2 - 2c), so in some block their squared distance is
within that block's share of 2 - 2c, in proportion to its coordinates.  Each block is range-joined under its budget: the
first few coordinates of the block form a grid with cells twice the block's radius wide, a vector is at home in one cell
and visits the neighbouring cells that its ball reaches (only those behind its own in the cells' order, so that a
pair meets once).  Home vectors meet each other and the cell's visitors.  Candidates are pairs within the block's
budget; a pair that several blocks find counts in the first of them, so the union needs no list of pairs.
Candidates are verified by their cosine in double precision.

A cell with more than ``SIDE`` vectors is cut into chunks that meet chunk by chunk, so a very common vector is spread
over many tasks of bounded size; a task returns numbers of links and a spanning forest of its links, never all pairs.

Defined cases: a vector that is null, empty, all zeros, or holds a null or a non-finite component links with nothing; so
do vectors of different lengths.  Rows that repeat id and vector are one vector, returned as often as it comes; rows
with one id and different vectors are different vectors.  A null id counts as a partner, and never names a component
unless it is alone (component null, kept).  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brasa.llm.common import connected_components, store, table

LEAST = 0.95
BLOCK = 32
MOST_BLOCKS = 4096
GRID = 4  # coordinates of a block that its grid is laid over
SIDE = 4096  # vectors of one side of a task
MARGIN = 1e-4  # of single precision
SLACK = 1e-7  # candidates may lie so much further apart; verification is exact


@lru_cache(maxsize=8)
def rotation(dims: int) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(42).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def blocks_of(dims: int, block: int = BLOCK) -> list[slice]:
    edges = [*range(0, dims, block), dims]
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def cells(points: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Home cell of each point, and (row, cell) of the cells behind it that its ball reaches."""
    wide = 2 * radius
    base = 2 * int(np.ceil(1 / wide)) + 3
    index = np.floor(points / wide).astype(np.int64)
    rows, key, used = np.arange(len(points)), np.zeros(len(points), np.int64), np.zeros(len(points))
    home = np.zeros(len(points), np.int64)
    for d in range(points.shape[1]):
        home = home * base + index[:, d] + base // 2
        inside = points[rows, d] - index[rows, d] * wide
        steps = [(0, np.zeros(len(rows))), (-1, inside), (1, wide - inside)]
        rows, key, used = (np.concatenate(x) for x in zip(*[
            (rows, key * base + index[rows, d] + base // 2 + step, used + far ** 2) for step, far in steps]))
        near = used <= radius ** 2
        rows, key, used = rows[near], key[near], used[near]
    behind = key > home[rows]
    return home, rows[behind], key[behind]


def verified(left: np.ndarray, right: np.ndarray, block: int, least: float, same: bool) -> Iterator[tuple]:
    """(i, j) index arrays of the pairs that count in this block; both sides are vectors of length one."""
    limit = 2 - 2 * least + SLACK
    turn = rotation(left.shape[1])
    a, b = left @ turn, right @ turn
    parts = blocks_of(left.shape[1])
    budgets = [limit * (p.stop - p.start) / left.shape[1] for p in parts]
    x, y = a[:, parts[block]], b[:, parts[block]]
    # squared distances by one product, in single precision with a margin: |x|^2 + |y|^2 - 2xy
    one = np.ones((len(x), 1))
    x = np.hstack([(x ** 2).sum(1, keepdims=True), one, -2 * x]).astype(np.float32)
    y = np.hstack([np.ones((len(y), 1)), (y ** 2).sum(1, keepdims=True), y]).astype(np.float32).T
    for i in range(0, x.shape[0], 256):
        skipped = i if same else 0  # the pairs below the diagonal have been met
        near = x[i:i + 256] @ y[:, skipped:] <= np.float32(budgets[block] + MARGIN)
        if same:
            near &= np.arange(len(near))[:, None] < np.arange(near.shape[1])[None, :]
        found = np.flatnonzero(near)
        p, q = found // near.shape[1], found % near.shape[1] + skipped
        for s in range(0, len(p), 65536):
            one, two = p[s:s + 65536] + i, q[s:s + 65536]
            linked = np.einsum("ij,ij->i", left[one], right[two]) >= least
            one, two = one[linked], two[linked]
            gap = (a[one] - b[two]) ** 2
            first = np.argmax(np.stack([gap[:, part].sum(1) <= budget for part, budget in zip(parts, budgets)]), axis=0)
            yield one[first == block], two[first == block]


def _valid(embedding: Column) -> Column:
    whole = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embedding.isNotNull() & F.coalesce(whole, F.lit(False)) & F.coalesce(
        F.exists(embedding, lambda x: x != 0), F.lit(False))


def _met(vectors: DataFrame, least: float, grid: int) -> DataFrame:
    """Rows (dims, block, cell, home, node, embedding): every vector at home and on its visits."""
    @F.pandas_udf("array<long>")
    def places(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        """cell * 2 * MOST_BLOCKS + block * 2 + home."""
        for part in parts:
            out = pd.Series([None] * len(part), dtype=object)
            sizes = part.map(len).to_numpy()
            for dims in np.unique(sizes):
                at = np.flatnonzero(sizes == dims)
                turned = unit(np.stack(part.iloc[at]).astype(np.float64)) @ rotation(int(dims))
                rows, codes = [], []
                for k, where in enumerate(blocks_of(int(dims))):
                    radius = ((2 - 2 * least + SLACK) * (where.stop - where.start) / dims + SLACK) ** 0.5
                    home, row, cell = cells(turned[:, where][:, :grid], radius)
                    rows += [np.arange(len(at)), row]
                    codes += [home * 2 * MOST_BLOCKS + 2 * k + 1, cell * 2 * MOST_BLOCKS + 2 * k]
                row, code = np.concatenate(rows), np.concatenate(codes)
                order = np.argsort(row, kind="stable")
                ends = np.cumsum(np.bincount(row, minlength=len(at)))
                for i, own in zip(at, np.split(code[order], ends[:-1])):
                    out.iat[i] = own
            yield out

    place = F.col("place")
    return vectors.select("*", F.explode(places("embedding")).alias("place")).select(
        "dims", F.shiftright(place, 1).bitwiseAND(F.lit(MOST_BLOCKS - 1)).cast("int").alias("block"),
        F.shiftright(place, 13).alias("cell"), (place.bitwiseAND(F.lit(1)) == 1).alias("home"),
        "node", "embedding")


def links(spark: SparkSession, vectors: DataFrame, least: float = LEAST, side: int = SIDE,
          grid: int = GRID) -> DataFrame:
    """Rows (node, n_links, partner): partial numbers of links, and links that span the components (n_links 0).

    ``vectors`` has node (text, unique) and embedding (array of float or double, valid).
    """
    met = _met(vectors.select("node", "embedding", F.size("embedding").alias("dims")), least, grid)
    place = ["dims", "block", "cell"]
    sizes = met.groupBy(place).agg(*[F.ceil(F.count_if(F.col("home") == own) / F.lit(side)).cast("int").alias(name)
                                     for own, name in ((True, "home_chunks"), (False, "visit_chunks"))])
    chunk = F.when(F.col("home"), F.pmod(F.xxhash64("node"), F.greatest("home_chunks", F.lit(1)))).otherwise(
        F.pmod(F.xxhash64("node"), F.greatest("visit_chunks", F.lit(1)))).cast("int")
    cut = met.join(sizes.filter("home_chunks > 0"), place).withColumn("chunk", chunk)

    def each(upto: str, make) -> Column:
        return F.when(F.col(upto) > 0, F.transform(F.sequence(F.lit(0), F.col(upto) - 1), make)).otherwise(
            F.array().cast("array<struct<visit:boolean,low:int,high:int>>"))

    def task(visit: bool, low, high) -> Column:
        return F.struct(F.lit(visit).alias("visit"), low.cast("int").alias("low"), high.cast("int").alias("high"))

    at_home = F.concat(each("home_chunks", lambda o: task(False, F.least("chunk", o), F.greatest("chunk", o))),
                       each("visit_chunks", lambda v: task(True, F.col("chunk"), v)))
    on_visit = each("home_chunks", lambda h: task(True, h, F.col("chunk")))
    spread = cut.withColumn("task", F.explode(F.when(F.col("home"), at_home).otherwise(on_visit)))
    # dealt by task: else a cell's tasks would all stay in the partition that the cell came to
    spread = spread.select("*", "task.*").drop("task").repartition(*place, "visit", "low", "high")

    def join(group: pd.DataFrame) -> pd.DataFrame:
        nodes, own = group["node"].to_numpy(), group["home"].to_numpy()
        info = group[["visit", "low", "high"]].iloc[0]
        vectors = unit(np.stack(group["embedding"]).astype(np.float64))
        if info["visit"]:
            first = own
        else:
            first = (group["chunk"] == info["low"]).to_numpy()
        same = not info["visit"] and info["low"] == info["high"]
        left, right = np.flatnonzero(first), np.flatnonzero(first if same else ~first)
        degree, parent, forest = np.zeros(len(nodes), np.int64), np.arange(len(nodes)), []

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        if len(left) and len(right):
            for i, j in verified(vectors[left], vectors[right], int(group["block"].iat[0]), least, same):
                one, two = left[i], right[j]
                degree += np.bincount(one, minlength=len(nodes)) + np.bincount(two, minlength=len(nodes))
                apart = parent[one] != parent[two]
                for x, y in zip(one[apart].tolist(), two[apart].tolist()):
                    p, q = root(x), root(y)
                    if p != q:
                        parent[max(p, q)] = min(p, q)
                        forest.append((nodes[x], 0, nodes[y]))
        counted = [(nodes[i], int(degree[i]), None) for i in np.flatnonzero(degree)]
        return pd.DataFrame(counted + forest, columns=["node", "n_links", "partner"])

    return spread.groupBy(*place, "visit", "low", "high").applyInPandas(join, "node string, n_links long, partner string")


def near_duplicates(spark: SparkSession, rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                    least: float = LEAST, side: int = SIDE) -> DataFrame:
    """One row per row: vec_id, n_links, component_id, kept."""
    rows = rows.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"))
    kind = rows.schema["embedding"].dataType.simpleString()
    rows = rows.withColumn("node", F.concat_ws(":", F.coalesce(F.col("vec_id").cast("string"), F.lit("")),
                                               F.hex(F.xxhash64("embedding"))))
    vectors = rows.filter(_valid(F.col("embedding"))).select(
        "node", F.col("embedding") if kind in ("array<float>", "array<double>") else
        F.col("embedding").cast("array<double>").alias("embedding")).dropDuplicates(["node"])
    vectors, _ = store(spark, vectors, "vectors")
    found, _ = store(spark, links(spark, vectors, least, side), "links")
    degrees = found.filter("partner is null").groupBy("node").agg(F.sum("n_links").alias("n_links"))
    of = connected_components(spark, found.filter("partner is not null").select(
        F.col("node").alias("a"), F.col("partner").alias("b")))
    ids = rows.select("vec_id", "node")
    inside = ids.join(of, "node", "left").join(degrees, "node", "left")
    least_id = inside.filter("component is not null").groupBy("component").agg(F.min("vec_id").alias("smallest"))
    return inside.join(least_id, "component", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("component").isNull(), F.col("vec_id")).otherwise(F.col("smallest")).alias("component_id")
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
