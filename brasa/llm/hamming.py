"""Exact top-k search over binary codes by incremental multi-index hashing.

A code of ``BITS`` bits is cut into ``SEGMENTS`` segments, and every segment is an index.  A query looks up, in each index,
all values within radius 0 of its own segment, then radius 1, and so on.  After radius s in all indexes every code within
SEGMENTS * (s + 1) - 1 bits of the query has been met: a code further away than s bits in every segment is at least
SEGMENTS * (s + 1) bits away.  A query stops as soon as its kth best verified distance is within that bound, which covers
ties at the kth distance as well; the others go on with the next radius.  At radius ``BITS / SEGMENTS`` everything
has been met, so the search always ends, and nothing is cut off on the way.

The index holds different codes, each with its ``k`` smallest ids (no more of one code can be among the best k, as
equal distances are ordered by id), so a very common vector is one entry.  Queries with equal codes are one query, which
looks for one more than k hits, as each asker then leaves itself out.  Candidates are cut to the best k + 1 per query
within each task, before they are shuffled.

Codes are the signs of rotated vectors (``codes``).  Defined cases: a vector that is null or empty, or holds a null or a
non-finite component, has no code; it is no hit and has none.  Rows with null id are no hits and don't ask.  Repeated rows
(equal id and code) are one; rows with one id and different codes are hits of their own.  Fewer than k other codes: all
of them are hits.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brasa.llm.common import store, table
from brasa.llm.embeddings import rotation

BITS = 64
SEGMENTS = 4
K = 10
EVERY = 100  # ids divisible by it ask


def codes(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Rows (id, code): the signs of the first ``BITS`` rotated components, as a long."""
    valid = F.col(embedding).isNotNull() & (F.size(embedding) > 0) & F.coalesce(F.forall(
        embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))

    @F.pandas_udf("long")
    def signs(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            out = np.zeros(len(part), np.int64)
            sizes = part.map(len).to_numpy()
            for dims in np.unique(sizes):
                at = np.flatnonzero(sizes == dims)
                turned = np.stack(part.iloc[at]).astype(np.float64) @ rotation(int(dims))
                bits = turned[:, :BITS] > 0
                out[at] = bits @ (np.int64(1) << np.arange(bits.shape[1], dtype=np.int64))
            yield pd.Series(out)

    return rows.filter(valid & F.col(vec_id).isNotNull()).select(F.col(vec_id).alias("id"),
                                                                 signs(F.col(embedding)).alias("code"))


def _segment(code: Column, s: int) -> Column:
    width = BITS // SEGMENTS
    return F.shiftrightunsigned(code, s * width).bitwiseAND(F.lit((1 << width) - 1)).cast("int")


def _segments(rows: DataFrame) -> DataFrame:
    """A row for each segment of each code, with the segment's number and value."""
    parts = F.array(*[F.struct(F.lit(s).alias("segment"), _segment(F.col("code"), s).alias("value"))
                      for s in range(SEGMENTS)])
    return rows.select("*", F.explode(parts).alias("part")).select(*rows.columns, "part.segment", "part.value")


def _masks(radius: int) -> Column:
    """All masks of a segment with exactly ``radius`` bits."""
    width = BITS // SEGMENTS
    masks = [sum(1 << b for b in bits) for bits in combinations(range(width), radius)]
    return F.expr(f"array({', '.join(map(str, masks))})")


def nearest(spark: SparkSession, rows: DataFrame, asking: Column, k: int = K) -> DataFrame:
    """Rows (query_id, hit_id, distance, place) of the k nearest other rows for each row (id, code) that asks.

    Equal distances are ordered by id.
    """
    rows, _ = store(spark, rows.select("id", "code").distinct(), "codes")
    # a code's ids are cut to the k + 1 smallest, the asker among them at most; first in parts of the code
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    few = salted.withColumn("n", F.row_number().over(Window.partitionBy("code", "salt").orderBy("id"))).filter(
        F.col("n") <= k + 1)
    index, _ = store(spark, few.groupBy("code").agg(F.slice(F.sort_array(F.collect_list("id")), 1, k + 1).alias("ids")),
                     "index")
    entries, _ = store(spark, _segments(index.select("code", F.get("ids", F.lit(0)).alias("first_id"),
                                                     F.size("ids").alias("n_ids"))), "entries")
    open_, _ = store(spark, rows.filter(asking).select(F.col("code").alias("query")).distinct(), "queries")
    nearer = Window.partitionBy("query").orderBy("distance", "first_id")
    candidate = ["query", "code", "first_id", "n_ids", "distance"]
    done, found = [], None
    for radius in range(BITS // SEGMENTS + 1):
        probes = _segments(open_.select("query", F.col("query").alias("code"))).select(
            "query", "segment", F.explode(F.transform(_masks(radius), _flipped)).alias("value"))
        # merged: the planner takes the probes for as few as the queries and would broadcast them all
        met = probes.hint("merge").join(entries, ["segment", "value"]).withColumn(
            "distance", F.bit_count(F.col("query").bitwiseXOR(F.col("code")))).select(candidate)
        met = met if found is None else met.unionByName(found)
        best, _ = store(spark, met.distinct().withColumn("place", F.row_number().over(nearer)).filter(
            F.col("place") <= k + 1).select(candidate), "best")
        bound = SEGMENTS * (radius + 1) - 1
        # enough ids within the distance up to which everything has been met: k and perhaps the asker
        closed, _ = store(spark, best.filter(F.col("distance") <= bound).groupBy("query").agg(
            F.sum("n_ids").alias("n")).filter(F.col("n") > k).select("query"), "closed")
        last = radius == BITS // SEGMENTS
        done.append(best if last else best.join(closed, "query", "left_semi"))
        open_, _ = store(spark, open_.join(closed, "query", "left_anti"), "queries")
        if last or open_.isEmpty():
            break
        found = best.join(closed, "query", "left_anti")
    hits = reduce(DataFrame.unionByName, done).join(index, "code")
    asked = rows.filter(asking).select(F.col("id").alias("query_id"), F.col("code").alias("query"))
    each = asked.join(hits, "query").select("query_id", "query", "distance", "code", F.explode("ids").alias("hit_id"))
    others = each.filter((F.col("hit_id") != F.col("query_id")) | (F.col("code") != F.col("query")))
    order = Window.partitionBy("query_id", "query").orderBy("distance", "hit_id", "code")
    return others.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).select(
        "query_id", "hit_id", F.col("distance").cast("int").alias("distance"), F.col("place").cast("int").alias("place"))


def _flipped(mask: Column) -> Column:
    return F.col("value").bitwiseXOR(mask)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = codes(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return nearest(spark, rows, F.col("id") % EVERY == 0)
