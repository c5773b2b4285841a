"""Helpers shared by the operators: stored intermediate tables and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brasa.session import new_table_path


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a given table; columns beside them are never read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def store(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to a new folder under the shared work folder; the frame read back, and its path.

    The written table cuts the lineage: a lost executor costs its running tasks, not what went before.
    """
    path = new_table_path(spark, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_stored(spark: SparkSession, path: str) -> None:
    """Remove a table made by ``store`` that no later frame reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, each with underscores before it until it is none of the columns."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of ``edges`` (columns a, b, of one orderable type).

    component is the smallest node that is reachable.  Large-star and small-star steps in turn; each is one
    pre-aggregated minimum per node and one join, so a node with very many links is summed before the shuffle
    and its join partition can be split.  Links of a node to itself and repeated links change nothing; links
    with a null end are dropped.
    """
    now, path = store(spark, _canonical(edges), "links")
    signature = _signature(now)
    while signature[0]:
        after, after_path = store(spark, _small_star(_large_star(now)), "links")
        seen = _signature(after)
        drop_stored(spark, path)
        now, path = after, after_path
        if seen == signature:
            break
        signature = seen
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)


def _canonical(edges: DataFrame) -> DataFrame:
    """Each link once, from the larger node to the smaller."""
    return (edges.filter("a is not null and b is not null and a <> b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Links of larger neighbours move to the smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours link to the smallest of them."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
