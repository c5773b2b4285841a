"""Point-in-time (as-of) lookup against a versioned dimension.

A fact row dated ``d`` takes the version with ``valid_from <= d`` and
``d < valid_to`` (or ``valid_to`` open).  Misses - unknown id, NULL id or
NULL date - get the default key.  The join is an equi-join on the business id
with a range residual, so it shuffles on the id; the version side holds only a
few rows per id.

Hot ids (one id holding a large share of the facts): with AQE's skew join on
(the Spark 4 default) the oversized shuffle partitions of the fact side are
split at run time.  Without it (``skew="salt"``, or ``"auto"`` on a session
where the skew join is off) the hot ids are found first - ids with at least
``hot_share`` of the fact rows, so at most ``1 / hot_share`` of them, a bound
that makes broadcasting them safe - and their fact rows are spread over
``salts`` salts while only their few version rows are replicated per salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _aqe_splits_skew(df: DataFrame) -> bool:
    conf = df.sparkSession.conf
    return (conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
            and conf.get("spark.sql.adaptive.skewJoin.enabled", "true").lower() == "true")


def asof_join(facts: DataFrame, versions: DataFrame, fact_id: str, fact_date: str,
              out: str, *, version_id: str = "id_empleado", version_key: str = "empleado_key",
              valid_from: str = "fecha_inicio_validez", valid_to: str = "fecha_fin_validez",
              default: str | None = "-1", skew: str = "auto", hot_share: float = 0.01,
              salts: int = 32) -> DataFrame:
    v = versions.select(
        F.col(version_id).alias(f"_{out}_id"), F.col(valid_from).alias(f"_{out}_from"),
        F.col(valid_to).alias(f"_{out}_to"), F.col(version_key).alias(f"_{out}_key"))
    d = F.col(fact_date)
    cond = ((F.col(fact_id) == F.col(f"_{out}_id")) & (d >= F.col(f"_{out}_from"))
            & (F.col(f"_{out}_to").isNull() | (d < F.col(f"_{out}_to"))))
    salt_it = skew == "salt" or (skew == "auto" and not _aqe_splits_skew(facts))
    if salt_it:
        facts, v, cond = _salted(facts, v, fact_id, out, cond, hot_share, salts)
    # a row without id or date matches nothing: it gets a place of its own in the shuffle, not that of NULL
    able = F.col(fact_id).isNotNull() & d.isNotNull()
    facts = facts.withColumn(f"_{out}_by", F.when(able, F.lit(0).cast("bigint")).otherwise(
        F.xxhash64(*[F.col(c) for c in facts.columns])))
    v = v.withColumn(f"_{out}_vby", F.lit(0).cast("bigint"))
    # shuffled at every size, as the versions grow with the input; few an id, so they are hashed and the facts not sorted
    joined = facts.join(v.hint("shuffle_hash"), cond & (F.col(f"_{out}_by") == F.col(f"_{out}_vby")), "left").drop(
        f"_{out}_by", f"_{out}_vby")
    key = F.col(f"_{out}_key")
    if default is not None:
        key = F.coalesce(key, F.lit(default))
    drop = [f"_{out}_id", f"_{out}_from", f"_{out}_to", f"_{out}_key"] + ([f"_{out}_salt", f"_{out}_vsalt"] if salt_it else [])
    return joined.withColumn(out, key).drop(*drop)


def _salted(facts: DataFrame, v: DataFrame, fact_id: str, out: str, cond, hot_share: float, salts: int):
    ids = facts.select(F.col(fact_id).alias("_hid")).filter(F.col("_hid").isNotNull())
    counts = ids.groupBy("_hid").agg(F.count(F.lit(1)).alias("_n"))          # partial aggregation first
    total = ids.agg(F.count(F.lit(1)).alias("_total")).withColumn("_one", F.lit(1))
    hot = (counts.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one")
           .filter(F.col("_n") >= F.col("_total") * F.lit(hot_share)).select("_hid", F.lit(True).alias("_hot")))
    # at most 1 / hot_share ids can hold hot_share of the rows: a proven bound, safe to broadcast
    hot = F.broadcast(hot)
    row_hash = F.xxhash64(*[F.col(c) for c in facts.columns])
    f = (facts.join(hot, F.col(fact_id) == F.col("_hid"), "left")
         .withColumn(f"_{out}_salt", F.when(F.col("_hot"), F.pmod(row_hash, F.lit(salts))).otherwise(F.lit(0)))
         .drop("_hid", "_hot"))
    vv = (v.join(hot, F.col(f"_{out}_id") == F.col("_hid"), "left")
          .withColumn(f"_{out}_vsalt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
                                                 .otherwise(F.array(F.lit(0)))))
          .drop("_hid", "_hot"))
    return f, vv, cond & (F.col(f"_{out}_salt") == F.col(f"_{out}_vsalt"))


def asof_by_order(facts: DataFrame, versions: DataFrame, fact_id: str, fact_date: str, out: str, *,
                  version_id: str = "id_empleado", version_key: str = "empleado_key",
                  valid_from: str = "fecha_inicio_validez", valid_to: str = "fecha_fin_validez",
                  default: str | None = "-1") -> DataFrame:
    """``asof_join`` for ids with very many versions: the two sides are merged in order of time instead of compared.

    The different (id, date) pairs of the facts and the starts of the versions are put into one order of time for each id;
    a pair takes the last version before it.  An id's time is cut into months, ordered apart, and the version that is
    open when a month ends is carried on to the following ones.  The pairs' answers go back to the facts by an equi-join on
    (id, date), so no fact meets more than one row, however many versions its id has.  Versions of one id don't overlap;
    those that end before or when they begin are never valid.  Misses as in ``asof_join``.
    """
    at = lambda c: F.col(c).cast("timestamp_ntz")
    able = F.col(fact_id).isNotNull() & F.col(fact_date).isNotNull()
    valid = F.col(version_id).isNotNull() & (F.col(valid_to).isNull() | (F.col(valid_from) < F.col(valid_to)))
    starts = versions.filter(valid & F.col(valid_from).isNotNull()).select(
        F.col(version_id).alias("_id"), at(valid_from).alias("_at"), F.lit(True).alias("_starts"),
        F.struct(at(valid_to).alias("to"), F.col(version_key).alias("key")).alias("_version"))
    pairs = facts.filter(able).select(F.col(fact_id).alias("_id"), at(fact_date).alias("_at")).distinct().withColumns(
        {"_starts": F.lit(False), "_version": F.lit(None).cast(starts.schema["_version"].dataType)})
    merged = starts.unionByName(pairs).withColumn("_month", F.trunc(F.to_date("_at"), "month"))
    in_month = Window.partitionBy("_id", "_month").orderBy("_at", F.col("_starts").desc())
    so_far = F.last("_version", ignorenulls=True).over(in_month.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    asked = merged.withColumn("_own", so_far).filter(~F.col("_starts"))
    months = merged.groupBy("_id", "_month").agg(F.max_by("_version", F.when(F.col("_starts"), F.col("_at"))).alias("_closing"))
    earlier = Window.partitionBy("_id").orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    months = months.select("_id", "_month", F.last("_closing", ignorenulls=True).over(earlier).alias("_carried"))
    found = asked.join(months, ["_id", "_month"]).withColumn("_found", F.coalesce("_own", "_carried"))
    found = found.filter(F.col("_found.to").isNull() | (F.col("_at") < F.col("_found.to"))).select(
        F.col("_id").cast("string").alias(f"_{out}_vby"), F.col("_at").alias(f"_{out}_at"), F.col("_found.key").alias(f"_{out}_key"))
    # a fact without id or date matches nothing: it gets a place of its own in the shuffle, not that of NULL
    by = F.when(able, F.col(fact_id).cast("string")).otherwise(
        F.concat(F.lit("~"), F.xxhash64(*[F.col(c) for c in facts.columns]).cast("string")))
    joined = facts.withColumn(f"_{out}_by", by).join(
        found, (F.col(f"_{out}_by") == F.col(f"_{out}_vby")) & (at(fact_date) == F.col(f"_{out}_at")), "left")
    key = F.col(f"_{out}_key")
    return joined.select(*[c for c in facts.columns if c != out], (key if default is None else F.coalesce(key, F.lit(default))).alias(out))
