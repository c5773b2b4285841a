import random
from decimal import Decimal
from statistics import median

import pytest
from pyspark.sql import functions as F

from brasa.operators.selection import exact_medians


def _expected(rows):
    groups = {}
    for g, x in rows:
        groups.setdefault(g, []).extend([] if x is None else [Decimal(x)])
    return {g: (sum(v) / 2 if len(v) == 0 else median(v)) if v else None for g, v in groups.items()}


def test_medians_of_wide_ranges_ties_nulls_and_a_hot_group(spark):
    rng = random.Random(5)
    rows = [("hot", rng.randrange(-10 ** 17, 10 ** 17)) for _ in range(3000)] + [("tie", 7)] * 2000 + [("tie", 8)] * 2000
    rows += [(None, x) for x in (1, 2, None, 10 ** 18, -10 ** 18)] + [("none", None), ("one", -3), ("far", 0), ("far", 0),
                                                                     ("far", 10 ** 18)]
    rows += [(f"g{i % 9}", rng.randrange(50)) for i in range(500)]
    got = exact_medians(spark.createDataFrame(rows, "g string, x bigint"), ["g"], "x", "m")
    assert {r.g: r.m for r in got.collect()} == _expected(rows)


def test_medians_of_decimals_and_over_everything(spark):
    rows = [("a", Decimal("1.25")), ("a", Decimal("-1.26")), ("b", Decimal("9999999999999999.99"))]
    df = spark.createDataFrame(rows, "g string, x decimal(18,2)")
    assert {r.g: r.m for r in exact_medians(df, ["g"], "x", "m").collect()} == {
        "a": Decimal("-0.005"), "b": Decimal("9999999999999999.990")}
    assert exact_medians(df, [], "x", "m").collect()[0].m == Decimal("1.250")
    assert exact_medians(df.limit(0), ["g"], "x", "m").collect() == []
    with pytest.raises(TypeError):
        exact_medians(df.withColumn("x", F.col("x").cast("double")), ["g"], "x", "m")
