from datetime import date, timedelta

from pyspark.sql import functions as F

from brasa.operators.distinct import distinct_ids, id_bitmaps, united


def test_distinct_ids_of_days_months_and_quarters(spark):
    day = lambda n: date(2024, 1, 1) + timedelta(n)
    ids = [None, 0, 1, -1, -32768, -32769, 32767, 32768, 32769, 10 ** 12, 5]
    rows = [(day(i % 120), "ab"[i % 2], ids[(i * i) % len(ids)]) for i in range(900)]
    df = spark.createDataFrame(rows, "d date, g string, id bigint")
    days = id_bitmaps(df, "id", F.col("d"), ["g"])

    def counted(key):
        sets = {}
        for d, g, i in rows:
            if i is not None:
                sets.setdefault(key(d, g), set()).add(i)
        return {k: len(v) for k, v in sets.items()}

    month = united(days, F.trunc("dia", "month"), ["g"])
    assert {(r.dia, r.g): r.n for r in distinct_ids(days, "n", ["g"]).collect()} == counted(lambda d, g: (d, g))
    assert {(r.dia, r.g): r.n for r in distinct_ids(month, "n", ["g"]).collect()} == counted(lambda d, g: (d.replace(day=1), g))
    quarter = united(month, F.trunc("dia", "quarter"))                   # from months, groups united too
    assert {r.dia: r.n for r in distinct_ids(quarter, "n").collect()} == counted(
        lambda d, g: d.replace(month=1 + (d.month - 1) // 3 * 3, day=1))
    assert distinct_ids(id_bitmaps(df.limit(0), "id", F.col("d")), "n").collect() == []
