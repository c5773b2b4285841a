"""The ranked views don't depend on the number of ranges that the ranks are cut into."""

import pytest

from conftest import SF_SMALL


@pytest.mark.parametrize("view", ["v3", "v4", "v10", "v11", "v12", "v13"])
def test_ranked_view_for_any_number_of_ranges(spark, view):
    from brasa.registry import warehouse
    w = warehouse(spark, SF_SMALL)
    default = getattr(w, view)()
    expected = sorted(tuple(r) for r in default.collect())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        other = getattr(w, view)()
        assert sorted(tuple(r) for r in other.select(*default.columns).collect()) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
