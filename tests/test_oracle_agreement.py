"""Every registered query agrees with its DuckDB oracle (row count, columns, values) at sf0.001."""

import os

import duckdb
import pytest

from brasa.registry import all_queries
from conftest import SF_SMALL
from oracles.all import all_oracles
from tools.compare import digest

QUERIES = all_queries()
NAMES = sorted(QUERIES)
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events").split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return c


def test_every_query_has_an_oracle():
    assert set(NAMES) == set(ORACLES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLES[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(rel.columns, orows)[0]
