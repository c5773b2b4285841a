import pandas as pd
import pytest


SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def frame(spark):
    """A DataFrame of the given rows."""
    def make(rows, schema):
        return spark.createDataFrame(pd.DataFrame(rows) if isinstance(rows, dict) else rows, schema)

    return make


class Groups:
    """Components by brute force."""

    def __init__(self, n):
        self.parent = list(range(n))

    def root(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def link(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


@pytest.fixture(name="groups")
def groups_fixture():
    return Groups
