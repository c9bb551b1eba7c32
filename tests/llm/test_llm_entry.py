"""Every registered query of the package against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from repotide.llm import ORACLE, QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(entry_points.SMALL), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{entry_points.SMALL}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_all_are_registered():
    numbers = {name.split("_")[0] for name in entry_points.queries() if name.startswith("op")}
    assert numbers == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in entry_points.queries()
    assert set(ORACLE) <= set(QUERIES)


def rounded(row):
    return tuple(round(x, 9) if isinstance(x, float) and math.isfinite(x) else x for x in row)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, entry_points.SMALL)
    reference = duck.execute(ORACLE[name])
    columns = [column[0] for column in reference.description]
    assert sorted(result.columns) == sorted(columns)
    got = sorted((rounded(row) for row in result.select(*columns).collect()), key=repr)
    assert got == sorted((rounded(row) for row in reference.fetchall()), key=repr)
    assert got
