import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from repotide.session import get_session  # noqa: E402

REPO = (
    "seq BIGINT, poll BIGINT, id BIGINT, full_name STRING, pushed_at STRING, "
    "stargazers_count BIGINT, description STRING, language STRING"
)

# Two polls and a third one later. Repository 1 comes back with other stars and another language,
# 2 twice in one poll, 5 never has a language at first, 9 has no description.
ROWS = [
    (0, 0, 1, "a/one", "2024-03-01T10:00:00Z", 10, "Fast data tool", "Python"),
    (1, 0, 2, "a/two", "2024-03-01T09:59:00Z", 20, "data  data\tbase", "Python"),
    (2, 0, 2, "a/two", "2024-03-01T09:59:00Z", 20, "data  data\tbase", "Python"),
    (3, 0, 3, "b/three", "2024-03-01T09:58:59Z", 0, "", "Java"),
    (4, 0, 5, "b/five", "2024-03-01T09:59:30Z", 7, "no language yet", None),
    (5, 1, 1, "a/one", "2024-03-01T10:00:30Z", 99, "renamed", "Java"),
    (6, 1, 5, "b/five", "2024-03-01T10:00:45Z", 8, "héllo, wörld 42!", "C"),
    (7, 1, 9, "b/nine", "2024-03-01T10:02:00Z", 4, None, "C"),
    (8, 2, 4, "c/four", "2024-03-01T09:00:00Z", 0, "数据 \U0001f680 A a", "Java"),
    (9, 2, 9, "b/nine", "2024-03-01T10:02:00Z", 4, "late text", "C"),
]


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[4]", spark__sql__shuffle__partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")


@pytest.fixture(scope="session")
def repos(spark):
    from pyspark.sql import functions as F

    from repotide.functions.times import parse_utc

    rows = spark.createDataFrame(ROWS, REPO)
    return rows.withColumn("pushed_at", parse_utc(F.col("pushed_at")))


def rows_of(df, *columns):
    """Rows as sorted tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
