"""Every registered query against its SQL counterpart on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from conftest import plan_of
from repotide.plans import catalog
from repotide.plans.tables import SCHEMAS

SF_DIR = entry_points.SMALL
QUERIES = {name: query for name, query in entry_points.queries().items() if name in catalog.QUERIES}
ORACLE = catalog.ORACLE

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    reference = duck.execute(ORACLE[name])
    columns = [column[0] for column in reference.description]
    assert sorted(result.columns) == sorted(columns)
    got = comparable(result.columns, result.collect())
    assert got == comparable(columns, reference.fetchall())
    assert got


# Copies with one number, with others and with none, and rows without a language or a text.
ODD_DOCUMENTS = [
    (1, "a", "en"), (1, "a", "en"), (2, "a", "en"), (3, "b", None), (4, "b", "de"), (4, "b", None),
    (5, None, "en"), (6, None, None), (7, "c", "fr"), (7, "d", "fr"), (8, "d", "fr"),
    (9, "e", "en"), (10, "f", "en"), (None, "e", "en"), (None, "g", "en"), (None, "g", "en"),
]


def odd_documents(spark, folder):
    """Two files, so that the last micro-batch of a replay holds documents with a number and without."""
    rows = [(number, text, lang, "s", 1) for number, text, lang in ODD_DOCUMENTS]
    for part in ([r for r in rows if r[0] != 2], [r for r in rows if r[0] == 2]):
        documents = spark.createDataFrame(part, SCHEMAS["documents"]).coalesce(1)
        documents.write.mode("append").parquet(f"{folder}/documents.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    return connection


@pytest.mark.parametrize("name", ["rejected_rows", "stream_rejected"])
def test_every_document_is_accepted_or_rejected(spark, folder, name):
    connection = odd_documents(spark, folder)
    expected = comparable(["doc_id", "language", "reason"], connection.execute(ORACLE[name]).fetchall())
    assert len(expected) == 9
    result = QUERIES[name](spark, folder)
    assert comparable(result.columns, result.collect()) == expected


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["Language", "Word", "Freq"]
    assert result.count() > 0


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if "stream" not in n and n != "state_fold"])
def test_no_query_pairs_rows(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan


@pytest.mark.parametrize(
    "name", ["top10_words", "repo_totals", "recent_last10", "poll_dedup", "batch_dedup", "avg_stars"]
)
def test_rankings_are_cut_before_the_shuffle(spark, name):
    assert "Partial" in [part.strip() for part in plan_of(QUERIES[name](spark, SF_DIR)).replace("\n", ",").split(",")]


@pytest.mark.parametrize(
    "name, columns",
    [
        ("top10_words", {"text", "lang"}),
        ("recent_per_batch", {"ts", "user_id", "event_type"}),
        ("digit_histogram", {"o_orderkey"}),
        ("odd_numbers_first10", {"o_orderkey"}),
        ("nine_multiples", {"user_id"}),
    ],
)
def test_scans_read_only_what_is_used(spark, name, columns):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {field.split(":")[0] for field in schema.split(",")} == columns


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("sql_filter_ci", "LessThan(p_size,4)"),
        ("sql_filter_star", "LessThan(p_size,4)"),
        ("union_feeds", "EqualTo(lang,fr)"),
        ("latest_snapshot", "GreaterThanOrEqual(ts,ScalarSubquery"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan_of(QUERIES[name](spark, SF_DIR))
