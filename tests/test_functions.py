import re
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows_of
from repotide import fixed
from repotide.functions import labels, numbers, text, times


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")


def apply(spark, values, expression, kind="string"):
    rows = column(spark, values, kind).select("i", expression(F.col("v")).alias("o")).collect()
    return [r.o for r in sorted(rows)]


def expected_words(value):
    return re.sub(fixed.NON_LETTERS, "", value).split()


def test_every_character_is_cleaned_like_the_fixed_pattern(spark):
    codes = [c for c in range(1, 0x11000) if not 0xD800 <= c <= 0xDFFF]
    values = [f"a{chr(c)}b" for c in codes]
    got = apply(spark, values, text.letters_only)
    assert got == [re.sub(fixed.NON_LETTERS, "", v) for v in values]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\0")), min_size=40))
def test_words_match_plain_python(spark, values):
    assert apply(spark, values, text.words) == [expected_words(v) for v in values]


def test_words_cases(spark):
    values = ["  two  spaces ", "tab\tjoins\nlines", "A a", "数据", "", None, "don't 42x"]
    assert apply(spark, values, text.words) == [
        ["two", "spaces"], ["tabjoinslines"], ["A", "a"], [], [], None, ["dont", "x"],
    ]
    assert apply(spark, values, lambda v: text.words(v, fold_case=True))[2] == ["a", "a"]
    assert apply(spark, values, text.words_or_empty)[5] == []


def test_tokens_keep_empty_ones(spark):
    assert apply(spark, ["a  b "], text.tokens) == [re.sub(fixed.NON_LETTERS, "", "a  b ").split(" ")]


def test_missing_text_is_null(spark):
    assert apply(spark, ["None", "none", ""], text.missing_to_null) == [None, "none", ""]


def test_spread_characters(spark):
    got = apply(spark, [0, 7, 10123, -45], text.spread_characters, "bigint")
    assert got == ["0", "7", "1,0,1,2,3", "-,4,5"]
    back = apply(spark, got, text.split_commas)
    assert back[2] == list("10123")


def test_divisibility(spark):
    values = [0, 9, 10**9, -9, -10, 18, 1]
    assert apply(spark, values, numbers.divisible_label, "bigint") == [
        "Yes" if v % 9 == 0 else "No" for v in values
    ]
    assert apply(spark, values, numbers.is_odd, "bigint") == [v % 2 != 0 for v in values]


def test_ratio_or_zero(spark):
    df = spark.createDataFrame([(10, 4), (3, 0), (0, 5)], "a BIGINT, b BIGINT")
    assert rows_of(df.select(numbers.ratio_or_zero(F.col("a"), F.col("b")))) == [(0.0,), (0.0,), (2.5,)]


def test_text_to_integer(spark):
    assert apply(spark, [" 12 ", "x", "", "1.5", "-3"], numbers.text_to_integer) == [
        12, None, None, None, -3,
    ]


def test_parse_utc_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Toronto")
    try:
        seconds = lambda v: times.epoch_seconds(times.parse_utc(v))
        assert apply(spark, ["1970-01-01T00:01:00Z", "nonsense", None], seconds) == [60, None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_time_texts(spark):
    df = spark.sql("SELECT timestamp_seconds(3661) AS t")
    row = df.select(times.utc_text(F.col("t")), times.clock_text(F.col("t"))).first()
    assert tuple(row) == ("1970-01-01T01:01:01Z", "01:01:01")


@pytest.mark.parametrize(
    "age, recent, label",
    [(59, True, "recent"), (60, True, "old"), (60.4, False, "old"), (61, False, "old"), (-5, True, "recent")],
)
def test_recency_bounds(spark, age, recent, label):
    now = F.lit("2024-03-01 10:00:00").cast("timestamp")
    df = spark.range(1).select(F.timestamp_micros(F.unix_micros(now) - F.lit(int(age * 10**6))).alias("t"))
    row = df.select(times.is_recent(F.col("t"), now), times.age_label(F.col("t"), now)).first()
    assert tuple(row) == (recent, label)


def test_batch_bounds(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 1, 10, 4, 59),), (datetime(2024, 3, 1, 10, 5),)], "t TIMESTAMP_NTZ")
    ends = [r[0].minute for r in df.select(times.batch_end(F.col("t"), 300)).collect()]
    starts = [r[0].minute for r in df.select(times.batch_start(F.col("t"), 300)).collect()]
    assert (starts, ends) == ([0, 5], [5, 10])


def test_language_bucket(spark):
    values = ["python", "PYTHON", "Java", "JavaScript", "None", None]
    assert apply(spark, values, labels.language_bucket) == ["Python", "Python", "Java", "C", "C", "C"]
