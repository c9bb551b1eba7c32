"""Decoder queries: table rows are rendered as lines of each wire form and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.fixed import MISSING_TEXT
from repotide.functions.text import letters_only, words_or_empty
from repotide.functions.times import epoch_seconds, utc_text
from repotide.operators.filters import with_language
from repotide.plans.tables import table
from repotide.sources import decode


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as repositories with a name and a push time, one minute apart from 2024 on."""
    pushed_at = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("doc_id") * 60)
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat_ws("/", "source", "doc_id").alias("full_name"),
        utc_text(pushed_at).alias("pushed_at"),
        F.col("n_chars").alias("stargazers_count"),
        F.col("text").alias("description"),
        F.col("lang").alias("language"),
    )


def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    rows = decode.decode_json(events, "k BIGINT").rows
    return rows.groupBy("k").agg(F.count("*").alias("n"))


def repo_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = decode.to_json_lines(decode.repo_words(_documents(spark, sf_dir)))
    rows = decode.repo_rows(decode.decode_json(lines).rows)
    return rows.select(
        "full_name",
        epoch_seconds(F.col("pushed_at")).alias("pushed_epoch"),
        "stargazers_count",
        F.size("description").alias("n_words"),
        "language",
    )


def tsv_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    number = F.col("event_id")
    time = F.when(number % 7 == 3, "soon").otherwise(utc_text(F.col("ts")))
    stars = F.when(number % 11 == 2, "many").otherwise(F.col("user_id").cast("string"))
    name = F.when(number % 23 == 1, "").otherwise(number.cast("string"))
    # Some lines lose their last field, as concat_ws leaves out nulls.
    kind = F.when(number % 29 != 4, F.col("event_type"))
    lines = events.select(F.concat_ws("\t", name, time, stars, "props", kind).alias("value"))
    decoded = decode.decode_tsv(lines)
    rows = decoded.rows.select(
        F.col("full_name").cast("bigint").alias("event_id"),
        epoch_seconds(F.col("pushed_at")).alias("pushed_epoch"),
        F.col("stargazers_count").alias("user_id"),
        F.col("description").alias("props"),
        F.col("language").alias("event_type"),
        F.lit(None).cast("string").alias("reason"),
    )
    field = [F.try_element_at(F.split("value", "\t"), F.lit(i)) for i in (1, 2, 3, 4, 5)]
    return rows.unionByName(
        decoded.rejects.select(
            F.nullif(field[0], F.lit("")).cast("bigint").alias("event_id"),
            F.lit(None).cast("bigint").alias("pushed_epoch"),
            F.lit(None).cast("bigint").alias("user_id"),
            field[3].alias("props"),
            field[4].alias("event_type"),
            "reason",
        )
    )


def int_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event gives one whole number with blanks around it and one line that is none.

    Both are counted in the same pass.
    """
    events = table(spark, sf_dir, "events")
    texts = F.array(F.format_string("\t%d ", "event_id"), F.concat(F.lit("x"), "event_type"))
    return decode.count_integers(events.select(F.explode(texts).alias("value")))


def envelope_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document is sent as a response of three items: as it is, without a description, and
    without a language; the last one is dropped again."""

    def item(number: int, description, language):
        return F.struct(
            (F.col("doc_id") * 3 + number).alias("id"),
            "full_name",
            "pushed_at",
            "stargazers_count",
            description.alias("description"),
            language.alias("language"),
        )

    none = F.lit(None).cast("string")
    items = F.array(
        item(0, F.col("description"), F.col("language")),
        item(1, none, F.col("language")),
        item(2, none, none),
    )
    bodies = _documents(spark, sf_dir).select(
        F.to_json(F.struct(items.alias("items")), {"ignoreNullFields": "false"}).alias("value")
    )
    rows = with_language(decode.unnest_envelopes(bodies).rows)
    found = words_or_empty(F.col("description"))
    return rows.select(
        "id", "full_name", "stargazers_count", F.size(found).alias("n_words"), "language"
    )


def capture_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as two captured text lines with a banner between them: one has its text, with
    commas and without line ends, the other the word that stands for a missing description."""

    def line(text):
        return F.concat_ws(",", "full_name", "pushed_at", "stargazers_count", text, "language")

    text = F.concat_ws(",", letters_only(F.col("description")), F.lit("end"))
    captured = F.array(line(text), F.lit("-----Poll-----"), line(F.lit(MISSING_TEXT)))
    lines = _documents(spark, sf_dir).select(F.explode(captured).alias("value"))
    return decode.decode_capture(lines).rows.select(
        "full_name",
        epoch_seconds(F.col("pushed_at")).alias("pushed_epoch"),
        "stargazers_count",
        F.col("description"),
        "language",
    )


def envelope_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document is sent as a response whose items lack an id or have a time that is none, and as
    one that breaks off."""
    documents = _documents(spark, sf_dir)

    def item(number: Column, pushed_at: Column):
        none = F.lit(None).cast("string").alias("description")
        return F.struct(
            number.alias("id"), "full_name", pushed_at.alias("pushed_at"), "stargazers_count", none, "language"
        )

    number = F.col("doc_id")
    items = F.array(
        item(number, F.col("pushed_at")),
        item(F.lit(None).cast("bigint"), F.col("pushed_at")),
        item(number, F.lit("yesterday")),
    )
    body = F.to_json(F.struct(items.alias("items")), {"ignoreNullFields": "false"})
    broken = F.substring(body, F.lit(1), F.length(body) - 9)
    bodies = documents.select(body.alias("body"), broken.alias("broken"))
    lines = bodies.select(F.explode(F.array("body", "broken")).alias("value"))
    first = F.regexp_extract("value", r'"full_name":"[^"]*?(\d+)"', 1).cast("bigint")
    return decode.unnest_envelopes(lines).rejects.select(first.alias("doc_id"), "reason")


def capture_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a captured line that is good, one that is too short, one without a name and
    one whose stars are no number. Its number stands in the last field."""

    def line(*fields):
        return F.concat_ws(",", *fields, F.col("doc_id").cast("string"))

    name, pushed_at, text = F.col("full_name"), F.col("pushed_at"), F.lit("some, text")
    captured = F.array(
        line(name, pushed_at, F.lit("1"), text),
        line(name, pushed_at),
        line(F.lit(""), pushed_at, F.lit("1"), text),
        line(name, pushed_at, F.lit("many"), text),
    )
    lines = _documents(spark, sf_dir).select(F.explode(captured).alias("value"))
    number = F.substring_index("value", ",", -1).cast("bigint")
    return decode.decode_capture(lines).rejects.select(number.alias("doc_id"), "reason")


QUERIES = {
    "json_decode": json_decode,
    "repo_json_roundtrip": repo_json_roundtrip,
    "tsv_decode": tsv_decode,
    "int_decode": int_decode,
    "envelope_unnest": envelope_unnest,
    "capture_parse": capture_parse,
    "envelope_rejects": envelope_rejects,
    "capture_rejects": capture_rejects,
}
