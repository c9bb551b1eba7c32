"""Line decoders. Each one splits its input into good rows and rejected lines.

Everything here is a projection or a filter over built-in expressions, so the same function
serves batch and streaming input and adds no shuffle. ``keep`` names further columns of the input
that go along with the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repotide.functions.numbers import text_to_integer
from repotide.functions.text import missing_to_null, words
from repotide.functions.times import parse_utc
from repotide.schemas import ENVELOPE, REPO_JSON, TEXT_FIELDS

CORRUPT = "_corrupt"
BANNER = "^-+[^-]*-+$"


MALFORMED, NO_KEY, UNREADABLE = "malformed", "no key", "unreadable field"


class Decoded(NamedTuple):
    """``rejects`` has the columns ``value`` and ``reason``."""

    rows: DataFrame
    rejects: DataFrame


def _parse(lines: DataFrame, parsed: Column, name: str, keep: Sequence[str]) -> DataFrame:
    """The lines with their parsed form, parsed once, and the columns to ``keep``.

    A filter on the output of a generator cannot be moved below it. Without the generator Catalyst
    would copy the parsing expression into the filter and parse every line again there.
    """
    return lines.select("value", *keep, F.explode(F.array(parsed)).alias(name))


def _split(parsed: DataFrame, reason: Column, rows: Sequence[Column | str]) -> Decoded:
    """Good rows have a null ``reason``."""
    good = parsed.where(reason.isNull()).select(*rows)
    return Decoded(good, parsed.where(reason.isNotNull()).select("value", reason.alias("reason")))


def _unreadable(text: Column, value: Column) -> Column:
    """A field that is there but does not parse."""
    return (F.trim(text) != "") & value.isNull()


def decode_json(
    lines: DataFrame,
    schema: str = REPO_JSON,
    keep: Sequence[str] = (),
    key: str | None = None,
    time: str | None = None,
) -> Decoded:
    """One object per line. Malformed lines and lines of the wrong shape are rejected.

    So are lines without the field ``key`` and those whose field ``time`` is there but no instant.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    record = F.from_json("value", f"{schema}, {CORRUPT} STRING", options)
    parsed = _parse(lines, record, "r", keep)
    reason = F.when(F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull(), MALFORMED)
    if key:
        reason = reason.when(F.col(f"r.{key}").isNull(), NO_KEY)
    if time:
        at = F.col(f"r.{time}")
        reason = reason.when(_unreadable(at, parse_utc(at)), UNREADABLE)
    rows, rejects = _split(parsed, reason, ["r.*", *keep])
    return Decoded(rows.drop(CORRUPT), rejects)


def repo_rows(decoded: DataFrame) -> DataFrame:
    """Turn the push time of decoded repository lines into an instant."""
    return decoded.withColumn("pushed_at", parse_utc(F.col("pushed_at")))


def _repo_columns(name: Column, pushed: Column, stars: Column, text: Column, language: Column):
    values = (name, parse_utc(pushed), text_to_integer(stars), text, language)
    return [value.alias(field) for value, field in zip(values, TEXT_FIELDS)]


def _text_reason(whole: Column, name: Column, pushed: Column, stars: Column) -> Column:
    bad = _unreadable(pushed, parse_utc(pushed)) | _unreadable(stars, text_to_integer(stars))
    return (
        F.when(~F.coalesce(whole, F.lit(False)), MALFORMED)
        .when(name.isNull() | (F.trim(name) == ""), NO_KEY)
        .when(bad, UNREADABLE)
    )


def decode_tsv(lines: DataFrame, keep: Sequence[str] = ()) -> Decoded:
    """Five tab-separated fields per line; any other number of fields is rejected.

    So are lines without a name, and those whose stars or push time are there but do not parse.
    """
    parsed = _parse(lines, F.split("value", "\t"), "f", keep)
    field = [F.try_element_at("f", F.lit(i + 1)) for i in range(len(TEXT_FIELDS))]
    reason = _text_reason(F.size("f") == len(TEXT_FIELDS), *field[:3])
    return _split(parsed, reason, [*_repo_columns(*field), *keep])


def decode_integers(lines: DataFrame, keep: Sequence[str] = ()) -> Decoded:
    """One whole number per line, column ``value``; other lines are rejected."""
    parsed = _parse(lines, text_to_integer(F.col("value")), "n", keep)
    reason = F.when(F.col("n").isNull(), MALFORMED)
    return _split(parsed, reason, [F.col("n").alias("value"), *keep])


def count_integers(lines: DataFrame) -> DataFrame:
    """Number and sum of the good lines and number of the rejected ones, from one pass."""
    parsed = _parse(lines, text_to_integer(F.col("value")), "n", [])
    good = F.col("n").isNotNull()
    counted = parsed.groupBy(F.when(good, "rows").otherwise("rejects").alias("part"))
    return counted.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"))


def decode_capture(lines: DataFrame, keep: Sequence[str] = ()) -> Decoded:
    """Five unquoted comma-separated fields, where the fourth may hold commas itself.

    The first three fields are cut off the front and the last one off the back, so the line is
    walked twice rather than matched by a backtracking pattern. Banner lines between polls are
    neither rows nor rejects.
    """
    lines = lines.where(~F.col("value").rlike(BANNER))
    rest = F.try_element_at("f", F.lit(4))
    cut = _parse(lines, F.split("value", ",", 4), "f", keep).withColumn(
        "last", F.substring_index(rest, ",", -1)
    )
    text = F.substring(rest, F.lit(1), F.length(rest) - F.length("last") - 1)
    field = [F.try_element_at("f", F.lit(i)) for i in (1, 2, 3)]
    columns = _repo_columns(*field, missing_to_null(text), missing_to_null(F.col("last")))
    reason = _text_reason((F.size("f") == 4) & rest.contains(","), *field)
    return _split(cut, reason, [*columns, *keep])


def unnest_envelopes(bodies: DataFrame, keep: Sequence[str] = ()) -> Decoded:
    """One row per repository of each search response; missing or null ``items`` give none.

    A broken body is rejected whole; an item without an id or with an unreadable push time is
    rejected as JSON.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    body = F.from_json("value", f"{ENVELOPE}, {CORRUPT} STRING", options)
    parsed = _parse(bodies, body, "r", keep)
    broken = F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()
    bad = parsed.where(broken).select("value", F.lit(MALFORMED).alias("reason"))
    items = parsed.where(~broken).select(F.explode("r.items").alias("item"), *keep)
    at = F.col("item.pushed_at")
    reason = F.when(F.col("item").isNull() | F.col("item.id").isNull(), NO_KEY).when(
        _unreadable(at, parse_utc(at)), UNREADABLE
    )
    items = items.withColumn("value", F.to_json("item"))
    rows, rejects = _split(items, reason, ["item.*", *keep])
    return Decoded(rows, bad.unionByName(rejects))


def repo_words(repos: DataFrame) -> DataFrame:
    """The wire form of a repository: the five kept fields with the description cut into words."""
    return repos.select(
        "full_name",
        "pushed_at",
        "stargazers_count",
        words(F.col("description")).alias("description"),
        "language",
    )


def to_json_lines(rows: DataFrame) -> DataFrame:
    """Each row as one JSON object in a column ``value``."""
    return rows.select(F.to_json(F.struct("*")).alias("value"))
