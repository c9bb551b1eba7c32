"""The programs from line files to tables and report."""

import json
import os

import pytest

from conftest import ROWS, rows_of
from repotide import run
from repotide.sinks import tables


def arrive(folder, number, values):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{number}.txt"
    with open(path, "w") as out:
        out.write("\n".join(values) + "\n")
    os.utime(path, (1_700_000_000 + number * 60, 1_700_000_000 + number * 60))


def as_line(form, row):
    _, _, id_, name, pushed, stars, text, language = row
    repo = {"full_name": name, "pushed_at": pushed, "stargazers_count": stars, "language": language}
    if form == "json":
        return json.dumps({**repo, "description": (text or "").split()})
    if form == "envelope":
        return json.dumps({"items": [{**repo, "id": id_, "description": text}]})
    return "\t".join([name, pushed, str(stars), (text or "").replace("\t", ""), language or "None"])


def show(spark, out):
    counts = tables.latest_batch(spark, f"{out}/dash_counts", tables.DASHBOARD["dash_counts"])
    stars = tables.latest_batch(spark, f"{out}/dash_stars", tables.DASHBOARD["dash_stars"])
    return rows_of(counts), rows_of(stars)


@pytest.mark.parametrize("form", ["json", "envelope", "tsv"])
def test_repos_program(spark, folder, form):
    places = ["--out", f"{folder}/out", "--checkpoint", f"{folder}/c", "--input", f"{folder}/in"]
    arrive(f"{folder}/in", 0, [as_line(form, r) for r in ROWS[:5]] + ["broken"])
    run.main(["repos", "--form", form, "--once", *places])
    arrive(f"{folder}/in", 1, [as_line(form, r) for r in ROWS[5:]])
    run.main(["repos", "--form", form, "--once", *places])
    assert show(spark, f"{folder}/out") == (
        [("C", 2), ("Java", 2), ("Python", 2)],
        [("C", 6.0), ("Java", 0.0), ("Python", 15.0)],
    )
    run.main(
        ["report", "--out", f"{folder}/out", "--to", f"{folder}/report", "--started", "1", "--ended", "2"]
    )
    part = [f for f in os.listdir(f"{folder}/report") if f.startswith("part-")][0]
    lines = open(f"{folder}/report/{part}").read().splitlines()
    assert lines[:4] == ["1:2", "Python:2:15.0", "Java:2:0.0", "C:2:6.0"]
    assert lines[4].startswith("Python:(data,")


def test_numbers_and_buckets_programs(spark, folder):
    arrive(f"{folder}/n", 0, ["9", "18", "x", "4"])
    arrive(f"{folder}/t", 0, [as_line("tsv", r) for r in ROWS])
    for program, source in (("numbers", "n"), ("buckets", "t")):
        run.main(
            [program, "--once", "--input", f"{folder}/{source}", "--out", f"{folder}/{program}",
             "--checkpoint", f"{folder}/c-{program}"]
        )
    running = tables.latest_batch(spark, f"{folder}/numbers/running", "isMultipleOf9 STRING, count BIGINT")
    assert rows_of(running) == [("No", 1), ("Yes", 2)]
    buckets = tables.latest_batch(spark, f"{folder}/buckets/buckets", "lang STRING, count BIGINT")
    assert rows_of(buckets) == [("C", 4), ("Java", 3), ("Python", 3)]
