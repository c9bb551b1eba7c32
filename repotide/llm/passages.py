"""Passages of at least ``RUN`` words that other documents hold too, wherever they lie in lines.

A run is ``RUN`` words in a row, compared as op2 compares words; line ends part words only.

* **Anchors.** Of the ``WINDOW`` stretches of ``CORE`` words in a run, the one with the smallest hash (a
  MinHash of size one) is its anchor: equal runs have it at the same place. Each run belongs to one
  anchor, and neighbouring runs mostly to the same.
* **Runs.** Anchors whose core occurs once hold no repeated run. For the others the hashes of their runs
  meet by core in one task, which finds those of different texts. A core that occurs more than ``HOT``
  times does not go to one task: its runs are counted one by one.

Texts that occur more than once are looked at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repotide.llm.common import MIX, SEPARATORS, hinted, mixed, ragged, stored, word_hashes, words

RUN = 50
CORE = 12
WINDOW = RUN - CORE + 1
# Words handled at once, but for a single text that is longer.
STEP = 200_000
# Rows of anchors handled at once, but for a single core.
ROWS = 20_000
HOT = 50_000
LAST = np.iinfo(np.int64).max

RUNS = "text_id BIGINT, rep BIGINT, core BIGINT, start INT, runs BINARY, open BINARY"
FOUND = "text_id BIGINT, start INT, end INT, cut BOOLEAN"
MERGED = "text_id BIGINT, n_passages INT, passage_words INT, cuts ARRAY<STRUCT<start: INT, end: INT>>"


def _both(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    out = (first * MIX) ^ second
    out ^= out >> np.uint64(29)
    out *= MIX
    return out ^ (out >> np.uint64(32))


class Hashes:
    """Hashes of stretches of words by their starts, each as long as asked for; those past the end are void."""

    def __init__(self, values: np.ndarray) -> None:
        self.by = {1: np.concatenate([values.astype(np.int64).view(np.uint64), np.zeros(RUN, np.uint64)])}

    def of(self, size: int) -> np.ndarray:
        if size not in self.by:
            half = 1 << (size - 1).bit_length() - 1
            first, rest = self.of(half), self.of(size - half)
            self.by[size] = _both(first, np.concatenate([rest[half:], rest[:half]]))
        return self.by[size]


def owners(values: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, Hashes]:
    """Starts of all runs in texts laid end to end, the anchor of each, and the hashes of the words."""
    hashes = Hashes(values)
    n = len(values)
    starts = np.arange(n)
    starts = starts[starts + RUN <= np.repeat(ends[1:], np.diff(ends))]
    if not len(starts):
        return starts, starts, hashes
    ranked = mixed(hashes.of(CORE)[:n]) & np.uint64(0xFFFFFFFF00000000)
    ranked |= np.arange(n, dtype=np.uint64)
    blocks = -(-(n + WINDOW) // WINDOW)
    filled = np.full(blocks * WINDOW, np.iinfo(np.uint64).max)
    filled[:n] = ranked
    filled = filled.reshape(blocks, WINDOW)
    ahead = np.minimum.accumulate(filled, axis=1).ravel()
    behind = np.minimum.accumulate(filled[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[starts], ahead[starts + WINDOW - 1])
    return starts, (least & np.uint64(0xFFFFFFFF)).astype(np.int64), hashes


def _parts(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with STEP words or fewer, or a single row."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    low = 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(total, total[low] + STEP, side="right")) - 1)
        yield low, high
        low = high


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, offsets = ragged(batch.column("hashes"))
        for low, high in _parts(np.diff(offsets)):
            values, ends = ragged(batch.column("hashes").slice(low, high - low))
            _, owner, hashes = owners(values, ends)
            at = np.unique(owner)
            if len(at):
                row = np.searchsorted(ends, at, side="right") - 1
                text_id = batch.column("text_id").slice(low, high - low).take(pa.array(row))
                core = hashes.of(CORE)[at].view(np.int64)
                yield pa.RecordBatch.from_arrays([text_id, pa.array(core)], ["text_id", "core"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By anchor, the hashes of its runs, and which of them lie in lines that stay."""
    for batch in batches:
        _, offsets = ragged(batch.column("hashes"))
        for low, high in _parts(np.diff(offsets)):
            part = batch.slice(low, high - low)
            values, ends = ragged(part.column("hashes"))
            starts, owner, hashes = owners(values, ends)
            if not len(starts):
                continue
            row = np.searchsorted(ends, starts, side="right") - 1
            core = hashes.of(CORE)[owner].view(np.int64)
            cores, core_ends = ragged(part.column("cores"))
            lines, line_ends = ragged(part.column("n_words"))
            removed, removed_ends = ragged(part.column("removed"))
            gone = np.zeros(len(values) + 1, np.int64)
            wanted = np.zeros(len(starts), bool)
            for i in range(len(part)):
                own = slice(*np.searchsorted(row, [i, i + 1]))
                wanted[own] = np.isin(core[own], cores[core_ends[i] : core_ends[i + 1]])
                lost = np.zeros(line_ends[i + 1] - line_ends[i], bool)
                lost[removed[removed_ends[i] : removed_ends[i + 1]]] = True
                gone[ends[i] + 1 : ends[i + 1] + 1] = np.repeat(lost, lines[line_ends[i] : line_ends[i + 1]])
            gone = np.cumsum(gone)
            starts, owner, row, core = starts[wanted], owner[wanted], row[wanted], core[wanted]
            if not len(starts):
                continue
            run = hashes.of(RUN)[starts]
            stays = gone[starts + RUN] == gone[starts]
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            spans = list(zip(first.tolist(), [*first[1:].tolist(), len(starts)]))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("text_id").take(pa.array(row[first])),
                    part.column("rep").take(pa.array(row[first])),
                    pa.array(core[first]),
                    pa.array((starts - ends[row])[first].astype(np.int32)),
                    pa.array([run[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([stays[a:b].tobytes() for a, b in spans], pa.binary()),
                ],
                ["text_id", "rep", "core", "start", "runs", "open"],
            )


def _repeated(rows: pa.Table) -> pa.RecordBatch:
    """Stretches of runs that different texts hold, and of those that an earlier text holds in lines that stay."""
    sizes = np.array([len(r) for r in rows["open"].to_pylist()], np.int64)
    run = np.frombuffer(b"".join(rows["runs"].to_pylist()), np.uint64)
    stays = np.frombuffer(b"".join(rows["open"].to_pylist()), bool)
    row = np.repeat(np.arange(len(sizes)), sizes)
    begin = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    start = rows["start"].to_numpy()[row] + np.arange(len(row)) - begin[row]
    text, rep = rows["text_id"].to_numpy()[row], rows["rep"].to_numpy()[row]
    order = np.lexsort((start, text, rep, ~stays, run))
    run, text, start, stays, place = run[order], text[order], start[order], stays[order], order
    new = np.diff(run, prepend=run[:1]) != 0
    new[:1] = True
    group = np.cumsum(new) - 1
    least = np.minimum.reduceat(text, np.flatnonzero(new))
    most = np.maximum.reduceat(text, np.flatnonzero(new))
    held = np.empty(len(row), bool)
    held[place] = (least != most)[group]
    cut = np.empty(len(row), bool)
    # The first place in a line that stays is kept, with all others in its text.
    cut[place] = stays & (text != text[np.flatnonzero(new)][group])
    text, start = rows["text_id"].to_numpy()[row], rows["start"].to_numpy()[row] + np.arange(len(row)) - begin[row]
    out: list[tuple] = []
    for flags, which in ((held, False), (cut, True)):
        chosen = np.flatnonzero(flags)
        breaks = (np.diff(chosen, prepend=-2) != 1) | (row[chosen] != row[chosen - 1])
        first = np.flatnonzero(breaks)
        last = np.concatenate([first[1:], [len(chosen)]])[: len(first)] - 1
        out.append((text[chosen[first]], start[chosen[first]], start[chosen[last]] + RUN, np.full(len(first), which)))
    columns = [np.concatenate(c) for c in zip(*out)]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["text_id", "start", "end", "cut"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by core; whole cores are compared, many at once."""
    left: list[pa.RecordBatch] = []
    for batch in batches:
        core = batch.column("core").to_numpy()
        cut = int(np.searchsorted(core, core[-1])) if len(core) else 0
        if cut and sum(map(len, left)) + cut >= ROWS:
            yield _repeated(pa.Table.from_batches([*left, batch.slice(0, cut)]))
            left, batch = [], batch.slice(cut)
        elif len(core) and left and left[-1].column("core")[-1].as_py() != core[0] and sum(map(len, left)) >= ROWS:
            yield _repeated(pa.Table.from_batches(left))
            left = []
        if len(batch):
            left.append(batch)
    if left:
        yield _repeated(pa.Table.from_batches(left))


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        sizes = np.array([len(r) for r in rows["open"].to_pylist()], np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        begin = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        start = rows["start"].to_numpy()[row] + np.arange(len(row)) - begin[row]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows["text_id"].to_numpy()[row]),
                pa.array(rows["rep"].to_numpy()[row]),
                pa.array(start.astype(np.int32)),
                pa.array(np.frombuffer(b"".join(rows["runs"].to_pylist()), np.int64)),
                pa.array(np.frombuffer(b"".join(rows["open"].to_pylist()), bool)),
            ],
            ["text_id", "rep", "start", "run", "open"],
        )


def _counted(runs: DataFrame) -> DataFrame:
    """The same stretches as by ``_compare``, one row for each run."""
    single = stored(
        runs.mapInArrow(_one_by_one, "text_id BIGINT, rep BIGINT, start INT, run BIGINT, open BOOLEAN"), "runs"
    )
    first = F.min(F.when(F.col("open"), F.struct("rep", "text_id")))["text_id"]
    held = single.groupBy("run").agg(F.min("text_id").alias("least"), F.max("text_id").alias("most"), first.alias("first"))
    held = stored(held.where("least < most").drop("least", "most"), "held_runs")
    end = (F.col("start") + RUN).alias("end")
    cut = F.col("open") & (F.col("text_id") != F.col("first"))
    both = F.explode(F.when(cut, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))).alias("cut")
    return single.join(hinted(held), "run").select("text_id", "start", end, both)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def union(spans: list[dict]) -> list[dict]:
        out: list[dict] = []
        for span in sorted(({"start": s["start"], "end": s["end"]} for s in spans), key=lambda s: s["start"]):
            if out and span["start"] <= out[-1]["end"]:
                out[-1]["end"] = max(out[-1]["end"], span["end"])
            else:
                out.append(span)
        return out

    for batch in batches:
        rows = [(union(s), union([x for x in s if x["cut"]])) for s in batch.column("spans").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("text_id"),
                pa.array([len(s) for s, _ in rows], pa.int32()),
                pa.array([sum(x["end"] - x["start"] for x in s) for s, _ in rows], pa.int32()),
                pa.array([c for _, c in rows], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ],
            ["text_id", "n_passages", "passage_words", "cuts"],
        )


def repeated_passages(texts: DataFrame, removed: DataFrame, hot: int = HOT) -> DataFrame:
    """(text_id, n_passages, passage_words, cuts) of texts (text_id, rep, text) with runs that another text holds.

    ``rep`` is the number of a text's first document, by which texts are ordered, nulls last. ``removed``
    (text_id, removed) names lines that go anyway. ``cuts`` are ranges of words whose runs lie in lines that stay and
    are held by an earlier text in lines that stay.
    """
    hashed = texts.select("text_id", word_hashes(F.col("text")).alias("hashes"))
    found = stored(hashed.mapInArrow(_anchors, "text_id BIGINT, core BIGINT"), "passage_anchors")
    often = found.groupBy("core").agg(F.count("*").alias("n")).where("n > 1")
    left = found.join(hinted(stored(often, "passage_cores")), "core")
    by_text = left.groupBy("text_id").agg(F.collect_set("core").alias("cores"), F.max("n").alias("most"))
    by_text = stored(by_text, "passage_texts")
    chosen = texts.join(hinted(by_text.drop("most")), "text_id")
    chosen = chosen.join(hinted(removed), "text_id", "left")
    counts = F.transform(F.split("text", "\n"), lambda line: F.size(words(line)))
    chosen = chosen.select(
        "text_id",
        F.coalesce("rep", F.lit(int(LAST))).alias("rep"),
        word_hashes(F.col("text")).alias("hashes"),
        counts.alias("n_words"),
        "cores",
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )
    runs = chosen.mapInArrow(_runs, RUNS)
    crowded = by_text.agg(F.max("most")).first()[0] or 0
    if crowded > hot:
        runs = stored(runs, "passage_runs")
        beyond = stored(often.where(F.col("n") > hot).select("core"), "hot_cores")
        counted = _counted(runs.join(hinted(beyond), "core", "left_semi").select(*RUNS.replace(",", "").split()[::2]))
        runs = runs.join(hinted(beyond), "core", "left_anti").select(*RUNS.replace(",", "").split()[::2])
    spans = runs.repartition("core").sortWithinPartitions("core").mapInArrow(_compare, FOUND)
    if crowded > hot:
        spans = spans.union(counted)
    spans = spans.groupBy("text_id").agg(F.collect_list(F.struct("start", "end", "cut")).alias("spans"))
    return stored(spans.mapInArrow(_merged, MERGED), "passages")


def without_words(text: Column, cuts: Column) -> Column:
    """The text without ranges of words, but with all its line ends."""
    word = SEPARATORS.replace("^", "")
    # With a blank before it, a text starts with what parts words, and takes turns from there.
    pieces = F.regexp_extract_all(F.concat(F.lit(" "), text), F.lit(f"{word}|{SEPARATORS}"), F.lit(0))

    def piece(p: Column, i: Column) -> Column:
        # The number of the word, or of the words before and after.
        first, last = F.floor((i - 1) / 2), F.floor(i / 2)
        inside = F.exists(cuts, lambda c: (first >= c["start"]) & (last < c["end"]))
        return F.when(inside, F.regexp_replace(p, "[^\n]+", "")).otherwise(p)

    return F.substr(F.array_join(F.transform(pieces, piece), ""), F.lit(2))
