"""Exact substring dedup by a distributed, prefix-aware merge sort of suffixes.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts anywhere else.

* **Anchors.** Of the first ``WINDOW`` starts of any such string, the one with the smallest hash of
  eight bytes is its anchor: equal strings have it at the same place. Only suffixes at anchors are
  sorted, about one in ``WINDOW / 2`` bytes. An anchor can matter only if the ``CORE`` bytes from it
  on, which any string it is the anchor of contains, occur at another anchor; others are dropped by
  counting hashes.
* **Runs.** Each task sorts the suffixes at its anchors, up to ``LENGTH`` bytes of them, merges equal
  ones, and writes them front-coded (length shared with the one before, and the rest), cut by
  their core's hash.
* **Merge.** All runs of a cut meet in one task, in a loser tree that knows how much each loser shares
  with the winner; only bytes beyond that are compared. It gives the sorted suffixes and what
  neighbours share.
* **Reach.** Two anchors share r bytes onwards (the least of what neighbours between them share) and
  l bytes backwards. If l + r >= LENGTH, all of these are covered. An anchor's covered bytes are those
  from its largest such l to its largest such r, as all of these stretches meet at the anchor.

Texts that occur more than once are sorted once. A core that occurs more than ``HOT`` times does not
go to one task: each string of LENGTH bytes around its anchors is counted by its digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.llm.common import MIX, grouped, hinted, mixed, read, stored

LENGTH = 400
GRAM = 8
# Runs are cut at so many suffixes, and so many meet in one merge.
RUN, MERGE = 100_000, 20_000
HOT = 50_000
# Starts handled at once; a longer text is handled in steps.
STEP = 1 << 20
# Groups up to this size are compared pair by pair in Python, larger ones by columns.
SMALL = 24


class Lengths:
    """The sizes that follow from the length of a string."""

    def __init__(self, length: int) -> None:
        self.length = length
        self.window = length // 2
        self.core = length - self.window + 1
        if self.window + GRAM > length:
            raise ValueError("strings must be longer than 15 bytes")


def _words_at(buffer: np.ndarray) -> np.ndarray:
    """Eight bytes from every position on, as integers; zeros follow the end."""
    padded = np.concatenate([buffer, np.zeros(GRAM, np.uint8)])
    return np.ndarray(len(buffer), np.dtype("<u8"), padded.tobytes(), strides=(1,))


def anchors(buffer: np.ndarray, ends: np.ndarray, size: Lengths) -> np.ndarray:
    """Anchor positions in texts laid end to end; ``ends`` holds where each text ends."""
    found = []
    w = size.window
    for begin in range(0, len(buffer), STEP):
        part = buffer[begin : begin + STEP + size.length]
        starts = np.arange(begin, min(begin + STEP, len(buffer)))
        end = ends[np.searchsorted(ends, starts, side="right")]
        valid = starts + size.length <= end
        if not valid.any():
            continue
        ranked = mixed(_words_at(part)) & np.uint64(0xFFFFFFFF00000000)
        ranked |= np.arange(len(part), dtype=np.uint64)
        blocks = -(-(len(part) + w) // w)
        filled = np.full(blocks * w, np.iinfo(np.uint64).max)
        filled[: len(part)] = ranked
        filled = filled.reshape(blocks, w)
        ahead = np.minimum.accumulate(filled, axis=1).ravel()
        behind = np.minimum.accumulate(filled[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[: len(starts)], ahead[w - 1 : w - 1 + len(starts)])
        place = (least[valid] & np.uint64(0xFFFFFFFF)).astype(np.int64) + begin
        found.append(place[np.flatnonzero(np.diff(place, prepend=-1))])
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def core_keys(buffer: np.ndarray, at: np.ndarray, size: Lengths) -> np.ndarray:
    """Hashes of the ``core`` bytes from each anchor on, all of which lie in its text."""
    key = np.zeros(len(at), np.uint64)
    whole = size.core // GRAM
    for i in range(0, len(at), STEP):
        own = at[i : i + STEP]
        low, high = own[0], own[-1] + size.core
        words = _words_at(buffer[low : high + GRAM])
        out = np.zeros(len(own), np.uint64)
        for j in range(whole):
            out = (out ^ words[own - low + GRAM * j]) * MIX
            out ^= out >> np.uint64(32)
        for j in range(whole * GRAM, size.core):
            out = (out ^ buffer[own + j].astype(np.uint64)) * MIX
            out ^= out >> np.uint64(32)
        key[i : i + STEP] = mixed(out)
    return key.view(np.int64)


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, nulls as empty, and where each text ends."""
    raw = [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(t) for t in raw], dtype=np.int64)


def _find(size: Lengths):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buffer, ends = _texts(batch.column("text"))
            at = anchors(buffer, ends, size)
            if len(at):
                row = np.searchsorted(ends, at, side="right")
                start = np.concatenate([[0], ends])[row]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("tid").take(pa.array(row)),
                        pa.array((at - start).astype(np.int32)),
                        pa.array(core_keys(buffer, at, size)),
                    ],
                    ["tid", "at", "core"],
                )

    return run


def shared(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of two strings that share at least ``known`` bytes."""
    most = min(len(a), len(b))
    if a[known:most] == b[known:most]:
        return most
    low, high = known, most
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low if a[low] != b[low] else high


Suffix = tuple[bytes, bytes, list]


def front_code(run: list[Suffix]) -> bytes:
    """A sorted run of (suffix, reversed bytes before it, members) as one compressed block."""
    shares, rests, befores, members = [], [], [], []
    last = b""
    for suffix, before, own in run:
        same = shared(last, suffix)
        shares.append(same)
        rests.append(suffix[same:])
        befores.append(before)
        members.append(b"".join(tid + at.to_bytes(8, "little") for tid, at in own))
        last = suffix
    head = np.array(
        [[s, len(r), len(b), len(m)] for s, r, b, m in zip(shares, rests, befores, members)], np.int64
    )
    parts = [len(run).to_bytes(8, "little"), head.tobytes(), *rests, *befores, *members]
    raw = b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def decode(block: bytes) -> Iterator[tuple[bytes, int, bytes, list]]:
    """Suffixes of a block with what each shares with the one before it."""
    raw = pa.decompress(block[8:], int.from_bytes(block[:8], "little"), codec="zstd", asbytes=True)
    n = int.from_bytes(raw[:8], "little")
    head = np.frombuffer(raw, np.int64, 4 * n, 8).reshape(n, 4)
    rest = 8 + head.nbytes
    before = rest + int(head[:, 1].sum())
    member = before + int(head[:, 2].sum())
    last = b""
    for share, n_rest, n_before, n_member in head.tolist():
        last = last[:share] + raw[rest : rest + n_rest]
        own = raw[member : member + n_member]
        yield (
            last,
            share,
            raw[before : before + n_before],
            [
                (own[i : i + 16], int.from_bytes(own[i + 16 : i + 24], "little"))
                for i in range(0, n_member, 24)
            ],
        )
        rest, before, member = rest + n_rest, before + n_before, member + n_member


def merge(runs: list[Iterator]) -> Iterator[tuple[bytes, int, bytes, list]]:
    """Merge sorted runs with a loser tree; each output comes with what it shares with the last.

    ``share[i]`` is what the head of run i shares with the winner that last passed its node, which is
    the last output for every loser on the path that is replayed. The head that shares more with the
    last output is the smaller one; only at equality are bytes compared, and only beyond it.
    """
    k = 1
    while k < len(runs):
        k *= 2
    heads: list = [next(run, None) for run in runs] + [None] * (k - len(runs))
    share = [0] * k
    losers = [0] * k

    def beats(i: int, j: int) -> bool:
        """Whether the head of i comes first; the loser's share becomes that with the winner."""
        a, b = heads[i], heads[j]
        if b is None:
            return True
        if a is None:
            return False
        if share[i] != share[j]:
            return share[i] > share[j]
        x, y = a[0], b[0]
        same = shared(x, y, share[i])
        first = (x[same : same + 1], i) < (y[same : same + 1], j)
        share[j if first else i] = same
        return first

    def play(node: int) -> int:
        if node >= k:
            return node - k
        left, right = play(2 * node), play(2 * node + 1)
        if not beats(left, right):
            left, right = right, left
        losers[node] = right
        return left

    winner = play(1) if k > 1 else 0
    while heads[winner] is not None:
        suffix, _, before, own = heads[winner]
        yield suffix, share[winner], before, own
        heads[winner] = next(runs[winner], None) if winner < len(runs) else None
        share[winner] = heads[winner][1] if heads[winner] else 0
        node = (winner + k) // 2
        while node:
            if beats(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2


def reach(suffixes: list[bytes], shares: list[int], befores: list[bytes], length: int):
    """For each of a group of sorted suffixes its largest l and r, or None.

    ``shares[i]`` is what suffix i shares with suffix i - 1.
    """
    n = len(suffixes)
    left, right = [0] * n, [0] * n
    if n <= SMALL:
        for i in range(n):
            r = length
            for j in range(i + 1, n):
                r = min(r, shares[j])
                l = shared(befores[i], befores[j])
                if l + r >= length:
                    for x in (i, j):
                        left[x], right[x] = max(left[x], l), max(right[x], r)
    else:
        order = sorted(range(n), key=befores.__getitem__)
        back = np.zeros(n, np.int64)
        back[1:] = [shared(befores[a], befores[b]) for a, b in zip(order, order[1:])]
        on, place = np.array(shares), np.array(order)
        low, high = np.full(n, -1), np.full(n, -1)
        for l in range(int(back.max()) + 1):
            # Equal strings around the anchor have equal parts before and after it.
            after = np.cumsum(np.r_[True, on[1:] < length - l])
            ahead = np.empty(n, np.int64)
            ahead[place] = np.cumsum(np.r_[True, back[1:] < l])
            key = after * (n + 1) + ahead
            ranked = np.sort(key)
            twice = ranked[1:][ranked[1:] == ranked[:-1]]
            if len(twice):
                hit = np.isin(key, twice)
                low[hit & (low < 0)] = l
                high[hit] = l
        left = high.tolist()
        right = [length - x for x in low.tolist()]
        return [(l, r) if l >= 0 else None for l, r in zip(left, right)]
    return [(l, r) if r else None for l, r in zip(left, right)]


def _write_runs(size: Lengths, cuts: int, run_size: int):
    """Sorted, front-coded runs by cut, from texts and the anchors that are left in them."""

    def blocks(found: dict) -> Iterator[pa.RecordBatch]:
        out: dict[int, list[Suffix]] = {}
        for (cut, suffix, before), own in found.items():
            out.setdefault(cut, []).append((suffix, before, own))
        for cut, run in out.items():
            run.sort(key=lambda s: s[:2])
            yield pa.RecordBatch.from_arrays(
                [pa.array([cut], pa.int64()), pa.array([front_code(run)], pa.binary())], ["cut", "block"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for batch in batches:
            for tid, text, ats, cores in zip(*(batch.column(c) for c in ("tid", "text", "ats", "cores"))):
                raw, tid = text.as_py().encode(), tid.as_py()
                for at, core in zip(ats.as_py(), cores.as_py()):
                    suffix = raw[at : at + size.length]
                    before = raw[max(0, at - size.window + 1) : at][::-1]
                    found.setdefault((core % cuts, suffix, before), []).append((tid, at))
                if len(found) >= run_size:
                    yield from blocks(found)
                    found = {}
        yield from blocks(found)

    return run


def _merge_runs(size: Lengths):
    def groups(blocks: list[bytes]) -> Iterator[list]:
        """Suffixes that share their cores; equal ones with equal bytes before them are one."""
        group: list = []
        for suffix, share, before, own in merge([decode(b) for b in blocks]):
            if group and share < size.core:
                yield group
                group = []
            group.append((suffix, share, before, own))
        if group:
            yield group

    def covered(group: list) -> Iterator[tuple[bytes, int, int]]:
        same: dict[tuple[bytes, bytes], list] = {}
        for suffix, _, before, own in group:
            same.setdefault((suffix, before), []).extend(own)
        distinct: list = []
        least = size.length
        seen = set()
        for suffix, share, before, _ in group:
            least = min(least, share)
            if (suffix, before) not in seen:
                seen.add((suffix, before))
                distinct.append((suffix, least, before))
                least = size.length
        found = reach([d[0] for d in distinct], [d[1] for d in distinct], [d[2] for d in distinct], size.length)
        for (suffix, _, before), lr in zip(distinct, found):
            own = same[suffix, before]
            if len(own) > 1 and len(before) + len(suffix) >= size.length:
                lr = (len(before), len(suffix))
            if lr:
                for tid, at in own:
                    yield tid, at - lr[0], at + lr[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches, "cut"):
            found = [c for group in groups([r["block"] for r in rows]) for c in covered(group)]
            if found:
                tid, start, end = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tid, pa.binary()), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                    ["tid", "start", "end"],
                )

    return run


def _count_strings(size: Lengths):
    """Every string of the full length around an anchor, by its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tid, text, ats in zip(*(batch.column(c) for c in ("tid", "text", "ats"))):
                raw, tid = text.as_py().encode(), tid.as_py()
                starts = sorted(
                    {
                        s
                        for at in ats.as_py()
                        for s in range(max(0, at - size.window + 1), min(at, len(raw) - size.length) + 1)
                    }
                )
                digests = [hashlib.blake2b(raw[s : s + size.length], digest_size=16).digest() for s in starts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([tid] * len(starts), pa.binary()),
                        pa.array(starts, pa.int64()),
                        pa.array(digests, pa.binary()),
                    ],
                    ["tid", "start", "string"],
                )

    return run


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, spans = (batch.column(c) for c in ("doc_id", "text", "spans"))
        out = []
        for i in range(len(batch)):
            text = texts[i].as_py()
            raw = b"" if text is None else text.encode()
            kept, at, n = hashlib.sha256(), 0, 0
            merged: list[list[int]] = []
            for start, end in sorted((s["start"], s["end"]) for s in spans[i].as_py() or ()):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([start, end])
            for start, end in merged:
                kept.update(raw[at:start])
                at, n = end, n + end - start
            kept.update(raw[at:])
            out.append((ids[i].as_py(), len(raw), n, len(merged), kept.hexdigest(), merged))
        if out:
            columns = list(zip(*out))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
            )


REMOVED = (
    "doc_id BIGINT, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept_sha256 STRING, "
    "spans ARRAY<ARRAY<BIGINT>>"
)


def covered_spans(texts: DataFrame, length: int, hot: int, merge_size: int, run_size: int) -> DataFrame:
    """(tid, start, end) of covered bytes, overlapping, of distinct texts (tid, text)."""
    size = Lengths(length)
    long = texts.where(F.octet_length("text") >= length)
    found = stored(long.mapInArrow(_find(size), "tid BINARY, at INT, core BIGINT"), "anchors")
    often = found.groupBy("core").agg(F.count("*").alias("n")).where("n > 1")
    # Stored, so that both sides of the join are dealt out for it and a hot core can be split.
    left = stored(found.join(hinted(stored(often, "cores")), "core"), "candidates")

    def with_text(chosen: DataFrame) -> DataFrame:
        by_text = stored(
            chosen.groupBy("tid").agg(F.collect_list("at").alias("ats"), F.collect_list("core").alias("cores")),
            "by_text",
        )
        return long.join(by_text, "tid")

    usual = left.where(F.col("n") <= hot)
    cuts = max(1, -(-usual.count() // merge_size))
    runs = with_text(usual).mapInArrow(_write_runs(size, cuts, run_size), "cut BIGINT, block BINARY")
    # Merges are of even size: one task holds several cuts when they are many.
    merged = runs.repartition("cut").sortWithinPartitions("cut")
    spans = merged.mapInArrow(_merge_runs(size), "tid BINARY, start BIGINT, end BIGINT")
    crowded = left.where(F.col("n") > hot)
    if crowded.limit(1).count():
        strings = with_text(crowded).mapInArrow(
            _count_strings(size), "tid BINARY, start BIGINT, string BINARY"
        )
        strings = stored(strings, "strings")
        twice = strings.groupBy("string").agg(F.count("*").alias("n")).where("n > 1").select("string")
        ends = strings.join(hinted(stored(twice, "twice")), "string", "left_semi")
        spans = spans.union(ends.select("tid", "start", (F.col("start") + length).alias("end")))
    return spans


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    hot: int = HOT,
    merge_size: int = MERGE,
    run_size: int = RUN,
) -> DataFrame:
    """Per document what is left without bytes that a repeated string of ``length`` bytes covers.

    ``n_bytes``, ``n_removed``, ``n_spans`` (maximal runs removed), ``kept_sha256`` (of what is left) and
    ``spans`` (byte ranges removed). A null text is empty. Of a text that occurs more than once,
    repeated rows included, all bytes go if it has ``length`` of them. Other columns are ignored; no
    rows give no rows.
    """
    rows = docs.select("doc_id", "text", F.unhex(F.substring(F.sha2("text", 256), 1, 32)).alias("tid"))
    copies = rows.where(F.octet_length("text") >= length).groupBy("tid")
    copies = copies.agg(F.count("*").alias("n"), F.min("doc_id").alias("rep")).where("n > 1")
    copies = stored(copies.withColumnRenamed("tid", "of"), "copies")
    marked = rows.join(hinted(copies), F.col("tid") == F.col("of"), "left").drop("of")
    # A second row of the same number and text among the copies adds nothing, and does no harm.
    once = marked.where("n is null or doc_id <=> rep").select("tid", "text")
    spans = covered_spans(once, length, hot, merge_size, run_size)
    spans = spans.groupBy("tid").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    spans = stored(spans, "spans")
    size = F.octet_length("text").cast("bigint")
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), size.alias("end")))
    joined = marked.join(spans, "tid", "left").select(
        "doc_id", "text", F.when(F.col("n").isNotNull(), whole).otherwise(F.col("found")).alias("spans")
    )
    return joined.mapInArrow(_remove, REMOVED)


def op9_suffix_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).drop("spans")
