"""Removal of byte strings that start at more than one place of a corpus.

Every byte covered by a string of ``length`` bytes with two starting places,
anywhere in the corpus, goes. Prefix-free parsing keeps that affordable: the
start of a rolling-hash minimum among ``reach`` positions is a trigger, and the
triggers depend on content alone, so equal strings are parsed alike. Each
string belongs to the first minimum in its leading ``reach`` positions; the
strings of one trigger form a phrase. The dictionary holds the phrases'
leading ``length - reach + 1`` bytes from the trigger on, which all strings of
the phrase share: where those are unique in the corpus, nothing repeats. Where
the whole phrase repeats, all its strings do. Only phrases in between, at the
ends of a repeated passage, are opened and their strings counted one by one.

Suffixes of the parse matter up to ``length`` bytes only, and only whether they
are equal. They are therefore grouped by hash instead of being sorted into one
array: grouping needs no global order, and a passage in every document is
counted before the shuffle. Two hashes of 64 bits, of core and string, have to agree.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.buffers import Prefix, mix, slices, text_bytes
from tickbars.sources.paths import saved

PHRASE = {"id": pa.int64(), "h": pa.int64(), "first": pa.int32(), "core": pa.int64(), "small": pa.bool_(), "bytes": pa.binary()}
SPAN = "id long, h long, first int, last int"
#: Slices of this size keep the arrays of a task in its processor's cache.
SLICE = 1 << 19


@dataclass(frozen=True)
class Repeats:
    """``length``: bytes of a repeated string; ``reach``: longest phrase (a power of two);
    ``trigger``: bytes under the rolling hash; ``group``: most kinds of phrases of one core that a
    task compares at once, more are compared as rows."""

    length: int = 200
    reach: int = 128
    trigger: int = 16
    group: int = 16_384

    def __post_init__(self) -> None:
        if self.reach & (self.reach - 1) or self.reach + self.trigger > self.length:
            raise ValueError("reach is a power of two, and reach + trigger at most length")


def phrases(data: np.ndarray, offsets: np.ndarray, spec: Repeats):
    """(first start, last start, trigger) of every phrase: runs of strings with one trigger."""
    sizes = np.diff(offsets)
    n = max(0, len(data) - spec.length + 1)
    valid = (np.repeat(offsets[1:], sizes) - np.arange(len(data)))[:n] >= spec.length
    if not valid.any():
        return (np.zeros(0, np.int64),) * 3
    hashed = Prefix(data)
    rolled = hashed.rolling(spec.trigger)
    least = (rolled & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(rolled), dtype=np.uint64)
    step = 1
    while step < spec.reach:
        least[:-step] = np.minimum(least[:-step], least[step:])
        step *= 2
    at = (least[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (at[1:] != at[:-1])
    last = valid.copy()
    last[:-1] &= ~valid[1:] | (at[1:] != at[:-1])
    first = np.flatnonzero(new)
    return first, np.flatnonzero(last), at[first]


def _runs(texts: DataFrame, spec: Repeats) -> DataFrame:
    """Phrases of (id, h, text): where they start and end, hashes of core and whole."""
    core = spec.length - spec.reach + 1

    def run(batches):
        for part in slices(batches, limit=SLICE):
            data, offsets = text_bytes(part.column("text"))
            first, last, trigger = phrases(data, offsets, spec)
            if not len(first):
                continue
            hashed = Prefix(data)
            row = np.searchsorted(offsets, first, side="right") - 1
            ids, hs = (part.column(c).to_numpy(zero_copy_only=False)[row] for c in ("id", "h"))
            begin = offsets[row]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids),
                    pa.array(hs),
                    pa.array((first - begin).astype(np.int32)),
                    pa.array((last - begin).astype(np.int32)),
                    pa.array(hashed.ranges(trigger, trigger + core).view(np.int64)),
                    pa.array(hashed.ranges(first, last + spec.length).view(np.int64)),
                ],
                names=["id", "h", "first", "last", "core", "whole"],
            )

    return texts.mapInArrow(run, "id long, h long, first int, last int, core long, whole long")


def _opened(texts: DataFrame, spec: Repeats) -> DataFrame:
    """The bytes of the phrases to open: (id, h, text, open) to one row per phrase."""

    def run(batches):
        for batch in batches:
            texts_, rows = batch.column("text").to_pylist(), []
            for id_, h, text, phrases_ in zip(batch.column("id").to_pylist(), batch.column("h").to_pylist(), texts_, batch.column("open").to_pylist()):
                for p in phrases_:
                    rows.append((id_, h, p["first"], p["core"], p["small"], text[p["first"] : p["last"] + spec.length]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), PHRASE.values())], names=list(PHRASE))

    return texts.mapInArrow(run, "id long, h long, first int, core long, small boolean, bytes binary")


def _strings(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, offset in the row, hash) of every string of the phrases in ``column``."""
    data, offsets = text_bytes(column)
    counts = np.diff(offsets) - length + 1
    row = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offsets[row] + at
    return row, at, Prefix(data).ranges(start, start + length)


def _spans(members: pa.Array, row: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """Runs of consecutive strings as spans of their documents."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:] - 1, len(row) - 1) if len(row) else head
    taken = members.take(pa.array(row[head]))
    base = taken.field("first").to_numpy(zero_copy_only=False)
    arrays = [taken.field("id"), taken.field("h"), pa.array((base + at[head]).astype(np.int32)), pa.array((base + at[tail]).astype(np.int32))]
    return pa.RecordBatch.from_arrays(arrays, names=["id", "h", "first", "last"])


def _by_members(batches, limit: int = 1 << 12):
    """The batches cut to rows with ``limit`` members together, or one row."""
    for batch in batches:
        ends, at = np.cumsum(np.diff(batch.column("members").offsets.to_numpy())), 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right")))
            # A copy, as the offsets of a slice would still be those of the batch.
            yield pa.RecordBatch.from_arrays([pa.array(batch.column("members").slice(at, to - at).to_pylist(), batch.column("members").type)], names=["members"])
            at = to


def _small_groups(groups: DataFrame, length: int) -> DataFrame:
    """Strings that phrases with one core share; ``members`` holds all those phrases."""

    def run(batches):
        for batch in _by_members(batches):
            lists = batch.column("members")
            members = lists.flatten()
            group = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            row, at, hashed = _strings(members.field("bytes"), length)
            _, inverse, counts = np.unique(mix(hashed ^ mix(group[row].astype(np.uint64))), return_inverse=True, return_counts=True)
            again = counts[inverse] > 1
            yield _spans(members, row[again], at[again])

    return groups.mapInArrow(run, SPAN)


def _large_groups(phrases_: DataFrame, length: int) -> DataFrame:
    """The same for cores with many phrases: strings as rows, counted before the shuffle."""

    def run(batches):
        for part in slices(batches, "bytes", 1 << 19):
            row, at, hashed = _strings(part.column("bytes"), length)
            pick = pa.array(row)
            arrays = [part.column(c).take(pick) for c in ("core", "id", "h")]
            base = part.column("first").to_numpy(zero_copy_only=False)[row]
            arrays += [pa.array((base + at).astype(np.int32)), pa.array(hashed.view(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=["core", "id", "h", "first", "x"])

    strings = phrases_.mapInArrow(run, "core long, id long, h long, first int, x long")
    again = strings.groupBy("core", "x").agg(F.count("*").alias("n")).where("n > 1").select("core", "x")
    return strings.join(again.hint("merge"), ["core", "x"]).select("id", "h", "first", F.col("first").alias("last"))


def _cut(batches, length: int):
    for batch in batches:
        out = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            text = text or b""
            kept, removed, runs, at, end = [], 0, 0, 0, 0
            for a, b in sorted((s["first"], s["last"] + length) for s in spans or ()):
                if a > end or not runs:
                    kept.append(text[end:a])
                    runs, end = runs + 1, b
                    removed += b - a
                elif b > end:
                    removed += b - end
                    end = b
            kept.append(text[end:])
            out.append((len(text), removed, runs, b"".join(kept)))
        columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))] if out else []
        if columns:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, spec: Repeats = Repeats()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept (binary).

    A string that occurs twice goes at both places, also in rows that share a
    doc_id or have none. A null text counts as empty; a text shorter than
    ``length`` bytes loses nothing.
    """
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("id"),
        F.xxhash64("text").alias("h"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("binary").alias("text"),
    )
    runs = _runs(texts, spec)
    wholes = runs.groupBy("core", "whole").agg(F.count("*").alias("n"))
    cores = wholes.groupBy("core").agg(F.sum("n").alias("total"), F.min("n").alias("least"), F.count("*").alias("kinds")).where("total > 1")
    marked = runs.join(wholes.join(cores.hint("merge"), "core").select("core", "whole", "n", "least", "kinds").hint("merge"), ["core", "whole"])
    marked = saved(marked, "phrases")
    settled = marked.where("n > 1").select("id", "h", "first", "last")
    # Lone phrases may share some strings with other phrases of their core; of a repeated one, a single copy stands for all.
    mixed = marked.where("least = 1 AND kinds > 1")
    mixed = mixed.where("n = 1").union(mixed.where("n > 1").dropDuplicates(["core", "whole"]))
    struct = F.struct("first", "last", "core", (F.col("kinds") <= spec.group).alias("small"))
    by_text = mixed.groupBy("id", "h").agg(F.collect_set(struct).alias("open"))
    opened = _opened(texts.join(by_text.hint("merge"), ["id", "h"]).select("id", "h", "text", "open"), spec)
    small = opened.where("small").groupBy("core").agg(F.collect_list(F.struct("id", "h", "first", "bytes")).alias("members"))
    found = _small_groups(small, spec.length).union(_large_groups(opened.where("NOT small"), spec.length))
    spans = settled.union(found).groupBy("id", "h").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    both = texts.join(spans.hint("merge"), ["id", "h"], "left").select("doc_id", "text", "spans")
    return both.mapInArrow(
        lambda batches: _cut(batches, spec.length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
