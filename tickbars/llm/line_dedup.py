"""Removal of lines that an earlier line repeats, exactly or but for one word.

Lines are compared as words, A-Z in lower case. A line's deletion
neighbourhood is the line itself and every variant with one word left out, as
hashed keys. Lines within one edit share a key: with a word replaced, both
lack it at the same place; with a word added, the longer line lacks it and the
shorter one is that variant. So a grouped minimum per key names the earliest
neighbour of every line, without pairs, and a line thousands repeat is merged
before the shuffle. The edit distance to that neighbour is then verified.

Most lines have no neighbour. Lines one edit apart agree in their first or in
their last half, so only lines that share a half with another line get
variants.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.buffers import LOWER, Prefix, mix, powers, slices, text_bytes, words
from tickbars.sources.paths import saved

LINE = "id long, h long, line int, n int, a long, b long, halves array<long>"


@dataclass(frozen=True)
class LineDedup:
    """``least``: fewest words of a line that may go as an exact repeat; ``least_near``: words per edit, so fewest of a near line."""

    least: int = 1
    least_near: int = 8


class _Words:
    """Hashes over the word sequences of the lines of some texts."""

    def __init__(self, column: pa.Array) -> None:
        data, offsets = text_bytes(column)
        data = LOWER[data]
        starts, ends, _ = words(data, offsets)
        self.hashes = Prefix(data).ranges(starts, ends)
        up, self.down = powers(len(starts) + 2)
        self.sums = np.zeros(len(starts) + 2, np.uint64)
        np.cumsum(self.hashes * up[: len(starts)], out=self.sums[1:-1])
        # Lines start with a text and after each line feed.
        feeds = np.flatnonzero(data == 10)
        self.lines = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable")
        of_text = np.searchsorted(feeds, offsets) + np.arange(len(offsets))
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(of_text))
        self.number = np.arange(len(self.lines)) - of_text[self.text]
        self.first = np.searchsorted(starts, self.lines)
        self.last = np.append(self.first[1:], len(starts))

    def ranges(self, a: np.ndarray, b: np.ndarray, seed: int = 0) -> np.ndarray:
        return mix(mix((self.sums[b] - self.sums[a]) * self.down[a]) + np.uint64(seed))

    def without(self, a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Hash of words a..b without the one at ``at``."""
        head = (self.sums[at] - self.sums[a]) * self.down[a]
        tail = (self.sums[b] - self.sums[at + 1]) * self.down[a + 1]
        return mix(mix(head + tail) + np.uint64(0))


def _lines(texts: DataFrame, spec: LineDedup) -> DataFrame:
    """Every line that may go: its place, its number of words, its key, the hashes of its halves."""

    def run(batches):
        for part in slices(batches):
            w = _Words(part.column("text"))
            n = w.last - w.first
            pick = np.flatnonzero(n >= spec.least)
            n, a, b = n[pick], w.first[pick], w.last[pick]
            low, high = n // 2, (n + 1) // 2
            halves = np.stack([w.ranges(a, a + low, 1), w.ranges(a, a + high, 1), w.ranges(b - low, b, 2), w.ranges(b - high, b, 2)], axis=1)
            near, odd = n >= spec.least_near, n % 2 == 1
            counts = np.where(near, np.where(odd, 4, 2), 0)
            use = np.repeat(near[:, None], 4, axis=1)
            use[~odd, 1] = use[~odd, 3] = False
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), pa.array(halves[use].view(np.int64)))
            row = w.text[pick]
            columns = [part.column(c).to_numpy(zero_copy_only=False)[row] for c in ("id", "h")]
            columns += [w.number[pick].astype(np.int32), n.astype(np.int32), w.ranges(a, b).view(np.int64), w.ranges(a, b, 3).view(np.int64)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), lists], names=["id", "h", "line", "n", "a", "b", "halves"])

    return texts.mapInArrow(run, LINE)


def _variants(opened: DataFrame) -> DataFrame:
    """(id, h, text, open: lines) to keys: (id, h, line, key, at), ``at`` -1 for the line itself."""

    def run(batches):
        for part in slices(batches):
            w = _Words(part.column("text"))
            lists = part.column("open")
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            number = lists.flatten().to_numpy(zero_copy_only=False)
            first_line = np.searchsorted(w.text, np.arange(len(lists)))
            line = first_line[row] + number
            a, b = w.first[line], w.last[line]
            n = b - a
            each = np.repeat(np.arange(len(line)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            key = np.concatenate([w.ranges(a, b), w.without(a[each], b[each], a[each] + at)])
            which = np.concatenate([np.arange(len(line)), each])
            columns = [part.column(c).to_numpy(zero_copy_only=False)[row[which]] for c in ("id", "h")]
            columns += [number[which].astype(np.int32), key.view(np.int64), np.concatenate([np.full(len(line), -1), at]).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["id", "h", "line", "key", "at"])

    return opened.mapInArrow(run, "id long, h long, line int, key long, at int")


def within_one(x: list, y: list) -> bool:
    """Whether two sequences are at most one replaced, added or dropped item apart."""
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > 1:
        return False
    k = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), len(x))
    return x[k + (len(x) == len(y)) :] == y[k + 1 :]


def _words_of(texts: DataFrame, places: DataFrame) -> DataFrame:
    """(id, h, line) with the words of the line."""

    def run(batches):
        for batch in batches:
            rows = []
            for id_, h, text, numbers in zip(*(batch.column(c).to_pylist() for c in ("id", "h", "text", "open"))):
                split = (text or b"").lower().split(b"\n")
                rows += [(id_, h, k, split[k].split()) for k in numbers]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["id", "h", "line", "words"])

    by_text = places.groupBy("id", "h").agg(F.collect_set("line").alias("open"))
    opened = texts.join(by_text.hint("merge"), ["id", "h"]).select("id", "h", "text", "open")
    return opened.mapInArrow(run, "id long, h long, line int, words array<binary>")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (place, other) whose lines are within one edit."""

    def run(batches):
        for batch in batches:
            good = [within_one(x, y) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("place")], names=["place"]).filter(pa.array(good, pa.bool_()))

    places = pairs.select(F.explode(F.array("place", "other")).alias("place")).select("place.*").distinct()
    known = saved(_words_of(texts, places).select(F.struct("id", "h", "line").alias("place"), "words"), "line_words")
    other = known.select(F.col("place").alias("other"), F.col("words").alias("y"))
    both = pairs.join(known.withColumnRenamed("words", "x").hint("merge"), "place").join(other.hint("merge"), "other")
    return both.select("place", "x", "y").mapInArrow(run, "place struct<id: long, h: long, line: int>")


def _rewritten(batches):
    """Batches that end in text and gone, with these replaced by what is left."""
    for batch in slices(batches, limit=1 << 20):
        rows = []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
            lines = [] if text is None else text.split(b"\n")
            gone = set(gone or ())
            kept = b"\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else text
            rows.append((len(lines), len(gone), kept))
        made = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, (pa.int64(), pa.int64(), pa.binary()))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *made], names=[*batch.schema.names[:-2], "n_lines", "n_removed", "kept"])


def dedup_lines(docs: DataFrame, spec: LineDedup = LineDedup(), carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): columns ``carry``, n_lines, n_removed, kept (binary).

    A line goes if a line of an earlier place, (doc_id, hash of the text, line
    number), has the same words or lies within one edit of it; places are
    compared on the input, so what removes a line may go itself. A null doc_id
    comes first. Rows equal in doc_id and text are one place and stay alike.
    Lines without words stay, and those with fewer than ``least``. A line without
    white space is one word, however long. A null text has no lines and stays null.
    """
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("id"),
        F.xxhash64("text").alias("h"),
        *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(carry)],
        F.col("text").cast("binary").alias("text"),
    )
    lines = saved(_lines(texts, spec), "lines")
    kinds = lines.groupBy("a", "b").agg(
        F.min(F.struct("id", "h", "line")).alias("place"), F.count("*").alias("times"), F.first("halves").alias("halves")
    )
    kinds = saved(kinds, "line_kinds")
    halves = kinds.select(F.col("place"), F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    by_text = halves.join(shared.hint("merge"), "half").select("place.*").distinct()
    by_text = by_text.groupBy("id", "h").agg(F.collect_list("line").alias("open"))
    opened = texts.join(by_text.hint("merge"), ["id", "h"]).select("id", "h", "text", "open")
    keys = saved(_variants(opened).select(F.struct("id", "h", "line").alias("place"), "key", "at"), "line_variants")

    replaced = keys.where("at >= 0").groupBy("key", "at").agg(F.min("place").alias("other"), F.count("*").alias("n")).where("n > 1")
    added = keys.groupBy("key").agg(
        F.min(F.expr("CASE WHEN at < 0 THEN place END")).alias("whole"), F.min(F.expr("CASE WHEN at >= 0 THEN place END")).alias("longer")
    ).where("whole IS NOT NULL AND longer IS NOT NULL")
    same = keys.join(replaced.hint("merge"), ["key", "at"]).select("place", "other")
    more = keys.join(added.hint("merge"), "key").select("place", F.expr("CASE WHEN at < 0 THEN longer ELSE whole END").alias("other"))
    earliest = same.union(more).where("other < place").groupBy("place").agg(F.min("other").alias("other"))
    near = _verified(saved(earliest, "line_pairs"), texts)

    # A kind with an earlier neighbour goes everywhere, any other one stays at its first place.
    fate = kinds.join(near.withColumn("near", F.lit(True)).hint("merge"), "place", "left").where("near OR times > 1")
    fate = fate.select("a", "b", F.coalesce("near", F.lit(False)).alias("near"), "place")
    gone = lines.join(fate.hint("merge"), ["a", "b"]).where(F.col("near") | (F.struct("id", "h", "line") != F.col("place")))
    gone = gone.groupBy("id", "h").agg(F.collect_set("line").alias("gone"))
    out = texts.join(gone.hint("merge"), ["id", "h"], "left").select(*[f"_{i}" for i in range(len(carry))], "text", "gone")
    kinds_ = dict(docs.dtypes)
    schema = ", ".join([*(f"_{i} {kinds_[c]}" for i, c in enumerate(carry)), "n_lines long", "n_removed long", "kept binary"])
    out = out.mapInArrow(_rewritten, schema)
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(carry)], "n_lines", "n_removed", "kept")
