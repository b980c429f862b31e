"""Documents that quote a benchmark item, whole and with few edits.

Pigeonhole matching: an item that may differ in ``k`` edits is split into
``k + 1`` pieces, one of which must occur unchanged. All pieces of a block of
items form one automaton that scans each document once; where a piece hits,
Myers' bit-parallel recurrence gives the edit distance of the whole item to
the text around it.

Texts are compared in lower case, anything but letters and digits being one
space. The items are a stated query set: they are measured first and handled
in blocks of bounded size, each against all documents, without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

OTHER = re.compile(r"[\W_]+")
MATCH = "item_id long, distance int, start int"


@dataclass(frozen=True)
class Contamination:
    """``per_edit``: characters of an item per allowed edit; ``least``: an item with fewer characters
    matches only word for word, without an edit; ``block``: characters of the items handled at once."""

    per_edit: int = 15
    least: int = 24
    block: int = 4_000_000


def plain(text: str | None) -> str:
    return OTHER.sub(" ", (text or "").lower()).strip()


def edit_distance_within(masks: dict[str, int], size: int, text: str, most: int) -> tuple[int, int] | None:
    """(distance, end) of the best substring of ``text`` for a pattern given by its character masks."""
    top, ones = 1 << (size - 1), (1 << size) - 1
    plus, minus, score, best = ones, 0, size, (most + 1, 0)
    for end, c in enumerate(text, 1):
        equal = masks.get(c, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (ones & ~(horizontal | plus))
        down = plus & horizontal
        score += 1 if up & top else -1 if down & top else 0
        if score < best[0]:
            best = (score, end)
        up, down = (up << 1) & ones, (down << 1) & ones
        plus = down | (ones & ~(vertical | up))
        minus = up & vertical
    return best if best[0] <= most else None


class Items:
    """The automaton of a block of items."""

    def __init__(self, items: list[tuple[int, str]], spec: Contamination) -> None:
        self.items, pieces = [], {}
        for item_id, text in items:
            text = plain(text)
            if not text:
                continue
            if len(text) < spec.least:
                pieces.setdefault(f" {text} ", []).append((len(self.items), None))
                self.items.append((item_id, text, 0, {}))
                continue
            edits = len(text) // spec.per_edit
            masks: dict[str, int] = {}
            for i, c in enumerate(text):
                masks[c] = masks.get(c, 0) | 1 << i
            k = len(self.items)
            self.items.append((item_id, text, edits, masks))
            cuts = [len(text) * i // (edits + 1) for i in range(edits + 2)]
            for a, b in zip(cuts, cuts[1:]):
                pieces.setdefault(text[a:b], []).append((k, a))
        self.pieces = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.pieces.add_word(piece, (len(piece), places))
        if pieces:
            self.pieces.make_automaton()

    def matches(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item_id, distance, start in the plain text) of the best place of each item in ``text``."""
        if not self.items or not text:
            return []
        text = plain(text)
        tried: set[tuple[int, int]] = set()
        best: dict[int, tuple[int, int]] = {}
        for end, (size, places) in self.pieces.iter(f" {text} "):  # places are one further on than in the text
            for k, offset in places:
                if offset is None:
                    best.setdefault(k, (0, end + 1 - size))
                    continue
                start = end - size - offset
                if (k, start) in tried or best.get(k, (1,))[0] == 0:
                    continue
                tried.add((k, start))
                _, item, edits, masks = self.items[k]
                if text.startswith(item, max(start, 0)) and start >= 0:
                    best[k] = (0, start)
                    continue
                low = max(0, start - edits)
                found = edit_distance_within(masks, len(item), text[low : start + len(item) + edits], edits)
                if found and found[0] < best.get(k, (edits + 1,))[0]:
                    best[k] = (found[0], max(0, low + found[1] - len(item)))
        return [(self.items[k][0], distance, start) for k, (distance, start) in sorted(best.items())]


def item_blocks(benchmark: DataFrame, spec: Contamination) -> Iterator[list[tuple[int, str]]]:
    """The items (item_id, text), as lists of bounded size on the driver."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / spec.block))
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield [(r.item_id, r.text) for r in part.collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame, spec: Contamination = Contamination()) -> DataFrame:
    """(doc_id, item_id, distance, start): the items that each row of ``docs`` contains.

    ``start`` is the place in the compared form of the text. A null text or
    item matches nothing; repeated items count once, repeated documents each.
    """

    def search(items: list[tuple[int, str]]):
        def run(batches):
            found = Items(items, spec)
            for batch in batches:
                rows = [(i, *m) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for m in found.matches(t)]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, kinds)], names=["doc_id", "item_id", "distance", "start"])

        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, {MATCH}")

    out = None
    for items in item_blocks(benchmark, spec):
        found = search(items)
        out = found if out is None else out.union(found)
    return out


def without_contaminated(docs: DataFrame, benchmark: DataFrame, spec: Contamination = Contamination()) -> DataFrame:
    """The rows of ``docs`` that contain no item, all columns as they are."""

    def clean(frame: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
        at = frame.columns.index("text")
        names = frame.schema.names
        plain_names = frame.toDF(*[f"_{i}" for i in range(len(names))])

        def run(batches):
            found = Items(items, spec)
            for batch in batches:
                yield batch.filter(pa.array([not found.matches(t) for t in batch.column(at).to_pylist()], pa.bool_()))

        return plain_names.mapInArrow(run, StructType(plain_names.schema.fields)).toDF(*names)

    for items in item_blocks(benchmark, spec):
        docs = clean(docs, items)
    return docs
