"""Best documents for each item by weighted terms, without a document index.

The items are a stated query set. Their distinct terms form an automaton
(Aho-Corasick) that goes to every task; each term has a guard on both sides, so
only whole terms match, and one scan of a text counts all of them. A first pass
keeps, per document, its length and the counts of the items' terms it holds;
the weights follow from that table. A second pass over it scores the documents:
what the automaton put out for a term goes to the items that have the term, and
every task keeps its best documents per item. No row is made for a document and
an item that share a term but do not come near the best.

Items are measured first and handled in blocks: a block's terms have about
``block_bytes`` bytes and it has about ``block_items`` items. Only a block's
terms, postings, weights and item ids are sent to tasks; nothing that grows
with the documents is.

Defined cases: a null or empty text has no terms; such a document counts for
nothing, and such an item finds nothing. Rows that share an item_id (null
included) are one item with the terms of all. Rows of documents are ranked one
by one, also those with equal ids or texts; a null doc_id comes before others
on equal scores. Texts are scanned whole, however long. Empty tables give an
empty result; further columns are never looked at.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickbars.llm.buffers import slices
from tickbars.sources.paths import saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed value: the characters of a term.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GUARD = " "
RESULT = "item_id long, rank int, doc_id long, score long"


@dataclass(frozen=True)
class LexicalSearch:
    """``cells``: scores of documents by items that a task holds at once; ``group``: tasks whose results are merged first."""

    top: int = 10
    block_bytes: int = 4_000_000
    block_items: int = 5_000
    cells: int = 1_000_000
    group: int = 64


def _plain_bytes() -> bytes:
    """Bytes of a text to those of its terms in lower case, all others to the guard."""
    table = bytearray(GUARD.encode() * 128 + bytes(range(128, 256)))
    for c in "0123456789" + LOWER:
        table[ord(c)] = ord(c)
    for a, b in zip(UPPER, LOWER):
        table[ord(a)] = ord(b)
    return bytes(table)


PLAIN = _plain_bytes()


@dataclass
class Block:
    """Items with their terms: the items of term t are ``places[bounds[t]:bounds[t + 1]]``."""

    name: str
    items: list[int | None]
    terms: list[str]
    bounds: np.ndarray
    places: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @classmethod
    def of(cls, name: str, rows: list[tuple[int | None, str]]) -> Block:
        items = sorted({i for i, _ in rows}, key=lambda i: (i is not None, i or 0))
        terms = sorted({t for _, t in rows})
        item, term = {i: k for k, i in enumerate(items)}, {t: k for k, t in enumerate(terms)}
        pairs = np.array(sorted((term[t], item[i]) for i, t in rows), np.int64).reshape(-1, 2)
        bounds = np.searchsorted(pairs[:, 0], np.arange(len(terms) + 1))
        return cls(name, items, terms, bounds, pairs[:, 1].copy())


_automata: dict[str, ahocorasick.Automaton] = {}


def automaton(block: Block) -> ahocorasick.Automaton:
    """That of a block, built once per Python process."""
    if block.name not in _automata:
        _automata.clear()
        made = _automata[block.name] = ahocorasick.Automaton()
        for k, term in enumerate(block.terms):
            made.add_word(f"{GUARD}{term}{GUARD}", k)
        if block.terms:
            made.make_automaton()
    return _automata[block.name]


def term_counts(data: bytes, machine: ahocorasick.Automaton) -> tuple[int, Counter]:
    """(all terms of a text, occurrences of the automaton's terms)."""
    plain = data.translate(PLAIN)
    inside = np.frombuffer(plain, np.uint8) != ord(GUARD)
    n = int(np.count_nonzero(inside[1:] & ~inside[:-1])) + int(inside[:1].sum())
    found = Counter(k for _, k in machine.iter(f"{GUARD}{plain.decode('utf-8', 'replace')}{GUARD}")) if len(machine) else Counter()
    return n, found


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term)."""
    terms = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0))
    return items.select(F.col("item_id").cast("long"), F.explode(terms).alias("term")).distinct()


def scan(docs: DataFrame, block: Block) -> DataFrame:
    """(doc_id, n, terms, counts) of the documents with a term; ``terms`` are those of the block."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(shared.value)
        for part in slices(batches):
            found = [term_counts(x, machine) for x in part.column("text").to_pylist()]
            lists = ([list(c) for _, c in found], [list(c.values()) for _, c in found])
            columns = [pa.array([n for n, _ in found], pa.int64()), pa.array(lists[0], pa.list_(pa.int32())), pa.array(lists[1], pa.list_(pa.int64()))]
            made = pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=["doc_id", "n", "terms", "counts"])
            yield made.filter(pa.array([n > 0 for n, _ in found], pa.bool_()))

    whole = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return whole.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>")


def term_weights(n_docs: int, frequencies: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in frequencies], np.int64)


class Best:
    """The best rows per item of what one task has seen."""

    def __init__(self, n_items: int, top: int) -> None:
        self.top = top
        self.rows = [np.zeros(0, np.int64) for _ in range(4)]  # item, score, whether the id is known, id
        self.waiting: list[list[np.ndarray]] = []
        self.least, self.last = np.zeros(n_items, np.int64), np.full(n_items, np.iinfo(np.int64).min)

    def add(self, scores: np.ndarray, known: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` of documents (rows) by items (columns)."""
        near = (scores > self.least) | ((scores == self.least) & (ids[:, None] < self.last))
        doc, item = np.nonzero(near)
        self.waiting.append([item, scores[doc, item], known[doc], ids[doc]])
        if sum(len(w[0]) for w in self.waiting) > 8 * self.top * len(self.least):
            self.settle()

    def settle(self) -> list[np.ndarray]:
        item, score, known, ids = (np.concatenate(c) for c in zip(self.rows, *self.waiting))
        order = np.lexsort((ids, known, -score, item))
        item, score, known, ids = (c[order] for c in (item, score, known, ids))
        place = np.arange(len(item)) - np.searchsorted(item, item)
        kept = place < self.top
        self.rows, self.waiting = [c[kept] for c in (item, score, known, ids)], []
        full = place == self.top - 1
        self.least[item[full]], self.last[item[full]] = score[full], ids[full]
        return self.rows


def document_scores(block: Block, m: list[int], doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
    """Scores of documents by items; ``doc``, ``term`` and ``tf`` have an entry per document and term."""
    gain = block.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.array(m, np.int64)[doc]))
    size = block.bounds[term + 1] - block.bounds[term]
    first = np.repeat(block.bounds[term] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) if len(size) else size
    item = block.places[first + np.arange(int(size.sum()))]
    out = np.zeros(len(m) * len(block.items), np.int64)
    np.add.at(out, np.repeat(doc, size) * len(block.items) + item, np.repeat(gain, size))
    return out.reshape(len(m), -1)


def _scored(found: DataFrame, block: Block, n_docs: int, n_terms: int, spec: LexicalSearch) -> DataFrame:
    """The best (item_id, doc_id, score) of every task."""
    shared = found.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, part = shared.value, TaskContext.get().partitionId()
        best, step = Best(len(block.items), spec.top), max(1, spec.cells // len(block.items))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                rows = batch.slice(at, step)
                terms, counts = rows.column("terms"), rows.column("counts")
                sizes = np.diff(terms.offsets.to_numpy())
                doc = np.repeat(np.arange(rows.num_rows), sizes)
                m = [10 + 90 * n * n_docs // n_terms for n in rows.column("n").to_pylist()]
                ids = rows.column("doc_id")
                known = ids.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
                values = ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
                best.add(document_scores(block, m, doc, terms.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy()), known, values)
        item, score, known, ids = best.settle()
        names = pa.array(block.items, pa.int64()).take(pa.array(item))
        columns = [names, pa.array(ids, mask=known == 0), pa.array(score), pa.array(np.full(len(item), part // spec.group, np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=["item_id", "doc_id", "score", "part"])

    return found.where(F.size("terms") > 0).mapInArrow(run, "item_id long, doc_id long, score long, part int")


def _best(rows: DataFrame, top: int, *key: str) -> DataFrame:
    order = W.partitionBy(*key).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _block_of(terms: DataFrame, spec: LexicalSearch) -> tuple[int, Column]:
    """(number of blocks, block of an item)."""
    size = terms.agg(F.sum(F.octet_length("term") + 16), F.count_distinct(F.coalesce("item_id", F.lit(0)))).first()
    blocks = max(1, math.ceil((size[0] or 0) / spec.block_bytes), math.ceil(size[1] / spec.block_items))
    return blocks, F.pmod(F.xxhash64("item_id"), F.lit(blocks))


def search(docs: DataFrame, items: DataFrame, spec: LexicalSearch = LexicalSearch()) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents with a score above 0 of every item."""
    spark, out = docs.sparkSession, None
    terms = saved(item_terms(items), "item-terms")
    blocks, at = _block_of(terms, spec)
    for k in range(blocks):
        rows = [tuple(r) for r in terms.where(at == k).select("item_id", "term").collect()]  # bounded by the block
        if not rows:
            continue
        block = Block.of(uuid.uuid4().hex, rows)
        found = saved(scan(docs, block), "scan")
        n_docs, n_terms = found.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            break
        frequencies = np.zeros(len(block.terms), np.int64)
        for row in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # terms of the block
            frequencies[row["term"]] = row["count"]
        block.weights = term_weights(n_docs, frequencies)
        scored = _best(_scored(found, block, n_docs, n_terms, spec), spec.top, "item_id", "part").drop("rank")
        ranked = _best(scored, spec.top, "item_id").select("item_id", "rank", "doc_id", "score")
        out = ranked if out is None else out.unionByName(ranked)
    return out if out is not None else spark.createDataFrame([], RESULT)
