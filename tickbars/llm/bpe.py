"""Byte-level BPE encoding and decoding of whole texts.

Texts of up to ``chunk`` characters are encoded as they are. A longer text is
cut into overlapping chunks that are pre-tokenised in parallel. The pattern
looks ahead but never back, so two scans that once share a boundary agree from
there on: the first shared boundary in an overlap is where the text is cut.
The pieces are encoded in parallel and their ids joined in order; where two
scans share no boundary, both chunks stay one piece.

``ids`` are little-endian unsigned 32-bit integers in one binary value. A null
text counts as empty. Other columns are carried along, whatever their names.
Tasks work on slices of bounded size, so their memory does not depend on how
many rows an Arrow batch has.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tickbars.llm.buffers import slices

#: A boundary this close to the end of a chunk could still depend on what follows it.
LOOKAHEAD = 4
#: Bytes of text that a task works on at once.
SLICE = 1 << 20


@dataclass(frozen=True)
class Bpe:
    """``ranks``: content of a rank file (base64 of a token and its rank per line)."""

    ranks: bytes
    pattern: str
    chunk: int = 32_768
    overlap: int = 2_048

    @classmethod
    def from_file(cls, path: str, pattern: str, **options) -> Bpe:
        with open(path, "rb") as file:
            return cls(file.read(), pattern, **options)


@lru_cache(maxsize=2)
def _encoding(ranks: bytes, pattern: str) -> tuple[tiktoken.Encoding, list[bytes]]:
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    tokens = [b""] * (max(table.values()) + 1)
    for token, rank in table.items():
        tokens[rank] = token
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}), tokens


@lru_cache(maxsize=2)
def _splitter(pattern: str) -> regex.Pattern:
    # The class of white space that the encoder's own regular expressions have.
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def encode_text(text: str | None, ranks: bytes, pattern: str) -> bytes:
    return np.array(_encoding(ranks, pattern)[0].encode_ordinary(text or ""), "<u4").tobytes()


def decode_ids(ids: bytes, ranks: bytes, pattern: str) -> bytes:
    return b"".join(map(_encoding(ranks, pattern)[1].__getitem__, np.frombuffer(ids, "<u4").tolist()))


def boundaries(text: str, start: int, low: int, high: int, pattern: str) -> list[int]:
    """Starts in [low, high) of the matches that a scan from ``start`` finds."""
    found = []
    for match in _splitter(pattern).finditer(text, start):
        if match.start() >= high:
            break
        if match.start() >= low:
            found.append(match.start())
    return found


def _mapped(df: DataFrame, source: str, **works: Callable) -> DataFrame:
    """``df`` with binary columns, each the work of that name on ``source`` or, from the second on, on the one before."""
    order = [c for c in df.columns if c not in works]
    plain = df.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(order)])
    at, steps = order.index(source), list(works.values())
    names = [f"made_{i}" for i in range(len(steps))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, f"_{at}", SLICE):
            values, made = batch.column(at).to_pylist(), []
            for work in steps:
                values = [work(x) for x in values]
                made.append(pa.array(values, pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *names])

    out = plain.mapInArrow(run, StructType([*plain.schema.fields, *(StructField(n, BinaryType()) for n in names)]))
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(order)], *[F.col(n).alias(c) for n, c in zip(names, works)])


def encode(docs: DataFrame, bpe: Bpe, column: str = "text", decoded: str | None = None) -> DataFrame:
    """``docs`` with a column ``ids``; a column of that name is replaced.

    ``decoded`` names a column for the bytes that the finished ids decode to,
    made by the same tasks: a chain of two Python steps needs two processes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bpe.ranks)
    pattern, chunk, overlap = bpe.pattern, bpe.chunk, bpe.overlap

    def work(text):
        return encode_text(text, shared.value, pattern)

    back = {decoded: lambda ids: decode_ids(ids, shared.value, pattern)} if decoded else {}
    size = F.coalesce(F.length(F.col(f"`{column}`")), F.lit(0))
    short = _mapped(docs.where(size <= chunk), column, ids=work, **back)
    key = F.sha2(F.col(f"`{column}`").cast("binary"), 256)
    whole = docs.where(size > chunk).select(key.alias("key"), F.col(f"`{column}`").alias("text")).dropDuplicates(["key"])
    encoded = _long_texts(whole, work, pattern, chunk, overlap, back)
    keep = [c for c in docs.columns if c not in ("ids", decoded)]
    longer = docs.where(size > chunk).select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keep)], key.alias("key"))
    longer = longer.join(encoded, "key").select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], "ids", *back)
    return short.unionByName(longer)


def _long_texts(whole: DataFrame, work: Callable, pattern: str, chunk: int, overlap: int, back: dict[str, Callable]) -> DataFrame:
    """(key, text) to (key, ids) and what ``back`` makes of them, the chunks and pieces of a text in parallel."""

    def split(batches):
        for batch in slices(batches, limit=SLICE):
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                rows = [(key, i, text[at : at + chunk + overlap], at + chunk + overlap >= len(text)) for i, at in enumerate(range(0, len(text), chunk))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["key", "part", "text", "last"])

    def scan(batches):
        for batch in slices(batches, limit=SLICE):
            parts, texts, lasts = (batch.column(c).to_pylist() for c in ("part", "text", "last"))
            heads, tails = [], []
            for part, text, last in zip(parts, texts, lasts):
                found = boundaries(text, 0, 0, len(text), pattern)
                safe = len(text) if last else len(text) - LOOKAHEAD
                heads.append([part * chunk + x for x in found if x < overlap])
                tails.append([part * chunk + x for x in found if chunk <= x <= safe])
            names, kind = ["key", "part", "head", "tail"], pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("part"), pa.array(heads, kind), pa.array(tails, kind)], names=names)

    def cut(batches):
        for batch in slices(batches, limit=SLICE):
            for key, text, cuts in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "cuts"))):
                edges = [0, *(cuts or []), len(text)]
                rows = [(key, i, text[a:b]) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["key", "part", "text"])

    def join(batches):
        for batch in batches:
            for k in range(batch.num_rows):  # one long text at a time
                ids = b"".join(x["ids"] for x in batch.column("pieces")[k].as_py())
                made = [ids, *(f(ids) for f in back.values())]
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(k, 1), *(pa.array([x], pa.binary()) for x in made)], names=["key", "ids", *back])

    chunks = whole.mapInArrow(split, "key string, part long, text string, last boolean").repartition("key", "part")
    scans = chunks.mapInArrow(scan, "key string, part long, head array<long>, tail array<long>")
    after = scans.select("key", (F.col("part") - 1).alias("part"), F.col("head").alias("next"))
    cuts = scans.join(after, ["key", "part"]).select("key", F.array_min(F.array_intersect("tail", "next")).alias("at"))
    cuts = cuts.groupBy("key").agg(F.array_sort(F.collect_set("at")).alias("cuts"))
    pieces = whole.join(cuts, "key", "left").mapInArrow(cut, "key string, part long, text string").repartition("key", "part")
    made = _mapped(pieces, "text", ids=work).drop("text")
    made = made.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("part", "ids"))).alias("pieces"))
    return made.mapInArrow(join, ", ".join(["key string", "ids binary", *(f"`{c}` binary" for c in back)]))


def decode(encoded: DataFrame, bpe: Bpe, target: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of its ``ids`` in a binary column ``target``."""
    shared = encoded.sparkSession.sparkContext.broadcast(bpe.ranks)
    pattern = bpe.pattern
    return _mapped(encoded, "ids", **{target: lambda ids: decode_ids(ids or b"", shared.value, pattern)})
