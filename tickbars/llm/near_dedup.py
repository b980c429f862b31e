"""Near-duplicate documents by MinHash bands and odd sketches.

A document's set holds its distinct word shingles as 64-bit hashes. Each of
``samples`` MinHash values of a set flips one bit of a parity bitmap, the odd
sketch: two sketches differ where the samples differ, so the population count
of their XOR tells how many samples do. Documents that share a band of MinHash
values are candidates; pairs whose sketches are too far apart are dropped, the
rest is confirmed on full sets.

Equal sets form a class before anything is compared. Classes of a bucket are
compared with one hub, then those still apart with another one, so a group of
copies costs a few pairs per member. Classes that are still apart from others
of a bucket are then compared with all of their family, those with the same
hub in most of their buckets, and at last with those of other families in
their buckets. Large families and buckets are compared block by block inside
the tasks, so no pair of a bucket goes untested and few leave a task.
A null text counts as empty; a text without words is linked with nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.llm.buffers import LOWER, Prefix, binaries, mix, per_text, slices, text_bytes, words
from tickbars.llm.components import components
from tickbars.sources.paths import saved

EMPTY = np.iinfo(np.uint32).max


@dataclass(frozen=True)
class NearDedup:
    """``percent``: smallest Jaccard similarity. With 32 bands of 4 rows a pair at 0.8 misses all
    buckets with probability 5e-8. ``deviations``: how far above its mean a pair's sketch distance may lie. At the end, buckets of up to
    ``small`` members are compared as pairs, larger ones in blocks of ``block`` members."""

    shingle: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4
    samples: int = 512
    bits: int = 1024
    deviations: float = 6.0
    small: int = 16
    block: int = 512

    def sketch_limit(self) -> int:
        """Largest XOR count at which a pair of exactly ``percent`` may still be."""
        differing = self.samples * (1 - self.percent / 100)
        kept = (1 - 2 / self.bits) ** (2 * differing)
        mean = self.bits / 2 * (1 - kept)
        sampled = 2 * math.sqrt(differing * self.percent / 100) * kept
        return math.ceil(mean + self.deviations * math.hypot(sampled, math.sqrt(mean)))

    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        draws = mix(np.arange(1, 2 * self.samples + 1, dtype=np.uint64))
        return (draws[::2] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (draws[1::2] >> np.uint64(32)).astype(np.uint32)


def shingle_hashes(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every shingle, offsets per text). A text with fewer words is one shingle."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, of_text = words(data, offsets)
    hashed = Prefix(data).ranges(starts, ends)
    counts = np.diff(of_text)
    made = np.where(counts == 0, 0, np.maximum(counts - width + 1, 1))
    bounds = np.concatenate([[0], np.cumsum(made)])
    first = np.arange(bounds[-1]) + np.repeat(of_text[:-1] - bounds[:-1], made)
    length = np.repeat(np.minimum(counts, width), made)
    out = mix(length.astype(np.uint64))
    for k in range(width):
        used = k < length
        out[used] = mix(out[used] * np.uint64(0x9E3779B97F4A7C15) + hashed[first[used] + k])
    return out, bounds


def _sets(hashes: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    return [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def _keys(sets: list[np.ndarray]) -> list[bytes | None]:
    """128 bits of a whole set; None for the empty one."""
    odd = np.uint64(0xD6E8FEB86659FD93)
    with np.errstate(over="ignore"):
        return [np.array([s.sum(), mix(s ^ odd).sum()], np.uint64).tobytes() if len(s) else None for s in sets]


def _features(batches, spec: NearDedup) -> Iterator[pa.RecordBatch]:
    times, flips = spec.seeds()
    place = np.arange(spec.samples, dtype=np.uint64)[:, None] << np.uint64(32)
    for part in slices(batches):
        hashes, bounds = shingle_hashes(part.column("text"), spec.shingle)
        sets = _sets(hashes, bounds)
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        signature = np.stack([per_text((short ^ b) * a, bounds, np.minimum, EMPTY) for a, b in zip(times, flips)])
        flipped = (mix(signature.astype(np.uint64) | place) % np.uint64(spec.bits)).astype(np.int64)
        bits = np.zeros((part.num_rows, spec.bits), np.uint8)
        for row in flipped:
            bits[np.arange(part.num_rows), row] ^= 1
        sketch = np.packbits(bits, axis=1).view(np.int64)
        banded = signature[: spec.bands * spec.rows].astype(np.uint64).reshape(spec.bands, spec.rows, -1)
        bucket = mix(np.arange(spec.bands, dtype=np.uint64))[:, None]
        for k in range(spec.rows):
            bucket = mix(bucket * np.uint64(31) + banded[:, k])
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                part.column("text_hash"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(_keys(sets), pa.binary()),
                pa.array(list(bucket.T.view(np.int64)), pa.list_(pa.int64())),
                pa.array(list(sketch), pa.list_(pa.int64())),
            ],
            names=["doc_id", "text_hash", "n_shingles", "key", "buckets", "sketch"],
        )


def features(docs: DataFrame, spec: NearDedup) -> DataFrame:
    """Per row of (doc_id, text): a hash of the text, size and key of its set, its buckets and its sketch."""
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        lambda batches: _features(batches, spec),
        "doc_id long, text_hash long, n_shingles long, key binary, buckets array<long>, sketch array<long>",
    )


def _full_sets(docs: DataFrame, spec: NearDedup) -> DataFrame:
    def run(batches):
        for part in slices(batches):
            sets = _sets(*shingle_hashes(part.column("text"), spec.shingle))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(_keys(sets), pa.binary()), binaries(s.tobytes() for s in sets)],
                names=["first_id", "key", "members"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "first_id long, key binary, members binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def run(batches):
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
                x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    right = sets.select(F.col("node").alias("b"), F.col("members").alias("right"))
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("left"))
    both = pairs.join(right.hint("merge"), "b").join(left.hint("merge"), "a").select("a", "b", "left", "right")
    return both.mapInArrow(run, "a long, b long")


def _distance(a: str, b: str, words_: int) -> Column:
    total = F.lit(0)
    for k in range(words_):
        total = total + F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k]))
    return total


def _near(pairs: DataFrame, classes: DataFrame, spec: NearDedup) -> DataFrame:
    """The pairs whose sketches are near enough to be confirmed."""
    left = classes.select(F.col("node").alias("a"), F.col("sketch").alias("s"))
    right = classes.select(F.col("node").alias("b"), F.col("sketch").alias("t"))
    both = pairs.join(right.hint("merge"), "b").join(left.hint("merge"), "a")
    return both.where(_distance("s", "t", spec.bits // 64) <= spec.sketch_limit()).select("a", "b")


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("component", F.col("node"))
    return members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _apart(at: DataFrame, also: str = "component") -> DataFrame:
    """The buckets with more than one component, and more than one ``also``, with their size as n."""
    ends = [F.min("component").alias("x"), F.max("component").alias("y"), F.min(also).alias("p"), F.max(also).alias("q"), F.count("*").alias("n")]
    return at.join(at.groupBy("bucket").agg(*ends).where("x <> y AND p <> q").select("bucket", "n"), "bucket")


def _pairs(at: DataFrame, also: str = "component") -> DataFrame:
    """(node, hub) of one bucket that differ in component and in ``also``."""
    other = at.select("bucket", F.col("node").alias("hub"), F.col("component").alias("h"), F.col(also).alias("g"))
    return at.join(other, "bucket").where((F.col("component") < F.col("h")) & (F.col(also) != F.col("g")))


def _untried(pairs: DataFrame, tried: DataFrame | None) -> DataFrame:
    """Pairs of ``node`` and ``hub`` as distinct (a, b) with a < b that are not in ``tried``."""
    pairs = pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    return pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")


def _groups(batches, key: int):
    """Tables of consecutive rows that agree in the first ``key`` columns."""
    held, last = [], None
    for batch in batches:
        columns = [batch.column(k).to_numpy() for k in range(key)]
        new = np.ones(batch.num_rows, bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        cuts = [*np.flatnonzero(new), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            mine = tuple(c[a] for c in columns)
            if mine != last and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = mine
    if held:
        yield pa.Table.from_batches(held)


def _blocked(large: DataFrame, spec: NearDedup) -> DataFrame:
    """Members of large buckets dealt to blocks, a row for every pair of blocks it is in."""
    blocks = F.ceil(F.col("n") / spec.block).cast("int")
    mine = F.pmod(F.xxhash64("node"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    kept = [c for c in large.columns if c not in ("bucket", "n")]
    dealt = large.select("bucket", *kept, mine.alias("mine"), other)
    return dealt.select("bucket", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", *kept)


def _large_buckets(large: DataFrame, classes: DataFrame, spec: NearDedup) -> tuple[DataFrame, DataFrame]:
    """Sketches of large buckets, of different families, compared block by block.

    Gives (node, hub) pairs near enough from blocks with few of them; from the
    others, members with a near partner, to be compared on full sets in place.
    """
    limit = spec.sketch_limit()

    def run(batches):
        for group in _groups(batches, 3):
            bucket, low, high = (group.column(k)[0].as_py() for k in range(3))
            mine, node, component, family = (group.column(k).to_numpy() for k in (3, 4, 5, 6))
            sketch = np.array(group.column(7).to_pylist(), np.int64)
            left, right = np.flatnonzero(mine == low), np.flatnonzero(mine == high)
            rows = []
            for k in left:
                others = right[right > k] if low == high else right
                others = others[(component[others] != component[k]) & (family[others] != family[k])]
                near = others[np.bitwise_count(sketch[others] ^ sketch[k]).sum(axis=1) <= limit]
                rows.append(np.stack([np.full(len(near), k), near]))
            pairs = np.concatenate(rows, axis=1) if rows else np.zeros((2, 0), np.int64)
            if pairs.shape[1] > spec.small * len(node):
                used = np.unique(pairs)
                kind, x, y = "dense", node[used], component[used]
                side = mine[used]
            else:
                kind, x, y = "pair", node[pairs[0]], node[pairs[1]]
                side = np.zeros(len(x), np.int32)
            n = len(x)
            arrays = [pa.array([kind] * n, pa.string()), pa.array(np.full(n, bucket)), *(pa.array(np.full(n, v, np.int32)) for v in (low, high)), pa.array(side, pa.int32()), pa.array(x), pa.array(y)]
            yield pa.RecordBatch.from_arrays(arrays, names=["kind", "bucket", "low", "high", "mine", "x", "y"])

    dealt = _blocked(large, spec).join(classes.select("node", "sketch").hint("merge"), "node")
    dealt = dealt.select("bucket", "low", "high", "mine", "node", "component", "family", "sketch")
    dealt = dealt.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    made = saved(dealt.mapInArrow(run, "kind string, bucket long, low int, high int, mine int, x long, y long"), "blocks")
    sparse = made.where("kind = 'pair'").select(F.col("x").alias("node"), F.col("y").alias("hub"))
    dense = made.where("kind = 'dense'").select("bucket", "low", "high", "mine", F.col("x").alias("node"), F.col("y").alias("component"))
    return sparse, dense


def _dense_links(dense: DataFrame, sets: DataFrame, spec: NearDedup) -> DataFrame:
    """Links of dense blocks, confirmed on full sets; of those, only what joins components."""

    def run(batches):
        for group in _groups(batches, 3):
            low, high = group.column(1)[0].as_py(), group.column(2)[0].as_py()
            mine, node, component = (group.column(k).to_numpy() for k in (3, 4, 5))
            sizes = np.array([len(m) // 8 for m in group.column(6).to_pylist()])
            members = np.frombuffer(b"".join(group.column(6).to_pylist()), np.uint64)
            kinds, ids = np.unique(members, return_inverse=True)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            flags, root = np.zeros(len(kinds), bool), {int(c): int(c) for c in component}
            links = []

            def find(c: int) -> int:
                while root[c] != c:
                    root[c] = root[root[c]]
                    c = root[c]
                return c

            right = mine == high
            for k in np.flatnonzero(mine == low):
                mine_ids = ids[bounds[k] : bounds[k + 1]]
                flags[mine_ids] = True
                shared = np.add.reduceat(flags[ids], bounds[:-1])
                flags[mine_ids] = False
                near = right & (100 * shared >= spec.percent * (sizes + sizes[k] - shared))
                for other in np.flatnonzero(near):
                    p, q = find(int(component[k])), find(int(component[other]))
                    if p != q:
                        root[max(p, q)] = min(p, q)
                        links.append((min(node[k], node[other]), max(node[k], node[other])))
            columns = zip(*links) if links else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    rows = dense.join(sets.hint("merge"), "node").select("bucket", "low", "high", "mine", "node", "component", "members")
    rows = rows.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    return rows.mapInArrow(run, "a long, b long")


def near_components(docs: DataFrame, spec: NearDedup = NearDedup(), details: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Documents are linked at ``percent`` similarity; ``component_id`` is the
    smallest doc_id a document reaches. Every row is a document of its own,
    also where rows share a doc_id. ``details`` adds ``key``, which names the
    set (null without words), ``text_hash``, and ``is_head``, which marks the
    rows with the set that stands for its component. A null doc_id never represents others and is never kept.
    """
    made = saved(features(docs, spec), "features")
    classes = made.where("key IS NOT NULL AND doc_id IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.first("buckets").alias("buckets"), F.first("sketch").alias("sketch")
    )
    # Numbers in the order of (first_id, key): unique for a class even where ids are repeated.
    order = ["first_id", "key"]
    classes = classes.repartitionByRange(*order).sortWithinPartitions(*order)
    classes = saved(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    spread = classes.select("node", F.explode("buckets").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = saved(spread.join(shared, "bucket").select("bucket", "node"), "members")
    nodes = members.select("node").distinct()
    named = classes.select("key", "first_id", "node").join(nodes, "node", "left_semi")
    candidates = docs.select(F.col("doc_id").cast("long"), "text").join(named.select(F.col("first_id").alias("doc_id")), "doc_id", "left_semi")
    full = _full_sets(candidates, spec)
    full = saved(full.join(named, ["key", "first_id"]).dropDuplicates(["node"]).select("node", "members"), "sets")

    links, labels, tried = full.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0), None, None

    def linked(found: DataFrame) -> None:
        nonlocal links, labels
        found = saved(found, "links")
        if labels is None or not found.isEmpty():
            links = links.union(found)
            labels = saved(components(links), "labels")

    for hub in (F.min("node"), F.max_by("node", F.xxhash64("node"))):
        at = _labelled(members, labels)
        hubs = at.groupBy("bucket").agg(hub.alias("hub"), F.min("component").alias("x"), F.max("component").alias("y"))
        hubs = hubs.where("x <> y").join(at.select("bucket", F.col("node").alias("hub"), F.col("component").alias("h")), ["bucket", "hub"])
        pairs = at.join(hubs, "bucket").where("component <> h")
        near = saved(_near(_untried(pairs, tried), classes, spec), "near")
        tried = near if tried is None else tried.union(near)
        linked(_confirmed(near, full, spec.percent))
    # Nodes still apart from others of a bucket, by family: the hub they share most buckets with.
    at = saved(_apart(_labelled(members, labels)), "apart")
    if not at.isEmpty():
        shares = at.join(at.groupBy("bucket").agg(F.min("node").alias("hub")), "bucket").groupBy("node", "hub").agg(F.count("*").alias("n"))
        families = saved(shares.groupBy("node").agg(F.max_by("hub", F.struct("n", -F.col("hub"))).alias("family")), "families")
        at = _apart(_labelled(families.select(F.col("family").alias("bucket"), "node"), labels))
        few, many = at.where(F.col("n") <= spec.small), at.where(F.col("n") > spec.small)
        near = _near(_untried(_pairs(few), tried), classes, spec)
        linked(_confirmed(near, full, spec.percent).union(_dense_links(_blocked(many, spec), full, spec)))
        # What is left are pairs of different families.
        at = saved(_apart(_labelled(members, labels).join(families.hint("merge"), "node"), "family"), "apart")
        few, many = at.where(F.col("n") <= spec.small), at.where(F.col("n") > spec.small)
        sparse, dense = _large_buckets(many, classes, spec)
        near = _near(_untried(_pairs(few, "family"), tried), classes, spec).union(_untried(sparse, tried)).distinct()
        linked(_confirmed(near, full, spec.percent).union(_dense_links(dense, full, spec)))

    known = classes.select("key", "node").join(labels, "node", "left")
    known = known.select("key", "node", F.coalesce("component", "node").alias("component"))
    heads = classes.select(F.col("node").alias("component"), F.col("first_id").alias("component_id"))
    known = known.join(heads, "component").select("key", "component_id", (F.col("node") == F.col("component")).alias("is_head"))
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return made.select("doc_id", "n_shingles", "key", "text_hash").join(known, "key", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"),
        *(["key", "text_hash", F.coalesce("is_head", F.lit(True)).alias("is_head")] if details else []),
    )
