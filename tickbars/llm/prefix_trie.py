"""Prefix trie of conversations, its subtree totals by time-forward processing.

A node is a distinct sequence of turns that conversations begin with. Its key
is a hash of sums: every turn, hashed together with its place, adds to four
lanes, so the keys of all prefixes are running sums, also where a conversation
lies in many partitions. A further hash of the last turn and the key of the
parent must agree in all members of a node, or the job ends with an error.

Totals of subtrees go from nodes to their parents as messages. Nodes are sorted
by level, deepest first, by Spark's external sort; a task walks through them
with a queue of messages, ordered like the nodes, that spills sorted runs to
unnamed files. A shard holds whole subtrees. Nodes with so many members that
their subtrees are no shards any more, ``heavy`` ones, number ``most_heavy`` at
most: the members of all nodes are the rows of the table, and a heavy node has
more than a ``most_heavy``-th of them. They come last, in one task, with the
totals of the shards' roots as first messages. A node with one member heads a
chain with one leaf that saves nothing; chains send one message to the node
they hang from and are not walked through.

The turns of a conversation are numbered by a sort over ranges of (conv_id,
turn, role, text), and running sums go by blocks of places, so that one
conversation may hold any share of the rows. The digest of the conversations
that end at a node streams over chunks of sorted ids.

Defined cases: a null role or text is empty; turns go by turn (null first),
equal ones by role, then text, and repeated rows are turns of their own. Rows
without a conv_id belong to no conversation. An empty table has no conversation
and no node, not even a root. Further columns are never looked at.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickbars.sources.paths import saved

KEY = ["k1", "k2"]
LANES = ["a", "b", "c", "d"]
#: A lane adds 30 bits a turn: sums of 2**33 turns stay below 2**63.
LANE_BITS = (1 << 30) - 1
OF_NOTHING = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class TrieSpec:
    """``share``: conversations take up to ``share`` - 1 first turns of the first one of their ``group``; None leaves them as they are."""

    share: int | None = 9
    group: int = 5
    most_heavy: int = 2_000
    least_heavy: int = 64
    block: int = 1024
    pending: int = 200_000
    chunk: int = 4096


class SpillingQueue:
    """Messages in the order of their keys; beyond ``most`` they go to sorted runs on disk."""

    RECORD = struct.Struct("<6q")

    def __init__(self, most: int) -> None:
        self.most, self.heap, self.heads, self.spilled = most, [], [], 0

    def put(self, key: tuple[int, int, int], leaves: int, saved_: int) -> None:
        heappush(self.heap, (*key, 1, leaves, saved_))
        if len(self.heap) > self.most:
            self._spill()

    def take(self, key: tuple[int, int, int]) -> tuple[int, int, int]:
        """(messages, leaves, saved) of all messages with ``key``; none may be due before it."""
        children = leaves = saved_ = 0
        while self.heap and self.heap[0][:3] <= key:
            *due, n, more, bytes_ = heappop(self.heap)
            self._check(due, key)
            children, leaves, saved_ = children + n, leaves + more, saved_ + bytes_
        while self.heads and self.heads[0][0][:3] <= key:
            (*due, n, more, bytes_), at, run = heappop(self.heads)
            self._check(due, key)
            children, leaves, saved_ = children + n, leaves + more, saved_ + bytes_
            self._advance(at, run)
        return children, leaves, saved_

    def empty(self) -> bool:
        return not self.heap and not self.heads

    @staticmethod
    def _check(due: list[int], key: tuple[int, int, int]) -> None:
        if tuple(due) != key:
            raise RuntimeError(f"a message for {tuple(due)} has no node")

    def _spill(self) -> None:
        file, last = tempfile.TemporaryFile(), None
        self.heap.sort()
        for row in self.heap:
            if last is not None and last[:3] == row[:3]:
                last = (*last[:3], *(x + y for x, y in zip(last[3:], row[3:])))
                continue
            if last is not None:
                file.write(self.RECORD.pack(*last))
            last = row
        file.write(self.RECORD.pack(*last))
        file.seek(0)
        self.heap, self.spilled = [], self.spilled + 1
        self._advance(self.spilled, self._read(file))

    def _read(self, file) -> Iterator[tuple]:
        with file:
            while data := file.read(self.RECORD.size * 4096):
                yield from self.RECORD.iter_unpack(data)

    def _advance(self, at: int, run: Iterator[tuple]) -> None:
        head = next(run, None)
        if head is not None:
            heappush(self.heads, (head, at, run))


TOTALS = "k1 long, k2 long, depth long, p1 long, p2 long, top boolean, n_children long, n_leaves long, saved_tokens long"


def _totals(nodes: DataFrame, pending: int) -> DataFrame:
    """Subtree totals of nodes, whose partitions hold whole subtrees below their ``top`` nodes.

    Needs rows sorted by level, deepest first, then key, with what comes from
    outside in ``children``, ``leaves`` and ``saved``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(pending)
        for batch in batches:
            out = []
            for depth, k1, k2, p1, p2, top, own, children, leaves, saved_ in zip(*(c.to_pylist() for c in batch.columns)):
                n, more, below = queue.take((-depth, k1, k2))
                children, saved_ = children + n, saved_ + own + below
                leaves = leaves + more if children else 1
                out.append((k1, k2, depth, p1, p2, top, children, leaves, saved_))
                if not top:
                    queue.put((1 - depth, p1, p2), leaves, saved_)
            kinds = [pa.int64()] * 5 + [pa.bool_()] + [pa.int64()] * 3
            columns = zip(*out) if out else [[]] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[x.split()[0] for x in TOTALS.split(", ")])
        if not queue.empty():
            raise RuntimeError("messages without a node are left")

    ordered = nodes.select("depth", "k1", "k2", "p1", "p2", "top", "own", "children", "leaves", "saved")
    return ordered.sortWithinPartitions(F.col("depth").desc(), "k1", "k2").mapInArrow(run, TOTALS)


def _turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, part, row and hashes of every turn, segments of the conversations by part)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    plain = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), "turn", role.alias("role"), text.alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    rows = plain.repartitionByRange(*order).sortWithinPartitions(*order)
    hashes = [F.xxhash64(F.lit(k), "role", "text").alias(name) for k, name in enumerate(("h1", "h2", "check"))]
    place = [F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")]
    rows = saved(rows.select("conv_id", *place, *hashes, F.octet_length("text").cast("long").alias("n_bytes")), "turns")
    parts = rows.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count("*").alias("in_part"))
    own = W.partitionBy("conv_id")
    before = F.coalesce(F.sum("in_part").over(own.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return rows, parts.withColumns({"before": before, "n": F.sum("in_part").over(own)})


def _sequences(conversations: DataFrame, spec: TrieSpec) -> tuple[DataFrame, DataFrame]:
    """(rows conv_id, depth, hashes, length of the sequence; one row per conversation: conv_id, length)."""
    turns, parts = _turns(conversations)
    parts = saved(parts, "parts")
    sizes = parts.where("before = 0").select("conv_id", "n")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % spec.share if spec.share else F.lit(0)
    asked = sizes.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % spec.group).alias("donor"), h.cast("long").alias("h"))
    given = sizes.select(F.col("conv_id").alias("donor"), F.col("n").alias("there"))
    asked = asked.join(given, "donor", "left").withColumn("m", F.least("h", F.coalesce("there", F.lit(0))))
    length = F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    asked = saved(asked.select("conv_id", "donor", "h", "m", length.alias("length")), "asked")

    whole = parts.drop("n").join(asked, "conv_id")
    hashed = ["h1", "h2", "check", "n_bytes"]
    placed = turns.join(whole, ["conv_id", "part"]).withColumn("place", F.col("row") - F.col("first") + F.col("before") + 1)
    own = placed.where("place > h").select("conv_id", (F.col("place") - F.col("h") + F.col("m")).alias("depth"), *hashed, "length")
    if not spec.share:
        return own, asked.select("conv_id", "length")
    heads = placed.where((F.col("conv_id") % spec.group == 0) & (F.col("place") < spec.share))
    heads = heads.select(F.col("conv_id").alias("donor"), F.col("place").alias("depth"), *hashed)
    taken = asked.where("m > 0").join(heads, "donor").where("depth <= m").select("conv_id", "depth", *hashed, "length")
    return own.unionByName(taken), asked.select("conv_id", "length")


def _key(depth: Column, lanes: list[Column]) -> list[Column]:
    return [F.xxhash64(F.lit(k), depth.cast("long"), *lanes) for k in (0, 1)]


def _members(sequences: DataFrame, spec: TrieSpec) -> DataFrame:
    """Every conversation at every node it passes: conv_id, depth, key, parent's key, check, n_bytes, is_end."""
    wide = [F.xxhash64(F.lit(k), "depth", "h1", "h2") for k in (10, 11)]
    adds = [x for w in wide for x in (w.bitwiseAND(LANE_BITS), F.shiftrightunsigned(w, 32).bitwiseAND(LANE_BITS))]
    rows = sequences.select(
        "conv_id", "depth", "check", "n_bytes", "length", F.floor((F.col("depth") - 1) / spec.block).alias("block"),
        *(x.alias(f"add_{c}") for c, x in zip(LANES, adds)),
    )
    within = W.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumns({f"sum_{c}": F.sum(f"add_{c}").over(within) for c in LANES})
    # Only conversations of several blocks have anything to carry over.
    blocks = sequences.where(F.col("length") > spec.block).select("conv_id", "depth", F.floor((F.col("depth") - 1) / spec.block).alias("block"), *(x.alias(f"add_{c}") for c, x in zip(LANES, adds)))
    blocks = blocks.groupBy("conv_id", "block").agg(*(F.sum(f"add_{c}").alias(c) for c in LANES))
    earlier = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carried = blocks.select("conv_id", "block", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in LANES))
    rows = rows.join(carried, ["conv_id", "block"], "left")
    sums = [F.col(f"sum_{c}") + F.coalesce(c, F.lit(0)) for c in LANES]
    (k1, k2), (p1, p2) = _key(F.col("depth"), sums), _key(F.col("depth") - 1, [s - F.col(f"add_{c}") for c, s in zip(LANES, sums)])
    named = [k1.alias("k1"), k2.alias("k2"), p1.alias("p1"), p2.alias("p2")]
    return rows.select("conv_id", "depth", *named, "check", "n_bytes", (F.col("depth") == F.col("length")).alias("is_end"))


def _nodes(members: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row per node, the root included."""
    agreed = (F.min("p1") == F.max("p1")) & (F.min("p2") == F.max("p2")) & (F.min("check") == F.max("check")) & (F.min("depth") == F.max("depth"))
    nodes = members.groupBy(*KEY).agg(
        F.min("depth").alias("depth"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"), F.count_if("is_end").alias("n_ends"), F.max(F.when(F.col("is_end"), F.col("conv_id"))).alias("one_end"),
        F.max("n_bytes").alias("n_bytes"), agreed.alias("agreed"),
    )
    nodes = nodes.where(F.when(F.col("agreed"), F.lit(True)).otherwise(F.raise_error(F.lit("two sequences have one key")).cast("boolean")))
    ends = F.when(F.col("length") == 0, F.col("conv_id"))
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.count(ends).alias("n_ends"), F.max(ends).alias("one_end"))
    nothing = F.lit(0).cast("long")
    k1, k2 = _key(F.lit(0), [nothing] * 4)
    root = root.where("n_convs > 0").select(
        k1.alias("k1"), k2.alias("k2"), nothing.alias("depth"), nothing.alias("p1"), nothing.alias("p2"), "conv_id", "n_convs", "n_ends", "one_end", nothing.alias("n_bytes")
    )
    return nodes.drop("agreed").unionByName(root)


def _end_digests(ends: DataFrame, chunk: int) -> DataFrame:
    """(k1, k2, ends_sha256) of (k1, k2, conv_id): ids in numeric order, joined by commas, hashed as a stream."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            k1, k2, ids = (c.to_numpy() for c in batch.columns)
            new = np.ones(len(ids), bool)
            new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
            cuts = np.union1d(np.flatnonzero(new), np.arange(0, len(ids), chunk))
            texts = [",".join(map(str, x.tolist())) for x in np.split(ids, cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(k1[cuts]), pa.array(k2[cuts]), pa.array(ids[cuts]), pa.array(texts)], names=["k1", "k2", "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            out = []
            for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
                if (k1, k2) == last:
                    state.update(b"," + ids.encode())
                    continue
                if last is not None:
                    out.append((*last, state.hexdigest()))
                last, state = (k1, k2), hashlib.sha256(ids.encode())
            yield digest_rows(out)
        if last is not None:
            yield digest_rows([(*last, state.hexdigest())])

    def digest_rows(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], names=[*KEY, "ends_sha256"])

    order = [*KEY, "conv_id"]
    made = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(chunks, "k1 long, k2 long, first long, ids string")
    return made.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digests, "k1 long, k2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, spec: TrieSpec = TrieSpec()) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    sequences, lengths = _sequences(conversations, spec)
    members = saved(_members(sequences, spec), "members")
    nodes = saved(_nodes(members, lengths), "nodes")
    size = nodes.agg(F.coalesce(F.sum("n_convs"), F.lit(0))).first()[0]
    bound = max(spec.least_heavy, size // spec.most_heavy)
    is_heavy = (F.col("n_convs") > bound) | (F.col("depth") == 0)
    heavy = nodes.where(is_heavy)
    known = F.broadcast(heavy.select(*KEY))  # most_heavy rows and the root

    # Shards: the first node of a conversation that is not heavy names its subtree.
    light = nodes.where(~is_heavy & (F.col("n_convs") > 1))
    tops = members.join(known, KEY, "left_anti").groupBy("conv_id").agg(F.min("depth").alias("at"), F.min_by("k1", "depth").alias("shard"))
    # Chains of nodes with one member: a leaf for the node they hang from.
    chains = nodes.where((F.col("n_convs") == 1) & (F.col("depth") > 0))
    chains = chains.groupBy("conv_id").agg(F.min_by("p1", "depth").alias("k1"), F.min_by("p2", "depth").alias("k2"))
    chains = saved(chains.groupBy(*KEY).agg(F.count("*").alias("chains")), "chains")
    own = ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("own")
    hung = F.coalesce("chains", F.lit(0)).cast("long")
    shards = light.join(chains, KEY, "left").join(tops, "conv_id").select(
        "shard", "depth", *KEY, "p1", "p2", (F.col("depth") == F.col("at")).alias("top"), own, hung.alias("children"), hung.alias("leaves"), F.lit(0).cast("long").alias("saved")
    )
    below = saved(_totals(shards.repartition("shard"), spec.pending), "totals")

    # Across the roots of the shards.
    roots = below.where("top").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("of_roots"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    )
    last = heavy.join(chains, KEY, "left").join(roots, KEY, "left").select(
        "depth", *KEY, "p1", "p2", (F.col("depth") == 0).alias("top"), own,
        (hung + F.coalesce("of_roots", F.lit(0))).alias("children"), (hung + F.coalesce("leaves", F.lit(0))).alias("leaves"), F.coalesce("saved", F.lit(0)).alias("saved"),
    )
    above = _totals(last.repartition(1), spec.pending)
    totals = below.unionByName(above).select(*KEY, "n_children", "n_leaves", "saved_tokens")

    k1, k2 = _key(F.lit(0), [F.lit(0).cast("long")] * 4)
    ends = members.where("is_end").select(*KEY, "conv_id")
    ends = ends.unionByName(lengths.where("length = 0").select(k1.alias("k1"), k2.alias("k2"), "conv_id"))
    several = nodes.where("n_ends > 1").select(*KEY)
    digests = _end_digests(ends.join(several, KEY, "left_semi"), spec.chunk)

    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    of_heavy = F.broadcast(heavy.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("heavy_parent")))
    one = F.when(F.col("n_ends") == 1, F.sha2(F.col("one_end").cast("string"), 256)).otherwise(OF_NOTHING)
    found = nodes.join(totals, KEY, "left").join(digests, KEY, "left").join(of_heavy, ["p1", "p2"], "left")
    # A heavy parent can have any number of children; the others are not many for one task.
    low = found.where("heavy_parent IS NULL AND depth > 0").join(parents, ["p1", "p2"])
    high = found.where("heavy_parent IS NOT NULL OR depth = 0").withColumn("parent_conv_id", F.col("heavy_parent"))
    return low.unionByName(high).select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", 1 - F.col("n_ends")).alias("n_children"),
        F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", one).alias("ends_sha256"),
    )
