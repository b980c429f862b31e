import hashlib
import random
import zlib

import pytest

from tickbars.llm.prefix_trie import SpillingQueue, TrieSpec, prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_force(rows, share=9):
    """The rows of all nodes from (conv_id, turn, role, text), by dictionaries of whole sequences."""
    talks = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        talks.setdefault(c, []).append((role or "", text or ""))
    made = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % share if share else 0
        first = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        made[c] = (*talks.get(first, [])[:h], *own[h:])
    members = {}
    for c, talk in made.items():
        for d in range(len(talk) + 1):
            members.setdefault(talk[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        mine = children.get(node, [])
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        totals[node] = (sum(totals[x][0] for x in mine) or 1, own + sum(totals[x][1] for x in mine))
    out = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if made[c] == node)
        parent = min(members[node[:-1]]) if node else None
        out.append((min(ids), len(node), parent, len(ids), len(children.get(node, [])), *totals[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def odd_rows():
    draw = random.Random(3)
    rows = [(c, t, draw.choice(["user", "bot"]), draw.choice(["yes", "no", "é漢", "", "maybe so"])) for c in range(60) for t in range(draw.randint(1, 12))]
    rows += [(100 + c, t, "user", f"same {t}") for c in range(80) for t in range(5)]
    rows += [(300, None, None, None), (300, None, None, None), (300, 1, "user", None), (300, 1, "bot", "b"), (300, 1, "bot", "a"), (301, 1, None, ""), (-7, 1, "user", "x"), (-5, 1, "user", "x"), (-5, 2, "user", "y")]
    rows += [(None, 1, "user", "nobody"), (2**62, 3, "user", "far"), (2**62, -3, "user", "first")]
    rows += [(500, t, "bot", f"long {t % 3}") for t in range(400)] + [(505, t, "bot", f"long {t % 3}") for t in range(390)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("spec", [TrieSpec(), TrieSpec(block=16, pending=3, chunk=4, least_heavy=1, most_heavy=50), TrieSpec(share=None, least_heavy=10, block=7)])
def test_against_brute_force(spark, spec):
    rows = odd_rows()
    frame = spark.createDataFrame([(*r, "z", 1) for r in rows], "conv_id long, turn int, role string, text string, depth string, k1 int").repartition(5)
    found = prefix_trie(frame, spec)
    assert found.columns == COLUMNS and all(t == "bigint" for _, t in found.dtypes[:-1])
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_force(rows, spec.share)


def test_heavy_nodes_in_two_levels_of_shards(spark):
    rows = [(c, t, "user", "start" if t < 3 else f"{t} {c % (7 if t < 5 else 50)}") for c in range(400) for t in range(7)]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    for spec in (TrieSpec(least_heavy=20, most_heavy=100), TrieSpec(least_heavy=1, most_heavy=10**6)):
        assert sorted((tuple(r) for r in prefix_trie(frame, spec).collect()), key=repr) == brute_force(rows)


def test_small_tables(spark):
    schema = "conv_id long, turn int, role string, text string"
    assert prefix_trie(spark.createDataFrame([], schema)).count() == 0
    assert prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], schema)).count() == 0
    for rows in ([(1, 1, "a", "b")], [(5, 1, "a", "b")], [(c, 1, "a", "b") for c in range(9)]):
        assert sorted((tuple(r) for r in prefix_trie(spark.createDataFrame(rows, schema)).collect()), key=repr) == brute_force(rows)


def test_queue_gives_messages_in_order_from_memory_and_runs():
    draw, queue, want = random.Random(1), SpillingQueue(10), {}
    for k in range(500):
        key = (-draw.randint(0, 3), draw.randint(0, 9), draw.randint(0, 2))
        queue.put(key, k, 2 * k)
        n, leaves, kept = want.get(key, (0, 0, 0))
        want[key] = (n + 1, leaves + k, kept + 2 * k)
    assert queue.spilled > 10
    for key in sorted(want):
        assert queue.take(key) == want[key]
        assert queue.take(key) == (0, 0, 0)
    assert queue.empty()
    queue.put((-2, 1, 1), 1, 1)
    with pytest.raises(RuntimeError):
        queue.take((-1, 0, 0))
