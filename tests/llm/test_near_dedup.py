import random

import pytest
from pyspark.sql import functions as F

from tickbars.llm.components import components
from tickbars.llm.near_dedup import NearDedup, near_components


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def brute_force(docs, width, percent):
    """doc_id -> (set size, smallest doc_id reachable)."""
    sets = {i: shingles(t, width) for i, t in docs if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def family(seed, size, words=150):
    """Copies of one text with a few words replaced: similarities on both sides of the threshold."""
    draw = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    for i in range(size):
        text = list(base)
        for _ in range(draw.choice([0, 1, 2, 3, 5, 6, 7])):
            text[draw.randrange(words)] = f"x{draw.random()}"
        yield 3 * i, " ".join(text)


ODD = [(5000, None), (5001, ""), (5002, " \n"), (5003, "solo"), (5004, "Solo"), (5005, "solo two"), (5006, "é" * 5000)]


@pytest.mark.parametrize("spec", [NearDedup(shingle=4), NearDedup(small=3, block=40)])
def test_components_are_those_of_all_pairs(spark, spec):
    docs = [*family(5, 110), *ODD]
    docs += [(9000 + i, docs[3][1]) for i in range(30)]
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, node int")
    found = near_components(frame, spec).collect()
    want = brute_force(docs, spec.shingle, spec.percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_null_ids_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (7, text), (7, text), (9, text), (None, "other words here now"), (None, None)]
    found = near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(
        [(None, 36, 7, False), (7, 36, 7, True), (7, 36, 7, True), (9, 36, 7, False), (None, 1, None, False), (None, 0, None, False)],
        key=repr,
    )


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(3, a), (5, a), (5, b), (6, b + " more"), (7, "c " * 9)]
    found = near_components(spark.createDataFrame(rows, "doc_id long, text string"), details=True)
    assert sorted((r.doc_id, r.component_id, r.kept, r.is_head) for r in found.collect()) == [
        (3, 3, True, True), (5, 3, False, True), (5, 5, True, True), (6, 5, False, False), (7, 7, True, True)
    ]


@pytest.mark.parametrize("few", [0, 10**6])
def test_components_in_one_task_and_in_rounds(spark, few):
    draw = random.Random(4)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(300)] + [(k, k + 1) for k in range(1000, 1040)] + [(5, 5)]
    found = components(spark.createDataFrame(edges, "a long, b long"), few).collect()
    root = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(60):
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert {r.node: r.component for r in found} == root and len(found) == len(root)


def test_empty_table(spark):
    assert near_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_sketch_limit_leaves_room_at_the_threshold():
    spec = NearDedup()
    differing = 2 * spec.samples * (1 - spec.percent / 100)
    mean = spec.bits / 2 * (1 - (1 - 2 / spec.bits) ** differing)
    assert mean < spec.sketch_limit() < spec.bits / 2
