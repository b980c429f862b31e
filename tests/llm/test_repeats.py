import random
from collections import Counter

import pytest

from tickbars.llm.repeats import Repeats, remove_repeats


def brute_force(docs, length):
    starts = Counter(t[k : k + length] for _, t in docs for k in range(len(t) - length + 1))
    out = []
    for i, t in docs:
        covered = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if starts[t[k : k + length]] > 1:
                covered[k : k + length] = b"\1" * length
        spans = sum(1 for a, b in zip(b"\0" + bytes(covered), covered) if b and not a)
        out.append((i, len(t), sum(covered), spans, bytes(x for x, c in zip(t, covered) if not c)))
    return sorted(out, key=repr)


def check(spark, docs, spec):
    frame = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, h int")
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeats(frame, spec).collect()]
    assert sorted(found, key=repr) == brute_force([(i, (t or "").encode()) for i, t in docs], spec.length)


@pytest.mark.parametrize("group", [16_384, 2])
def test_shared_passages(spark, group):
    draw = random.Random(group)
    text = lambda n: "".join(draw.choices("abcde é\n", k=n))
    passages = [text(n) for n in (199, 200, 201, 260, 900)]
    docs = [(i, text(draw.randint(0, 400)) + draw.choice(passages) + text(draw.randint(0, 400))) for i in range(60)]
    docs += [(99, docs[0][1]), (99, docs[0][1]), (None, None), (None, docs[1][1]), (100, ""), (101, "a" * 5000), (102, "ab" * 99 + "!" * 400)]
    docs += [(103, "ab" * 99 + "c!" * 200), (104, "z" * 199), (105, "z" * 199)]
    check(spark, docs, Repeats(group=group))


def test_other_lengths(spark):
    draw = random.Random(9)
    docs = [(i, "".join(draw.choices("ab", k=150))) for i in range(25)]
    check(spark, docs, Repeats(length=24, reach=16, trigger=6))


def test_empty_table_and_bad_settings(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        Repeats(length=100, reach=128)
