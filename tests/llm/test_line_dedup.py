import random

from pyspark.sql import functions as F
from hypothesis import given
from hypothesis import strategies as st

from tickbars.llm.line_dedup import LineDedup, dedup_lines, within_one

BASE = "one two three four five six seven eight nine ten"


def edit_distance(x, y):
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], min(last + (a != b), row[j] + 1, row[j - 1] + 1)
    return row[-1]


@given(st.lists(st.integers(0, 2), max_size=7), st.lists(st.integers(0, 2), max_size=7))
def test_within_one(x, y):
    assert within_one(x, y) == (edit_distance(x, y) <= 1)


def brute_force(rows, spec):
    """(place of row, lines to remove) by comparing every line with every earlier one."""
    places = []
    for doc_id, h, text in {(i, h, t) for i, h, t in rows if t is not None}:
        for k, line in enumerate(text.encode().lower().split(b"\n")):
            words = line.split()
            if len(words) >= spec.least:
                places.append((-(2**63) if doc_id is None else doc_id, h, k, words))
    places.sort()
    gone = set()
    for n, (i, h, k, words) in enumerate(places):
        for *_, other in places[:n]:
            near = min(len(words), len(other)) >= spec.least_near and abs(len(words) - len(other)) <= 1 and edit_distance(words, other) <= 1
            if words == other or near:
                gone.add((i, h, k))
                break
    # A kind of line with an earlier neighbour goes at all of its places, and that is covered: its places come later.
    return gone


def run(spark, docs, spec=LineDedup()):
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("line", F.lit(1)).withColumn("h", F.lit("x"))
    rows = [(r.doc_id, r.k, r.text) for r in frame.withColumn("k", F.xxhash64("text")).collect()]
    gone = brute_force(rows, spec)
    want = []
    for doc_id, h, text in rows:
        lines = [] if text is None else text.split("\n")
        mine = {k for k in range(len(lines)) if (-(2**63) if doc_id is None else doc_id, h, k) in gone}
        want.append((doc_id, 1, "x", len(lines), len(mine), None if text is None else "\n".join(x for k, x in enumerate(lines) if k not in mine)))
    found = dedup_lines(frame, spec, ("doc_id", "line", "h")).withColumn("kept", F.col("kept").cast("string")).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    return found


def test_lines_within_one_edit(spark):
    run(spark, [
        (None, None), (None, BASE), (1, ""), (2, BASE), (3, BASE.replace("five", "FIVE") + "\n" + BASE.replace("five", "x")),
        (4, BASE + " eleven\n\nzero " + BASE), (5, BASE.replace("five ", "") + "\n" + BASE.replace("six ", "six six ")), (2, BASE),
        (6, "a b\na b\n a b c\nA  b c"), (7, "ten " + BASE[:-4] + "\r"), (8, "\n" * 50 + "lone line here"), (9, ("many words " * 3000).strip()),
    ])


def test_random_lines_with_a_frequent_one(spark):
    draw, docs = random.Random(1), []
    lines = [" ".join(draw.choices("abcdefg", k=draw.randint(2, 12))) for _ in range(25)]
    for i in range(40):
        mine = []
        for line in draw.sample(lines, 3):
            words = line.split()
            if draw.random() < 0.5:
                words[draw.randrange(len(words))] = draw.choice(["z", "z z", ""])
            mine.append(" ".join(words))
        docs.append((i // 2, "\n".join(["The line that nearly every document of the table has", *mine])))
    run(spark, docs)
    run(spark, docs, LineDedup(least=3, least_near=4))


def test_short_lines_and_lines_without_spaces(spark):
    url = "https://example.org/" + "a" * 400
    found = run(spark, [(1, f"{url}\nEnd."), (2, f"end.\n\n{url}\n\n new"), (3, f"{url}\r\n完全に同じ行"), (4, "完全に同じ行\n \n"), (4, "end. new")])
    assert [r.kept for r in sorted(found, key=lambda r: (r.doc_id, r.n_lines))][1:] == ["\n\n new", "完全に同じ行", "end. new", " \n"]


def test_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []
