import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tickbars.llm.decontaminate import Contamination, Items, contaminated, edit_distance_within, plain, without_contaminated

ITEM = "The quick brown fox jumps over the lazy dog, and then it sleeps in the warm sun for an hour."
SCHEMA = "doc_id long, text string, item_id int"


def substring_distance(pattern, text):
    """Least edit distance of ``pattern`` to any substring, by the plain recurrence."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        last, row[0] = row[0], 0
        for i, p in enumerate(pattern, 1):
            last, row[i] = row[i], min(last + (p != c), row[i] + 1, row[i - 1] + 1)
        best = min(best, row[-1])
    return best


@settings(max_examples=200, deadline=None)
@given(st.text("ab ", min_size=1, max_size=70), st.text("abc ", max_size=90))
def test_bit_parallel_distance(pattern, text):
    masks = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    found = edit_distance_within(masks, len(pattern), text, len(pattern))
    assert found[0] == substring_distance(pattern, text) if text else True


def test_every_item_within_its_budget_is_found():
    draw, spec = random.Random(3), Contamination()
    items = [(k, " ".join("".join(draw.choices("abcdefgh", k=draw.randint(2, 8))) for _ in range(20))) for k in range(15)]
    search, texts = Items(items, spec), []
    for _ in range(120):
        k, text = draw.choice(items)
        text = list(plain(text))
        for _ in range(draw.randint(0, 14)):
            text[draw.randrange(len(text))] = draw.choice(["", "z", "zz", "q"])
        texts.append("lead " + "".join(text) + " tail")
    for text in texts:
        want = {k for k, item in items if substring_distance(plain(item), plain(text)) <= len(plain(item)) // spec.per_edit}
        assert {m[0] for m in search.matches(text)} == want


def test_contaminated(spark):
    docs = [
        (1, "intro " + ITEM.upper() + " outro"), (2, "clean text only"), (3, ITEM.replace("lazy", "hazy").replace(",", "  \n")), (4, None), (5, ""),
        (6, ITEM[:40]), (None, ITEM), (1, "intro " + ITEM.upper() + " outro"), (8, "filler words " * 20_000 + ITEM),
    ]
    items = [(10, ITEM), (10, ITEM), (11, None), (12, "short"), (13, ""), (14, "Some other item that nobody quotes anywhere at all.")]
    frame = spark.createDataFrame([(*d, 0) for d in docs], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for spec in (Contamination(), Contamination(block=60)):
        found = contaminated(frame, bench, spec).collect()
        assert sorted(((r.doc_id, r.item_id, r.distance) for r in found), key=repr) == sorted(
            [(1, 10, 0), (1, 10, 0), (3, 10, 1), (None, 10, 0), (8, 10, 0)], key=repr
        )
        kept = without_contaminated(frame, bench, spec)
        assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 6]
    assert contaminated(frame, bench.limit(0)).count() == 0 and without_contaminated(frame, bench.limit(0)).count() == len(docs)
    assert contaminated(frame.limit(0), bench).count() == 0


def test_short_items_match_word_for_word():
    search = Items([(1, "What is the capital now"), (2, "Yes!"), (3, "...")], Contamination())
    assert [m[:2] for m in search.matches("He asked: what is the CAPITAL, now?")] == [(1, 0)]
    assert [m[0] for m in search.matches("yes")] == [2] and search.matches("yesterday") == []
    assert search.matches("what is the capitol now") == [] and search.matches("now what is the capital") == []
