import math
import re
from collections import Counter

import pytest

from tickbars.llm.lexical_search import LexicalSearch, PLAIN, search

TERM = re.compile(r"[0-9a-z\u0080-\U0010ffff]+")


def terms(text):
    return TERM.findall((text or "").translate({k: k + 32 for k in range(65, 91)}))


def brute_force(docs, items, top=10):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in c for _, c in counted) + 1))) for s in wanted.values() for t in s}
    out = []
    for item, mine in wanted.items():
        found = []
        for doc, c in counted:
            m = 100 - 90 + 90 * sum(c.values()) * n_docs // n_terms
            score = sum(weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in mine if c[t])
            if score > 0:
                found.append((-score, doc is not None, doc or 0, doc, score))
        out += [(item, k, f[3], f[4]) for k, f in enumerate(sorted(found, key=lambda f: f[:3])[:top], 1)]
    return sorted(out, key=repr)


def odd_rows():
    texts = [None, "", "...", "The cat_sat on THE mat", "cat", "Straße ÉCOLE é école 漢字", "x\x00cat\x7fdog", "dog " * 500, "the the the"]
    docs = [(k, t) for k, t in enumerate(texts)] + [(4, "cat"), (4, "another cat"), (None, "cat"), (-(2**63), "cat"), (2**62, "dog cat")]
    docs += [(1000 + k, f"word{k % 7} dog number{k % 11} " + "filler " * (k % 5)) for k in range(300)]
    items = [(1, "the cat"), (2, "DOG, dog; word3"), (3, None), (4, ""), (5, "école É 漢字"), (None, "cat"), (1, "mat"), (7, "absent term"), (8, "filler number1 word2 cat")]
    return docs, items + [(20 + k, f"word{k} number{k}") for k in range(12)]


@pytest.mark.parametrize("spec", [LexicalSearch(), LexicalSearch(block_items=4, cells=40, group=1), LexicalSearch(top=2, block_bytes=90)])
def test_against_brute_force(spark, spec):
    docs, items = odd_rows()
    frame = spark.createDataFrame([(t, i, "x", 1) for i, t in docs], "text string, doc_id long, item_id string, score int").repartition(6)
    asked = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, rank int")
    found = search(frame, asked, spec)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_force(docs, items, spec.top)


def test_many_equal_scores(spark):
    frame = spark.range(5000).selectExpr("5000 - id AS doc_id", "'same words here' AS text").repartition(5)
    found = search(frame, spark.createDataFrame([(1, "words")], "item_id long, text string"), LexicalSearch(cells=100)).collect()
    # All documents have the term: its weight is floor(1000 * ln(10002 / 10001)) = 0.
    assert found == []
    frame = frame.union(spark.createDataFrame([(9000 + k, "other") for k in range(5000)], "doc_id long, text string"))
    found = search(frame, spark.createDataFrame([(1, "words")], "item_id long, text string"), LexicalSearch(cells=100)).collect()
    assert [(r.rank, r.doc_id) for r in sorted(found, key=lambda r: r.rank)] == [(k, k) for k in range(1, 11)]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search(docs.limit(0), items).count() == 0 and search(docs, items.limit(0)).count() == 0
    assert search(docs.selectExpr("doc_id", "CAST(NULL AS STRING) AS text"), items).count() == 0


def test_bytes_of_terms():
    kept = {b for b in range(256) if PLAIN[b] != 32}
    assert kept == {*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)}
