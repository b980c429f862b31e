import hashlib

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from tickbars.llm.fingerprint import Syncmers, _cuts, _with_bucket, as_text, fingerprints, likeness, with_anchors

SCHEMA = "doc_id long, text string"


def neighbours(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    return [(i, t or "", order[(k + 1) % len(order)][1] or "") for k, (i, t) in enumerate(order)]


def edited(text, following):
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


@pytest.mark.parametrize("bucket", [128, 3, 1])
def test_edited_texts(spark, bucket):
    rows = [(7 * i * i - 40, f"text {i} é🙂 " * (i % 9)) for i in range(80)] + [(None, None), (10**15, "far away " * 50), (-(10**12), "x")]
    found = fingerprints(spark.createDataFrame(rows, SCHEMA), Syncmers(bucket=bucket)).collect()
    want = {i: (len(t), hashlib.sha256(edited(t, n).encode()).hexdigest()) for i, t, n in neighbours(rows)}
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in found} == want and len(found) == len(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)


def test_ids_at_both_ends_and_a_clashing_column(spark):
    rows = [(-(2**63), "low"), (2**63 - 1, "high"), (0, "zero " * 9), (None, "none"), (-1, None), (1, "")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("anchors", F.lit(1)).withColumn("_bucket", F.lit("x"))
    found = fingerprints(frame, Syncmers(bucket=1)).collect()
    want = {i: hashlib.sha256(edited(t, n).encode()).hexdigest() for i, t, n in neighbours(rows)}
    assert {r.doc_id: r.edited_sha256 for r in found} == want and len(found) == len(rows)


def test_buckets_stay_small_whatever_the_ids(spark):
    far = spark.range(20_000).select(F.when(F.col("id") == 5, 10**15).when(F.col("id") > 6_000, F.col("id")).alias("doc_id"), F.col("id").cast("string").alias("text"))
    one = far.withColumn("doc_id", F.when(F.col("text").cast("int") % 3 == 0, 7).otherwise(F.col("doc_id")))
    for docs in (far, one):
        sizes = _with_bucket(docs, _cuts(docs, Syncmers())).groupBy("_bucket").count().agg(F.max("count"), F.count("*")).first()
        assert sizes[0] < 4 * 128 and sizes[1] > 100


def test_one_row_repeated_rows_and_none(spark):
    one = fingerprints(spark.createDataFrame([(1, "abcdef")], SCHEMA)).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one.near_next == 1.0
    same = fingerprints(spark.createDataFrame([(1, "abc def")] * 3 + [(None, "abc def")], SCHEMA)).collect()
    assert len(same) == 4 and len({r.fingerprint for r in same}) == 1
    assert fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0


def test_anchors_depend_on_their_own_surroundings_only(spark):
    words = [f"word{i * 7919 % 1000}" for i in range(300)]
    rows = [(1, " ".join(words)), (2, " ".join(["other", "start"] + words[10:] + ["end"])), (3, " ".join(words)), (4, None), (5, "one"), (6, "two words")]
    frame = with_anchors(spark.createDataFrame(rows, SCHEMA), "text", "a").withColumn("f", as_text("a"))
    found = {r.doc_id: r for r in frame.collect()}
    assert found[1].f == found[3].f and found[4].f == "" and len(found[5].f) == 8 and found[6].f
    inner = found[2].a[8:-8]
    assert any(found[1].a[k : k + len(inner)] == inner for k in range(len(found[1].a)))
    pair = spark.createDataFrame([(found[1].a, found[2].a, found[5].a)], "a array<int>, b array<int>, c array<int>")
    near, far = pair.select(likeness("a", "b"), likeness("a", "c")).first()
    assert near > 0.9 and far == 0.0


def test_edits_are_near_and_neighbours_are_not(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = fingerprints(docs).where("n_chars >= 500").agg(F.min("near_edited"), F.max("near_next")).first()
    assert found[0] > 0.4 and found[1] < 0.3
    plan = fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
