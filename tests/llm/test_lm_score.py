import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from tickbars.llm import lm_score
from tickbars.llm.lm_score import MixSpec, normal, score, train

QUICK = MixSpec(bits=14, sample=60, sample_bytes=60_000, frequent=1e-3)


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 250").select("doc_id", "text")
    odd = [(None, None), (7001, ""), (7002, "a" * 3000), (7003, "it's\x0b 'll  \n\n  x　y z" * 50), (7002, "a" * 3000), (7004, " \t")]
    docs = docs.union(spark.createDataFrame(odd, docs.schema)).withColumn("key", F.lit(1))
    learnt = docs.where("pmod(crc32(cast(cast(doc_id AS string) AS binary)), 5) <> 1")
    model = train(learnt, QUICK)
    return docs.collect(), model, score(docs, model).toPandas()


def test_unigram_base(scored):
    docs, model, found = scored
    counts = Counter(t for r in docs if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 != 1 for t in tokens(r.text))
    total, kinds = sum(counts.values()), len(counts)
    assert (model.total, model.kinds) == (total, kinds) and set(found["train_tokens"]) == {total}
    want = []
    for r in docs:
        mine = tokens(r.text)
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (kinds + 1))) for t in mine)
        want.append((r.doc_id, len(mine), sum(counts[t] > 0 for t in mine), round(base, 5)))
    rows = [(None if i != i else int(i), n, k, round(b, 5)) for i, n, k, b in zip(found["doc_id"], found["n_tokens"], found["n_known"], found["base_score"])]
    assert sorted(rows, key=repr) == sorted(want, key=repr)


def test_scores_are_sums_of_byte_probabilities(scored):
    docs, model, found = scored
    by_id = {i: s for i, s in zip(found["doc_id"], found["score"])}
    for r in docs[:3] + [r for r in docs if r.doc_id in (7001, 7002, 7003)]:
        data = b"\n" * 5 + normal(r.text) + b"\n"
        codes = [int.from_bytes(data[k - 5 : k + 1], "big") for k in range(5, len(data))]
        assert by_id[r.doc_id] == pytest.approx(model.mixer.log10(np.array(codes, np.int64)).sum())


def test_probabilities_of_all_bytes_sum_to_one(scored):
    mixer = scored[1].mixer
    for context in (b"\n\n\n\n\n", b" the ", b"qqqqq", "né é".encode()[-5:].rjust(5)):
        codes = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.int64)
        assert (10 ** mixer.log10(codes)).sum() == pytest.approx(1.0)


def test_held_out_texts_cost_far_less_than_uniform_bytes(scored):
    assert scored[2]["bits_per_byte"].median() < 3.5


def test_copies_are_learned_from_as_one(spark):
    rows = [(f"word{i} and {i * i} others here",) for i in range(30)]
    copies = spark.createDataFrame(rows + [(rows[0][0],)] * 500 + [(None,)] * 5, "text string")
    learnt = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(lm_score.Mixer, "learn", lambda self, texts: learnt.extend(texts))
        model = train(copies, MixSpec(bits=12, sample=10**6))
    assert sorted(learnt) == sorted(t for t, in rows) and model.total > 500


@pytest.fixture(scope="module")
def learnt(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 60").select("text")
    rare = spark.createDataFrame([("zq" * 40 + str(i),) for i in range(40)], "text string")
    return docs.union(docs.limit(3)).union(rare)


def test_a_model_does_not_depend_on_the_texts_drawn_first(spark, learnt):
    models = [train(learnt, MixSpec(bits=14, sample=n, sample_bytes=10**6)).mixer for n in (0, 1, 1000)]
    for other in models[1:]:
        assert np.allclose(models[0].by_place, other.by_place, atol=0.02) and np.allclose(models[0].map, other.map, atol=0.01)
    text = [int.from_bytes(b"\n\n\n\n\n the words\n"[k : k + 6], "big") for k in range(11)]
    scores = [m.log10(np.array(text, np.int64)).sum() for m in models]
    assert scores[1:] == pytest.approx(scores[:1] * 2, rel=1e-3)


def test_weights_and_map_are_the_best_for_all_training_texts(learnt):
    """Text by text, byte by byte, without the counted n-grams: no slope is left, and the map holds the shares of ones."""
    mixer = train(learnt, MixSpec(bits=14)).mixer
    codes = np.concatenate([lm_score._codes(*lm_score._buffer([r.text])[:2]) for r in learnt.collect()])
    first, by_count, blank = lm_score.Mixer.first()
    slope = [mixer.by_place - first, (mixer.by_count - by_count)]
    hits, ones = np.full(blank.shape, 50.0), 50.0 * blank
    slots, table = lm_score._slots(codes, 14), np.arange(7)
    for j in range(8):
        own = ((codes >> (7 - j)) & 1).astype(np.float64)
        logits, longest, bucket = mixer._inputs(slots[:, j], own.astype(np.float32))
        by_place = (mixer.by_place[longest * 8 + j] * logits.T).sum(axis=1)
        by_counts = (mixer.by_count[longest[:, None], table, bucket.T] * logits.T).sum(axis=1)
        np.add.at(slope[0], longest * 8 + j, (logits * (1 / (1 + np.exp(-by_place)) - own)).T)
        np.add.at(slope[1], (longest[:, None], table, bucket.T), (logits * (1 / (1 + np.exp(-by_counts)) - own)).T)
        node = (1 << j) | ((codes & 255) >> (8 - j))
        at = np.clip(((by_place + by_counts) / 2 + 8) * 2, 0, 31.999)
        for low, part in ((np.floor(at).astype(int), 1 - at % 1), (np.floor(at).astype(int) + 1, at % 1)):
            np.add.at(hits, (node, low), part)
            np.add.at(ones, (node, low), part * own)
    assert max(np.abs(s).max() for s in slope) < 1e-3 * len(codes)
    assert np.allclose(mixer.map, np.clip(ones / hits, 1e-5, 1 - 1e-5), atol=1e-3)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    model = train(none, QUICK)
    assert score(none, model).count() == 0
    row = score(spark.createDataFrame([(1, "some text")], none.schema), model).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and row.score < 0
