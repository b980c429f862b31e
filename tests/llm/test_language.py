import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from tickbars.llm import language
from tickbars.llm.buffers import text_bytes
from tickbars.llm.language import LanguageSpec, _smoothed, identify, letters, train


def kneser_ney(rows, text, order, discount, alphabet):
    """Nats per character, straight from the definition."""
    counts = [Counter() for _ in range(order)]
    for _, gram, n in rows:
        counts[len(gram) - 1][gram] += n
    for n in range(order - 1, 0, -1):
        for gram in counts[n]:
            counts[n - 1][gram[1:]] += 1

    def p(gram):
        if not gram:
            return 1 / (alphabet + 1)
        level = counts[len(gram) - 1]
        total = sum(c for g, c in level.items() if g[:-1] == gram[:-1])
        kinds = sum(1 for g in level if g[:-1] == gram[:-1])
        if not total:
            return p(gram[1:])
        return max(level[gram] - discount, 0) / total + discount * kinds / total * p(gram[1:])

    return -sum(math.log(p(text[max(0, k - order) : k])) for k in range(2, len(text) + 1)) / (len(text) - 1)


def test_tables_give_interpolated_kneser_ney():
    spec = LanguageSpec(order=3)
    line = " das war das war sie da was"
    rows = [("x", line[max(0, k - 3) : k], 1) for k in range(2, len(line) + 1)]
    rows = [(*key, n) for key, n in Counter((a, b) for a, b, _ in rows).items()]
    model = _smoothed(rows, ["x"], spec)
    alphabet = len({c for c in line})
    for text in ("das wars", "sie war da", "quark", "w"):
        values, counts = model.entropies(*text_bytes(pa.array([text])))
        assert counts[0] == len(text)
        assert values[0, 0] == pytest.approx(kneser_ney(rows, " " + text, 3, spec.discount, alphabet), rel=1e-5)


def test_letters():
    data, offsets = text_bytes(pa.array(["Ab, ÇD!", None, "12", "", "x"]))
    points, bounds = letters(data, offsets)
    assert ["".join(map(chr, points[a:b])) for a, b in zip(bounds, bounds[1:])] == [" ab çd ", " ", " ", " ", " x"]


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    model = train(docs.where(~held), LanguageSpec(sample=100))
    odd = spark.createDataFrame([(None, None), (-1, ""), (-2, "12 !?"), (-3, "The thing that is of the and. " * 3000), (-3, "и"), (-4, "the")], "doc_id long, text string")
    found = identify(docs.select("doc_id", "text").union(odd), model).toPandas()
    truth = docs.where(held).select("doc_id", "lang").toPandas().merge(found, on="doc_id")
    assert len(found) == 1006 and (truth["lang"] == truth["lang_pred"]).mean() > 0.99
    assert not truth["rejected"].mean() > 0.01 and found["score"].between(0, 1).all()
    other = found[~(found["doc_id"] >= 0)]
    assert sorted(other["lang_pred"])[-3:] == ["und"] * 3 and (other[other["lang_pred"] == "und"]["score"] == 0).all()
    assert other[other["lang_pred"] == "und"]["rejected"].all()
    assert other[other["doc_id"] == -4]["lang_pred"].tolist() == ["en"]


def test_copies_are_drawn_once(spark, monkeypatch):
    texts = [(lang, f"{lang} text number {i}") for lang in ("de", "en") for i in range(40)]
    copies = spark.range(3000).select(F.lit("en").alias("lang"), F.concat(F.lit("en text number "), F.col("id") % 10).alias("text"))
    parts = []
    counts, calibrate = language._counts, language._calibrate
    monkeypatch.setattr(language, "_counts", lambda df, n: parts.append(df) or counts(df, n))
    monkeypatch.setattr(language, "_calibrate", lambda model, df: parts.append(df) or calibrate(model, df))
    train(spark.createDataFrame(texts, "lang string, text string").union(copies), LanguageSpec(order=2))
    assert sorted((r.lang, r.text) for part in parts for r in part.collect()) == sorted(texts)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = train(none)
    assert identify(none, model).count() == 0
    some = spark.createDataFrame([(1, "words")], "doc_id long, text string")
    assert [tuple(r) for r in identify(some, model).collect()] == [(1, "und", 0.0, True)]
