import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF_DIR
from tickbars.llm.queries import QUERIES
from tickbars.llm.token_counts import Vocabulary, prefix_counts, tokens_before, truncated, within_budget

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
CONTENT = open(PATH, "rb").read()
OWN, LIBRARY = Vocabulary(CONTENT, PATTERN), Tokenizer.from_file(PATH)
PARTS = [*"ab'sltredvm 1\n\t!é　漢🙂́\u0085\x1c\x00", "'re", "'ll", "  ", "<|endoftext|>", "<|endof", "the ", "ing", "----", "don't"]


def library(text: str) -> int:
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


def running(text: str) -> list[int]:
    return OWN.text_steps(text).cumsum().tolist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=30).map("".join))
def test_every_prefix_has_the_count_of_the_library(text):
    assert running(text) == [library(text[: k + 1]) for k in range(len(text))]


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    assert running(text) == [library(text[: k + 1]) for k in range(len(text))]


def test_long_pieces_and_texts(monkeypatch):
    for text in ("a" * 3000, "=" * 5000, " " * 700 + "x", "ab" * 2000 + "<|endoftext|>" * 3, "\n" * 200):
        assert running(text)[-1] == library(text)
        assert running(text)[len(text) // 2] == library(text[: len(text) // 2 + 1])
    text = "Some words,  and more 123 of them\n\n" * 50
    whole = running(text)
    monkeypatch.setattr("tickbars.llm.token_counts.LONG_TEXT", 10)
    monkeypatch.setattr("tickbars.llm.token_counts.REMEMBERED", 3)
    assert running(text) == whole == [library(text[: k + 1]) for k in range(len(text))]


def test_tokens_that_fit_are_those_that_stay_apart():
    slow = Vocabulary(CONTENT, PATTERN)
    slow.ordered = False
    assert OWN.ordered
    n = len(OWN.tokens)
    alike = [k for k, t in enumerate(OWN.tokens) if len(set(t)) == 1 and len(t) < 20]
    pairs = [(a, b) for a in alike for b in alike if OWN.tokens[a][0] == OWN.tokens[b][0]]
    pairs += [(k * 7919 % n, k * 104729 % n) for k in range(3000)] + [(k * 31 % 700, k * 17 % 900) for k in range(3000)]
    for a, b in pairs:
        assert OWN.fits((a + 1) * n + b) == slow.fits((a + 1) * n + b)
    assert all(OWN.merged(t) == [t] for t in OWN.tokens[:2000])


def test_special_strings_that_cannot_be_counted_alone():
    with pytest.raises(ValueError):
        Vocabulary(CONTENT.replace(b'"lstrip":false', b'"lstrip":true').replace(b'"lstrip": false', b'"lstrip": true'), PATTERN)


def test_table_of_odd_rows(spark):
    texts = [None, "", "one", "one", "it's  two\n\n\nlines", "x<|endoftext|>y", "漢字 é" * 300, "word " * 20_000, " \t "]
    rows = [(None if k == 2 else 5, t, "k", 1) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, _0 int")
    counted = prefix_counts(docs, CONTENT, PATTERN, keep=("doc_id", "text", "_0"), budget=3)
    assert counted.columns == ["doc_id", "text", "_0", "n_bytes", "n_chars", "n_tokens", "steps", "fitting_chars", "over_limit"]
    found = counted.collect()
    assert sorted((repr(r.doc_id), repr(r.text)) for r in found) == sorted((repr(r[0]), repr(r[1])) for r in rows)
    for r in found:
        text = r.text or ""
        assert (r.n_bytes, r.n_chars, r.n_tokens) == (len(text.encode()), len(text), library(text))
        assert len(r.steps) == 2 * len(text) and r.over_limit == (r.n_tokens > 3)
        if len(text) < 100:
            assert r.fitting_chars == max([k for k in range(len(text) + 1) if library(text[:k]) <= 3])
    assert prefix_counts(docs.limit(0), CONTENT, PATTERN).count() == 0


def test_answers_from_the_stored_steps(spark, tmp_path):
    docs = spark.createDataFrame([(1, "The count   of'll every prefix<|endoftext|> is kept!"), (2, ""), (3, None)], "doc_id long, text string")
    prefix_counts(docs, CONTENT, PATTERN).write.parquet(str(tmp_path / "counts"))
    counted, text = spark.read.parquet(str(tmp_path / "counts")), docs.first().text
    for limit in (0, 1, 5, 8, 100):
        fitting = {r.doc_id: (r.fitting_chars, r.over_limit) for r in within_budget(counted, limit).collect()}
        best = max(k for k in range(len(text) + 1) if library(text[:k]) <= limit)
        assert fitting == {1: (best, library(text) > limit), 2: (0, False), 3: (0, False)}
        assert {r.doc_id: r.text for r in truncated(docs, counted, limit).collect()} == {1: text[:best], 2: "", 3: None}
    for chars in (0, 9, 30, 500):
        assert {r.doc_id: r.prefix_tokens for r in tokens_before(counted, chars).collect()} == {1: library(text[:chars]), 2: 0, 3: 0}


def test_query_counts_like_the_library(spark):
    found = QUERIES["op12_token_counts"](spark, SF_DIR)
    assert found.columns[:4] == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    rows = found.collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        n = library(docs[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 512)
