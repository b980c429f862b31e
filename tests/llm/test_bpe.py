import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickbars.llm.bpe import LOOKAHEAD, Bpe, _encoding, boundaries, decode, decode_ids, encode, encode_text

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
ODD = [
    (None, None), (1, ""), (2, "a" * 1000), (3, "it's 'll  \n\n  x　y\x1c z" * 60), (2, "a" * 1000), (4, " " * 500 + "b" + "!" * 400),
    (5, "Ünï 漢字 🙂 1234 <|endoftext|>" * 40), (6, "word " * 400), (7, "   \t" * 200 + "x"),
]


@pytest.mark.parametrize(("chunk", "overlap"), [(32_768, 2_048), (300, 40), (64, 16)])
def test_ids_of_the_library_and_round_trip(spark, chunk, overlap):
    bpe = Bpe.from_file(PATH, PATTERN, chunk=chunk, overlap=overlap)
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in ODD], "doc_id long, text string, _0 int, key string")
    found = decode(encode(docs, bpe), bpe)
    assert found.columns == ["doc_id", "text", "_0", "key", "ids", "decoded"]
    library = _encoding(bpe.ranks, PATTERN)[0]
    rows = found.collect()
    assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == sorted(ODD, key=repr)
    for r in rows:
        ids = [int.from_bytes(r.ids[k : k + 4], "little") for k in range(0, len(r.ids), 4)]
        assert ids == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    both = encode(docs, bpe, decoded="decoded")
    assert both.columns == found.columns and sorted(map(repr, both.collect())) == sorted(map(repr, rows))
    assert encode(docs.limit(0), bpe).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab'sl 1\n\t!é　"), min_size=30, max_size=120), st.integers(5, 25))
def test_scans_that_share_a_boundary_agree_from_there(text, start):
    ranks = Bpe.from_file(PATH, PATTERN).ranks
    true, other = boundaries(text, 0, 0, len(text), PATTERN), boundaries(text[start:], 0, 0, len(text), PATTERN)
    safe = boundaries(text[: start + 15], 0, start, start + 15 - LOOKAHEAD, PATTERN)
    shared = sorted(set(safe) & {start + x for x in other})
    if shared:
        at = shared[0]
        assert at in true
        assert encode_text(text[:at], ranks, PATTERN) + encode_text(text[at:], ranks, PATTERN) == encode_text(text, ranks, PATTERN)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_round_trip(text):
    ranks = Bpe.from_file(PATH, PATTERN).ranks
    assert decode_ids(encode_text(text, ranks, PATTERN), ranks, PATTERN) == text.encode()
