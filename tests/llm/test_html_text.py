import time

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tickbars.llm.html_text import _Block, _decided, extract, main_text

LONG = "This is the main part of the story, and it has a lot of words in it that the reader will want to see."
MORE = "Another paragraph that is part of the story and it is long enough to be counted as text, with the usual words."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<p>", ""),
        ("<script>var a = '<p>" + LONG, ""),
        ("<!-- " + LONG, ""),
        ("<article>one</article>", "one"),
        ("<article><h1>Head</h1><p>a &amp; b&nbsp;&#233; &lt;x&gt;<br>c<p>Two", "Head\n\na & b é <x> c\n\nTwo"),
        (f"<p>{LONG}<br><br>{MORE}</p>", f"{LONG}\n\n{MORE}"),
        (f"<nav><a href=x>Menu</a></nav><p>{LONG}</p><p>Short.</p><p>{MORE}</p><footer>{LONG}</footer>", f"{LONG}\n\nShort.\n\n{MORE}"),
        (f"<div class='cookie-notice'>{LONG}</div><div id=sidebar>{LONG}</div><div>{MORE}</div>", MORE),
        (f"<article><p>{LONG}</p><section class=comments><p>{MORE}</p></section></article>", LONG),
        (f"<article><p>{LONG}</p><aside>{MORE}</aside><form><p>{MORE}</p></form><p>End.</p></article><p>{MORE}</p>", f"{LONG}\n\nEnd."),
        (f"<article><header><h1>Head</h1></header><p>{LONG}</p><ul><li><a href=1>more</a><li><a href=2>links</a></ul></article>", f"Head\n\n{LONG}"),
        (f"<p>{LONG}</p><p style='display: none'>{MORE}</p><p hidden>{MORE}</p>", LONG),
        (f"<body class='has-sidebar'><div class='page'><p>{LONG}", LONG),
        (f'<p title="a > b">{LONG}</p><p class="', LONG),
    ],
)
def test_main_text(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<head><title>x</title><meta charset=utf-8><style>p {{}}</style><body><article>{LONG}</article>", LONG),
        (f"<html><head><title>x</title><script>1</script></head><body><article>{LONG}</article>", LONG),
        *[(f"<article><p>{LONG}</p><{name}><p>{MORE}</p></article>", f"{LONG}\n\n{MORE}") for name in ("button", "object", "canvas", "noscript", "video", "svg", "iframe")],
        (f"<article><p>{LONG}</p><button><p>{MORE}</p><button>Send</button></article>", f"{LONG}\n\n{MORE}"),
        (f"<article><p>{LONG}</p><svg/><p>{MORE}</p><svg><text>no</text></svg></article>", f"{LONG}\n\n{MORE}"),
        (f"<article><p>{LONG}</p><object>a<object>b</object>c<!-- <object> --></object></article>", LONG),
        (f"<article><p>{LONG}</p><style><p>{MORE}</p></article>", LONG),
    ],
)
def test_elements_without_an_end_tag_cut_nothing_off(page, text):
    assert main_text(page) == text


def test_inline_tags_do_not_split_words():
    assert main_text("<article>wo<b>r</b>d <i>x</i></article>") == "word x"


def test_long_and_deep_pages():
    deep = "<div>" * 3000 + "<article><p>" + LONG * 2000 + "</article>"
    assert main_text(deep) == LONG * 2000


@pytest.mark.parametrize("page", ["<p>a</p>" * 100_000, "<div>" * 100_000, "<article>" + "<li>x" * 100_000, "<b>" * 100_000 + "</i>" * 100_000])
def test_time_grows_with_the_page_not_with_its_square(page):
    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 20


def nearest_decided(found, k, step):
    """The nearest decided block of the same article, by looking at one after the other."""
    at = k + step
    while 0 <= at < len(found):
        if found[at].label and found[at].article == found[k].article and not (found[at].article and found[at].bad):
            return at
        at += step
    return None


@given(st.lists(st.tuples(st.sampled_from(["", "good", "bad"]), st.integers(0, 2), st.booleans()), max_size=30))
def test_neighbours_are_the_nearest_decided_ones(rows):
    found = [_Block(text="x", label=a, article=b, bad=c) for a, b, c in rows]
    for step in (1, -1):
        near = _decided(found, step)
        for k, b in enumerate(found):
            if not b.label:
                assert near[k] == nearest_decided(found, k, -step)


def test_extract_keeps_every_row(spark):
    rows = [(1, "u", f"<article>{LONG}</article>", 5), (1, "u", f"<article>{LONG}</article>", 5), (None, None, None, None), (2, "", "", 1)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    found = extract(frame).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(
        [(1, "u", LONG, len(LONG))] * 2 + [(None, None, "", 0), (2, "", "", 0)], key=repr
    )
    assert extract(frame.limit(0)).count() == 0
