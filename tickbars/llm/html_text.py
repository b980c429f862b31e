"""Main text of web pages by two passes over their blocks.

A page is cut into blocks at block-level tags. The first pass labels a block
by itself: menus, footers, forms, notices, adverts and comments by the element
they are in, others by length, share of link text and share of stop words. The
second pass settles short blocks and those with middling figures: they take
the label of the nearest decided block before or after them, within the same
article where the page marks one. Inside a marked article only link lists need
figures; a page without a mark goes by the figures alone.

Character references are decoded, white space within a block is one space,
blocks are joined by an empty line. A null page is empty.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|\Z)", re.DOTALL
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
WORD = re.compile(r"[^\W\d_]+")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

#: Elements of HTML by their role.
RAW = frozenset("script style textarea title iframe xmp noframes".split())
SKIPPED = frozenset("noscript template svg math select button object audio video canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCK - frozenset("caption tbody td tfoot th thead tr option optgroup legend".split())
SIBLINGS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table".split())
ASIDE = frozenset("nav footer aside form menu dialog fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())

#: Words in class names and ids of elements that are not part of an article.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs sidebar aside widget widgets footer topbar masthead cookie cookies consent gdpr notice notices notification alert popup "
    "modal overlay newsletter subscribe subscription signup login register share sharing social related recommended recommendations teaser comment "
    "comments commentlist discussion disqus respond response responses reply replies pagination pager search form copyright disclaimer legal toolbar skip".split()
)
HEADS = frozenset(("header", "head", "top"))
MARKS = frozenset(("article", "post", "entry", "story"))

#: Frequent words of English, German, French and Spanish.
STOP = frozenset(
    "the of and to in is that for it as with was on be by at this are from or an have not he his but they which you we a "
    "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach bei um am sind noch wie einem über so zum war haben nur oder aber vor zur "
    "le la les de et un une des du en est que qui dans pour par sur au plus pas ce il ne se son avec sont ou mais comme aux leur cette "
    "el los las y que en del se por con una su para como más al lo pero sus o este ha si porque entre cuando muy sin sobre".split()
)


@dataclass(frozen=True)
class BlockRules:
    """``short``: characters below which a block is ambiguous; ``links``: largest share of link text;
    ``few`` and ``many``: shares of stop words below which a block is boilerplate and from which it is text."""

    short: int = 70
    links: float = 0.34
    few: float = 0.05
    many: float = 0.12


@dataclass
class _Block:
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    bad: bool = False
    article: int = 0
    heading: bool = False
    text: str = ""
    label: str = ""


def _named(attributes: dict[str, str], inside: bool) -> bool:
    for value in (attributes.get("class", ""), attributes.get("id", "")):
        for name in value.split():
            parts = [p.lower() for p in PART.findall(name)]
            if parts and parts[0] in ("has", "with", "no", "without", "js"):
                continue
            if NAMES.intersection(parts) or not inside and HEADS.intersection(parts):
                return True
    return False


def _is_aside(name: str, attributes: dict[str, str], inside: bool) -> bool:
    if name in ("html", "body", "main"):
        return False
    if name in ASIDE or name == "header" and not inside:
        return True
    if attributes.get("role", "").lower() in ROLES or "hidden" in attributes or attributes.get("aria-hidden", "") == "true":
        return True
    style = attributes.get("style", "").replace(" ", "").lower()
    return "display:none" in style or "visibility:hidden" in style or _named(attributes, inside)


def _is_article(name: str, attributes: dict[str, str]) -> bool:
    if name in ("article", "main") or attributes.get("role", "").lower() in ("main", "article"):
        return True
    for value in (attributes.get("class", ""), attributes.get("id", "")):
        for word in value.split():
            parts = [p.lower() for p in PART.findall(word)]
            if parts and parts[0] in MARKS and (len(parts) == 1 or parts[1] in ("content", "body", "text")):
                return True
    return False


def _raw_end(page: str, at: int, name: str, endless: set[str]) -> int:
    """Where the raw text of an element ends; without an end tag only the tag counts, but for scripts and styles."""
    if name not in endless:
        end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
        if end:
            return end.end()
        endless.add(name)  # nor is there one further on
    return len(page) if name in ("script", "style") else at


def _skipped(page: str) -> dict[int, int]:
    """Start of each element of SKIPPED that has an end tag of its own, to the end of that tag."""
    out: dict[int, int] = {}
    opened: dict[str, list[int]] = {name: [] for name in SKIPPED}
    at, endless = 0, set()
    while found := TOKEN.search(page, at):
        at = found.end()
        name = (found[2] or "").lower()
        if found[1] and opened.get(name):
            out[opened[name].pop()] = at
        elif not found[1] and name in RAW:
            at = _raw_end(page, at, name, endless)
        elif not found[1] and name in SKIPPED and not (name in ("svg", "math") and found[3].endswith("/")):
            opened[name].append(found.start())
    return out


def blocks(page: str) -> list[_Block]:
    """The blocks of a page in order, with the elements around them taken into account."""
    out: list[_Block] = []
    stack: list[tuple[str, bool, int, bool]] = []  # name, aside, article, link
    places: dict[str, list[int]] = {}  # where the open elements of a name stand in the stack
    open_blocks: list[int] = []
    current, bad, article, link, heading, articles, breaks = _Block(), False, 0, False, False, 0, 0

    def close() -> None:
        nonlocal current, breaks
        if current.parts:
            current.text = " ".join(html.unescape("".join(current.parts)).split())
            if current.text:
                out.append(current)
        current, breaks = _Block(bad=bad, article=article, heading=heading), 0

    def restore() -> None:
        nonlocal bad, article, link, heading
        _, bad, article, link = stack[-1] if stack else ("", False, 0, False)
        heading = any(len(s[0]) == 2 and s[0][0] == "h" and s[0][1].isdigit() for s in stack[-4:])

    def pop(k: int) -> None:
        ends = bool(open_blocks) and open_blocks[-1] >= k
        for name, *_ in stack[k:]:
            places[name].pop()
            if name in BLOCK:
                open_blocks.pop()
        del stack[k:]
        restore()
        if ends:
            close()

    def last(names: Iterable[str]) -> int | None:
        return max((places[n][-1] for n in names if places.get(n)), default=None)

    def words(text: str) -> None:
        nonlocal breaks
        current.parts.append(text)
        if link:
            current.linked.append(text)
        if not text.isspace():
            breaks = 0

    at, size = 0, len(page)
    endless, skipped = set(), None
    while at < size:
        found = TOKEN.search(page, at)
        if not found:
            words(page[at:])
            break
        if found.start() > at:
            words(page[at : found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if found[1]:
            k = last((name,))
            if k is not None:
                pop(k)
            continue
        if name in RAW or name in SKIPPED:
            if name in RAW:
                at = _raw_end(page, at, name, endless)
            else:
                skipped = _skipped(page) if skipped is None else skipped
                at = skipped.get(found.start(), at)
            if name in ("select", "button", "textarea"):
                words(" ")
            continue
        if name == "head":  # its end tag may be left out, and what may stand in it has no text
            continue
        if name == "br":
            words(" ")
            breaks += 1
            if breaks == 2:
                close()
            continue
        if name in ENDS_P:
            k = last(("p",))
            if k is not None and open_blocks[-1] == k:
                pop(k)
        if name in SIBLINGS:
            k = last(SIBLINGS[name] | SCOPES)
            if k is not None and stack[k][0] not in SCOPES:
                pop(k)
        if name in VOID:
            if name == "hr":
                close()
            continue
        attributes = {a.lower(): b or c or d for a, b, c, d in ATTRIBUTE.findall(found[3])} if found[3] else {}
        if found[3] and re.search(r"(?:^|\s)hidden(?:\s|$)", found[3]):
            attributes["hidden"] = ""
        aside = bad or _is_aside(name, attributes, article > 0)
        if not aside and not article and _is_article(name, attributes):
            articles += 1
            article = articles
        places.setdefault(name, []).append(len(stack))
        if name in BLOCK:
            open_blocks.append(len(stack))
        stack.append((name, aside, article, link or name == "a"))
        restore()
        if name in BLOCK:
            close()
    close()
    return out


def _decided(found: list[_Block], step: int) -> list[int | None]:
    """For each block the nearest decided one of its article on one side; one pass."""
    last: dict[int, int] = {}
    out: list[int | None] = [None] * len(found)
    for k in range(len(found))[::step]:
        b = found[k]
        out[k] = last.get(b.article)
        if b.label and not (b.article and b.bad):
            last[b.article] = k
    return out


def label(found: list[_Block], rules: BlockRules) -> list[_Block]:
    """The blocks that are main text."""
    marked = any(b.article and not b.bad for b in found)
    for b in found:
        linked = len(" ".join(html.unescape("".join(b.linked)).split()))
        share = linked / len(b.text)
        if b.bad or marked and not b.article or share > rules.links:
            b.label = "bad"
            continue
        tokens = WORD.findall(b.text.lower())
        stop = sum(t in STOP for t in tokens) / max(len(tokens), 1)
        if b.text.startswith("©") and len(b.text) < rules.short:
            b.label = "bad"
        elif b.heading or len(b.text) < rules.short:
            b.label = ""
        elif b.article or stop >= rules.many:
            b.label = "good"
        elif stop < rules.few:
            b.label = "bad"
    behind, ahead = _decided(found, 1), _decided(found, -1)
    decided = [b.label for b in found]
    for k, b in enumerate(found):
        if b.label:
            continue
        before, after = behind[k], ahead[k]
        if before is None and after is None:
            b.label = "good" if b.article else "bad"
        elif b.article:
            # Link lists aside, what an article marks as its own stays unless both sides are link lists.
            near = {decided[i] for i in (before, after) if i is not None}
            b.label = "good" if "good" in near else "bad"
        elif before is None or after is None:
            b.label = decided[after if before is None else before]
        elif b.heading:
            b.label = decided[after]
        else:
            b.label = decided[before if k - before <= after - k else after]
    return [b for b in found if b.label == "good"]


def main_text(page: str | None, rules: BlockRules = BlockRules()) -> str:
    return "\n\n".join(b.text for b in label(blocks(page or ""), rules))


def extract(pages: DataFrame, rules: BlockRules = BlockRules(), keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Columns ``keep`` of every row with the main text of ``html`` as ``text`` and its code points as ``n_chars``."""
    plain = pages.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keep)], F.col("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, rules) for h in batch.column(batch.num_columns - 1).to_pylist()]
            made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=[*batch.schema.names[:-1], "text", "n_chars"])

    kept = ", ".join(f"_{i} {t}" for i, t in enumerate(dict(pages.dtypes)[c] for c in keep))
    out = plain.mapInArrow(run, f"{kept}, text string, n_chars long")
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], "text", "n_chars")
