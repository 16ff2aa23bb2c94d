"""The main text of web pages by maximum-scoring subsequence.

A page is a sequence of tags and words.  Words score positive and tags negative, by weights
learned from pages that label themselves: those with an ``article`` or ``main`` element, whose words count as
content.  Words in menus, footers, adverts and other boilerplate elements score
negative, so they end a region.  One linear scan finds the contiguous region with the largest sum;
its text without the boilerplate elements inside it is the result.

What a word scores depends on where it stands: in the page's main element, outside of it, on a page without
one, or in boilerplate; and on its block and whether it is in a link.  Each such class, and each tag,
has the log-odds of content among the labelled pages as its weight; a prior stands for classes that they don't have.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches

SAMPLE = 5_000  # labelled pages that weights are learned from
MOST = 4.0  # weights lie within this
LEAST_TAG = -0.05  # no tag scores more
DEEPEST = 512  # elements within elements; deeper ones belong to that above them, as in browsers

#: Elements without content of their own or an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
#: Elements that end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary "
    "table tbody td tfoot th thead title tr ul".split()
)
#: Elements that are never part of an article.
BOILERPLATE = frozenset(
    "nav footer aside form button select option textarea input label script style template noscript noembed noframes "
    "iframe object svg canvas audio video map menu dialog head title xmp datalist".split()
)
#: Words of classes, ids and roles that name such parts.
NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising advertorial adsense adsbygoogle sponsor sponsored sponsors promo promos "
    "promotion promoted outbrain taboola banner nav navbar navigation menu menubar menus breadcrumb breadcrumbs pagination "
    "pager toolbar topbar footer foot header masthead sidebar sidebars complementary widget widgets related recommended "
    "recommendations trending popular share sharing social follow newsletter subscribe subscription signup login signin "
    "register search searchbox searchform cookie cookies consent gdpr privacy notice notices notification alert alertdialog "
    "popup modal overlay dialog paywall comment comments commentlist commentary respond reply replies disqus discussion "
    "guestbook copyright legal disclaimer skip hidden contentinfo form toc".split()
)
#: Roles of the element that holds a page's main text, where there is no article.
MAIN_NAMES = frozenset("article main".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:=\s*+(?:\"[^\"]*\"|'[^']*')|[^>])*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


class Run(NamedTuple):
    """Some text, or a tag (``text`` None): its class, and whether it is in a boilerplate element or a main one."""

    kind: str
    text: str | None
    boilerplate: bool
    main: bool
    block: int  # texts with the same number are one block


def attributes(text: str) -> dict[str, str]:
    found = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(a or b or c))
    return found


def named_parts(names: str) -> set[str]:
    return {x.lower() for x in _NAME_PARTS.findall(names)}


def is_boilerplate(tag: str, attrs: dict[str, str], in_main: bool) -> bool:
    """Whether an element is none of an article: by its name, its class, id or role, or because it is hidden."""
    if tag in ("html", "body", "article", "main"):
        # a page's or an article's own classes describe the page; comments are articles too
        return tag == "article" and bool(named_parts(attrs.get("class", "")) & {"comment", "reply"})
    if tag in BOILERPLATE or (tag == "header" and not in_main):
        return True
    if not attrs:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", ""):
        return True
    if re.fullmatch("h[1-6]|header|hgroup|p", tag):
        names = attrs.get("role", "") + " " + attrs.get("class", "")
        return bool(named_parts(names) & (NAMES - {"header", "hidden"}))
    return bool(named_parts(" ".join(attrs.get(x, "") for x in ("class", "id", "role"))) & NAMES)


class _Element(NamedTuple):
    tag: str
    boilerplate: bool
    holders: int  # which kinds of main element it is in, one bit each
    link: bool
    block: str


ROOT = _Element("", False, 0, False, "bare")
_SHOWN = BLOCKS | frozenset("a b em i img span strong".split())


def _holder(tag: str, attrs: dict[str, str]) -> int:
    """The kind of main element, as a bit: an article counts before a main element, and that before a role."""
    if tag in ("article", "main"):
        return 1 if tag == "article" else 2
    return 4 if attrs.get("role", "").lower() in MAIN_NAMES or attrs.get("itemprop", "").lower() == "articlebody" else 0


def _block_kind(tag: str, outer: str) -> str:
    if tag == "p":
        return "p"
    if re.fullmatch("h[1-6]", tag):
        return "heading"
    if tag in ("li", "dt", "dd", "td", "th"):
        return "item"
    return "div" if tag in BLOCKS else outer


def _parsed(page: str) -> Iterator[tuple[str, str | None, _Element, int]]:
    """(tag or "", text, element, block) in order.  Elements that aren't closed end with the one around them."""
    stack, block, at = [ROOT], 0, 0
    while at < len(page):
        found = _TAG.search(page, at)
        stop = found.start() if found else len(page)
        if stop > at:
            text = page[at:stop]
            if not found:  # a tag that the page's end cuts off isn't text
                text = re.sub(r"<[A-Za-z/!][^<>]*$", "", text)
            yield "", html.unescape(text), stack[-1], block
        if not found:
            break
        at, tag = found.end(), (found.group(2) or "").lower()
        if not tag:
            continue
        block += tag in BLOCKS
        if tag == "br":
            yield "br", " ", stack[-1], block
        elif found.group(1):
            place = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), None)
            yield tag, None, stack[place or -1], block
            if place:
                del stack[place:]
        else:
            _close(stack, tag)
            outer = stack[-1]
            attrs = attributes(found.group(3)) if found.group(3).strip(" /") else {}
            here = _Element(
                tag,
                outer.boilerplate or is_boilerplate(tag, attrs, bool(outer.holders)),
                outer.holders | _holder(tag, attrs),
                outer.link or tag == "a",
                _block_kind(tag, outer.block),
            )
            yield tag, None, here, block
            if tag in RAW:
                close = re.compile(rf"</{tag}\s*>|</{tag}$", re.I).search(page, at)
                stop = close.start() if close else len(page)
                yield "", page[at:stop], here, block
                at = close.end() if close else len(page)
                block += tag in BLOCKS
            elif tag not in VOID and len(stack) < DEEPEST:
                stack.append(here)


def runs(page: str) -> list[Run]:
    """Tags and texts of a page in order, by zone: in the page's main element, outside of it, on a page
    without one, or in boilerplate."""
    every = list(_parsed(page))
    seen = 0
    for _, _, here, _ in every:
        if not here.boilerplate:
            seen |= here.holders
    wanted = seen & -seen
    out = []
    for tag, text, here, block in every:
        main = bool(here.holders & wanted)
        zone = "boiler" if here.boilerplate else "main" if main else "outside" if wanted else "page"
        if tag == "br":
            kind = "br"
        elif tag:
            kind = f"{zone} <{tag if tag in _SHOWN else 'other'}>"
        else:
            kind = f"{zone} {here.block}{' link' if here.link else ''}"
        out.append(Run(kind, text, here.boilerplate, main, block))
    return out


#: Which open elements a new one ends, and which ones keep them from it.
_ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
}


def _close(stack: list[_Element], tag: str) -> None:
    """End what the start of ``tag`` ends: a paragraph before any block, an item before the next one."""
    for tags, within in ((("p",), BLOCKS - {"p"}), _ENDS.get(tag, ((), ()))):
        if tag in BLOCKS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in tags:
                    del stack[i:]
                    break
                if stack[i].tag in within:
                    break


#: Prior log-odds of content, by zone and by block; a link's words have one less.
ZONE_PRIOR = {"main": 2.0, "outside": -1.5, "page": 0.0, "boiler": -3.0}
BLOCK_PRIOR = {"p": 1.0, "heading": 1.0, "item": 0.2, "div": 0.3, "bare": 0.3}
TAG_PRIOR = {"main": -0.05, "outside": -1.0, "page": -0.2, "boiler": -0.5}


def prior(kind: str) -> float:
    zone, _, rest = kind.partition(" ")
    if rest.startswith("<"):
        return TAG_PRIOR[zone]
    return ZONE_PRIOR[zone] + BLOCK_PRIOR[rest.removesuffix(" link")] - (1.0 if rest.endswith("link") else 0.0)


def log_odds(inside: float, outside: float, kind: str) -> float:
    pull = math.exp(prior(kind) / 2)
    found = math.log((inside + pull) / (outside + 1 / pull))
    if "<" in kind:
        return max(-MOST, min(LEAST_TAG, found))
    return max(-MOST, min(MOST, found))


def class_counts(page: str) -> Counter:
    """Words and tags of a labelled page by (class, whether they are content).

    Each counts twice: as it is, and as on a page without a main element.
    """
    counts: Counter = Counter()
    for run in runs(page):
        n = 1 if run.text is None else len(run.text.split())
        if n and run.kind != "br":
            counts[run.kind, run.main] += n
            zone, _, rest = run.kind.partition(" ")
            if zone in ("main", "outside"):
                counts[f"page {rest}", run.main] += n
    return counts


def learn(pages: DataFrame, sample: int = SAMPLE) -> dict[str, float]:
    """Weights of all classes that occur, from at most ``sample`` different pages (page_id, url) with a main element.

    The pages are those with the smallest hashes; where there are none, the prior is all there is.
    """
    code = F.xxhash64("page_id", "url")
    marked = pages.where(F.col("html").rlike(r"(?i)<(?:article|main)[\s>]"))
    least = marked.select(code.alias("code")).distinct().orderBy("code").limit(sample).agg(F.max("code")).first()[0]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch["html"]:
                total.update(class_counts(page.as_py()))
        kinds, inside, ns = [k for k, _ in total], [m for _, m in total], list(total.values())
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(inside, pa.bool_()), pa.array(ns, pa.int64())], names=["kind", "inside", "n"])

    if least is None:
        return {}
    with small_batches(pages.sparkSession):
        counted = marked.where(code <= least).select("html").mapInArrow(count, "kind string, inside boolean, n long")
        rows = counted.groupBy("kind").pivot("inside", [True, False]).agg(F.sum("n")).collect()  # one for each class
    return {r["kind"]: log_odds(r["true"] or 0, r["false"] or 0, r["kind"]) for r in rows}


def best_region(page: list[Run], weights: dict[str, float]) -> tuple[int, int]:
    """[start, stop) of the contiguous runs with the largest sum, the first of equal ones; empty if none is positive.

    Boilerplate inside the main element is passed over: it leaves the text, but doesn't part it.
    """
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for i, run in enumerate(page):
        n = 1 if run.text is None else len(run.text.split())
        if run.kind == "br" or not n or (run.boilerplate and run.main):
            continue
        if total <= 0:
            total, start = 0.0, i
        weight = weights.get(run.kind)
        total += n * (log_odds(0, 0, run.kind) if weight is None else weight)
        if total > best:
            best, region = total, (start, i + 1)
    return region


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The text of a page's best region: white space is one space, blocks are joined by one space."""
    every = runs(page or "")
    start, stop = best_region(every, weights)
    parts, block = [], None
    for run in every[start:stop]:
        if run.text is not None and not run.boilerplate:
            if run.block != block:
                parts.append(" ")
            parts.append(run.text)
            block = run.block
    return " ".join("".join(parts).split())


def extract_main_text(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """page_id, url, text and n_chars of each row of ``pages`` (page_id, url, html).

    A null page, and one without a positive region, has an empty text.  Markup that isn't closed ends with the
    element around it, a tag cut off at the end of the page isn't text.  Equal pages have equal texts; an empty table gives
    none.  Whole pages are read, one at a time.
    """
    weights = learn(pages, sample)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), weights) for page in batch["html"]]
            columns = [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return pages.select("page_id", "url", "html").mapInArrow(extract, schema)
