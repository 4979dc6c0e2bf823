"""Main text of web pages by tag-path ratios.

A page is cut into blocks (text between block-level tags), each with its
root-to-leaf path of tags.  Scripts, menus, hidden elements and the like never
hold text.  Other elements are barred by their tag (forms, sidebars, footers,
...) or because a class or id names them so: a name is read as a whole, its last
word or its first one with a word for a holder after it (``comment-list``,
``leftRail``), so ``comments-open`` or ``social-policy-article`` bar nothing,
and paragraphs and headings of an article are never barred by a name.  A bar is
lifted from an element that holds most of the page's text and its ``main`` or
``h1``, or, barred by its tag alone, its article; a form that holds most of the
text of a page without any other article is lifted too.  For every path of the page the remaining
text length, punctuation and link text are added up; the ratios per node are
smoothed along the path (each ancestor's subtree counts half as much as the
step below it) and fused into one score.  A heading has the score of the best
path beside it; a path inside ``article`` or ``main`` has at least that of the
whole element, so its short list items stay with its paragraphs.  Paths below
``share`` of the page's level are dropped, but inside an article only if most
of their text is links; where the page marks an article, a path outside must
beat it.  The level is the median score of the text outside links, at most
that of ordinary paragraphs, so a few huge blocks outvote nothing.  What is left
is the text, in page order.

Pages are independent rows, so nothing is shuffled.

Defined results: null, empty or tag-only pages give an empty text; a page
without markup is one block; unclosed elements end with the page, an unclosed
comment, script or style runs to its end; character references are decoded
once; white space inside a block is one space, blocks are trimmed and joined by
a line break; extra columns are ignored and repeated rows treated alike.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of HTML elements by their kind.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre search section "
    "select summary table tbody td tfoot th thead tr ul".split())
NEVER = frozenset(
    "audio button canvas datalist embed head iframe input map nav noframes noscript object option script search select "
    "style svg template textarea title video".split())
SELDOM = frozenset("aside dialog fieldset footer form menu".split())
ENDS_P = BLOCK - frozenset("body html head".split())
SAME_LEVEL = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"},
              "option": {"option"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEVER_WORDS = frozenset(
    "ad ads adv advert advertisement advertising adbox adslot banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies copyright discussion disqus footer gdpr login masthead menu modal nav navbar navigation "
    "newsletter notice notices pagination popup promo promoted promotion rail recommended related replies reply respond "
    "responses share sharing sidebar signup skyscraper social sponsor sponsored subscribe toolbar widget".split())
# what may follow such a word in a name that still names the thing; others tell a state or something else
HOLDERS = frozenset(
    "area articles author bar block body bottom box button buttons col column container content embed form group header "
    "heading holder icons inner item items left link links list main meta news outer panel posts primary right row secondary "
    "section slot stories text this thread title top trail unit wrap wrapper zone".split())
STATES = frozenset("has have hide is js no not show with without".split())
TEXT_TAGS = HEADINGS | frozenset("blockquote dd dt figcaption li p pre td th".split())
NEVER_ROLES = frozenset("banner complementary contentinfo dialog alert alertdialog form menu menubar navigation search".split())
DEPTH = 96  # open elements that make up a path; deeper ones share it
ORDINARY = (1, 400, 4)  # nodes, text and punctuation of an ordinary paragraph
PUNCTUATION = re.compile(r"[.,;:!?…、。，！？；：।؟،]")

_TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+)>|<(/?)([a-zA-Z][^\s/<>]*)([^<>]*)>", re.S)
_ATTR = re.compile(r"""(?:^|[\s/"'])(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|$)""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACE = re.compile(r"\s+")


def _names_other(value: str) -> bool:
    """Whether a class or id value names something that is no article."""
    for name in value.split():
        words = [w.lower() for w in _WORD.findall(name)]
        if not words or words[0] in STATES:
            continue
        if words[-1] in NEVER_WORDS or words[0] in NEVER_WORDS and all(w in HOLDERS for w in words[1:]):
            return True
    return False


def _bar(tag: str, attrs: str, in_article: bool) -> str:
    """``never``: no content; ``tag`` or ``name``: barred unless lifted; empty: content."""
    if tag in NEVER:
        return "never"
    seldom = "tag" if tag in SELDOM or (tag == "header" and not in_article) else ""
    for name, value in _ATTR.findall(attrs) if attrs else ():
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return "never"
        if name == "role" and value.lower() in NEVER_ROLES:
            seldom = "name"
        if name in ("class", "id") and tag not in ("html", "body", "main") and not (in_article and tag in TEXT_TAGS):
            if _names_other(value):
                seldom = "name"
    return seldom


class _Bar:
    """A barred element: why, the text it holds, and whether main, h1 or an article lie in it."""

    def __init__(self, why: str, tag: str):
        self.why, self.tag, self.weight, self.main, self.article = why, tag, 0, False, False


def blocks(page: str) -> list[tuple[tuple[str, ...], str, int]]:
    """``(path, text, link length)`` of each block that may be content."""
    found = list(_blocks(page))
    total = 0
    for _, text, link, bars in found:
        total += len(text) - link
        for b in bars:
            b.weight += len(text) - link
    free = any(_article_depth(path) for path, _, _, bars in found if not bars)

    def lifted(b: _Bar) -> bool:
        return 2 * b.weight > total and (b.main or b.why == "tag" and (b.article or b.tag in ("form", "fieldset") and not free))

    return [x[:3] for x in found if all(lifted(b) for b in x[3])]


def _blocks(page: str) -> Iterator[tuple[tuple[str, ...], str, int, tuple[_Bar, ...]]]:
    """Every block outside what never holds content, with the bars it lies in."""
    stack: list[tuple[str, bool | _Bar]] = []  # open elements; True: never content
    barred = articles = links = 0
    bars: tuple[_Bar, ...] = ()
    within: tuple[_Bar, ...] = ()
    parts: list[str] = []
    link_chars = 0
    path: tuple[str, ...] = ()

    def flush():
        nonlocal parts, link_chars
        text = _SPACE.sub(" ", "".join(parts)).strip()
        out = (path, text, min(link_chars, len(text)), within) if text else None
        parts, link_chars = [], 0
        return out

    def pop_to(depth: int):
        nonlocal barred, articles, links, bars
        while len(stack) > depth:
            tag, bar = stack.pop()
            if bar is True:
                barred -= 1
            elif bar:
                bars = bars[:-1]
            articles -= tag in ("article", "main")
            links -= tag == "a"

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        text = page[at: m.start() if m else n]
        if text and not barred:
            text = html.unescape(text)
            if not parts:
                within = bars
                path = tuple(t for t, _ in islice(stack, DEPTH) if t in BLOCK)
            parts.append(text)
            if links:
                link_chars += len(text.strip())
        if not m:
            break
        at = m.end()
        tag = m.group(2) or m.group(5)
        if tag is None:  # comment, doctype
            continue
        tag, closing, attrs = tag.lower(), m.group(1) or m.group(4), m.group(3) or m.group(6) or ""
        if tag == "br":
            parts and parts.append(" ")
            continue
        if tag in BLOCK and (done := flush()):
            yield done
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    pop_to(i)
                    break
                if tag not in BLOCK and stack[i][0] in BLOCK:
                    break  # a stray inline end tag closes no block
            continue
        if tag in ENDS_P or tag in SAME_LEVEL:
            same = SAME_LEVEL.get(tag, set()) | ({"p"} if tag in ENDS_P else set())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in same:
                    pop_to(i)
                    break
                if stack[i][0] in BLOCK:
                    break
        if tag in VOID or attrs.endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:  # its content is no markup and no article
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        why = _bar(tag, attrs, articles > 0)
        for b in bars:
            b.main |= tag in ("main", "h1")
            b.article |= tag == "article" and not why
        bar = why == "never"
        if why and not bar and not barred:
            bar = _Bar(why, tag)
            bars += (bar,)
        stack.append((tag, bar))
        barred += bar is True
        articles += tag in ("article", "main")
        links += tag == "a"
    if done := flush():
        yield done


def _fused(nodes: float, length: float, marks: float) -> float:
    """Text per node, weighted by punctuation per node."""
    return length / nodes * math.log1p(1 + marks / nodes)


def path_scores(found: list[tuple[tuple[str, ...], str, int]], decay: float) -> dict[tuple[str, ...], float]:
    """The fused, smoothed ratio of each path."""
    leaves: dict[tuple[str, ...], list[float]] = {}  # nodes, text, punctuation, link text
    for path, text, link in found:
        s = leaves.setdefault(path, [0, 0, 0, 0])
        for k, v in enumerate((1, len(text), len(PUNCTUATION.findall(text)), link)):
            s[k] += v
    sums: dict[tuple[str, ...], list[float]] = {}  # the same of each subtree
    for path, own in leaves.items():
        for depth in range(len(path) + 1):
            s = sums.setdefault(path[:depth], [0, 0, 0, 0])
            for k, v in enumerate(own):
                s[k] += v
    out = {}
    for path, own in leaves.items():
        # html and body say nothing: every path has them
        low = next((i for i, t in enumerate(path) if t not in ("html", "body")), len(path) - 1)
        weight = length = marks = 0.0
        for step, depth in enumerate(range(len(path), low, -1)):
            s, w = own if not step else sums[path[:depth]], decay ** step
            weight, length, marks = weight + w, length + w * s[1] / s[0], marks + w * s[2] / s[0]
        score = _fused(weight, length, marks) if weight else _fused(*own[:3])
        score *= 1 - own[3] / own[1]
        inside = _article_depth(path)
        if inside:
            whole = sums[path[:inside]]
            score = max(score, _fused(*whole[:3]) * (1 - whole[3] / whole[1]))
        out[path] = score
    beside = {path[:-1]: 0.0 for path in out if path and path[-1] in HEADINGS}
    for path, score in out.items():
        for depth in range(len(path) + 1):
            if path[:depth] in beside:
                beside[path[:depth]] = max(beside[path[:depth]], score)
    return {path: beside[path[:-1]] if path and path[-1] in HEADINGS else score for path, score in out.items()}


def _article_depth(path: tuple[str, ...]) -> int:
    """Length of the path down to its outermost article element; 0 outside."""
    return next((i + 1 for i, t in enumerate(path) if t in ("article", "main")), 0)


def _linked(found: list[tuple[tuple[str, ...], str, int]]) -> set[tuple[str, ...]]:
    """Paths with more than half of their text in links."""
    excess: dict[tuple[str, ...], int] = {}
    for path, text, link in found:
        excess[path] = excess.get(path, 0) + 2 * link - len(text)
    return {p for p, x in excess.items() if x > 0}


def _level(found: list[tuple[tuple[str, ...], str, int]], scores: dict[tuple[str, ...], float]) -> float:
    """The score that half of the page's text outside links reaches, bounded by
    that of ordinary paragraphs."""
    weight: dict[tuple[str, ...], int] = {}
    for path, text, link in found:
        weight[path] = weight.get(path, 0) + len(text) - link
    left = sum(weight.values()) / 2
    for path in sorted(weight, key=scores.__getitem__):
        left -= weight[path]
        if left <= 0:
            return min(scores[path], _fused(*ORDINARY))
    return 0.0


def main_text(page: str | None, share: float = 0.05, decay: float = 0.5) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    scores = path_scores(found, decay)
    least = share * _level(found, scores)
    linked = _linked(found)
    article = max((v for p, v in scores.items() if _article_depth(p)), default=0)
    kept = {p for p, v in scores.items()
            if v > 0 and (v >= least or _article_depth(p) and p not in linked) and (_article_depth(p) or v > article)}
    return "\n".join(text for path, text, _ in found if path in kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            share: float = 0.05, decay: float = 0.5) -> DataFrame:
    """``page, url, text`` of every page."""
    src = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"),
                       F.col(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):  # small output batches for large pages
                part = batch.slice(i, 256)
                texts = [main_text(x.as_py(), share, decay) for x in part.column("html")]
                yield pa.RecordBatch.from_arrays([part.column("page"), part.column("url"), pa.array(texts, pa.string())],
                                                 ["page", "url", "text"])

    kinds = dict(src.dtypes)
    return src.mapInArrow(run, f"page {kinds['page']}, url {kinds['url']}, text string")
