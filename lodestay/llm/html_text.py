"""Main text of HTML pages: the contiguous region of the highest score, words counting for it and tags against."""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestay.llm.common import map_slices

SCHEMA = "page_id long, url string, text string, n_chars long"

#: Fixed values of HTML: elements that end a line of text, without an end tag, and with raw content.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are never part of an article, by name, by a word of class or id, and by role. Those of NEVER show no
#: text of their own; the others may wrap an article.
NEVER = frozenset("head title button select textarea noscript template iframe object svg canvas audio video".split())
OUTSIDE = frozenset(
    "nav header footer aside form head title button select textarea noscript template iframe object svg canvas "
    "audio video dialog menu".split())
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
    "menu breadcrumb breadcrumbs pagination pager footer header masthead sidebar widget widgets related recommended "
    "comment comments commentlist respond reply replies discussion disqus cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login share sharing social toolbar "
    "skip copyright disclaimer".split())
OUTSIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(?P<raw>script|style|xmp|noembed|noframes)\b(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+>(?P<content>.*?)(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z][^>]*>", re.S | re.I)
_DECLARATION = re.compile("<[!?]")
_ATTRIBUTE = re.compile(r"([a-zA-Z_:@][\w:.-]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

#: Containers whose content is labelled text, where a page has exactly one.
LABEL = ("article", "main")


def outside(name: str, attributes: str) -> str:
    """What speaks against an element being part of an article, or an empty text.

    ``never``: it shows no text, or is hidden. ``named``: it is by name or role
    one that no article consists of. ``worded``: it is a form, or a word of its
    class or id says so; such words may also tell what a page's wrapper has.
    """
    if name in NEVER:
        return "never"
    if name in OUTSIDE:
        return "worded" if name == "form" else "named"
    if not attributes.strip() or name in ("html", "body"):
        return ""
    found = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
    if "hidden" in found or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
        return "never"
    role = found.get("role", "").lower()
    if role in OUTSIDE_ROLES and role != "form":
        return "named"
    names = f"{found.get('class', '')} {found.get('id', '')}"
    return "worded" if role == "form" or any(p.lower() in OUTSIDE_WORDS for p in _PARTS.findall(names)) else ""


@dataclass
class Run:
    """A tag, or the text between two tags."""

    kind: str  # t:<name>, t:/<name>, or w:text, w:link, w:outside
    words: int = 0
    text: str = ""
    breaks: bool = False  # ends the block
    labelled: bool = False


@dataclass
class Element:
    """One that may be outside, or an ``article`` or ``main``: what ``outside`` says, and its bounds in runs."""

    name: str
    says: str
    start: int
    end: int = 0
    in_article: bool = False


def hide(out: list[Run], elements: list[Element]) -> None:
    """Turns the words of elements that are outside into ``w:outside``.

    One that wraps an ``article`` or ``main`` is not outside, unless it is
    itself in an article or never shows text; nor is, on a page without
    these, a ``worded`` one that holds most of the words that are no links.
    An ``article`` that its own class or id marks, as that of a comment does,
    only counts where there is no other.
    """
    def cover(which: list[Element]) -> list[int]:
        steps = [0] * (len(out) + 1)
        for e in which:
            steps[e.start] += 1
            steps[e.end] -= 1
        return list(accumulate(steps))

    off = [e for e in elements if e.says and e.name not in LABEL]
    if not off:
        return
    never = cover([e for e in off if e.says == "never"])
    labels = [e for e in elements if e.name in LABEL and not never[e.start]]
    labels = [e for e in labels if e.name == "main" or not e.says] or labels
    starts = [e.start for e in labels]  # ascending, as elements are in page order
    words = [0, *accumulate(0 if never[i] or r.kind != "w:text" else r.words for i, r in enumerate(out))]

    def wraps(e: Element) -> bool:
        if labels:
            return not e.in_article and bisect_right(starts, e.start) < bisect_left(starts, e.end)
        return e.says == "worded" and 2 * (words[e.end] - words[e.start]) > words[-1]

    for run, hidden in zip(out, cover([e for e in off if e.says == "never" or not wraps(e)])):
        if hidden and run.kind[0] == "w":
            run.kind = "w:outside"


def runs_of(page: str) -> list[Run]:
    """The page in order. Elements are closed as far as tags tell; what is never closed ends with the page."""
    return parsed(page)[0]


def _open_ended(m: re.Match) -> bool:
    """Whether a comment, script or style was ended by the page alone."""
    if m["raw"]:
        return m.end("content") == m.end()
    return m[0].startswith("<!--") and not (m[0].endswith("-->") and len(m[0]) >= 7)


def parsed(page: str) -> tuple[list[Run], list[Element]]:
    """The runs of ``runs_of``, and the elements that decide what of them is outside."""
    out: list[Run] = []
    elements: list[Element] = []
    stack: list[tuple[str, Element | None]] = []
    held: Counter = Counter()  # open elements by name, so that an end tag without one searches nothing
    blocks: list[int] = []  # places of open blocks in the stack
    links = labels = articles = at = 0

    def text(upto: int) -> None:
        if upto > at:
            value = html.unescape(page[at:upto])
            kind = "w:link" if links else "w:text"
            out.append(Run(kind, len(value.split()), value, labelled=labels > 0))

    def pop_to(k: int) -> None:
        nonlocal links, labels, articles
        for name, element in stack[k:]:
            if element:
                element.end = len(out)
            held[name] -= 1
            links -= name == "a"
            labels -= name in LABEL
            articles -= name == "article"
        del stack[k:]
        while blocks and blocks[-1] >= k:
            blocks.pop()

    end = page.rfind(">") + 1  # no tag ends behind it, and none is looked for there
    unclosed = False
    for m in _TOKEN.finditer(page, 0, end):
        text(m.start())
        at = m.end()
        name = m["name"]
        if not name:  # a comment, a declaration, a script, a style, or a broken tag
            unclosed = at == end and _open_ended(m)
            continue
        name = name.lower()
        block = name in BLOCKS
        if m["end"]:
            out.append(Run("t:/" + name, breaks=block, labelled=labels > 0))
            if held[name]:  # what is searched is closed, so all searches together are as long as the page
                pop_to(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name))
            continue
        if name == "br":
            out.append(Run("t:br", text="\n", labelled=labels > 0))
            continue
        if block and blocks:  # a block ends a paragraph, an item an item, if that is the innermost open block
            inner = stack[blocks[-1]][0]
            if inner == "p" or name == inner == "li":
                pop_to(blocks[-1])
        out.append(Run("t:" + name, breaks=block, labelled=labels > 0))
        if name not in VOID and not m["attributes"].endswith("/"):
            says = outside(name, m["attributes"])
            element = Element(name, says, len(out), in_article=articles > 0) if says or name in LABEL else None
            if element:
                elements.append(element)
            if block:
                blocks.append(len(stack))
            stack.append((name, element))
            held[name] += 1
            links += name == "a"
            labels += name in LABEL
            articles += name == "article"
    if not unclosed:  # the rest is text, up to a comment or declaration that nothing closes
        rest = _DECLARATION.search(page, end)
        text(rest.start() if rest else len(page))
    pop_to(0)
    hide(out, elements)
    return out, elements


@dataclass(frozen=True)
class Weights:
    """Score of a word by where it stands, and of each tag."""

    words: dict[str, float] = field(default_factory=lambda: {"w:text": 1.0, "w:link": -0.2, "w:outside": -1.0})
    tags: dict[str, float] = field(default_factory=dict)
    other_tag: float = -1.0

    def of(self, run: Run) -> float:
        if run.kind[0] == "w":
            return self.words[run.kind] * run.words
        return self.tags.get(run.kind, self.other_tag)


def best_region(scores: list[float]) -> tuple[int, int]:
    """Bounds of the contiguous part with the highest sum, the first of equal ones; (0, 0) if none is positive."""
    best = total = 0.0
    start, found = 0, (0, 0)
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, found = total, (start, i + 1)
    return found


def whole_region(runs: list[Run], elements: list[Element], a: int, b: int) -> tuple[int, int]:
    """The region ``runs[a:b]`` with all of the blocks at its ends.

    Where the page has one ``article``, or without any one ``main``, and the
    region lies in it in part, all of that element is in the region too.
    """
    if a == b:
        return a, b
    for name in LABEL:
        found = [e for e in elements if e.name == name]
        if len(found) == 1 and found[0].start < b and a < found[0].end:
            a, b = min(a, found[0].start), max(b, found[0].end)
        if found:
            break
    while a and not runs[a].breaks and not runs[a - 1].breaks:
        a -= 1
    while b < len(runs) and not runs[b - 1].breaks and not runs[b].breaks:
        b += 1
    return a, b


def main_text(page: str | None, weights: Weights) -> str:
    """Whole blocks of the best region, in page order, with two line ends between them."""
    runs, elements = parsed(page or "")
    a, b = whole_region(runs, elements, *best_region([weights.of(r) for r in runs]))
    blocks: list[str] = []
    now: list[str] = []
    for run in runs[a:b]:
        if run.breaks:
            blocks.append("".join(now))
            now = []
        elif run.kind != "w:outside":
            now.append(run.text)
    blocks.append("".join(now))
    return "\n\n".join(x for x in (" ".join(b.split()) for b in blocks) if x)


def learn_weights(
    pages: DataFrame, sample: int = 5000, page_id: str = "page_id", page: str = "html", max_kinds: int = 10_000,
) -> Weights:
    """Weights from labelled pages, those with just one ``article`` or ``main`` element.

    A kind of word or tag weighs the logarithm of how much more frequent it is
    inside than outside. Words of text are kept positive, tags negative. About
    ``sample`` pages, chosen by hash of the id, are learned from; the counts
    that reach the driver are one for each kind, for the ``max_kinds`` most
    frequent kinds; rarer tags weigh ``other_tag``. Without labelled pages the
    defaults of ``Weights`` hold.
    """
    rows = pages.select(F.xxhash64(F.col(page_id)).alias("h"), F.col(page).cast("string").alias("html"))
    rows = rows.where(F.lower("html").rlike("<(article|main)[\\s>]"))
    n = rows.count()
    rows = rows.where(F.pmod("h", F.lit(1 << 30)) < min(1.0, sample / max(n, 1)) * (1 << 30)).select("html")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        sums: Counter = Counter()
        for p in batch.column("html").to_pylist():
            if len(re.findall(r"<(?:article|main)[\s>]", p, re.I)) != 1:
                continue
            for run in runs_of(p):
                sums[run.kind, run.labelled] += run.words if run.kind[0] == "w" else 1
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in sums], pa.string()), pa.array([i for _, i in sums], pa.bool_()),
             pa.array(list(sums.values()), pa.int64())], ["kind", "inside", "n"])

    counted = map_slices(rows, "html", "kind string, inside boolean, n long", count)
    found = counted.groupBy("kind", "inside").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "kind", "inside").limit(max_kinds).collect()
    if not found:
        return Weights()
    inside = {r.kind: r.n for r in found if r.inside}
    beside = {r.kind: r.n for r in found if not r.inside}
    n_in, n_out = sum(inside.values()) + 1, sum(beside.values()) + 1

    def odds(kind: str) -> float:
        return math.log((inside.get(kind, 0) + 0.5) / n_in) - math.log((beside.get(kind, 0) + 0.5) / n_out)

    tags = {k: min(-0.1, odds(k)) for k in {*inside, *beside} if k[0] == "t"}
    link = odds("w:link") if "w:link" in inside or "w:link" in beside else -0.2
    words = {"w:text": max(0.5, odds("w:text")), "w:link": link, "w:outside": min(-0.5, odds("w:outside"))}
    return Weights(words, tags, min([-1.0, *tags.values()]) / 2)


def extract_text(
    pages: DataFrame, weights: Weights, page_id: str = "page_id", url: str = "url", page: str = "html",
) -> DataFrame:
    """One row per page with its main text and the text's length in code points.

    A null or empty page and one without words of text give an empty text.
    Reading takes time in proportion to the page, also of long and broken ones.
    Repeated rows are treated each; other columns are not read.
    """
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [main_text(p, weights) for p in batch.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()),
             pa.array(list(map(len, found)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.col(page).cast("string").alias("html"))
    return map_slices(rows, "html", SCHEMA, work)
