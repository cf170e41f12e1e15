"""Main text of web pages by tag-path ratios.

A page is cut into blocks (what stands between block-level tags); a block's path is the names of the block-level
elements around it, from the root. Per path, text length and punctuation per block are its ratios: articles
have long, punctuated blocks on few paths, menus and notices short ones on others. Both ratios are smoothed
over neighbouring blocks, fused to one score, and paths below a share of the best score are left out; so a
short paragraph stays by the company it keeps. Paths through elements whose class, id or role names something else
(a sidebar, comments, an advert) have their score lowered: such a path loses against an article, but on a page
where all text lies below such an element, it is the best there is. Elements that HTML itself has for
menus, footers, forms, scripts and the like are no text from the start.

A path is a node of a trie that grows with the open elements, so a page costs its length, however deep it nests.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

#: Elements whose content is never main text; those in RAW hold no markup.
RAW = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes"}
DROPPED = {
    "head", "nav", "footer", "aside", "form", "noscript", "template", "object", "embed", "svg", "canvas", "button",
    "select", "option", "label", "fieldset", "dialog", "menu", "audio", "video", "map", "applet",
} | RAW
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
    "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
    "tt", "u", "var", "wbr", "img", "nobr",
}
VOID = {"area", "base", "br", "col", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr", "frame"}
#: Start tags that end an open element of these names.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "body": {"head"},
}
#: Words in class, id or role that name what is not main text. They weigh, and decide nothing by themselves.
HINTS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
    "promotion", "banner", "sidebar", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "footer",
    "header", "masthead", "comment", "comments", "disqus", "respond", "reply", "replies", "cookie", "cookies",
    "consent", "gdpr", "notice", "popup", "modal", "overlay", "newsletter", "subscribe", "signup", "login", "share",
    "sharing", "social", "related", "recommended", "widget", "toolbar", "pagination", "pager", "copyright",
    "disclaimer", "contentinfo", "complementary", "search", "skip", "alert", "hidden",
}

#: Words that say in which way or where another one is: they name nothing by themselves.
PLAIN = {
    "area", "bar", "block", "bottom", "box", "button", "buttons", "container", "content", "div", "global", "group",
    "inner", "item", "items", "left", "links", "list", "main", "outer", "page", "panel", "primary", "reader", "right",
    "section", "site", "text", "top", "user", "wrap", "wrapper",
}
#: A class that begins with one of these tells what an element has or is not.
OF_OTHERS = {"with", "without", "no", "has", "not", "is"}
#: Scores are multiplied by these if a class consists of words that name something else, or holds such a word among others.
NAMED, TOUCHED = 0.05, 0.6

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)"
    r"|</?[!?a-zA-Z/][^>]*+(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：]")
SPACE = re.compile(r"\s+")

#: Share of the best path's score that a path needs, and weights of the neighbours in smoothing.
SHARE = 0.25
KERNEL = (1.0, 0.6, 0.14)


class Block:
    __slots__ = ("link", "path", "text")

    def __init__(self, path: Path, text: str, link: int):
        self.path, self.text, self.link = path, text, link


class Path:
    """A node of the trie of paths: what is above it is in what it inherits."""

    __slots__ = ("below", "marked", "weight")

    def __init__(self, marked: bool = False, weight: float = 1.0):
        self.below: dict[tuple[str, float], Path] = {}
        self.marked, self.weight = marked, weight

    def child(self, name: str, weight: float) -> Path:
        key = (name, weight)
        if key not in self.below:
            self.below[key] = Path(self.marked or name in ("article", "main"), min(self.weight, weight))
        return self.below[key]


def blocks(page: str) -> list[Block]:
    """Blocks of text in page order, without those in elements that are no text from the start."""
    out: list[Block] = []
    # Open elements: name, whether left out, path.
    stack: list[tuple[str, bool, Path]] = [("", False, Path())]
    open_: Counter[str] = Counter()
    pieces: list[str] = []
    link = 0

    def flush() -> None:
        nonlocal link
        text = SPACE.sub(" ", "".join(pieces)).strip()
        if text:
            out.append(Block(stack[-1][2], text, link))
        pieces.clear()
        link = 0

    def pop_to(names: set[str], stop: set[str] = frozenset()) -> None:
        if not any(open_[x] for x in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                open_.subtract(x[0] for x in stack[k:])
                del stack[k:]
                return
            if stack[k][0] in stop:
                return

    def say(text: str) -> None:
        nonlocal link
        if text and not stack[-1][1]:
            text = unescape(text) if "&" in text else text
            pieces.append(text)
            if open_["a"]:
                link += len(text.strip())

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        ending = m["end"] or m["end2"]
        if name == "br":
            say(" ")
            continue
        if name not in INLINE:
            flush()
        if ending:
            pop_to({name})
            continue
        if name not in INLINE:
            # A block ends the paragraph that it begins in, whatever inline elements are open there.
            pop_to({"p"}, {"td", "th", "li", "article", "section", "div", "body", "blockquote", "button", "object"})
            if name in ENDS:
                pop_to(ENDS[name], {"ul", "ol", "dl", "table", "article", "select"} - ENDS[name])
        attrs = m["attrs"] or m["attrs2"] or ""
        _, left_out, path = stack[-1]
        inside = path.marked or name in ("article", "main")
        hidden, weight = hints(name, attrs, inside) if attrs.strip() else (False, 1.0)
        left_out = left_out or name in DROPPED or hidden or (name == "header" and not inside)
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            at = close.start() if close else n
        if name not in VOID and not attrs.rstrip().endswith("/"):
            # Inline elements are no part of the path, but what they are called still tells.
            path = path if name in INLINE and weight == 1.0 else path.child("" if name in INLINE else name, weight)
            stack.append((name, left_out, path))
            open_[name] += 1
    flush()
    return out


def hints(name: str, attrs: str, inside: bool) -> tuple[bool, float]:
    """Whether an element is not shown, and the weight that its class, id and role give to its text."""
    if name in ("html", "body", "article", "main"):
        return False, 1.0
    weight = 1.0
    named = HINTS - {"header"} if inside else HINTS
    for key, *values in ATTRIBUTE.findall(attrs):
        key, value = key.lower(), "".join(values)
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True, 1.0
        if key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True, 1.0
            continue
        for word in value.split():
            parts = [w.lower() for w in PARTS.findall(word)]
            if not parts or parts[0] in OF_OTHERS or not named.intersection(parts):
                continue
            weight = min(weight, NAMED if named.union(PLAIN).issuperset(parts) else TOUCHED)
    return False, weight


def selected(found: list[Block], share: float = SHARE) -> list[Block]:
    """The blocks on paths whose smoothed, fused ratios reach a share of the best."""
    if not found:
        return []
    total: dict[Path, list[float]] = {}
    for b in found:
        t = total.setdefault(b.path, [0, 0, 0, 0])
        t[0] += 1
        t[1] += len(b.text)
        t[2] += len(PUNCTUATION.findall(b.text))
        t[3] += b.link
    lengths = _smooth([total[b.path][1] / total[b.path][0] for b in found])
    marks = _smooth([total[b.path][2] / total[b.path][0] for b in found])
    score: dict[Path, list[float]] = {}
    for b, length, mark in zip(found, lengths, marks, strict=True):
        linked = total[b.path][3] / max(1, total[b.path][1])
        fused = math.log1p(length) * (1 + math.log1p(mark)) * (1 - linked) * b.path.weight
        score.setdefault(b.path, []).append(fused * 2 if b.path.marked else fused)
    mean = {p: sum(x) / len(x) for p, x in score.items()}
    best = max(mean.values())
    kept = {p for p, x in mean.items() if x >= share * best and total[p][3] * 2 <= total[p][1]}
    # Where most main text stands in what is marked as an article, what stands outside does not belong to it.
    marked = {p for p in kept if p.marked}
    if 2 * sum(total[p][1] for p in marked) >= sum(total[p][1] for p in kept):
        kept = marked or kept
    return [b for b in found if b.path in kept]


def _smooth(x: list[float]) -> list[float]:
    out = []
    for i in range(len(x)):
        weights = values = 0.0
        for d, w in enumerate(KERNEL):
            for j in {i - d, i + d}:
                if 0 <= j < len(x):
                    weights += w
                    values += w * x[j]
        out.append(values / weights)
    return out


def main_text(page: str | None) -> str:
    """The blocks of the article, joined by two line feeds; empty if there is none."""
    return "\n\n".join(b.text for b in selected(blocks(page or "")))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    A null, empty or textless page has an empty text. Rows stay as they are, repeated ones and null ids too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    narrow = pages.select(pages["page_id"].cast("long"), pages["url"].cast("string"), pages["html"].cast("string"))
    return narrow.mapInArrow(run, "page_id long, url string, text string, n_chars long")
