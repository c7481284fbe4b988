"""Main text of web pages by tag-path ratios.

A page is cut into blocks; each block has the path of block-level tags (with classes) from
the root.  Per path, the text length, the punctuation and the length of link text are added
up and give two ratios per node, length and punctuation.  Both are smoothed over the blocks
in page order, so a heading between long paragraphs is not alone, and fused into one value.
Every outermost `article` or `main` is a container; without one it is the deepest path of
sectioning tags that holds nearly all of the fused mass.  Inside a container every path stays
that is not a list of links; without an explicit one, so do the paths of all other sections
whose mean is not below a share of the container's.
Paths through tags or class names that are surely page furniture have no mass at all.  A
class name that only holds such a word, as related-work does, makes an element doubtful: its
paths go if their mean, not smoothed, is below half of that of the rest of the page.
Scanning and adding up take time linear in the page, well formed or not.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

# Elements and class words.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend "
    "li main menu nav ol option p pre search section select summary table tbody td tfoot th "
    "thead title tr ul".split())
CLOSES_P = BLOCK - {"body", "caption", "head", "html", "legend", "option", "tbody", "td", "tfoot",
                    "th", "thead", "title", "tr"}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script style noscript template iframe svg textarea canvas object audio video math "
       "noembed noframes").split()
FURNITURE = frozenset("head title nav header footer aside form menu button select option dialog "
                      "search".split())
SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",),
        "td": ("table",), "th": ("table",), "option": ("select",)}
CLASS_WORDS = frozenset(
    "adverts advert advertisement advertising breadcrumb breadcrumbs byline comment comments "
    "commentlist consent cookie cookies disqus footer footnav gdpr masthead nav navbar navigation "
    "newsletter pagination respond sidebar skip sponsored subscribe".split())
#: Words that also stand in names of content; a name must consist of them and of the plain ones.
WEAK_WORDS = frozenset(
    "ad ads adv banner menu modal notice notices popup promo promos related reply replies share "
    "sharing social sponsor subscription toolbar widget widgets".split())
PLAIN_BEFORE = frozenset("bottom floating global left main mobile page post right site sticky "
                         "the top user".split())
PLAIN_AFTER = PLAIN_BEFORE | frozenset(
    "area articles aside bar block body box btn button buttons card cards column container content "
    "group holder icons inner item items left line link links list media news overlay panel posts "
    "right row section slot stories strip text title unit wrap wrapper".split())
#: Before or after a class word these tell of the layout, as in has-sidebar or no-sidebar.
LAYOUT = frozenset("has is layout no not with without".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SECTIONS = frozenset("html body center div section".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert "
                  "dialog".split())

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
UNQUOTED = re.compile(r"[^>\"']*")
COMMENT_END = re.compile(r"--!?>")
RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
SPACE = re.compile(r"\s+")
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？]")
LINK_LIST, SHARE, HOLDS, DOUBT = 0.75, 0.15, 0.8, 0.5
CONTENT, DOUBTFUL, SURE = 0, 1, 2


def names_furniture(name: str) -> int:
    """Whether a class or id says furniture for sure, perhaps, or not at all."""
    words = re.findall(r"[a-z0-9]+", name)
    told = CONTENT
    for i, word in enumerate(words):
        before, after = words[i - 1] if i else "", words[i + 1] if i + 1 < len(words) else ""
        if before in LAYOUT or after == "layout" or (
                before == "content" and after in ("wrap", "wrapper", "container")):
            continue
        if word in CLASS_WORDS:
            return SURE
        if word in WEAK_WORDS:
            if all(w in PLAIN_BEFORE for w in words[:i]) and all(
                    w in PLAIN_AFTER or w in WEAK_WORDS or w[0].isdigit() for w in words[i + 1:]):
                return SURE
            told = DOUBTFUL
    return told


def attributes(attrs: str) -> dict[str, str]:
    return {k.lower(): unescape(a or b or c) for k, a, b, c in ATTR.findall(attrs)}


def furniture_of(tag: str, attrs: str, found: dict[str, str]) -> int:
    if tag in FURNITURE:
        return SURE
    if not attrs or tag in ("html", "body", "main", "article"):
        return SURE if tag == "article" and "comment" in attrs.lower() else CONTENT
    names = f"{found.get('class', '')} {found.get('id', '')}"
    joined = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", names).lower()
    if (not {"header", "site-header", "page-header"}.isdisjoint(names.lower().split())
            or found.get("role", "").lower() in ROLES
            or found.get("aria-hidden", "").lower() == "true"
            or re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", attrs)
            or "display:none" in found.get("style", "").lower().replace(" ", "")):
        return SURE
    return max(map(names_furniture, joined.split()), default=CONTENT)


class Paths:
    """The tree of tag paths of a page; a parent's number is below those of its children."""

    def __init__(self):
        self.tag, self.parent, self.depth, self.furniture = [""], [0], [0], [CONTENT]
        self.numbers: dict[tuple[int, str, int], int] = {}

    def child(self, of: int, tag: str, label: str, furniture: int) -> int:
        furniture = max(furniture, self.furniture[of])
        n = self.numbers.setdefault((of, label, furniture), len(self.tag))
        if n == len(self.tag):
            self.tag.append(tag)
            self.parent.append(of)
            self.depth.append(self.depth[of] + 1)
            self.furniture.append(furniture)
        return n

    def inherit(self, own: list) -> list:
        """Each path's own value, or its parent's where that is None."""
        for n in range(1, len(own)):
            if own[n] is None:
                own[n] = own[self.parent[n]]
        return own

    def total(self, values: np.ndarray) -> np.ndarray:
        """Sums over each path and all below it."""
        out = values.astype(float).tolist()
        for n in range(len(out) - 1, 0, -1):
            out[self.parent[n]] += out[n]
        return np.array(out)


class Block:
    __slots__ = ("path", "text", "links")

    def __init__(self, path: int, text: str, links: int):
        self.path, self.text, self.links = path, text, links


def tokens_of(html: str) -> Iterator[tuple[str, bool, str, str]]:
    """(text before, whether an end tag, tag, attributes); comments and scripts have no tag.

    A `>` inside quotes does not end a tag, unless a quote stays open up to the end of the page:
    from there on quotes mean nothing.  What cannot be a tag is text.
    """
    at, look, quotes, last = 0, 0, True, html.rfind(">")
    while (start := html.find("<", look)) >= 0:
        if html.startswith("<!--", start):
            if html.startswith((">", "->"), start + 4):
                end = html.index(">", start) + 1
            else:
                m = COMMENT_END.search(html, start + 4)
                end = m.end() if m else len(html)
            yield html[at:start], False, "", ""
            at = look = end
            continue
        m = TAG.match(html, start)
        if start > last or not (m or html.startswith(("<!", "<?", "</"), start)):
            look = start + 1
            continue
        if not m:
            yield html[at:start], False, "", ""
            at = look = html.index(">", start) + 1
            continue
        end = UNQUOTED.match(html, m.end()).end() if quotes else html.find(">", m.end())
        while quotes and 0 <= end < len(html) and html[end] != ">":
            shut = html.find(html[end], end + 1)
            end = UNQUOTED.match(html, shut + 1).end() if shut >= 0 else len(html)
        if not 0 <= end < len(html):
            quotes, end = False, html.find(">", m.end())
        tag = m[2].lower()
        if not m[1] and tag in RAW_END:
            shut = RAW_END[tag].search(html, end + 1)
            yield html[at:start], False, "", ""
            at = look = shut.end() if shut else len(html)
            continue
        yield html[at:start], bool(m[1]), tag, html[m.end():end]
        at = look = end + 1
    # an unfinished tag at the very end is no text
    rest = html[at:]
    open_tag = re.compile(r"<[a-zA-Z/!]").search(rest, rest.rfind(">") + 1)
    yield rest[:open_tag.start()] if open_tag else rest, False, "", ""


def blocks_of(html: str) -> tuple[list[Block], Paths]:
    paths = Paths()
    stack: list[tuple[str, int]] = []  # tag, path
    opened: defaultdict[str, list[int]] = defaultdict(list)  # places in the stack
    found: list[Block] = []
    words: list[str] = []
    links, in_link = 0, False

    def close() -> None:
        nonlocal links, words
        text = SPACE.sub(" ", unescape("".join(words))).strip()
        if text:
            found.append(Block(stack[-1][1] if stack else 0, text, min(links, len(text))))
        words, links = [], 0

    def pop_to(tag: str, stops: tuple[str, ...] = ()) -> None:
        """Close the innermost such element, unless a stop stands inside it."""
        if opened[tag] and not any(opened[s] and opened[s][-1] > opened[tag][-1] for s in stops):
            close()
            for gone, _ in stack[(first := opened[tag][-1]):]:
                opened[gone].pop()
            del stack[first:]

    for part, ends, tag, attrs in tokens_of(html):
        if part:
            words.append(part)
            links += len(part) if in_link else 0
        if not tag:
            continue
        if ends:
            if tag == "a":
                in_link = False
            elif tag in BLOCK or opened[tag]:
                pop_to(tag)
                if tag == "p":
                    close()
        elif tag == "br":
            words.append(" ")
        elif tag in VOID:
            if tag == "hr":
                close()
        else:
            named = attributes(attrs) if attrs else {}
            furniture = furniture_of(tag, attrs, named)
            if tag == "a" and furniture != SURE:
                in_link = not attrs.rstrip().endswith("/")
            if tag not in BLOCK and furniture != SURE:
                continue
            if tag in CLOSES_P:
                pop_to("p", ("td", "th", "table", "button", "caption"))
            if tag in SAME:
                for other in (("dt", "dd") if tag in ("dt", "dd") else
                              ("td", "th") if tag in ("td", "th") else (tag,)):
                    pop_to(other, SAME[tag])
            elif tag[0] == "h" and tag[1:].isdigit():
                if stack and stack[-1][0] in HEADINGS:
                    pop_to(stack[-1][0])
            close()
            classes = ".".join(sorted(named.get("class", "").split()))
            above = stack[-1][1] if stack else 0
            opened[tag].append(len(stack))
            stack.append((tag, paths.child(above, tag, f"{tag}.{classes}", furniture)))
    close()
    return found, paths


def smooth(values: np.ndarray) -> np.ndarray:
    """A short bell over the blocks in page order."""
    if len(values) < 2:
        return values
    bell = np.exp(-0.5 * np.arange(-2, 3) ** 2)
    return (np.convolve(values, bell, "same")
            / np.convolve(np.ones(len(values)), bell, "same"))[:len(values)] \
        if len(values) >= 5 else (values + values.mean()) / 2


def content_blocks(html: str | None) -> list[str]:
    blocks, paths = blocks_of(html or "")
    blocks = [b for b in blocks if paths.furniture[b.path] != SURE]
    if not blocks:
        return []
    n = len(paths.tag)
    at = np.array([b.path for b in blocks])
    nodes = np.bincount(at, minlength=n)
    size, marks, linked = (np.bincount(at, each, n) for each in zip(*[
        (len(b.text), len(PUNCTUATION.findall(b.text)), b.links) for b in blocks]))
    each = np.maximum(nodes, 1)
    length, points = smooth((size / each)[at]), smooth((marks / each)[at])
    own = 1 - linked / np.maximum(size, 1)
    value = np.bincount(at, length * (1 + points), n) * own

    doubtful = np.array(paths.furniture) == DOUBTFUL
    if doubtful.any():
        # An outermost doubtful path, for each path at or below one; judged unsmoothed, so that
        # long paragraphs beside it do not help.
        plain = size * (1 + marks / each) * own
        outer = np.array(paths.inherit(
            [0] + [None if paths.furniture[paths.parent[k]] == DOUBTFUL else k if doubtful[k]
                   else 0 for k in range(1, n)]))
        held = np.bincount(outer, plain, n) / np.maximum(np.bincount(outer, nodes, n), 1)
        gone = (outer > 0) & (held[outer] < DOUBT * held[0])
        value, nodes = np.where(gone, 0.0, value), np.where(gone, 0, nodes)
    below = paths.total(value)
    named = [tag in ("article", "main") and below[k] > 0 for k, tag in enumerate(paths.tag)]
    if any(named):
        inside = np.array(paths.inherit([False] + [x or None for x in named[1:]]), bool)
    else:
        inside = main_sections(paths, value, nodes, below)
    # Headings may be links, and so may one paragraph; two or more such nodes are a list.
    heading = np.array([tag in HEADINGS for tag in paths.tag])
    keep = inside & (nodes > 0) & (heading | (nodes < 2) | (linked < LINK_LIST * size))
    return [b.text for b in blocks if keep[b.path]]


def main_sections(paths: Paths, value: np.ndarray, nodes: np.ndarray,
                  below: np.ndarray) -> np.ndarray:
    """Which paths belong to the container, or to a section as rich, on a page without article."""
    n = len(value)
    section = np.array(paths.inherit(
        [0] + [k if paths.tag[k] in SECTIONS else None for k in range(1, n)]))
    home = max((k for k in range(n) if below[k] >= HOLDS * below[0] and section[k] == k),
               key=paths.depth.__getitem__)
    inside = section == home
    if paths.tag[home] not in ("", "html", "body"):
        under = [False] * (home + 1) + [None] * (n - home - 1)
        under[home] = True
        inside |= np.array(paths.inherit(under), bool)
    group = np.where(inside, home, section)
    held, count = np.bincount(group, value, n), np.bincount(group, nodes, n)
    mean = value.sum() / max(nodes.sum(), 1)
    if count[home]:
        mean = min(mean, held[home] / count[home])
    return inside | ((held >= SHARE * mean * count) & (count > 0))[section]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Defined cases: null or empty html, and pages with furniture only, give an empty text;
    null ids and urls stay null; repeated rows give repeated rows; other columns are
    ignored.  The whole page is read and nothing is cut off.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            text = ["\n\n".join(content_blocks(h)) for h in batch["h"]]
            yield pd.DataFrame({"page_id": batch["i"].astype("Int64"), "url": batch["u"],
                                "text": text, "n_chars": [len(t) for t in text]})

    return pages.select(F.col(id_col).cast("long").alias("i"), F.col(url_col).alias("u"),
                        F.col(html_col).alias("h")) \
        .mapInPandas(run, "page_id long, url string, text string, n_chars long")
