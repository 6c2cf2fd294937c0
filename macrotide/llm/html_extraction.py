"""Main text of web pages by tag-path ratios.

Each text of a page has a path: the tags (with class and id words that say what an element is
for) from the root down to it. For each path of a page the mean text length and the mean number
of punctuation marks of its texts are taken; both rows of ratios are smoothed over neighbouring
texts with a Gaussian, multiplied, and averaged by path again. Paths that reach a share of
the deviation over the page are content. An ``article`` or ``main`` that holds a quarter of that content is taken whole and
for all of it, so that its short texts stay; one that does not, as a teaser of another page, is judged by its ratios alone. Menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts and styles never are. A
content path brings in headings, list items and other short texts of its container.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "page_id bigint, url string, text string, n_chars bigint"

# The elements of HTML by what they do to text.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "plaintext"}
EMPTY = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody "
    "td tfoot th thead tr ul".split()
)
ENDS_PARAGRAPH = BLOCKS - set("body html caption legend tbody td tfoot th thead tr option optgroup".split())
# An element that ends the nearest open one of these, but not beyond its list or table.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
NEVER = RAW | set(
    "head nav header footer aside form noscript template button select option dialog menu svg canvas object audio video map datalist".split()
)
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
# How far an element is trusted to hold the main text.
TRUSTED = {"main": 1, "article": 2}
# The share of the content, found by ratios, that an element must hold to be taken as the whole of it.
TRUSTED_SHARE = 0.25
# Elements that text may stand in besides paragraphs, and those between them and their container.
TEXTUAL = set("h1 h2 h3 h4 h5 h6 p li dt dd td th pre blockquote figcaption caption summary".split())
BETWEEN = set("ul ol dl menu dir table thead tbody tfoot tr li dd td th figure hgroup blockquote details".split())
NEVER_WORDS = set(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promotion banner "
    "sidebar aside rail menu menus nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer colophon comment "
    "comments disqus discussion respond reply replies notice notices notification cookie cookies consent gdpr popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations widget widgets toolbar "
    "pagination pager skip hidden copyright disclaimer alert".split()
)
NOT_ITSELF = {"has", "with", "no", "without", "hide", "is", "not"}

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
MARKUP = re.compile(r"</?[a-zA-Z]|<[!?]")
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
PUNCTUATION = re.compile(r"[.,;:!?…，。、；：！？؟،؛।¿¡]")


def named_away(value: str, first_only: bool) -> bool:
    """Whether a class or id names an element that is no main text. ``first_only``: only by its first word."""
    for name in value.split():
        parts = [p.lower() for p in NAME_PART.findall(name)]
        joined = [a + b for a, b in zip(parts, parts[1:], strict=False)]
        words = parts[:1] + joined[:1] if first_only else parts + joined
        if parts and parts[0] not in NOT_ITSELF and NEVER_WORDS.intersection(words):
            return True
    return False


class Paths:
    """The distinct tag paths of one page, each by its parent and its label. Path 0 is the root."""

    def __init__(self) -> None:
        self.raw: dict[tuple[int, str, str], int] = {}
        self.known: dict[tuple[int, str, bool, int], int] = {}
        self.tag, self.parent, self.away, self.trust, self.linked, self.block = [""], [0], [False], [0], [False], [0]

    def child(self, parent: int, tag: str, attributes: str) -> int:
        raw = (parent, tag, attributes)
        if raw not in self.raw:
            self.raw[raw] = self._child(parent, tag, attributes)
        return self.raw[raw]

    def _child(self, parent: int, tag: str, attributes: str) -> int:
        away, trust, names = self.away[parent] or tag in NEVER, TRUSTED.get(tag, 0), ""
        if attributes and not away:
            found = {k.lower(): html.unescape(a or b or c) for k, a, b, c in ATTRIBUTE.findall(attributes)}
            names, role = f"{found.get('class', '')} {found.get('id', '')}".strip(), found.get("role", "").lower()
            unseen = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in "".join(found.get("style", "").split())
            away = unseen or role in ROLES or tag not in ("html", "body") and named_away(names, trust > 0 or tag in HEADINGS)
            trust = max(trust, TRUSTED.get(role, 0), 2 if "articlebody" in found.get("itemprop", "").lower() else 0)
        key = (parent, f"{tag}.{names}", away, trust)
        if key not in self.known:
            new = self.known[key] = len(self.tag)
            self.tag.append(tag)
            self.parent.append(parent)
            self.away.append(away)
            self.trust.append(max(trust, self.trust[parent]))
            self.linked.append(self.linked[parent] or tag == "a")
            self.block.append(new if tag in BLOCKS else self.block[parent])
        return self.known[key]

    def container(self, path: int) -> int:
        """The path of what holds the block of ``path``, lists and tables passed over."""
        found = self.block[self.parent[self.block[path]]]
        while self.tag[found] in BETWEEN:
            found = self.block[self.parent[found]]
        return found


class Page:
    """The texts of a page that can be content: (block, path, text), in page order. Tags that end others without
    saying so do; tags without a partner are passed over."""

    def __init__(self, page: str) -> None:
        self.paths, self.texts = Paths(), []
        self.stack: list[tuple[str, int]] = []
        self.open: dict[str, int] = {}
        self.block = 0
        at = 0
        while at < len(page):
            mark = page.find("<", at)
            self._text(page[at : mark if mark >= 0 else len(page)])
            if mark < 0:
                break
            at = self._markup(page, mark)

    def _path(self) -> int:
        return self.stack[-1][1] if self.stack else 0

    def _text(self, text: str) -> None:
        if text and not self.paths.away[self._path()]:
            self.texts.append((self.block, self._path(), text))

    def _close(self, depth: int) -> None:
        while len(self.stack) > depth:
            tag, _ = self.stack.pop()
            self.open[tag] -= 1
            self.block += tag in BLOCKS

    def _end_nearest(self, tags: set[str], barrier: set[str]) -> None:
        if any(self.open.get(t) for t in tags):
            for depth in range(len(self.stack) - 1, -1, -1):
                if self.stack[depth][0] in tags:
                    self._close(depth)
                    return
                if self.stack[depth][0] in barrier:
                    return

    def _markup(self, page: str, mark: int) -> int:
        """Take the markup at ``mark``; where the text after it begins."""
        if page.startswith("<!--", mark):
            if page.startswith("<!-->", mark):
                return mark + 5
            end = page.find("-->", mark + 4)
            return end + 3 if end >= 0 else len(page)
        found = TAG.match(page, mark)
        if not found:
            if not MARKUP.match(page, mark):
                self._text("<")
                return mark + 1
            end = page.find(">", mark)  # a declaration, or a tag with a quote that never ends
            return end + 1 if end >= 0 else len(page)
        tag = found[2].lower()
        if found[1]:
            self._end(tag)
            return found.end()
        if tag in ENDS_PARAGRAPH:
            self._end_nearest({"p"}, {"td", "th", "table", "button", "object"})
        if tag in ENDS:
            self._end_nearest(*ENDS[tag])
        self.block += tag in BLOCKS
        if tag == "br":
            self._text(" ")
        elif tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, found.end()) if tag != "plaintext" else None
            return end.end() if end else len(page)
        elif tag not in EMPTY:
            self.stack.append((tag, self.paths.child(self._path(), tag, found[3])))
            self.open[tag] = self.open.get(tag, 0) + 1
        return found.end()

    def _end(self, tag: str) -> None:
        if self.open.get(tag):
            depth = len(self.stack) - 1
            while self.stack[depth][0] != tag:
                depth -= 1
            self._close(depth)
        self.block += tag in BLOCKS


def smoothed(values: np.ndarray) -> np.ndarray:
    """A Gaussian over each value and its neighbours; at the ends over those there are."""
    kernel = np.exp(-2.0 * np.arange(-1, 2) ** 2)  # half a text wide
    return np.convolve(values, kernel)[1:-1] / np.convolve(np.ones(len(values)), kernel)[1:-1]


def main_text(page: str, share: float = 0.8) -> str:
    """The main text of one page: its blocks, one a line."""
    parsed, blocks = Page(page), {}
    paths = parsed.paths
    for block, path, text in parsed.texts:
        blocks.setdefault(block, []).append((path, html.unescape(text)))
    lines, at, linked = [], [], []
    for parts in blocks.values():
        line = " ".join("".join(t for _, t in parts).split())
        if line:
            lines.append(line)
            at.append(max(parts, key=lambda part: len(part[1]))[0])  # a block has the path of its longest text
            linked.append(min(len(line), sum(len(t) for p, t in parts if paths.linked[p])))
    if not lines:
        return ""
    # Text of links counts nothing, nor do its marks.
    length = np.array([len(t) for t in lines], float)
    own = length - linked
    marks = np.array([len(PUNCTUATION.findall(t)) for t in lines]) * own / length
    _, group = np.unique(at, return_inverse=True)
    count = np.bincount(group)

    def by_path(values: np.ndarray) -> np.ndarray:
        return (np.bincount(group, values) / count)[group]

    fused = by_path(np.sqrt(smoothed(by_path(own)) * smoothed(by_path(marks))))
    content = fused >= share * fused.std()
    trust = np.array([paths.trust[p] for p in at])
    for level in range(trust.max(), 0, -1):
        in_level = trust == level
        if (content & in_level).any() and own[content & in_level].sum() >= TRUSTED_SHARE * own[content].sum():
            return "\n".join(t for t, yes in zip(lines, in_level | content & (trust > level), strict=True) if yes)
    holders = {paths.container(p) for p, yes in zip(at, content, strict=True) if yes}
    beside = np.array([paths.tag[paths.block[p]] in TEXTUAL and paths.container(p) in holders for p in at]) & (own * 2 >= length)
    return "\n".join(t for t, yes in zip(lines, content | beside, strict=True) if yes)


def extract_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """For every page its main text: blocks in page order, one a line, white space inside a block as one blank,
    references decoded, and the number of its characters.

    A null or empty page, and one without text, has an empty text. Text outside all markup is
    content as any other. One row for each input row, repeated rows and null ids or urls
    included; other columns are not read; an empty table gives no rows. Pages are read whole."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 256):
                part = batch.slice(first, 256)
                texts = [main_text(page.as_py() or "") for page in part.column(2)]
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"]
                )

    chosen = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )
    return chosen.mapInArrow(rows, SCHEMA)
