"""Main text of HTML pages by tree scoring.

One pass over the tags builds a tree of block elements.  Elements that are
furniture by tag or role, or whose class or id says so and nothing else (menus,
page headers and footers, sidebars, notices, adverts, forms, reader comments,
scripts, styles, hidden parts) give no text.  A name that holds such a word beside
others ("related-work") only weighs: it costs its element points.  So do names inside an
article that may belong to it ("discussion", "print", "section-header").  Each remaining
block of text is a paragraph that passes points for its length and commas to its
parent, half of them to the grandparent, a sixth to the next and two thirds of that
to each one above; a container's score is its points times the share of its text
that is not link text.  The best container, or the article around it, is kept, with
those siblings that score close to it or are plain paragraphs and headings; inside
it, an element that only weighs is kept if it reads like text.  The work is
proportional to the page, whatever its nesting.

White space inside a block becomes one space (``br`` counts as white space),
blocks are joined by one newline.  Pages are treated one by one: no shuffle.

Defined cases: null or empty HTML gives an empty text; text without any tag is
one block; unclosed elements, stray end tags, unclosed comments and scripts are
read as browsers do in outline; equal pages give equal texts; input columns pass
through, and those named like an output are replaced.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prismarq.llm.common import fresh

# Element names of the HTML standard, by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag of the key closes an open element of the value, unless one of SCOPE lies between.
CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option"}, "optgroup": {"option", "optgroup"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
SCOPE = frozenset("table ul ol dl menu div article section main body html aside blockquote select".split())
FURNITURE_TAGS = frozenset(
    "head script style noscript template iframe object svg canvas audio video map nav footer aside form button select input textarea label menu dialog search datalist fieldset".split()
)
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist".split())
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot adbox banner sponsor sponsored sponsors promo promotion promoted"
    " nav navbar navigation menu menus submenu breadcrumb breadcrumbs crumbs pagination pager toolbar topbar masthead"
    " header footer foot sidebar sidebars rail aside widget widgets"
    " cookie cookies consent gdpr notice notices alert alerts popup modal overlay toast disclaimer newsletter subscribe subscription signup login signin register"
    " share sharing social follow comment comments commentlist disqus discussion respond reply replies responses feedback"
    " related recommended recommendations trending outbrain taboola skip skiplink print hidden".split()
)
#: Words that say nothing of their own beside a furniture word.
PLAIN_WORDS = frozenset(
    "site page main top bottom left right center box block container wrapper wrap inner outer section list lists area bar item items link links post posts article articles"
    " story stories content text form unit slot holder module panel button buttons icon icons col column global primary secondary fixed sticky only view mobile desktop js id"
    " area zone group set row body title heading the and for of in to my our your".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus discussion respond reply replies responses".split())
#: Words that may also name a part of an article; inside one they only speak against it, and prose stays.
EITHER_WORDS = frozenset("discussion feedback print header masthead".split())
GOOD_WORDS = frozenset("article body content entry main page post text blog story".split())
TAG_POINTS = {"article": 30, "main": 20, "div": 5, "section": 5, "td": 3, "pre": 3, "blockquote": 3, "ul": -3, "ol": -3, "dl": -3, "li": -3, "address": -3, "th": -5}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|[^>]*(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role|style|hidden|aria-hidden)(?=[\s=/>]|\Z)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _attributes(rest: str) -> dict[str, str]:
    if len(rest) < 3:
        return {}
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(rest)}


def _name_words(a: dict[str, str]) -> list[set[str]]:
    """Lower-case words of each class and of the id."""
    return [{w.lower() for w in _WORD.findall(name) if len(w) > 1} for name in f"{a.get('class', '')} {a.get('id', '')}".split()]


class _Tree:
    """Block elements in page order with their text blocks; parents precede children."""

    def __init__(self):
        self.tag, self.parent, self.points = ["html"], [-1], [0.0]
        self.text_size, self.link_size, self.weight, self.weak = [0], [0], [0], [False]
        self.blocks: list[tuple[int, str]] = []
        #: Open elements: (tag, node, furniture, headings only, link, in a heading, in an article).
        self.stack: list[tuple[str, int, bool, bool, bool, bool, bool]] = [("html", 0, False, False, False, False, False)]
        #: How often each block tag is open, and each other tag above the last open block.
        self.open_blocks: dict[str, int] = {"html": 1}
        self.open_inline: list[dict[str, int]] = [{}]
        self.parts: list[str] = []
        self.links: int = 0

    def flush(self) -> None:
        """End the current block: it belongs to the innermost open block element."""
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                node = self.stack[-1][1]
                self.blocks.append((node, text))
                self.text_size[node] += len(text)
                self.link_size[node] += min(self.links, len(text))
            self.parts, self.links = [], 0

    def text(self, raw: str) -> None:
        _, _, furniture, headings, link, in_heading, _ = self.stack[-1]
        if furniture or not raw or headings and not in_heading:
            return
        raw = html.unescape(raw) if "&" in raw else raw
        self.parts.append(raw)
        if link:
            self.links += len(raw.strip())

    def open(self, tag: str, rest: str) -> None:
        if tag in BLOCK:
            self.flush()
            if tag not in ("html", "head", "body"):
                self._close_open("p")
            for other in CLOSES.get(tag, ()):
                self._close_open(other)
        elif tag == "br":
            self.parts and self.parts.append(" ")
        if tag in VOID:
            return
        _, node, furniture, headings, link, in_heading, inside = self.stack[-1]
        weight, weak = 0, False
        if not furniture:
            furniture, header, weight, weak = self._judge(tag, rest, inside)
            headings = headings or header
        if tag in BLOCK and tag != "html":
            self.tag.append(tag)
            self.parent.append(node)
            self.points.append(0.0)
            self.text_size.append(0)
            self.link_size.append(0)
            self.weight.append(weight)
            self.weak.append(weak)
            node = len(self.tag) - 1
        if tag in BLOCK:
            self.open_blocks[tag] = self.open_blocks.get(tag, 0) + 1
            self.open_inline.append({})
        else:
            here = self.open_inline[-1]
            here[tag] = here.get(tag, 0) + 1
        self.stack.append((tag, node, furniture, headings, link or tag == "a", in_heading or tag in HEADING, inside or tag in ("article", "main")))

    def _judge(self, tag: str, rest: str, inside: bool) -> tuple[bool, bool, int, bool]:
        """Whether an element is furniture, whether only its headings count, the weight of its names, and whether they speak against it."""
        a = _attributes(rest)
        names = _name_words(a)
        words = set().union(*names)
        good = 25 if words & GOOD_WORDS else 0
        if tag in ("html", "body", "main"):
            return False, False, good, False
        if tag == "article":
            return bool(words & COMMENT_WORDS), False, good, False
        if tag == "header" or inside and any(n and n <= {"header", "masthead"} for n in names):
            return not inside, inside, good, False
        hidden = "hidden" in a or a.get("aria-hidden", "").lower() == "true" or bool(_HIDING.search(a.get("style", "")))
        bad = FURNITURE_WORDS
        if words & {"has", "with", "no", "without"}:  # a layout that says what stands beside it
            bad = COMMENT_WORDS
        against = [n for n in names if n & bad]
        named = any(n <= bad | PLAIN_WORDS and not (inside and n & bad <= EITHER_WORDS) for n in against)  # a name that says so and nothing else
        named = named and (tag in BLOCK or bool(words & COMMENT_WORDS) or bool(words & {"ad", "ads", "advert"}))
        weak = bool(against) and tag in BLOCK
        return hidden or tag in FURNITURE_TAGS or a.get("role", "").lower() in FURNITURE_ROLES or named, False, -25 if weak else good, weak

    def _cut(self, i: int) -> None:
        """Close the open elements from place ``i`` of the stack on."""
        for tag, *_ in reversed(self.stack[i:]):
            if tag in BLOCK:
                self.open_blocks[tag] -= 1
                self.open_inline.pop()
            else:
                self.open_inline[-1][tag] -= 1
        del self.stack[i:]

    def _close_open(self, tag: str) -> None:
        """Close the innermost open ``tag`` unless a scope lies between."""
        if not self.open_blocks.get(tag):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                self.flush()
                self._cut(i)
                return
            if self.stack[i][0] in SCOPE or self.stack[i][0] in ("td", "th", "li") and tag == "p":
                return

    def close(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
            if not self.open_blocks.get(tag):
                return
        elif not self.open_inline[-1].get(tag):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                if tag not in ("html", "body"):
                    self._cut(i)
                return
            if self.stack[i][0] in ("article", "main", "body", "table") and tag in ("p", "li"):
                return

    def score(self) -> list[float]:
        """Points of the blocks, passed upward, with what tag and names add, less link density."""
        n = len(self.tag)
        direct, half, far = [0.0] * n, [0.0] * n, [0.0] * n
        for node, text in self.blocks:
            points = (1.0 if len(text) >= 25 else len(text) / 50) + text.count(",") + text.count("、") + text.count("，") + min(len(text) / 100, 3.0)
            at = self.parent[node] if self.tag[node] in ("p", "li", "td", "pre", "blockquote", "dd", "dt", *HEADING) else node
            direct[max(at, 0)] += points
        for i in range(n - 1, 0, -1):  # children come after their parents
            up = self.parent[i]
            self.text_size[up] += self.text_size[i]
            self.link_size[up] += self.link_size[i]
            half[up] += direct[i] / 2
            far[up] += half[i] / 3 + far[i] * 2 / 3
        out = []
        for i in range(n):
            points = direct[i] + half[i] + far[i]
            if points > 0:
                points += TAG_POINTS.get(self.tag[i], 0) + self.weight[i]
            self.points[i] = points
            out.append(points * (1 - self.density(i)))
        return out

    def density(self, node: int) -> float:
        return min(1.0, self.link_size[node] / self.text_size[node]) if self.text_size[node] else 0.0

    def reads_like_text(self, node: int) -> bool:
        """Whether an element whose name speaks against it has the points of prose, by itself, and few links."""
        return self.points[node] - TAG_POINTS.get(self.tag[node], 0) - self.weight[node] >= 2 and self.density(node) < 0.25

    def main_text(self) -> str:
        self.flush()
        if not self.blocks:
            return ""
        scores = self.score()
        best = max(range(len(scores)), key=lambda i: (scores[i], -i))
        around, at = best, best
        while at > 0:  # the outermost article around it, else the main element
            if self.tag[at] == "article" or self.tag[at] == "main" and self.tag[around] != "article":
                around = at
            at = self.parent[at]
        keep = [False] * len(self.tag)
        keep[around] = True
        bar = max(10.0, 0.2 * scores[around])
        for i in range(1, len(self.tag)):
            if keep[self.parent[i]]:
                keep[i] = not self.weak[i] or self.reads_like_text(i)
            elif i != around and around and self.parent[i] == self.parent[around] and self.text_size[i]:
                plain = self.tag[i] == "p" or self.tag[i] in HEADING
                keep[i] = not self.weak[i] and self.density(i) < 0.25 if plain else scores[i] >= bar and self.density(i) < 0.5
        return "\n".join(text for node, text in self.blocks if keep[node])


def main_text(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    tree, at, n = _Tree(), 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            tree.text(page[at:])
            break
        if m.start() > at:
            tree.text(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            if m[0].startswith("<![CDATA["):
                tree.text(m[0][9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if m["end"]:
            tree.close(name)
        elif name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
        else:
            tree.open(name, m["rest"])
    return tree.main_text()


def _extract(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in pages:
        yield pd.Series([main_text(x) if isinstance(x, str) else "" for x in s], dtype=object)


def extract_text(df: DataFrame, column: str = "html", out: str = "text") -> DataFrame:
    """``df`` with the main text of ``column`` as ``out``."""
    (x,) = fresh(df, "page")
    return df.withColumn(x, F.pandas_udf(_extract, "string")(F.col(column))).drop(*({out} - {column})).withColumn(out, F.col(x)).drop(x)


def op4_tree_scoring(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
