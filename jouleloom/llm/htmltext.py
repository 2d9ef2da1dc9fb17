"""Main text of web pages by tag-path ratios.

The text of a page lies in leaves: block elements with text of their own. A leaf has a path of tags from
the root. Over all leaves of a path, the mean text length and the mean number of punctuation marks tell
prose from menus, labels and remarks; paths whose text is mostly links count nothing. Both ratios are
smoothed along the page, fused and averaged over each path. Paths that reach a part of what the page's
text has on average, or what a plain paragraph has, are content, and leaves on them are the article. Other
leaves are kept where they belong to it: titles, lists and short lines beside or between content, but no lists
of links, and no boxes after the last or, where nothing names the article, before the first content. Elements
that HTML itself or their class, id or role mark as something else take no part, unless the article or most of
the page's text lies in them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from jouleloom.llm.common import small_batches

# Attributes as HTML reads them: a quote opens a value only after "=", and a value that is never closed ends as if unquoted.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)\]\]>|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[\s/]++"
    r"|=?[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]++)?+)?+|=)*+)>",
    re.S,
)
MARK = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)

# Elements of the HTML standard by what they mean for text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe object svg math title head select option button canvas audio video".split())
UNPARSED = frozenset("script style textarea title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
ASIDE = frozenset("nav footer aside form menu dialog fieldset".split())
CLOSES = {
    "li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}), "tr": ("tr td th", {"table"}),
    "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}), "option": ("option", {"select"}),
}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login sidebar side widget related recommended recommendations "
    "share sharing social breadcrumb breadcrumbs pagination pager menu nav navbar navigation topbar toolbar comment comments reply replies "
    "disqus respond footer masthead header skip search".split()
)
ARTICLES = frozenset("article main".split())
HEADS = frozenset("header masthead".split())  # inside an article they hold its title
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
BROKEN = re.compile(r"<[a-zA-Z/!?]")
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")

#: Weights of a leaf and its neighbours when ratios are smoothed.
KERNEL = np.array([0.2, 0.6, 0.2])
#: The part of the ratio of an average character that a content path must reach.
THRESHOLD = 0.6
#: The ratio of a paragraph of 100 characters with three marks: a path that reaches it is content in any case.
PARAGRAPH = 10 * (1 + 3**0.5)
#: Text of which more than this part is links is a list of links.
LINKS = 0.5
#: Elements lie in no more than so many others, as in browsers; deeper ones are taken as part of the last.
DEPTH = 512
#: Elements that are text by their nature; others are boxes, which are kept beside content only if they have some.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl li dt dd blockquote pre table figure figcaption caption header hgroup address details summary".split())
#: An element whose class or id speaks against it is kept if it has more than this part of the page's text.
MOST = 0.5

#: A named article is one with MOST of the content, and an article in it with this part of its content is taken instead.
INNER = 0.75

#: Why an element is set apart: by everyday words of its class or id or as a form, by its meaning, or for good.
WORDED, MEANT, NEVER = 1, 2, 3


def set_apart(tag: str, attributes: str, in_article: bool) -> int:
    """Why an element is thought not to belong to the article, the strongest reason; 0 if nothing says so."""
    if tag in RAW:
        return NEVER
    reason = 0
    if tag in ASIDE or (tag == "header" and not in_article):
        reason = WORDED if tag in ("form", "fieldset") else MEANT
    if not attributes or tag in ("html", "body", "article", "main"):
        return reason
    words = WORDS - HEADS if in_article else WORDS
    for name, *values in MARK.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return NEVER
        if name == "role":
            if value.lower() in ROLES:
                reason = max(reason, MEANT)
        elif name in ("class", "id") and not words.isdisjoint(w.lower() for w in WORD.findall(value)):
            reason = max(reason, WORDED)
    return reason


class Page:
    """Text nodes of a page in order: their blocks, the elements around them, and whether they are set apart.

    Of every element: its tag, its parent, the block element it belongs to, the number of its path of block
    elements, and whether it lies in a link or in something that is never text.
    """

    def __init__(self, html: str):
        self.nodes: list[tuple[int, str, int]] = []  # element, text, block
        self.tags, self.parents, self.reasons, self.blocks, self.paths = ["#root"], [-1], [0], [0], [0]
        self.linked, self.raw = [False], [False]
        self.links: list[str] = []  # attributes of links and areas
        self.block = 0
        known: dict[tuple[int, str], int] = {}
        stack, deeper, articles = [0], {}, 0
        at, end = 0, len(html)

        def close(to: int) -> None:
            nonlocal articles
            articles -= sum(self.tags[e] in ARTICLES for e in stack[to:])
            del stack[to:]
            deeper.clear()

        while at < end:
            token = TOKEN.search(html, at)
            stop = token.start() if token else end
            if token is None:  # a tag that never ends is none
                broken = BROKEN.search(html, at)
                stop = broken.start() if broken else end
            if stop > at:
                self.nodes.append((stack[-1], unescape(html[at:stop]), self.block))
            if token is None:
                break
            at = token.end()
            if token["cdata"]:
                self.nodes.append((stack[-1], token["cdata"], self.block))
            if token["tag"] is None:
                continue
            tag = token["tag"].lower()
            if tag not in INLINE:
                self.block += 1
            if token["end"]:
                if deeper.get(tag):
                    deeper[tag] -= 1
                    continue
                found = next((i for i in range(len(stack) - 1, 0, -1) if self.tags[stack[i]] == tag), None)
                if found is not None:
                    close(found)
                continue
            if tag in ("a", "area"):
                self.links.append(token["attributes"])
            if tag in VOID:
                continue
            if tag not in INLINE:
                for i in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                    open_ = self.tags[stack[i]]
                    if open_ == "p":
                        close(i)
                        break
                    if open_ not in INLINE:
                        break
            if tag in CLOSES:
                names, scope = CLOSES[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if self.tags[stack[i]] in scope:
                        break
                    if self.tags[stack[i]] in names.split():
                        close(i)
                        break
            if token["attributes"].endswith("/") and tag in ("svg", "math", "path"):
                continue
            if len(stack) > DEPTH and tag not in UNPARSED and (tag not in RAW or self.raw[stack[-1]]):
                deeper[tag] = deeper.get(tag, 0) + 1
                continue
            own, above = len(self.tags), stack[-1]
            stack.append(own)
            self.tags.append(tag)
            self.reasons.append(set_apart(tag, token["attributes"], articles > 0))
            self.parents.append(above)
            inline = tag in INLINE
            self.blocks.append(self.blocks[above] if inline else own)
            self.paths.append(self.paths[above] if inline else known.setdefault((self.paths[above], tag), len(known) + 1))
            self.linked.append(self.linked[above] or tag == "a")
            self.raw.append(self.raw[above] or tag in RAW)
            articles += tag in ARTICLES
            if tag in UNPARSED:
                closing = re.compile(f"</{tag}", re.I).search(html, at)
                stop = closing.start() if closing else end
                if tag == "title" and stop > at:
                    self.nodes.append((own, unescape(html[at:stop]), self.block))
                at = stop

    def summed(self, values: list) -> list:
        """The values of elements plus those of all inside them; parents come before their children."""
        out = list(values)
        for x in range(len(out) - 1, 0, -1):
            out[self.parents[x]] += out[x]
        return out

    def inherited(self, of: list) -> list[bool]:
        """Whether an element or one around it has it."""
        out = [bool(of[0])]
        for x in range(1, len(of)):
            out.append(out[self.parents[x]] or bool(of[x]))
        return out

    def apart(self) -> list[bool]:
        """Whether each element is set apart, itself or by one around it.

        Nothing but NEVER sets apart an element around the largest article or main, unless one with MOST of its
        text stands outside: comments and teasers can be articles too. On a page without any, a WORDED element
        is kept that has MOST of the page's text, and all are if nothing else is left.
        """
        count = len(self.tags)
        never = self.inherited([r == NEVER for r in self.reasons])
        own = [0] * count
        for e, t, _ in self.nodes:
            if not never[e]:
                own[e] += len(t.strip())
        mass = self.summed(own)

        def decided(around: set[int], least: float) -> list[bool]:
            return self.inherited(
                [r > 0 and not (r < NEVER and (x in around or (r == WORDED and mass[x] > least))) for x, r in enumerate(self.reasons)]
            )

        articles = [x for x in range(count) if self.tags[x] in ARTICLES and mass[x] > 0 and not never[x]]
        if articles:
            first = decided(set(), mass[0])
            largest = max(articles, key=mass.__getitem__)
            if max((mass[x] for x in articles if not first[x]), default=0) < MOST * mass[largest]:
                first = decided(set(self.around(largest)), mass[0])
        else:
            first = decided(set(), MOST * mass[0])
        if any(t.strip() and not first[e] for e, t, _ in self.nodes):
            return first
        return decided(set(), 0)

    def around(self, element: int) -> Iterator[int]:
        """`element` and all it lies in."""
        while element >= 0:
            yield element
            element = self.parents[element]

    def text(self, kept: list[bool]) -> str:
        """The text of the kept elements: white space as one space, blocks joined by one space."""
        out: list[str] = []
        last = None
        for element, text, block in self.nodes:
            if kept[element]:
                out += [" ", text] if block != last else [text]
                last = block
        return " ".join("".join(out).split())


class Leaves:
    """The leaves of a page in order, and the sums of text, link text and marks of each."""

    def __init__(self, page: Page, apart: list[bool]):
        self.page = page
        found: dict[int, int] = {}
        size, link, marks = [], [], []
        for e, t, _ in page.nodes:
            n = len(t.strip())
            if n and not apart[e]:
                i = found.setdefault(page.blocks[e], len(found))
                if i == len(size):
                    size.append(0)
                    link.append(0)
                    marks.append(0)
                size[i] += n
                link[i] += n if page.linked[e] else 0
                marks[i] += len(PUNCTUATION.findall(t))
        self.elements = list(found)
        self.size, self.link, self.marks = (np.array(x, np.float64) for x in (size, link, marks))

    def content(self) -> np.ndarray:
        """Which leaves are on content paths."""
        _, path = np.unique([self.page.paths[e] for e in self.elements], return_inverse=True)
        times = np.bincount(path)
        # Text length and punctuation per path, put back to its leaves, smoothed along the page and fused.
        text, marks = (smoothed(np.sqrt(np.bincount(path, x) / times)[path]) for x in (self.size, self.marks))
        listed = np.bincount(path, self.link) > LINKS * np.bincount(path, self.size)
        fused = np.where(listed, 0, np.bincount(path, text * (1 + marks)) / times)
        prose = self.size - self.link
        if not prose.sum():
            return np.zeros(len(path), bool)
        least = min(THRESHOLD * np.average(fused[path], weights=prose), PARAGRAPH)
        return (~listed & (fused >= least))[path]


def smoothed(values: np.ndarray) -> np.ndarray:
    return np.convolve(np.pad(values, 1, mode="edge"), KERNEL, mode="valid")


def named_article(page: Page, leaves: Leaves, content: np.ndarray) -> int:
    """The article or main with at least half of the content, the inner one if most of that is in it; 0 if none has."""
    own = [0.0] * len(page.tags)
    for e, n, is_content in zip(leaves.elements, leaves.size, content, strict=True):
        own[e] += n if is_content else 0
    mass = page.summed(own)
    found, least = 0, MOST * mass[0]
    for x in range(1, len(mass)):  # from the outside to the inside
        if page.tags[x] in ARTICLES and mass[x] and mass[x] >= least and (not found or found in page.around(x)):
            found, least = x, INNER * mass[x]
    return found


def selected(page: Page, apart: list[bool]) -> list[bool]:
    """Which elements' own text belongs to the article."""
    leaves = Leaves(page, apart)
    if not leaves.elements:
        return [False] * len(page.tags)
    content = leaves.content()
    if not content.any():
        return [not a for a in apart]
    region = named_article(page, leaves, content)
    inside = page.inherited([x == region for x in range(len(page.tags))])
    content &= np.array([inside[e] for e in leaves.elements])
    own, text, link = ([0.0] * len(page.tags) for _ in range(3))
    for e, n, a, is_content in zip(leaves.elements, leaves.size, leaves.link, content, strict=True):
        own[e], text[e], link[e] = float(is_content), n, a
    own, text, link = page.summed(own), page.summed(text), page.summed(link)
    # The outermost element around a leaf that has no content; the one it lies in has some.
    outermost = list(range(len(page.tags)))
    for x in range(1, len(outermost)):
        if not own[x] and not own[page.parents[x]]:
            outermost[x] = outermost[page.parents[x]]
    first, last = np.flatnonzero(content)[[0, -1]]
    kept = [False] * len(page.tags)
    for i, e in enumerate(leaves.elements):
        if content[i]:
            kept[e] = True
        elif inside[e]:
            if own[e]:  # text beside content in one element
                kept[e] = leaves.link[i] <= LINKS * leaves.size[i]
                continue
            box = outermost[e]
            beside = page.tags[box] in TEXTUAL or (i < last and (i > first or region > 0))
            kept[e] = beside and link[box] <= LINKS * text[box]
    return [not a and kept[page.blocks[x]] for x, a in enumerate(apart)]


def main_text(html: str | None) -> str:
    """The article of a page; empty for a null, an empty or a textless page."""
    if not html:
        return ""
    page = Page(html)
    return page.text(selected(page, page.apart()))


def visible_text(page: Page) -> str:
    """All text of a page but what belongs to no reader: scripts, styles and the like."""
    return page.text([not r for r in page.raw])


def title_of(page: Page) -> str:
    return " ".join("".join(t for e, t, _ in page.nodes if page.tags[e] == "title").split())


def text_column(html: Column) -> Column:
    @F.pandas_udf(StringType())
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(h) for h in pages], dtype=object)

    return extract.asNondeterministic()(html)


def extract_text(df: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns `keep`, text and n_chars (code points) of every page.

    Null, empty and textless pages have an empty text. Rows that repeat are each extracted; an empty table
    gives an empty one. Other columns are not read.
    """
    small_batches(df.sparkSession, rows=500)
    return df.select(*keep, text_column(F.col(html)).alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))
