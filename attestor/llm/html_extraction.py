"""Main text of web pages by the ratios of their tag paths.

1. The page becomes leaves: runs of text between block boundaries, each with its path of tags (and first
   class) from the root.  Tags that only shape letters don't count as steps of a path.
2. Out are elements that never hold article text (scripts, styles, menus, footers ...) and, unless an
   ``article`` or ``main`` is in them, forms, sidebars and what a class, id or role calls by such a name.
   Where a page has articles, or else a main part, leaves outside these are out too.
3. By path, the unlinked lengths and the punctuation of the leaves are summed and divided by the number of
   leaves.  In page order both ratios are smoothed by a Gaussian, then multiplied; leaves at or above a
   share of the standard deviation are content nodes.
4. The text is all leaves of the lowest element that holds nearly all text of the content nodes (widened to
   the ``article`` around it), whatever their own ratio, so that headings and short paragraphs stay; and,
   where the page has no article or main part, other content nodes and the first-rank heading before.

White space in a block becomes one space, blocks are joined by one space, character references are decoded
after the tags are read.  Null, empty and blank pages give an empty text; pages of any length are taken
whole; unclosed tags, comments and quotes end with the page.  Every row gives one row, so repeated rows stay
repeated, an empty table gives an empty result, and kept columns named as one that is made are left out.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from attestor.llm.common import map_arrow, with_text

MADE = ("text", "n_leaves", "n_content")

# Names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that only shape letters: no step of a path and no boundary.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter output picture q rp rt ruby s samp script small span strike strong style sub sup template time tt u var wbr".split())
#: Elements that never hold article text.
OUT = frozenset("head title script style noscript template textarea xmp iframe noembed noframes nav footer button select option datalist input fieldset legend object embed applet audio video canvas svg map menu".split())
#: Elements that are out unless they wrap the article; so is a header outside of it.
WRAPPERS = frozenset("form aside dialog".split())
#: An open element of the first set ends where one of the second begins, unless one of the third is between.
_BLOCKS = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_IMPLIED = (
    ({"p"}, _BLOCKS | {"li", "dt", "dd"}, {"button", "table", "td", "th", "caption", "object", "template"}),
    ({"li"}, {"li"}, {"ul", "ol", "menu", "dir"}),
    ({"dt", "dd"}, {"dt", "dd"}, {"dl"}),
    ({"option"}, {"option", "optgroup"}, {"select", "datalist"}),
    ({"td", "th"}, {"td", "th", "tr", "tbody", "thead", "tfoot"}, {"table"}),
    ({"tr"}, {"tr", "tbody", "thead", "tfoot"}, {"table"}),
    ({"tbody", "thead", "tfoot"}, {"tbody", "thead", "tfoot"}, {"table"}),
    ({"head"}, _BLOCKS | {"body"}, {"template"}),
)
#: An end tag doesn't reach out of these.
_SCOPE = frozenset("table td th caption template".split())
#: Words of a class, id or role that name what isn't the article.
NAMED = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner banners sponsor sponsored sponsors promo promotion menu menus nav navbar navigation navigations breadcrumb breadcrumbs"
    " sidebar sidebars aside footer masthead topbar toolbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login signin search searchbox"
    " share sharing social related recommended recommendations comment comments commentlist disqus respond reply replies pagination pager paging widget widgets skip contentinfo complementary dialog".split()
)
#: A word before one of these says what the element goes with, not what it is.
_WITH = frozenset("with has have no without hide show".split())
#: Elements whose name in a class isn't taken at its word, as they hold the page or the article.
_WHOLE = frozenset("html body main".split())

#: Deviation of the Gaussian in leaves; share of the standard deviation; share of the content text that the article's element holds.
SIGMA, LEAST, SHARE = 0.5, 0.8, 0.9

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""[\s/]*+(?:(>)|([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*+)|(["'])|))?|=)""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_LONG_REFERENCE = re.compile(r"&#(?:([xX])([0-9a-fA-F]{8,})|([0-9]{8,}));?")
_PUNCTUATION = re.compile(r"[.,;:!?…。、，；：！？،؛؟।]")


def _shortened(reference: re.Match) -> str:
    digits = (reference[2] or reference[3]).lstrip("0") or "0"
    return f"&#{reference[1] or ''}{digits};" if len(digits) < 8 else "\ufffd"


def decoded(text: str) -> str:
    """The text with character references decoded, however many digits they have."""
    return entities.unescape(_LONG_REFERENCE.sub(_shortened, text)) if "&" in text else text


class Page:
    """Elements in page order (parent, tag, path, what bars them) and leaves (element, text, linked length)."""

    def __init__(self, source: str):
        self.parent, self.tag, self.path, self.block = [-1], [""], [0], [True]
        self.out, self.named = [False], [False]  # out for good; out unless an article is inside
        self.paths: dict[tuple[int, str], int] = {}
        self.open = [0]
        self.count: dict[str, int] = {}
        self.leaves: list[tuple[int, str, int]] = []
        self._held: list[str] = []
        self._linked = self._links = 0
        self._read(source)

    def _read(self, s: str) -> None:
        at, n = 0, len(s)
        while at < n:
            lt = s.find("<", at)
            if lt < 0:
                self._text(s[at:])
                break
            if lt > at:
                self._text(s[at:lt])
            tag = _TAG.match(s, lt)
            if tag:
                at = self._tag(s, tag)
            elif s.startswith("<!--", lt):
                end = s.find("-->", lt + 2)
                at = end + 3 if end >= 0 else n
            elif s.startswith(("<!", "<?", "</"), lt):
                end = s.find(">", lt)
                at = end + 1 if end >= 0 else n
            else:
                self._text("<")
                at = lt + 1
        self._flush()

    def _tag(self, s: str, tag: re.Match) -> int:
        """Handle the tag at the match and return where text goes on."""
        name, at, n, found = tag[2].lower(), tag.end(), len(s), {}
        while True:
            part = _ATTRIBUTE.match(s, at)
            if part is None or part[6]:  # the page ends within the tag
                return n
            at = part.end()
            if part[1]:
                break
            if part[2]:
                found.setdefault(part[2].lower(), next((x for x in part.group(3, 4, 5) if x is not None), ""))
        if tag[1]:
            self._end(name)
            return at
        self._start(name, found)
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(s, at)
            self._end(name)
            if close is None:  # closed in itself, as in XHTML, or never
                return at if s[at - 2] == "/" else n
            end = s.find(">", close.end())
            return end + 1 if end >= 0 else n
        return at

    def _text(self, text: str) -> None:
        if not self.out[self.open[-1]]:
            self._held.append(decoded(text))
            if self._links:
                self._linked += len(text)

    def _flush(self) -> None:
        if self._held:
            text = " ".join("".join(self._held).split())
            if text:
                at = self.open[-1]
                while not self.block[at]:
                    at = self.parent[at]
                self.leaves.append((at, text, min(self._linked, len(text))))
            self._held, self._linked = [], 0

    def _start(self, name: str, attributes: dict[str, str]) -> None:
        for ended, beginning, between in _IMPLIED:
            if name in beginning and any(self.count.get(e) for e in ended):
                self._close(ended, between)
        if name in VOID or name in ("html", "body") and self.count.get(name):
            if name == "br":
                self._text(" ")
            elif name not in INLINE:
                self._flush()
            return
        above = self.open[-1]
        named = name not in _WHOLE and (name in WRAPPERS or self._called(name, attributes) or name == "header" and not (self.count.get("article") or self.count.get("main")))
        block = name not in INLINE or named
        if block:
            self._flush()
        classes = attributes.get("class", "").split()
        self.parent.append(above)
        self.tag.append(name)
        self.path.append(self.paths.setdefault((self.path[above], ".".join([name, *classes[:1]])), len(self.paths) + 1) if block else self.path[above])
        self.block.append(block)
        self.named.append(named)
        self.out.append(self.out[above] or name in OUT)
        self.open.append(len(self.tag) - 1)
        self.count[name] = self.count.get(name, 0) + 1
        self._links += name == "a"

    @staticmethod
    def _called(name: str, attributes: dict[str, str]) -> bool:
        """A class, id or role names a part that isn't the article.

        An ``article`` is taken for such only where the name begins with the word, as its classes also tell topics.
        """
        for a in ("class", "id", "role"):
            for token in attributes.get(a, "").split():
                words = [w.lower() for w in _WORDS.findall(token)]
                if name == "article":
                    words = words[:1]
                if any(w in NAMED and (not i or words[i - 1] not in _WITH) for i, w in enumerate(words)):
                    return True
                if words in (["header"], ["site", "header"], ["global", "header"], ["top", "header"]):
                    return True
        return False

    def _end(self, name: str) -> None:
        if self.count.get(name) and name not in ("html", "body"):
            self._close({name}, set() if name in _SCOPE or name == "tr" else _SCOPE)

    def _close(self, names: set[str], between: set[str] | frozenset[str]) -> None:
        """Close the innermost open element of these names with all in it, unless one of the others is between.

        The end of an inline element doesn't reach out of a block.
        """
        inline = names <= INLINE
        for k in range(len(self.open) - 1, 0, -1):
            at = self.open[k]
            if self.tag[at] in names:
                break
            if self.tag[at] in between or inline and self.block[at]:
                return
        else:
            return
        if any(self.block[at] for at in self.open[k:]):
            self._flush()
        for at in self.open[k:]:
            self.count[self.tag[at]] -= 1
            self._links -= self.tag[at] == "a"
        del self.open[k:]

    def within(self, tag: str) -> list[bool]:
        """Elements that are in one of this tag, or are one."""
        held = [False] * len(self.tag)
        for i in range(1, len(held)):
            held[i] = held[self.parent[i]] or self.tag[i] == tag
        return held

    def barred(self, forms: bool = True) -> list[bool]:
        """Elements that are out, by tag or by name; ``forms`` takes forms for such."""
        holds = _below(self, [t in ("article", "main") and not n for t, n in zip(self.tag, self.named, strict=True)])
        out = list(self.out)
        for i in range(1, len(out)):
            out[i] = out[i] or out[self.parent[i]] or self.named[i] and not holds[i] and (forms or self.tag[i] != "form")
        return out


def _below(page: Page, own: Iterable[float]) -> list[float]:
    """Sums of a figure over every element and all in it; an element comes after its parent."""
    total = list(own)
    for i in range(len(total) - 1, 0, -1):
        total[page.parent[i]] += total[i]
    return total


def ratios(path: np.ndarray, length: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The fused, smoothed ratio of every leaf."""
    _, place, count = np.unique(path, return_inverse=True, return_counts=True)
    reach = int(3 * SIGMA + 0.5)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    weight = np.convolve(np.ones(len(path)), kernel)[reach : len(path) + reach]
    text, point = (np.convolve((np.bincount(place, x) / count)[place], kernel)[reach : len(path) + reach] / weight for x in (length, marks))
    return text * (1 + point)


def _lowest(page: Page, element: np.ndarray, mass: np.ndarray) -> int:
    """The lowest element that holds nearly all of the mass and isn't a paragraph itself."""
    own = np.bincount(element, mass, len(page.tag)).tolist()
    whole = _below(page, own)
    children: list[list[int]] = [[] for _ in own]
    for i in range(1, len(own)):
        children[page.parent[i]].append(i)
    top = 0
    while True:
        into = max(children[top], key=lambda i: whole[i], default=None)
        if into is None or whole[into] < SHARE * whole[0] or 2 * own[into] >= whole[into]:
            return top
        top = into


def extract_page(source: str | None) -> tuple[str, int, int]:
    """Text, number of leaves, and number of content nodes of a page."""
    page = Page(source or "")
    out = page.barred()
    if all(out[e] for e, _, _ in page.leaves):  # a form around the whole page
        out = page.barred(forms=False)
    leaves, marked = [x for x in page.leaves if not out[x[0]]], False
    for tag in ("article", "main"):
        held = page.within(tag)
        if any(held[e] for e, _, _ in leaves):
            leaves, marked = [x for x in leaves if held[x[0]]], True
            break
    if not leaves:
        return "", len(page.leaves), 0
    element = np.array([e for e, _, _ in leaves])
    length = np.array([len(t) - k for _, t, k in leaves], np.float64)
    marks = np.array([len(_PUNCTUATION.findall(t)) for _, t, _ in leaves], np.float64)
    score = ratios(np.array(page.path)[element], length, marks)
    content = score >= LEAST * score.std()
    top = chosen = _lowest(page, element, np.where(content, np.maximum(length, 1), 0))
    while top:
        if page.tag[top] == "article":
            chosen = top
        top = page.parent[top]
    inside = [False] * len(page.tag)
    for i in range(len(inside)):
        inside[i] = i == chosen or i > 0 and inside[page.parent[i]]
    heads = [i for i, e in enumerate(element) if page.tag[e] == "h1"]
    title = None if marked or any(inside[element[i]] for i in heads) else max((i for i in heads if element[i] < chosen), default=None)
    texts = [t for i, (e, t, _) in enumerate(leaves) if inside[e] or not marked and content[i] or i == title]
    return " ".join(texts), len(page.leaves), int(content.sum())


def extract(pages: DataFrame, html: str = "html", keep: Iterable[str | Column] = ("page_id", "url")) -> DataFrame:
    """The kept columns, the main text, and the numbers of leaves and of content nodes of every page."""
    rows = with_text(pages, html, keep, *MADE)
    kept = rows.schema.fields[1:]
    names = [f"c{j}" for j in range(len(kept))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, leaves, content = zip(*map(extract_page, batch.column(0).to_pylist()), strict=True) if batch.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(text, pa.string()), pa.array(leaves, pa.int64()), pa.array(content, pa.int64())], [*names, *MADE])

    schema = ", ".join([*(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, kept, strict=True)), "text string, n_leaves bigint, n_content bigint"])
    return map_arrow(rows.toDF("html", *names), work, schema).toDF(*(f.name for f in kept), *MADE)
