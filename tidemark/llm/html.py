"""Main text of web pages by two passes over their blocks.

A page is cut into blocks at block-level tags.  The first pass judges every block by itself: what stands in a menu,
footer, form, advert or other part that says what it is, is not text; of the others, a long block with
many stop words and few links is text, and one made of links is not.  Short blocks, and long ones without
stop words, stay open.  In the second pass they take the label of the nearest decided neighbour on the page;
the borders of an article count as decided neighbours too.
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
from pyspark.sql import types as T

from .shared import quoted, short_batches

# Frequent function words, by language.
STOP_WORDS = frozenset(
    """
    the of and to in a is it that for on with as was by be this are from or an at not have which
    le la les de des du et un une est que qui en dans pour sur au aux par pas ne se ce il elle
    der die das und den dem ein eine ist nicht mit zu von im sich auf für als auch es wird
    el los las y del que en un una es por con para su al lo se no como más
    """.split()
)
#: Characters of a block that is judged by its stop words, and their least share in a block that is text.
LONG, DENSE = 70, 0.15
#: Share of a block's characters in links from which it is no text, and from which it is none unless stop words are dense.
LINKED, SOME_LINKS = 0.6, 0.3

# Elements by what they do to blocks.
#: Start and end a block.
BLOCKS = frozenset(
    """
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset
    h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td
    tfoot th thead tr ul
    """.split()
)
#: Hold no text of the page, whatever is in them.
SKIPPED = frozenset("script style noscript template iframe object embed applet svg math canvas audio video title textarea select button datalist noframes".split())
#: Of these, the ones that end at their own end tag alone.
RAW = frozenset("script style noscript template iframe title textarea noframes".split())
#: Are parts beside the text.
ASIDE = frozenset("nav footer aside form menu dialog header search".split())
#: Never have an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
#: Words in a class or id that say that a part is beside the text.
ASIDE_NAMES = frozenset(
    """
    ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb
    breadcrumbs footer header masthead sidebar aside widget widgets related recommended share sharing social comment comments disqus
    reply replies respond cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup
    login search pagination pager toolbar skip copyright disclaimer teaser
    """.split()
)
#: Words in front of these that take it back, as in "no-sidebar".
WITHOUT = frozenset("no has with without hide open closed".split())
#: Names of a part that is the text.
ARTICLE_NAMES = frozenset(
    """
    article article-body article-content articlebody content entry entry-content main main-content post post-body post-content story
    story-body
    """.split()
)
#: Elements that the start of another one ends.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_WORD = re.compile(r"[^\W\d_]+")

TEXT, OTHER, OPEN = 1, 0, -1


class Block(NamedTuple):
    """A run of text, the share of it in links, whether it is a heading, in which part it stands and in which element."""

    text: str
    linked: float
    heading: bool
    part: int
    box: int


def _tag_end(page: str, at: int) -> int:
    """Past the end of the tag that starts at ``at``, which quoted values may hold a ``>`` of."""
    end = page.find(">", at)
    if end < 0:
        return len(page)
    quote = min((q for q in (page.find('"', at, end), page.find("'", at, end)) if q >= 0), default=-1)
    while 0 <= quote < end:
        if page[quote - 1] != "=" and not page[at:quote].rstrip().endswith("="):
            quote = min((q for q in (page.find('"', quote + 1, end), page.find("'", quote + 1, end)) if q >= 0), default=-1)
            continue
        close = page.find(page[quote], quote + 1)
        if close < 0:
            return end + 1
        if close > end:
            end = page.find(">", close)
            if end < 0:
                return len(page)
        quote = min((q for q in (page.find('"', close + 1, end), page.find("'", close + 1, end)) if q >= 0), default=-1)
    return end + 1


def _attributes(tag: str) -> dict[str, str]:
    found = {}
    for m in _ATTRIBUTE.finditer(tag, _NAME.match(tag).end()):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return found


def _says_aside(names: str) -> bool:
    for name in names.split():
        parts = [x.lower() for x in _PARTS.findall(name)]
        if any(x in ASIDE_NAMES and not (k and parts[k - 1] in WITHOUT) for k, x in enumerate(parts)):
            return True
    return False


def _part(name: str, tag: str, inside: int) -> int:
    """The part that an element's content stands in: TEXT in an article, OTHER beside the text, OPEN elsewhere."""
    if inside == OTHER and name != "main":
        return OTHER
    own = _attributes(tag) if len(tag) > len(name) + 3 else {}
    role, names = own.get("role", "").lower(), f"{own.get('class', '')} {own.get('id', '')}"
    style = own.get("style", "").replace(" ", "").lower()
    if "hidden" in own or own.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style:
        return OTHER
    if name in ("html", "body"):
        return inside
    if name in ("article", "main") or role in ("main", "article") or own.get("itemprop", "").lower() == "articlebody":
        return OTHER if name != "main" and {x.lower() for x in names.split()} & ASIDE_NAMES else TEXT
    if name in ASIDE or role in ASIDE_ROLES or _says_aside(names):
        return OTHER
    return TEXT if {x.lower() for x in names.split()} & ARTICLE_NAMES else inside


class _Reader:
    """Cuts a page into blocks."""

    def __init__(self, page: str):
        self.page, self.found = page, []
        self.pieces: list[str] = []
        self.linked: list[str] = []
        #: Open elements: name, number, and the parts outside of it.
        self.stack: list[tuple[str, int, int, int]] = []
        self.depth: Counter = Counter()
        self.part = self.headed = OPEN
        self.paragraph: int | None = None
        self.number = self.breaks = 0
        self.in_link = self.heading = False
        self.missing: set[str] = set()

    def read(self) -> list[Block]:
        page, at = self.page, 0
        while at < len(page):
            start = page.find("<", at)
            if start < 0:
                break
            self.add(page[at:start])
            at = self.markup(start)
        self.add(page[at:])
        self.cut()
        return self.found

    def add(self, text: str) -> None:
        if text:
            self.pieces.append(text)
            if self.in_link:
                self.linked.append(text)
            if self.breaks and not text.isspace():
                self.breaks = 0

    def cut(self) -> None:
        """The block that was open ends."""
        if self.pieces:
            text = _one_line(self.pieces)
            if text:
                part = self.headed if self.heading else self.part if self.paragraph is None else self.paragraph
                linked = min(len(_one_line(self.linked)) / len(text), 1.0) if self.linked else 0.0
                self.found.append(Block(text, linked, self.heading, part, self.stack[-1][1] if self.stack else 0))
            self.pieces, self.linked = [], []
        self.paragraph, self.breaks = None, 0

    def past(self, what: str, start: int) -> int:
        """Past the next ``what``, or the end of the page; what is not there is looked for once."""
        if what in self.missing:
            return len(self.page)
        found = self.page.find(what, start)
        if found < 0:
            self.missing.add(what)
            return len(self.page)
        return found + len(what)

    def markup(self, start: int) -> int:
        """Reads what starts with ``<``; gives where to go on."""
        page = self.page
        follows = page[start + 1 : start + 2]
        if follows in ("!", "?"):
            if page.startswith("<!--", start):
                return start + 5 if page.startswith("<!-->", start) else self.past("-->", start + 4)
            return self.past("]]>" if page.startswith("<![CDATA[", start) else ">", start)
        match = _NAME.match(page, start)
        if not match:
            if follows == "/":
                return self.past(">", start)
            self.add("<")
            return start + 1
        end = _tag_end(page, start)
        name, closing = match[1].lower(), follows == "/"
        if name == "br":
            self.breaks += 1
            if self.breaks > 1:
                self.cut()
                self.breaks = 2
            self.pieces.append(" ")
        elif name == "a":
            self.in_link = not closing
        elif name in SKIPPED and not closing and name not in VOID:
            self.pieces.append(" ")
            if page[end - 2 : end] != "/>":
                return self.skipped(name, end)
        elif name in BLOCKS:
            self.cut()
            self.element(name, closing, page[start:end])
        return end

    def element(self, name: str, closing: bool, tag: str) -> None:
        if name == "p" or name in HEADINGS:
            self.in_link = False
            self.heading = not closing and name != "p"
            if not closing and name == "p" and "=" in tag:
                self.paragraph = _part(name, tag, self.part)
        elif closing:
            if self.depth[name]:
                self.leave(name)
        elif name not in VOID:
            if self.stack and self.stack[-1][0] in ENDS.get(name, ()):
                self.leave(self.stack[-1][0])
            self.number += 1
            self.stack.append((name, self.number, self.part, self.headed))
            self.depth[name] += 1
            inside = _part(name, tag, self.part)
            # the header of an article holds its headings
            self.headed = TEXT if name == "header" and self.part == TEXT else inside
            self.part = inside

    def leave(self, name: str) -> None:
        self.heading = self.in_link = False
        while self.stack:
            own, _, self.part, self.headed = self.stack.pop()
            self.depth[own] -= 1
            if own == name:
                return

    def skipped(self, name: str, at: int) -> int:
        """Past the end tag of an element without text.  One that is not closed holds the rest of the page if raw, nothing else."""
        end = None if name in self.missing else re.compile(rf"</{name}[\s/>]", re.I).search(self.page, at)
        if end is None:
            self.missing.add(name)
            return len(self.page) if name in RAW else at
        return _tag_end(self.page, end.start())


def _one_line(pieces: list[str]) -> str:
    return " ".join(html.unescape("".join(pieces)).split())


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, without empty ones.  Broken markup is read as far as it goes."""
    return _Reader(page).read()


def first_label(block: Block) -> int:
    """TEXT, OTHER or, where a block by itself does not show it, OPEN."""
    if block.part == OTHER:
        return OTHER
    if block.text[0] == "©":
        return OTHER
    words = _WORD.findall(block.text.lower())
    density = sum(word in STOP_WORDS for word in words) / len(words) if words else 0.0
    if block.linked >= LINKED or block.linked >= SOME_LINKS and density < DENSE:
        return OTHER
    if not block.heading and len(block.text) >= LONG and density >= DENSE:
        return TEXT
    return OPEN


def _sides(found: list[Block], first: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """For every block the distance and label of the nearest decided neighbour before it and after it.

    Neighbours in the same element come before any other.  Parts beside the text within an article are passed over, and
    its borders count as text half a block away.
    """
    n = len(found)
    near: list[list[tuple[float, int]]] = []
    for order in (range(n), range(n - 1, -1, -1)):
        side: list[tuple[float, int]] = [(math.inf, OPEN)] * n
        in_box: dict[int, tuple[int, int]] = {}
        at, label, last = -math.inf, OPEN, OPEN
        for step, k in enumerate(order):
            block = found[k]
            if block.part != OTHER and block.part != last:
                if block.part == TEXT or last == TEXT:
                    at, label = step - 0.5, block.part == TEXT
                last = block.part
            if block.box in in_box and block.part != TEXT:
                side[k] = step - in_box[block.box][0], in_box[block.box][1]
            elif label != OPEN:
                side[k] = step - at + (n if block.part != TEXT else 0), int(label)
            if first[k] != OPEN and not (block.part == OTHER and last == TEXT):
                at, label = step, first[k]
                if block.part != OTHER:
                    in_box[block.box] = step, first[k]
        near.append(side)
    for one, two in zip(*near):
        yield *one, *two


def labels(found: list[Block]) -> list[int]:
    """TEXT or OTHER for every block: its own label, or that of the nearest decided neighbour.

    Where neighbours before and after disagree, an open block in an article is text; elsewhere the nearer one decides, and
    at equal distance a heading goes with what follows and any other block with the text.  Where articles hold most of a
    page's text, what stands outside them is no text.  Where nothing is text, open blocks are.
    """
    first = [first_label(block) for block in found]
    inside = sum(len(block.text) for block, label in zip(found, first) if block.part == TEXT and label != OTHER)
    outside = sum(len(block.text) for block, label in zip(found, first) if block.part == OPEN and label == TEXT)
    if not inside and not outside:
        return [OTHER if label == OTHER else TEXT for label in first]
    if inside >= outside:
        first = [label if block.part == TEXT else OTHER for block, label in zip(found, first)]
    out = []
    for block, label, (left, one, right, two) in zip(found, first, _sides(found, first)):
        if label == OPEN:
            if one == two or OPEN in (one, two):
                label = max(one, two)
            elif block.part == TEXT or left == right and not block.heading:
                label = TEXT
            else:
                label = one if left < right else two
        out.append(label)
    return out


def main_text(page: str) -> str:
    """The blocks that are text, joined by line breaks."""
    found = blocks(page)
    return "\n".join(block.text for block, label in zip(found, labels(found)) if label == TEXT)


def extract_text(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, url, text, n_chars (code points of the text).

    The text is that of the article: no menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles,
    markup or reader comments.  Character references are decoded, white space within a block is one space,
    blocks are joined by one line break in the order of the page, and nothing else is dropped or cut.  A line break
    within a paragraph is white space, two or more in a row end the block.  Null and empty pages, and pages without
    any text, give an empty text; a page without tags is one block.  Rows that repeat give a row each, a null id or url
    stays null, and an empty table gives an empty result.  Other columns are not looked at.
    """
    short_batches(pages.sparkSession)
    rows = pages.select(quoted(id).alias("id"), quoted(url).alias("url"), quoted(html).alias("html"))
    schema = T.StructType([rows.schema["id"], rows.schema["url"]]).add("text", T.StringType()).add("n_chars", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py() or "") for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], schema.names
            )

    return rows.mapInArrow(run, schema).withColumnsRenamed({"id": id, "url": url})
