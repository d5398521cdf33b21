"""Main text of web pages by two passes of rules over their blocks.

The page is read once, tag by tag, into blocks of running text. The first pass decides a block by its surroundings
(menus, forms, notices and the like), by the share of its characters inside links, by its length and by its share of
stop words. What stays ambiguous, mostly short blocks, takes the label of the nearest decided neighbours in the second
pass. Spark deals the pages over tasks; a task holds one batch of pages at a time.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Frequent words of the languages that pages are expected in.
STOP_WORDS = frozenset(
    """
    a an and are as at be but by for from has have he in is it its not of on or that the they this to was were which with you
    au aux avec ce ces dans des du elle en est et il la le les mais ne ou par pas pour que qui se sur un une
    aber als auch auf aus bei das dem den der des die ein eine er für ich im ist mit nicht sich sie sind und von wie zu
    al como con de del el ella en era es está la las lo los más no para pero por que se sin su sus una y
    """.split()
)
# Elements by their part in a page.
RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE = frozenset("nav aside form button select option footer dialog menu svg object head".split())
ARTICLE = frozenset("article main".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An element that opens ends an open one of these kinds, up to the nearest of those.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
# Words in class, id or role that name what is not part of an article.
MARKS = frozenset(
    """
    ad ads adv advert adverts advertisement advertising adbox adslot banner breadcrumb breadcrumbs comment comments commentlist
    complementary consent contentinfo cookie cookies copyright discussion disqus footer gdpr login masthead menu menubar modal nav
    navbar navigation newsletter notice notification pager pagination popup popover promo promoted promotion related
    replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe tagcloud toolbar
    topbar widget widgets alert dialog responses
    """.split()
)
# Such words beside "header" name the head of an article, not of the page.
OWN_HEAD = frozenset("article entry post content title story".split())
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
TAG_START = re.compile(r"</?[a-zA-Z]")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Rules:
    """Limits of the first pass: shares of characters or words, lengths in code points."""

    links: float = 0.33
    short: int = 70
    long: int = 200
    stop_low: float = 0.15
    stop_high: float = 0.30
    stop_words: frozenset[str] = STOP_WORDS


@dataclass
class Block:
    text: str
    linked: int
    aside: bool
    inside: bool
    heading: bool
    parent: int
    label: str = ""


def marked(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element's class, id, role or visibility takes it out of the article."""
    if not attributes or name in ("html", "body"):
        return False
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        if key == "style" and HIDDEN.search(value):
            return True
        if key in ("class", "id", "role"):
            for item in value.split():
                parts = {p.lower() for p in NAME_PART.findall(item)}
                if name not in ARTICLE and parts & MARKS and not (key != "role" and parts & OWN_HEAD):
                    return True
                if name in ARTICLE and parts & {"comment", "comments", "reply"}:
                    return True
                if "header" in parts and not inside and not parts & OWN_HEAD:
                    return True
    return False


class Element(NamedTuple):
    """An open element: what holds inside it, and the numbers of the two nearest block elements."""

    name: str
    aside: bool
    inside: bool
    link: bool
    block: int
    parent: int


OUTSIDE = Element("", False, False, False, 0, 0)


class Reader:
    """Blocks of one page. Unclosed and misplaced tags are taken as browsers do, as far as blocks depend on it."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.open: list[Element] = []
        self.count = 0
        self.parts: list[str] = []
        self.linked = 0
        self.heading = False

    def text(self, raw: str) -> None:
        if raw:
            value = html.unescape(raw) if "&" in raw else raw
            self.parts.append(value)
            if self.open and self.open[-1].link:
                self.linked += sum(map(len, value.split()))

    def flush(self) -> None:
        if self.parts:
            value = " ".join("".join(self.parts).split())
            if value:
                around = self.open[-1] if self.open else OUTSIDE
                self.blocks.append(
                    Block(value, self.linked, around.aside, around.inside, self.heading, around.parent)
                )
            self.parts, self.linked = [], 0

    def close_to(self, at: int) -> None:
        del self.open[at:]
        self.heading = bool(self.open) and any(e.name in HEADINGS for e in self.open)

    def last_open(self, names, barrier=frozenset()) -> int:
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at].name in names:
                return at
            if self.open[at].name in barrier:
                return -1
        return -1

    def start(self, name: str, attributes: str) -> None:
        if name == "br":
            self.parts.append(" ")
            return
        if name in BLOCK:
            self.flush()
            # A paragraph ends where a block starts; what was open inside it goes with it.
            at = self.last_open({"p"}, BLOCK - {"p"})
            if at >= 0:
                self.close_to(at)
        if name in ENDS:
            at = self.last_open(*ENDS[name])
            if at >= 0:
                self.close_to(at)
        if name in VOID or (attributes.endswith("/") and name not in BLOCK and name != "a"):
            return
        if name == "a":  # links do not nest
            at = self.last_open({"a"}, BLOCK)
            if at >= 0:
                self.close_to(at)
        around = self.open[-1] if self.open else OUTSIDE
        out = name in ASIDE or (name == "header" and not around.inside) or marked(name, attributes, around.inside)
        inside = (around.inside or name in ARTICLE or "articleBody" in attributes) and not out
        link, block, parent = name == "a" or around.link, around.block, around.parent
        if name in BLOCK:
            self.count += 1
            link, block, parent = False, self.count, around.block  # a link that was never closed ends at a block
        self.open.append(Element(name, around.aside or out, inside, link, block, parent))
        self.heading = self.heading or name in HEADINGS

    def end(self, name: str) -> None:
        if name in ("br", "p") and self.last_open({name}) < 0:
            self.flush() if name == "p" else self.parts.append(" ")
            return
        at = self.last_open({name}, frozenset() if name in BLOCK else BLOCK)
        if name in BLOCK:
            self.flush()
        if at >= 0:
            self.close_to(at)

    def read(self, page: str) -> list[Block]:
        at, tag = 0, TAG
        while True:
            found = page.find("<", at)
            if found < 0:
                self.text(page[at:])
                break
            if page.startswith("<!--", found):
                self.text(page[at:found])
                stop = page.find("-->", found + 4)
                at = len(page) if stop < 0 else stop + 3
            elif page[found + 1 : found + 2] in ("!", "?"):
                self.text(page[at:found])
                stop = page.find(">", found)
                at = len(page) if stop < 0 else stop + 1
            else:
                hit = tag.match(page, found)
                named = hit is not None or TAG_START.match(page, found)
                if hit is None and named and tag is TAG:
                    # An unmatched quotation mark: from here on a tag ends at the first sign that can end it.
                    tag = LOOSE_TAG
                    hit = tag.match(page, found)
                if hit is None:
                    if named:  # cut off inside a tag
                        self.text(page[at:found])
                        break
                    self.text(page[at : found + 1])
                    at = found + 1
                    continue
                self.text(page[at:found])
                at, name = hit.end(), hit.group(2).lower()
                if hit.group(1):
                    self.end(name)
                elif name in RAW:
                    if name in BLOCK:
                        self.flush()
                    stop = re.compile(f"</{re.escape(name)}", re.I).search(page, at)
                    closing = page.find(">", stop.end()) if stop else -1
                    at = closing + 1 if closing >= 0 else len(page)
                else:
                    self.start(name, hit.group(3))
        self.flush()
        return self.blocks


def first_pass(block: Block, rules: Rules) -> str:
    """good, bad, near (good beside good) or short (ambiguous) by the block alone."""
    if block.aside:
        return "bad"
    letters = len(block.text) - block.text.count(" ")
    if block.linked > rules.links * max(letters, 1):
        return "bad"
    if "©" in block.text and len(block.text) < rules.long:
        return "bad"
    if len(block.text) < rules.short:
        return "bad" if block.linked and not block.inside else "short"
    words = WORD.findall(block.text.lower())
    stops = sum(map(rules.stop_words.__contains__, words))
    if stops >= rules.stop_high * max(len(words), 1):
        return "good" if len(block.text) > rules.long else "near"
    if stops >= rules.stop_low * max(len(words), 1):
        return "near"
    # Figures, code and languages without known stop words are no evidence against a block inside an article.
    return "short" if block.inside else "bad"


def decided(labels: list[str], ambiguous: str, edge: str) -> list[tuple[tuple[int, str], tuple[int, str]]]:
    """For each block the nearest one before and after it whose label is not ambiguous: (place, label), or the edge."""
    sides = []
    for step in (1, -1):
        side, last = [], (-1 if step > 0 else len(labels), edge)
        for at in range(len(labels))[::step]:
            side.append(last)
            if labels[at] not in ambiguous:
                last = (at, labels[at])
        sides.append(side[::step])
    return list(zip(*sides, strict=True))


def settle(blocks: list[Block], edge: str) -> None:
    """Second pass over a stretch of blocks, with the label that holds beyond its ends.

    Blocks of middling stop-word share are good beside a good one, or where no block is good. Then short blocks take
    the label of their decided neighbours; where these differ, of the one under the same parent, else of the nearer
    one, else good. A heading follows the block after it.
    """
    labels = [b.label for b in blocks]
    lonely = "good" not in labels
    for b, ((_, before), (_, after)) in zip(blocks, decided(labels, "short near", edge), strict=True):
        if b.label == "near":
            b.label = "good" if lonely or "good" in (before, after) else "bad"
    labels = [b.label for b in blocks]
    for at, (first, then) in enumerate(decided(labels, "short", edge)):
        b = blocks[at]
        if b.label != "short":
            continue
        if b.heading or first[1] == then[1]:
            b.label = then[1]
            continue
        kin = [0 <= place < len(blocks) and blocks[place].parent == b.parent for place, _ in (first, then)]
        if kin[0] != kin[1]:
            b.label = first[1] if kin[0] else then[1]
        elif at - first[0] != then[0] - at:
            b.label = first[1] if at - first[0] < then[0] - at else then[1]
        else:
            b.label = "good"


def classify(blocks: list[Block], rules: Rules) -> None:
    """Labels every block good or bad.

    An article that a page marks as such is the whole content, unless it holds no running text and other blocks do;
    its ambiguous blocks look no further than its own edges, which count as good. On other pages edges count as bad.
    """
    for b in blocks:
        b.label = first_pass(b, rules)
    article = [b for b in blocks if b.inside and b.label != "bad"]
    if any(b.label != "short" for b in article) or (article and all(b.label in ("short", "bad") for b in blocks)):
        stretch: list[Block] = []
        for b in [*blocks, None]:
            if b is not None and b.inside:
                stretch.append(b)
                continue
            if stretch:
                settle(stretch, "good")
                stretch = []
            if b is not None:
                b.label = "bad"
    else:
        settle(blocks, "bad")


def blocks_of(page: str | None, rules: Rules = Rules()) -> list[Block]:
    blocks = Reader().read(page or "")
    classify(blocks, rules)
    return blocks


def extract(pages: DataFrame, column: str = "html", rules: Rules = Rules()) -> DataFrame:
    """Every page as the struct ``row`` with its main text and its blocks.

    Adds ``text`` (good blocks in page order, joined by two line feeds; empty if there is none), ``n_chars`` (code
    points of it) and ``blocks`` (array of text, linked: characters inside links, good). White space inside a block is
    one space, a line break too; character references are decoded as browsers do.

    Null and empty pages give an empty text and no blocks. Pages are read whole, whatever their length. Repeated rows
    each keep their own result, and columns of any name stay inside ``row``. No row depends on another.
    """
    block = T.StructType().add("text", T.StringType()).add("linked", T.IntegerType()).add("good", T.BooleanType())
    schema = (
        T.StructType()
        .add("row", pages.schema)
        .add("text", T.StringType())
        .add("n_chars", T.LongType())
        .add("blocks", T.ArrayType(block))
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks_of(page, rules) for page in batch.column("html").to_pylist()]
            texts = ["\n\n".join(b.text for b in blocks if b.label == "good") for blocks in found]
            listed = [[{"text": b.text, "linked": b.linked, "good": b.label == "good"} for b in bs] for bs in found]
            kinds = pa.list_(pa.struct([("text", pa.string()), ("linked", pa.int32()), ("good", pa.bool_())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(listed, kinds),
                ],
                ["row", "text", "n_chars", "blocks"],
            )

    named = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), F.col(column).alias("html"))
    return named.mapInArrow(read, schema)
