"""Main text of web pages by two passes over blocks.

A page is read as a sequence of blocks, runs of text between block-level tags, each with its stop-
word density, length, share of text inside links, and the place it stands in.

First pass, block by block: blocks in boilerplate places (menus, headers, footers, sidebars,
notices, adverts, forms, comments) and blocks mostly made of links are bad; long blocks rich in stop
words are good; blocks of an article or main element are good if rich in stop words; everything else
is undecided. A place is known by its element or by a class, id or role that is about nothing else
("site-footer", "comment-list", but not "share-price" or "with-sidebar"); headings are never judged by
theirs. An element named for a part of the layout is taken by its word only if it holds no
article and less than half of the page's text. A name that only contains such a word makes a block doubtful:
outside of an article it is bad unless long and rich. Where most of a page's long text is not
rich in the stop words of any list, its language is not among them, and long blocks are good by length
and links alone. Where a page has an article with text, blocks outside of it are bad as long as what
could be main text out there is less than a quarter of the article's text; else the article is one
part of the page among others.

Second pass: an undecided block takes the label of its nearest decided neighbours. Inside an
article the article itself counts as a good one, and only a short block between two bad ones of the
article, which outvote it, is bad; elsewhere the ends of a page with
good blocks count as bad, and between two different neighbours, or where nothing is decided, its
own stop words settle it, or its length if the page's language is not known. On a page of a few
short lines, none of them good, every line that holds a word and no copyright is good.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Frequent function words of four languages.
STOP_WORDS = frozenset(
    "a about after all also an and any are as at be been but by can could do for from had has have he her his how"
    " i if in into is it its more no not of on one or other our out she so some such than that the their them then"
    " there these they this to up was we were what when which who will with would you your"
    " aber als am an auch auf aus bei bin bis da das dass dem den der des die durch ein eine einem einen einer er es"
    " für hat ich ihr im in ist ja kann mit nach nicht noch nur oder sein sich sie sind so über um und uns unter von"
    " vor war was wenn wie wir wird zu zum zur"
    " au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas"
    " plus pour qu que qui sa se ses son sont sur un une vous y été être"
    " al como con cuando de del desde donde el ella en entre era es esta este fue ha hasta hay la las lo los me mi"
    " muy más no o para pero por porque que se ser si sin sobre son su sus también un una y ya".split()
)

# Elements.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center col colgroup dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main"
    " menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(
    "script style textarea title noscript iframe xmp template svg object canvas annotation annotation-xml".split()
)
PLACES = frozenset("nav header footer aside form dialog menu button select".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Words of class, id and role attributes, and what a whole name around them says.
LAYOUT_WORDS = frozenset(
    "banner popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead"
    " share sharing social toolbar pagination pager widget widgets contentinfo complementary search alert dialog".split()
)
NOTICE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies"
    " consent gdpr notice newsletter subscribe subscription signup login paywall copyright".split()
)
SIDE_WORDS = frozenset(
    "comment comments disqus discussion respond reply replies related recommended recommendations teaser".split()
)
BAD_WORDS = LAYOUT_WORDS | NOTICE_WORDS | SIDE_WORDS
GOOD_WORDS = frozenset("article content post entry story main".split())
PLAIN_WORDS = frozenset(
    "area articles bar block body bottom box center col column container content entries first form group holder"
    " inner item items last left link links list main outer page panel posts primary region right row secondary"
    " section site slot stories text thread title top unit wrap wrapper".split()
)
WITHOUT_WORDS = frozenset("has hide is js no not show with without".split())
ROOTS = ("comment", "sidebar", "newsletter", "breadcrumb", "advert")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_WORD = re.compile(r"[^\W\d_]+")
# Characters that say as much as about three letters: Chinese, Japanese, Korean.
_WIDE = re.compile("[\u2e80-\ufaff]")


@dataclass
class Block:
    text: str
    link_chars: int
    n_links: int
    bad_place: bool
    in_article: bool
    heading: bool
    doubtful: bool = False
    label: str = ""


@dataclass
class _Open:
    """An open element and what it counts for while it is open."""

    name: str
    hard: bool = False
    header: bool = False
    article: bool = False
    doubtful: bool = False
    #: Number of its span, for an element that its content may clear.
    span: int = -1


class _Stack:
    """Open elements, with counts of what stands around a place, so that no tag looks at all of them."""

    def __init__(self) -> None:
        self.items: list[_Open] = []
        self.places: dict[str, list[int]] = {}
        self.hard = self.headers = self.articles = self.headings = self.doubtful = 0
        #: Of every element that its content may clear: first block, block after its last, characters, articles.
        self.spans: list[list[int]] = []
        self.blocks = self.chars = self.articles_seen = 0

    def _count(self, o: _Open, by: int) -> None:
        self.hard += by * o.hard
        self.headers += by * o.header
        self.articles += by * o.article
        self.headings += by * (o.name in HEADINGS)
        self.doubtful += by * o.doubtful

    def push(self, o: _Open) -> None:
        if o.span >= 0:
            o.span = len(self.spans)
            self.spans.append([self.blocks, -1, -self.chars, -self.articles_seen])
        self.articles_seen += o.article and o.name in ("article", "main")
        self.places.setdefault(o.name, []).append(len(self.items))
        self.items.append(o)
        self._count(o, 1)

    def last(self, name: str) -> int:
        found = self.places.get(name)
        return found[-1] if found else -1

    def cut(self, place: int) -> None:
        """Close the element at a place and all inside it."""
        while len(self.items) > place >= 0:
            o = self.items.pop()
            self.places[o.name].pop()
            self._count(o, -1)
            if o.span >= 0:
                span = self.spans[o.span]
                span[1] = self.blocks
                span[2] += self.chars
                span[3] += self.articles_seen

    def uncleared(self) -> list[bool]:
        """Of every block whether it stands in an element named for boilerplate that stays so.

        An element is cleared by an article inside it, or by holding half of the text or more.
        """
        steps = [0] * (self.blocks + 1)
        for first, after, chars, articles in self.spans:
            if not articles and 2 * chars < self.chars:
                steps[first] += 1
                steps[after] -= 1
        out, depth = [], 0
        for step in steps[:-1]:
            depth += step
            out.append(depth > 0)
        return out


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order; text that cannot be seen is left out. Time grows with its length."""
    found: list[Block] = []
    headed: list[bool] = []
    stack = _Stack()
    texts: list[str] = []
    link_texts: list[str] = []
    links = 0

    def flush() -> None:
        nonlocal links
        text = " ".join("".join(texts).split())
        if text:
            linked = len(" ".join("".join(link_texts).split()))
            heading = stack.headings > 0
            # The heading of an article may stand in the article's own header.
            bad = stack.hard > (stack.headers if heading and stack.articles else 0)
            found.append(Block(text, linked, links, bad, stack.articles > 0, heading, stack.doubtful > 0))
            stack.blocks += 1
            stack.chars += len(text) - linked
        texts.clear()
        link_texts.clear()
        links = 0

    def write(raw: str) -> None:
        if raw:
            text = entities.unescape(raw)
            texts.append(text)
            if stack.last("a") >= 0:
                link_texts.append(text)

    at, end = 0, len(page)
    while at < end:
        token = _TOKEN.search(page, at)
        if token is None:
            write(page[at:])
            break
        write(page[at : token.start()])
        at = token.end()
        name = (token[2] or "").lower()
        if not name:
            continue
        if token[1]:
            if name in BLOCKS:
                flush()
            stack.cut(stack.last(name))
            continue
        if name in RAW:
            if not token[3].rstrip().endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = stop.end() if stop else end
            continue
        if name == "br":
            texts.append(" ")
            continue
        if name in BLOCKS:
            flush()
            stack.cut(stack.last("p"))
            if name in ("li", "td", "th", "tr", "dt", "dd", "option"):
                # An open list item or cell of the same list or row ends.
                place = stack.last(name)
                if place > max(map(stack.last, ("ul", "ol", "dl", "table", "select", "menu"))):
                    stack.cut(place)
        elif name == "a":
            stack.cut(stack.last("a"))
            links += 1
        if name not in VOID:
            stack.push(_opened(name, token[3], stack.hard > 0))
    flush()
    stack.cut(0)
    for block, named in zip(found, stack.uncleared()):
        block.bad_place = block.bad_place or named
    return found


def _named(token: str) -> tuple[set[str], bool]:
    """The bad words of one name, and whether the name is about nothing else."""
    words = [w.lower() for w in _NAME_PART.findall(token)]
    if not words or words[0] in WITHOUT_WORDS:
        return set(), False
    words = [_root(w) for w in words]
    bad = {w for w in words if w in BAD_WORDS}
    return bad, bool(bad) and (words[-1] in BAD_WORDS or all(w in BAD_WORDS or w in PLAIN_WORDS for w in words))


def _root(word: str) -> str:
    """The bad word that a word written together begins or ends with, or the word."""
    for root in ROOTS:
        if word.endswith((root, f"{root}s")) or word.startswith(root) and word[len(root) :].lstrip("s") in PLAIN_WORDS:
            return root if root in BAD_WORDS else f"{root}s"
    return word


def _opened(name: str, raw: str, in_bad_place: bool) -> _Open:
    attributes = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)} if raw else {}
    hidden = "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"
    hidden = hidden or re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I) is not None
    surely: set[str] = set()
    maybe = False
    good = False
    if name not in ("html", "body", "main") and name not in HEADINGS:
        for token in " ".join(attributes.get(k, "") for k in ("class", "id", "role")).split():
            bad, whole = _named(token)
            surely |= bad if whole else set()
            maybe = maybe or bool(bad)
            good = good or not bad and not GOOD_WORDS.isdisjoint(w.lower() for w in _NAME_PART.findall(token))
    if name == "article":
        surely &= SIDE_WORDS
    hard = (name in PLACES and name != "form") or hidden or not surely.isdisjoint(SIDE_WORDS | NOTICE_WORDS)
    clearable = not hard and (name == "form" or bool(surely))
    article = name in ("article", "main") or good and name in ("div", "section", "td")
    article = article and not hard and not clearable and not in_bad_place
    return _Open(name, hard, hard and name == "header", article, maybe and not surely, 0 if clearable else -1)


def label_blocks(
    blocks: list[Block],
    long: int = 140,
    rich: float = 0.3,
    poor: float = 0.15,
    linked: float = 0.5,
    share: float = 0.25,
) -> list[Block]:
    """Label every block good or bad by the two passes."""
    density = [_stop_density(b.text) for b in blocks]
    length = [_length(b.text) for b in blocks]
    light = [not b.bad_place and b.link_chars <= linked * len(b.text) for b in blocks]
    strange = _strange(density, [n if ok else 0 for n, ok in zip(length, light)], long, rich)
    inside = sum(n for b, n, ok in zip(blocks, length, light) if ok and b.in_article)
    outside = sum(
        n
        for b, stops, n, ok in zip(blocks, density, length, light)
        if ok and not b.in_article and (n >= long or not b.n_links) and (strange or stops >= rich)
    )
    only_article = inside > 0 and outside < share * inside
    for b, stops, n, ok in zip(blocks, density, length, light):
        if not ok or only_article and not b.in_article:
            b.label = "bad"
        elif b.doubtful and not b.in_article and not (n >= long and (strange or stops >= rich)):
            b.label = "bad"
        elif (stops >= rich and (b.in_article or n >= long)) or strange and n >= long:
            b.label = "good"
        elif not b.in_article and b.n_links and n < long:
            b.label = "bad"
    decided = [b.label for b in blocks]
    after = _next_decided(decided)
    # Neighbours inside the article, for the blocks in it.
    own_labels = [b.label if b.in_article else "" for b in blocks]
    own_after = _next_decided(own_labels)
    own_before = _next_decided(own_labels[::-1])[::-1]
    before = edge = "bad" if "good" in decided else ""
    # Without a good block anywhere, menus say nothing about a text in a language not known.
    alone = strange and not edge
    # Nor is there a long text to compare with on a page of a few short lines.
    short = not edge and max((n for n, ok in zip(length, light) if ok), default=0) < long / 2
    for k, b in enumerate(blocks):
        if decided[k]:
            before = decided[k]
            continue
        near = {before, after[k] or edge} - {""}
        if b.in_article:
            outvoted = own_before[k] == own_after[k] == "bad" and not b.heading and length[k] < long
            b.label = "bad" if outvoted else "good"
        elif len(near) == 1 and not alone and not short:
            b.label = near.pop()
        else:
            own = density[k] >= poor or strange and length[k] >= long / 4
            b.label = "good" if own or short and _says(b.text) else "bad"
    return blocks


def _says(text: str) -> bool:
    """Whether a block holds a word and is no copyright line."""
    return _WORD.search(text) is not None and not text.lower().startswith(("copyright", "©", "(c)", "all rights"))


def _strange(density: list[float], length: list[int], long: int, rich: float) -> bool:
    """Whether most of the long text, or of all where none is long, is not rich in stop words."""
    least = long if max(length, default=0) >= long else 1
    known = sum(n for n, stops in zip(length, density) if n >= least and stops >= rich)
    return 2 * known < sum(n for n in length if n >= least)


def _length(text: str) -> int:
    """Characters, with those that stand for a syllable or a word counted three times."""
    return len(text) if text.isascii() else len(text) + 2 * len(_WIDE.findall(text))


def _next_decided(labels: list[str]) -> list[str]:
    out, following = [""] * len(labels), ""
    for k in range(len(labels) - 1, -1, -1):
        out[k] = following
        following = labels[k] or following
    return out


def _stop_density(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def main_text(page: str | None) -> str:
    """The main text of a page: its good blocks in order, joined by one space."""
    return " ".join(b.text for b in label_blocks(blocks_of(page or "")) if b.label == "good")


def extract_pages(df: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """Add the main text of the page in ``html_col`` as ``text_col``.

    Work is per row, without a shuffle. Defined results: a null or empty page has an empty text;
    tags and comments cut short end the page; repeated rows are read each; other columns stay, and
    one named like the new column is replaced.
    """
    kept = [c for c in df.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(v.as_py()) for v in batch.column(html_col)], pa.string())
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, texts], [*kept, text_col])

    plain = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, html_col])])
    fields = [f for f in plain.schema.fields if f.name in kept]
    schema = type(plain.schema)(fields).add(text_col, "string")
    return plain.mapInArrow(run, schema)
