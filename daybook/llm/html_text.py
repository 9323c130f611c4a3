"""Main text of HTML pages by two-pass block rules.

A page is cut into blocks at block-level tags.  Regions that are never article
text (navigation, site headers and footers, asides, forms, scripts, styles,
hidden parts, and elements whose class, id or role says menu, advert, notice,
comments and the like) are left out by their markup.  On a page without article
or main element a class, id or role does not leave out what holds most of the
page's text outside links; inside an article one that says something else as well
(``share-price-table``) leaves out only what is short or mostly links.  The remaining blocks go through two passes:

1. context-free: link density, length and stop-word density make a block good,
   bad or short; inside an article or main element text is good whatever its length, blocks in
   a row that consist of links are bad, and a short one of links that stands alone counts as short;
2. context-sensitive: a short block takes the label of its nearest decided
   neighbours, before and after; where they differ, the nearer one's, and at
   equal distance good.  A short block without a decided neighbour is good.  Blocks
   inside and outside of articles are no neighbours of each other.

Where few of the long blocks have stop words of a listed language, a block
that is not short is good without them.  If article or main elements hold most of
the good text, only what stands in them is kept.

Character references are decoded, white space inside a block becomes one
space, and good blocks are joined in page order by an empty line.  Null and
empty pages give the empty text.  Pages of any length are read whole; each page
is treated by itself, so repeated rows give equal results.  Input columns named
like an output column are replaced.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import replace_columns

# HTML element names.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary "
    "table tbody td tfoot th thead title tr ul".split())
SKIPPED_TAGS = frozenset(
    "head script style noscript template svg math canvas iframe object embed audio video map form button select "
    "textarea datalist nav aside footer menu dialog".split())
RAW_TAGS = frozenset("script style textarea title noscript iframe template".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words in class, id or role that name a region outside the article.
OUTSIDE_WORDS = frozenset(
    "ad ads adv advert advertisement adverts adsense banner breadcrumb breadcrumbs comment comments commentlist "
    "cookie cookies consent copyright disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation "
    "newsletter notice notices pager pagination popup promo promos promoted promotion related respond search share "
    "sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget widgets".split())
# Words that say nothing about what a region holds.
PLAIN_WORDS = frozenset(
    "area bar block body bottom box btn button buttons container content form group header inner item items layout left "
    "link links list main module outer panel post posts right row section small text title top unit wrap wrapper".split())
# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "a about after all also an and are as at be been but by can could do for from had has have he her his if in into "
    "is it its more no not of on one or other our out she so some than that the their them then there these they this "
    "to up was we were what when which who will with would you your "
    "aber als am auch auf aus bei das dass dem den der des die durch ein eine einen einer eines er es für hat ich ihr "
    "im ist mit nach nicht nur oder sein sich sie sind so über um und uns von vor war werden wie wir wird zu zum zur "
    "au aux avec ce ces cette dans de du elle en est et il ils je la le les leur lui mais ne nous on ou par pas plus "
    "pour qu que qui sa se ses son sont sur un une vous y "
    "al como con del el ella ellos era esta este ha hay las lo los más me mi muy ni o para pero por se si sin sobre su "
    "sus también te tu una uno unos ya".split())

LINK_SHARE = 0.5        # a block with more of its characters in links is bad
SHORT, LONG = 70, 200   # characters
SMALL = 50              # characters without white space of a region
FEW_STOPS, MANY_STOPS = 0.15, 0.30
LISTED = 0.25           # share of the long blocks' characters in blocks with stop words, below which no listed language fits

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|</?([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
                   re.DOTALL)
ARTICLE = re.compile(r"<(?:article|main)[\s>]", re.IGNORECASE)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)
UNSEEN = re.compile(r"<(script|style|noscript|template|nav|footer|aside|form|head)\b.*?</\1\s*>|<!--.*?-->", re.DOTALL | re.IGNORECASE)
LINK = re.compile(r"<a\b.*?</a\s*>", re.DOTALL | re.IGNORECASE)
WORD = re.compile(r"[^\W\d_]+")
PARTS = re.compile(r"[A-Za-z][a-z]+|[A-Z]+|[a-z]+")


def _outside(tag: str, attributes: str, in_article: bool) -> bool:
    """Is the element a region outside the article by its tag or attributes?"""
    if tag in SKIPPED_TAGS or tag == "header" and not in_article:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    if HIDDEN.search(attributes):
        return True
    for found in NAMED.findall(attributes):
        name = found[0] or found[1] or found[2]
        if any(p.lower() in OUTSIDE_WORDS for p in PARTS.findall(name)):
            return True
    return False


def _sure(attributes: str) -> bool:
    """Does a class, id or role name nothing but a region outside the article (``cookie-notice``, not ``share-price-table``)?"""
    for found in NAMED.findall(attributes):
        for name in (found[0] or found[1] or found[2]).split():
            words = {p.lower() for p in PARTS.findall(name)}
            if words & OUTSIDE_WORDS and words <= OUTSIDE_WORDS | PLAIN_WORDS:
                return True
    return False


def _plain(part: str) -> tuple[int, int]:
    """Characters of a part of a page without white space, tags and scripts: outside links, in links."""
    part = UNSEEN.sub(" ", part)
    rest = LINK.sub(" ", part)
    outside, whole = (len("".join(TOKEN.sub(" ", p).split())) for p in (rest, part))
    return outside, whole - outside


def _region_end(page: str, tag: str, at: int) -> int:
    """Where the element opened before ``at`` ends; -1 if it is never closed."""
    depth = 1
    for m in re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*>", re.IGNORECASE).finditer(page, at):
        depth += -1 if m[1] else 1
        if not depth:
            return m.end()
    return -1


class _Block:
    __slots__ = ("parts", "link_chars", "in_article", "heading")

    def __init__(self, in_article: bool, heading: bool):
        self.parts: list[str] = []
        self.link_chars = 0
        self.in_article = in_article
        self.heading = heading


def _blocks(page: str) -> list[tuple[str, int, bool, bool]]:
    """Blocks in page order: text, characters in links, inside an article, is a heading."""
    found: list[_Block] = []
    block = _Block(False, False)
    article = link = 0
    heading = False
    at = 0
    page_chars: int | None = None

    def holds_text(tag: str, attributes: str, end: int) -> bool:
        """Text in a region that its class, id or role alone would leave out?

        Inside an article: text of some length, few of its characters in links, under a name that says something else as well.
        On a page that marks no article: most of the page's text.
        """
        nonlocal page_chars
        if article and tag not in SKIPPED_TAGS and not HIDDEN.search(attributes):
            if _sure(attributes):
                return False
            own, linked = _plain(page[at:end])
            return own >= SMALL and linked <= LINK_SHARE * (own + linked)
        if tag in SKIPPED_TAGS or tag == "header" or HIDDEN.search(attributes) or ARTICLE.search(page):
            return False
        if page_chars is None:
            page_chars = _plain(page)[0]
        if 2 * (end - at) < page_chars:
            return False
        own, linked = _plain(page[at:end])
        return 2 * own > page_chars and linked <= LINK_SHARE * (own + linked)

    def text(piece: str) -> None:
        if piece:
            block.parts.append(piece)
            if link:
                block.link_chars += len(" ".join(html.unescape(piece).split()))

    while True:
        m = TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        if m[1] is None:
            continue
        tag, closing = m[1].lower(), page.startswith("</", m.start())
        if tag == "a":
            link = 0 if closing else 1
        elif tag == "br":
            block.parts.append(" ")
        if not closing and tag not in VOID_TAGS and not m[2].endswith("/") and _outside(tag, m[2], article > 0):
            if tag in RAW_TAGS:
                end = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else len(page)
            elif (end := _region_end(page, tag, at)) >= 0:
                if tag in SKIPPED_TAGS or not ARTICLE.search(page, at, end) and not holds_text(tag, m[2], end):
                    at = end  # a wrapper around the article is no region outside it
            elif tag == "head":
                body = re.compile(r"<body[\s>]", re.IGNORECASE).search(page, at)
                at = body.start() if body else at
        elif tag in ("article", "main"):
            article = max(0, article + (-1 if closing else 1))
        if tag in BLOCK_TAGS:
            heading = tag in HEADINGS and not closing
            if block.parts:
                found.append(block)
            block = _Block(article > 0, heading)
            link = 0
    if block.parts:
        found.append(block)
    out = []
    for b in found:
        joined = " ".join(html.unescape("".join(b.parts)).split())
        if joined:
            out.append((joined, b.link_chars, b.in_article, b.heading))
    return out


def _stops(text: str) -> float:
    """Share of stop words."""
    words = WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(len(words), 1)


def _listed(blocks: list[tuple[str, int, bool, bool]]) -> bool:
    """Do the listed languages fit the page?"""
    long = [b[0] for b in blocks if len(b[0]) >= SHORT and b[1] <= LINK_SHARE * len(b[0])]
    return sum(len(t) for t in long if _stops(t) >= FEW_STOPS) >= LISTED * sum(map(len, long))


def _in_article(blocks: list[tuple[str, int, bool, bool]]) -> list[str]:
    """good, bad or short for the blocks of a marked article: text stays, link lists go, a lone linked block is as its neighbours."""
    linked = [b[1] > LINK_SHARE * len(b[0]) for b in blocks]
    near = [a or b for a, b in zip([False, *linked], [*linked[1:], False][:len(linked)], strict=False)]
    return ["good" if not x else "bad" if n or len(b[0]) >= SHORT else "short" for b, x, n in zip(blocks, linked, near, strict=True)]


def _context_free(text: str, link_chars: int, listed: bool = True) -> str:
    """good, bad or short, for blocks outside marked articles."""
    if link_chars > LINK_SHARE * len(text):
        return "bad"
    if len(text) < SHORT:
        return "short"
    stops = _stops(text)
    if stops >= MANY_STOPS or stops >= FEW_STOPS and len(text) >= LONG:
        return "good"
    if not listed:
        return "good"  # its length and few links decide
    return "short" if stops >= FEW_STOPS else "bad"


def _settle(labels: list[str]) -> list[bool]:
    """Second pass: which blocks stay."""
    n = len(labels)
    before: list[int | None] = [None] * n
    after: list[int | None] = [None] * n
    last: int | None = None
    for i in range(n):
        before[i] = last
        last = i if labels[i] != "short" else last
    last = None
    for i in reversed(range(n)):
        after[i] = last
        last = i if labels[i] != "short" else last
    out = []
    for i, label in enumerate(labels):
        if label == "short":
            near = [(abs(j - i), labels[j] != "good") for j in (before[i], after[i]) if j is not None]
            out.append(not min(near)[1] if near else True)
        else:
            out.append(label == "good")
    return out


def main_text(page: str | None) -> str:
    """The article text of one page."""
    blocks = _blocks(page) if page else []
    inside, outside = [b for b in blocks if b[2]], [b for b in blocks if not b[2]]
    # Short blocks inherit from their own side of an article's border only.
    kept_inside = _settle(_in_article(inside))
    listed = _listed(outside)
    kept_outside = _settle([_context_free(b[0], b[1], listed) for b in outside])
    marked, rest = (sum(len(b[0]) for b, k in zip(side, kept, strict=True) if k)
                    for side, kept in ((inside, kept_inside), (outside, kept_outside)))
    if marked and marked >= rest:
        # A page that marks its article: what stands outside it is not part of it.
        return "\n\n".join(b[0] for b, k in zip(inside, kept_inside, strict=True) if k)
    sides = {True: iter(kept_inside), False: iter(kept_outside)}
    return "\n\n".join(b[0] for b in blocks if next(sides[b[2]]))


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` (the main text) and ``n_chars`` (its code points)."""

    @F.arrow_udf("string")
    def extracted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array([main_text(p) for p in column.to_pylist()], pa.string())

    base = replace_columns(pages, "text", "n_chars")
    source = pages[html_col] if html_col.lower() in ("text", "n_chars") else F.col(html_col)
    out = pages.select(*[F.col(f"`{c}`") for c in base.columns], extracted(source).alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
