"""HTML extraction by block rules in two passes.

A page is cut into blocks at block-level tags. In the first pass each block is decided by its
length, its link density (characters inside links) and its stop-word density; blocks inside menus,
footers, forms and the like, named by tag, role, class or id, are not text; the mark of a list item or table
cell holds for all inside it, and a link around blocks links their text. A class or id is only a
hint unless it names comments, related pages or advertisements: an article or main element inside
such a wrapper is text, and so is a wrapper that holds most of the page's prose. Inside an article or
main element, where such elements hold at least half of a page's prose, prose needs no stop words, since the element already says what it
is, and prose beside them is not text; where they hold less, one with under a quarter of the prose is a teaser and not text; nor does it on a page whose long blocks have next to none, since its language is not known
here. Short blocks of few links are left open, those with a copyright sign are not text. In the second pass an open block takes the label of the
nearest decided blocks before and after it; where those differ, or on a tie, a heading follows the
block after it and any other block the one before it. Open blocks look no further than their article
element and pass over menus and the like; where that leaves no decided block, open ones are text.

Scripts, styles, comments of the markup and the head are dropped, character references are decoded,
white space inside a block becomes one space, blocks are joined by a line end.

Defined cases: a null or empty page gives an empty text; unclosed elements end with their parent;
unclosed comments, scripts and styles run to the end. Rows that repeat a page_id each give a row. An
empty table gives an empty one. Extra columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import whole_text

MAX_LINKS = 0.33
SHORT, LONG = 70, 200
#: An article with a smaller part of a page's prose, where most of it lies elsewhere, is a teaser.
TEASER_PARTS = 4
FEW_STOPS, SOME_STOPS, MANY_STOPS = 0.05, 0.15, 0.25
GOOD, BAD, OPEN = "good", "bad", "open"

BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
#: Block tags that hold no blocks, so nesting is not counted for them.
LOOSE_TAGS = frozenset("p hr body html".split())
#: Those that nest but may lack an end tag: the tags whose opening ends them, and the element that holds them.
ITEM_TAGS = {
    **dict.fromkeys(["li"], (("li",), ("ul", "ol", "menu", "dir"))), **dict.fromkeys(["dt", "dd"], (("dt", "dd"), ("dl",))),
    **dict.fromkeys(["td", "th"], (("td", "th"), ("tr", "table"))), "tr": (("tr",), ("table",)), "option": (("option",), ("select",)),
    **dict.fromkeys(["thead", "tbody", "tfoot", "caption"], (("thead", "tbody", "tfoot", "caption"), ("table",))),
}
DROPPED_TAGS = frozenset("script style noscript template svg iframe object title math canvas".split())
OUTSIDE_TAGS = frozenset("nav footer aside form fieldset select textarea button menu dialog header".split())
TEXT_TAGS = frozenset(["article", "main"])
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
#: What class names and ids may end in, or be, that name what is not text.
OUTSIDE_NAMES = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies footer form gdpr header login masthead menu "
    "modal nav navbar navigation newsletter notice pagination pager popup promo promoted related replies reply respond share sharing sidebar signup "
    "skip social sponsor sponsored subscribe toolbar widget".split()
)
#: Those of them that hold text of others, so an article inside them is not the page's own.
OTHERS_NAMES = frozenset(
    "ad ads advert advertisement comment comments promo promoted related replies reply respond sponsor sponsored".split()
)
#: A name after one of these parts tells what stands beside the element.
BESIDE_PARTS = frozenset("has have no not with without".split())
#: Parts that say nothing, where a name ends in them.
PLAIN_PARTS = frozenset(
    "area bar block bottom box button buttons container group inner item items left link links list outer panel right section slot top wrap wrapper".split()
)
STOPS = frozenset(
    "a an and are as at be by for from has have he in is it not of on or that the this to was were what which with you "
    "au aux avec ce dans de des du elle en est et il la le les ne pas pour qui que sur un une "
    "als auch auf aus das dem den der die ein eine für im ist mit nicht sich sie und von zu "
    "al con del el es esta las lo los no para por se su una y".split()
)
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
ATTRIBUTES = re.compile(r"""[^"'>]*+(?:"[^"]*+"[^"'>]*+|'[^']*+'[^"'>]*+)*+>""")
NAMED = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
HREF = re.compile(r"(?:^|\s)href\s*=", re.IGNORECASE)
NAME_PARTS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
WORDS = re.compile(r"\w+")


@dataclass
class Block:
    text: str
    link_chars: int
    tag: str
    outside: bool
    article: int  # number of the article or main element around it, 0 for none
    label: str = OPEN
    wrappers: tuple[int, ...] = ()  # numbers of the elements around it whose names hint that it is outside


def _names(value: str) -> set[str]:
    """The names of ``OUTSIDE_NAMES`` that the tokens of a class or id end in."""
    found = set()
    for token in value.split():
        parts = [part.lower() for part in NAME_PARTS.findall(token)]
        while len(parts) > 1 and parts[-1] in PLAIN_PARTS:
            parts.pop()
        if parts and parts[-1] in OUTSIDE_NAMES and not BESIDE_PARTS.intersection(parts[:-1]):
            found.add(parts[-1])
    return found


def _outside(attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether the attributes say that an element is not text, and whether its names hint so."""
    hint = False
    for name, value in NAMED.findall(attributes):
        value, name = value.strip("\"'"), name.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True, False
        if name == "role" and value.lower() in OUTSIDE_ROLES:
            return True, False
        if name in ("class", "id"):
            names = _names(value) - ({"header"} if in_article else set())  # the header of an article holds its title
            if names & OTHERS_NAMES:
                return True, False
            hint = hint or bool(names)
    return False, hint


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order; those without any text are left out."""
    out: list[Block] = []
    nest: list[tuple[str, bool, int, tuple[int, ...]]] = []  # (tag, outside, article, wrappers) of open elements
    pieces: list[str] = []
    linked: list[str] = []
    tag, in_link, loose_outside, breaks, articles, hints = "", False, False, 0, 0, 0
    link_depth, link_in_paragraph = 0, False

    def close() -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            _, outside, article, wrappers = nest[-1] if nest else ("", False, 0, ())
            link_chars = len(" ".join(html.unescape(" ".join(linked)).split()))
            out.append(Block(text, link_chars, tag, outside or loose_outside, article, wrappers=wrappers))
        pieces.clear()
        linked.clear()

    def add(text: str) -> None:
        pieces.append(text)
        if in_link:
            linked.append(text)

    at, quoted = 0, True
    while at < len(page):
        start = page.find("<", at)
        m = TAG.match(page, start) if start >= 0 else None
        if start < 0 or not m and page[start + 1:start + 2] not in ("!", "?"):
            # text up to the next sign that may open a tag
            end = len(page) if start < 0 else start + 1
            add(page[at:end])
            breaks = 0 if page[at:end].strip() else breaks
            at = end
            continue
        if start > at:
            add(page[at:start])
            breaks = 0 if page[at:start].strip() else breaks
        if not m:
            end = "-->" if page.startswith("<!--", start) else ">"
            stop = page.find(end, start + len(end) + 1 if end == "-->" else start)
            at = stop + len(end) if stop >= 0 else len(page)
            continue
        whole = ATTRIBUTES.match(page, m.end()) if quoted else None
        if whole:
            at = whole.end()
        else:  # an open quote: from here on quotes no longer hide the end of a tag
            quoted = False
            stop = page.find(">", m.end())
            at = stop + 1 if stop >= 0 else len(page)
        name, ends, attributes = m[2].lower(), m[1] == "/", page[m.end():at - 1]
        if name in DROPPED_TAGS:
            if not ends and not attributes.endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.IGNORECASE).search(page, at)
                at = stop.end() if stop else len(page)
            continue
        if name == "br":
            breaks += 1
            if breaks > 1:
                close()
            else:
                add(" ")
            continue
        if name == "a":
            in_link = not ends and HREF.search(attributes) is not None
            link_depth, link_in_paragraph = len(nest), tag == "p"
            continue
        nested = name in BLOCK_TAGS or name == "button"
        if not nested:
            continue
        close()
        breaks = 0
        # a link left open in a paragraph ends with it; one that goes on around a block links all of that
        in_link, link_in_paragraph = in_link and not (link_in_paragraph and name in LOOSE_TAGS), link_in_paragraph and name in LOOSE_TAGS
        if name in LOOSE_TAGS:
            tag, loose_outside = ("", False) if ends else (name, any(_outside(attributes, bool(nest and nest[-1][2]))))
            continue
        loose_outside = False
        ended, holders = ITEM_TAGS.get(name, ((name,), ()))
        if ends or name in ITEM_TAGS:
            ended = (name,) if ends else ended
            for depth in range(len(nest) - 1, -1, -1):
                if nest[depth][0] in ended:
                    del nest[depth:]
                    break
                if nest[depth][0] in holders:
                    break
            in_link = in_link and len(nest) >= link_depth
        if ends:
            tag = ""
            continue
        tag = name
        _, outside, article, wrappers = nest[-1] if nest else ("", False, 0, ())
        if name in TEXT_TAGS:
            wrappers = ()
            outside = outside or _outside(attributes, bool(article))[0]
            if not article:
                articles += 1
                article = articles
        else:
            says, hint = _outside(attributes, bool(article))
            # the header of an article holds its title; that of a page does not
            outside = outside or says or name in OUTSIDE_TAGS and not (name == "header" and article)
            if hint:
                hints += 1
                wrappers += (hints,)
        nest.append((name, outside, article, wrappers))
    close()
    _settle_wrappers(out)
    return out


def _stop_density(text: str) -> float:
    words = WORDS.findall(text.lower())
    return sum(w in STOPS for w in words) / max(len(words), 1)


def _settle_wrappers(found: list[Block]) -> None:
    """Blocks inside a wrapper are outside, unless it holds most of the page's long prose."""
    if not any(b.wrappers for b in found):
        return
    long = [b for b in found if not b.outside and len(b.text) >= SHORT and b.link_chars <= MAX_LINKS * len(b.text)]
    prose = [b for b in long if b.article or _stop_density(b.text) >= SOME_STOPS] or long
    held = Counter(w for b in prose for w in b.wrappers)
    for block in found:
        if any(2 * held[w] <= len(prose) for w in block.wrappers):
            block.outside = True


def _unknown_language(found: list[Block]) -> bool:
    """Whether the long blocks of few links have next to no known stop words."""
    words = [w for b in found if not b.outside and len(b.text) >= SHORT and b.link_chars <= MAX_LINKS * len(b.text) for w in WORDS.findall(b.text.lower())]
    return sum(w in STOPS for w in words) < FEW_STOPS * len(words)


def _article_prose(found: list[Block]) -> tuple[Counter, int]:
    """The characters of prose in each article (0: in none), and in all."""
    long = [b for b in found if not b.outside and len(b.text) >= SHORT and b.link_chars <= MAX_LINKS * len(b.text)]
    beside = [b for b in long if not b.article]
    # beside articles only what reads as prose counts, unless none of it has known stop words
    dense = [b for b in beside if _stop_density(b.text) >= SOME_STOPS]
    chars = Counter()
    for b in [b for b in long if b.article] + (dense or [b for b in beside if len(b.text) >= LONG]):
        chars[b.article] += len(b.text)
    return chars, sum(chars.values())


def first_pass(found: list[Block]) -> None:
    """Decide each block by itself, or leave it open."""
    chars, prose = _article_prose(found)
    has_article = any(b.article and not b.outside for b in found) and 2 * (prose - chars[0]) >= prose
    unknown = not has_article and _unknown_language(found)
    for block in found:
        text = block.text
        short = len(text) < SHORT
        if block.outside or short and "©" in text or block.link_chars > MAX_LINKS * len(text):
            block.label = BAD
            continue
        if block.article and not has_article and TEASER_PARTS * chars[block.article] < prose:
            block.label = BAD
            continue
        if short:
            block.label = BAD if has_article and not block.article else OPEN
            continue
        if block.article and has_article:
            block.label = GOOD
            continue
        stops = _stop_density(text)
        if has_article:
            block.label = BAD
        elif unknown:
            block.label = GOOD if len(text) >= LONG else OPEN
        elif stops >= MANY_STOPS or stops >= SOME_STOPS and len(text) >= LONG:
            block.label = GOOD
        else:
            block.label = OPEN if stops >= FEW_STOPS else BAD


def second_pass(found: list[Block]) -> None:
    """Open blocks inherit from the nearest decided blocks of their article, or of the page."""
    decided = [b.label for b in found]
    before: dict[int, tuple[int, str]] = {}
    last: list[tuple[int, str] | None] = []
    for i, block in enumerate(found):
        last.append(before.get(block.article))
        if decided[i] != OPEN and not block.outside:
            before[block.article] = (i, decided[i])
    after: dict[int, tuple[int, str]] = {}
    for i in range(len(found) - 1, -1, -1):
        block = found[i]
        if decided[i] != OPEN:
            if not block.outside:
                after[block.article] = (i, decided[i])
            continue
        sides = [s for s in (last[i], after.get(block.article)) if s]
        if not sides:
            block.label = GOOD
        elif len(sides) == 1 or sides[0][1] == sides[1][1]:
            block.label = sides[0][1]
        elif i - sides[0][0] != sides[1][0] - i:
            block.label = sides[0][1] if i - sides[0][0] < sides[1][0] - i else sides[1][1]
        else:
            heading = len(block.tag) == 2 and block.tag[0] == "h"
            block.label = sides[1][1] if heading else sides[0][1]


def main_text(page: str) -> str:
    found = blocks(page)
    first_pass(found)
    second_pass(found)
    return "\n".join(b.text for b in found if b.label == GOOD)


def extract(pages: DataFrame) -> DataFrame:
    """(row, text) per page; ``row`` is the whole row."""
    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(main_text)

    return pages.select(F.struct(*[f"`{c}`" for c in pages.columns]).alias("row"), texts(whole_text("html")).alias("text"))
