"""Main text of web pages by minimum cuts.

A page falls into blocks: runs of text between the borders of block elements. A linear classifier gives
each block a cost of being content (names and tags it stands in, link share, sentences, length, vocabulary,
repetition; log odds), which becomes its capacity to the terminals. Blocks that follow each other or share a parent are tied, the more
the nearer they are in the DOM. The minimum cut separates content from the rest.
"""

from __future__ import annotations

import html as entities
import math
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from rillwork.llm.common import arrow_map, quoted
from rillwork.llm.mincut import labels

# Fixed values of HTML.
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset "
             "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu "
             "nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed frame hr img input link meta param source track wbr".split())
#: Elements whose insides are no markup, and those that show nothing of theirs.
RAW = set("script style textarea title xmp iframe noembed noframes".split())
SILENT = set("head script style template noscript svg math canvas object audio video select datalist "
             "button textarea iframe noembed noframes map".split())
#: A start tag closes these open elements, up to the nearest of the second set.
CLOSES = {**{t: ({"p"}, {"table", "td", "th", "button"}) for t in BLOCKS - {"option", "td", "th", "tr"}},
          "li": ({"li", "p"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd", "p"}, {"dl"}),
          "dd": ({"dt", "dd", "p"}, {"dl"}), "option": ({"option"}, {"select"}),
          "tr": ({"tr", "td", "th", "p"}, {"table"}), "td": ({"td", "th", "p"}, {"tr", "table"}),
          "th": ({"td", "th", "p"}, {"tr", "table"})}

TAG = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?/](?![a-zA-Z])[^>]*(?:>|\Z)|<!?[a-zA-Z][^>]*\Z"
                 r"|<![^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')?)*+)>", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|aria-hidden|itemprop)(?:\s*=\s*"
                       r"(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/>]|\Z)", re.I)

#: What the names of an element say it is; checked part by part.
AWAY = re.compile(r"(?:nav|navbar|navigation|menu|breadcrumbs?|footer|masthead|topbar|toolbar|sidebar|side|"
                  r"aside|widget|ads?|advert\w*|adsense|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|"
                  r"banner|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|search|"
                  r"share|sharing|social|related|recommend\w*|trending|comments?|disqus|replies|respond|"
                  r"pagination|pager|form|skip|contentinfo|complementary|dialog|hidden)")
HERE = re.compile(r"(?:article|articlebody|main|content|post|entry|story|body|text|prose)")
#: Names of wrappers and flags rather than of parts.
WRAPPER = re.compile(r"(?:has|with|no|is|without|layout|wrapper|wrap|container|page|outer|inner|grid|row)")
AWAY_TAGS = set("nav footer aside form dialog menu".split())
HEADINGS = set("h1 h2 h3 h4".split())
#: Weights of the classifier, log odds that a block is boilerplate; a positive sum speaks for it. What an element
#: is called is one feature of several, on the scale of the others and of the ties.
COST = {"away": 4.5, "here": -3.0, "outside": 1.5, "links": 4.5, "short": 0.5, "length": -0.7, "sentence": -1.0,
        "bare": 0.5, "rights": 2.0, "appeal": 3.5, "heading": -0.8, "paragraph": -0.7, "repeated": 0.7}
#: Ties: neighbours under one parent; each step further apart in the DOM halves them, and a border
#: between parts that say different things of themselves leaves a quarter.
NEAR, BORDER, FAR = 1.4, 0.25, 12
#: Wording of rights, and of appeals to the reader (consent, sign-up, sharing, adverts).
RIGHTS = re.compile(r"©|\(c\) \d{4}|all rights reserved|terms of (?:use|service)", re.I)
APPEAL = re.compile(r"\bwe use cookies\b|\baccept (?:all )?cookies\b|\b(?:cookie|privacy) policy\b|\bsign up\b|"
                    r"\blog ?in\b|\bsubscribe\b|\bnewsletter\b|\bshare this\b|\bfollow us\b|\bskip to\b|"
                    r"\badvert(?:isement|orial|ising)?\b|\bsponsor(?:s|ed)?\b|\b(?:buy|shop|order|download|try) "
                    r"(?:it |this )?now\b|\bclick here\b|\bspecial offer\b|\b\d+ ?% off\b|\blimited time\b", re.I)
SENTENCE = re.compile(r"[.!?…。！？।۔։።][\"'»”’)\]]*(?:\s|$)")
#: Code points under which a block is short, of a usual one, and of one that may hold notices.
SHORT, USUAL, NOTICES = 25, 60, 200


@dataclass
class Element:
    tag: str
    parent: Element | None
    depth: int
    silent: bool
    state: str  # "here", "away" or ""
    doubt: Element | None = None  # the nearest one, or itself, that only a name or a form puts away
    inside: str = ""  # its state without those
    seen: bool = False


@dataclass
class Block:
    text: str
    linked: int
    element: Element


def named(attributes: str) -> tuple[str, bool]:
    """What class, id and role say ("here", "away" or ""), and whether the element is hidden."""
    words, gone = [], False
    for name, *values in ATTRIBUTE.findall(attributes):
        value, name = "".join(values).lower(), name.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            gone = True
        elif name == "style":
            gone = gone or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value) is not None
        else:
            words += value.split()
    state = ""
    for word in words:
        parts = re.split(r"[-_:]+", word)
        if any(WRAPPER.fullmatch(p) for p in parts):
            continue
        if any(AWAY.fullmatch(p) for p in parts):
            return "away", gone
        if any(HERE.fullmatch(p) for p in parts):
            state = "here"
    return state, gone


def child(parent: Element, tag: str, attributes: str) -> Element:
    """An element's state is what it says, what its tag says, or its parent's. Once away, always away, but for
    what only a name or a form put away: ``doubt`` names these, ``settle`` decides."""
    said, gone = named(attributes) if "=" in attributes or "hidden" in attributes.lower() else ("", False)
    if tag in ("html", "body"):
        said = ""
    inside = parent.inside
    weak = False
    if inside != "away":
        if tag in AWAY_TAGS - {"form"} or tag == "header" and inside != "here":
            inside = "away"
        else:
            weak = said == "away" or tag == "form"
            if said == "here" or tag in ("article", "main"):
                inside = "here"
    element = Element(tag, parent, parent.depth + 1, parent.silent or gone or tag in SILENT, inside,
                      parent.doubt, inside)
    if weak:
        element.doubt = element
    return element


def settle(blocks: list[Block]) -> None:
    """A name or a form puts its element away, unless it holds most of the page's text that no tag puts away, and
    of the article or main part if there is one: such a wrapper says nothing. Then what is inside speaks for
    itself."""
    held: dict[int, list[int]] = {}
    doubts: list[Element] = []
    total, main = 0, 0
    for block in blocks:
        size = len(block.text) - block.linked if block.element.inside != "away" else 0
        here = size * (block.element.inside == "here")
        total, main = total + size, main + here
        d = block.element.doubt
        if d is not None:
            most = held.setdefault(id(d), [0, 0])
            most[0] += size
            most[1] += here
        while d is not None and not d.seen:
            d.seen = True
            doubts.append(d)
            d = d.parent.doubt
    doubts.sort(key=lambda d: -d.depth)
    for d in doubts:
        if (outer := d.parent.doubt) is not None:
            most, part = held.setdefault(id(outer), [0, 0]), held[id(d)]
            most[0] += part[0]
            most[1] += part[1]
    gone: set[int] = set()
    for d in reversed(doubts):
        size, here = held[id(d)]
        if 2 * size <= total or 0 < main >= 2 * here or id(d.parent.doubt) in gone:
            gone.add(id(d))
    for block in blocks:
        e = block.element
        e.state = "away" if id(e.doubt) in gone else e.inside


def blocks_of(page: str) -> list[Block]:
    """Blocks with text, in page order; silent and hidden elements have none."""
    root = Element("", None, 0, False, "")
    stack, found, pieces, linked, links = [root], [], [], 0, 0
    at, end = 0, len(page)
    # Places in the stack: of each tag, and of the elements that hold blocks. So no tag walks the whole stack.
    places: dict[str, list[int]] = {}
    holders = [0]

    def flush():
        nonlocal pieces, linked
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                found.append(Block(text, linked, stack[holders[-1]]))
        pieces, linked = [], 0

    def close(to: int):
        nonlocal links
        for e in stack[to:]:
            links -= e.tag == "a"
            places[e.tag].pop()
        del stack[to:]
        while holders[-1] >= to:
            holders.pop()

    while at < end:
        m = TAG.search(page, at)
        stop = m.start() if m else end
        if stop > at and not stack[-1].silent:
            piece = page[at:stop]
            pieces.append(piece)
            if links > 0:
                linked += len(piece.strip())
        if not m:
            break
        at = m.end()
        slash, tag = m[1], m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if slash:
            if tag in BLOCKS:
                flush()
            if places.get(tag):
                close(places[tag][-1])
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in BLOCKS:
            flush()
        if tag in CLOSES:
            closes, limit = CLOSES[tag]
            stop = max((p[-1] for t in limit if (p := places.get(t))), default=0)
            first = [p[i] for t in closes if (p := places.get(t)) and (i := bisect_right(p, stop)) < len(p)]
            if first:
                close(min(first))
        if tag in VOID:
            continue
        element = child(stack[-1], tag, m[3])
        if tag in RAW:
            over = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = over.end() if over else end
            continue
        if m[3].endswith("/") and tag not in BLOCKS and tag != "a":
            continue
        places.setdefault(tag, []).append(len(stack))
        if tag in BLOCKS:
            holders.append(len(stack))
        stack.append(element)
        links += tag == "a"
    flush()
    settle(found)
    return found


def steps_apart(a: Element, b: Element) -> int:
    """Steps between two elements in the DOM, ``FAR`` at most."""
    n = 0
    while a is not b and n < FAR:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        n += 1
    return n


def cost(block: Block, structured: bool, times: int) -> float:
    """What it costs to call a block content, less what it costs to call it boilerplate. ``times``: how often
    the page has its text."""
    text, state, tag = block.text, block.element.state, block.element.tag
    total = COST[state] if state else COST["outside"] * structured
    total += COST["links"] * min(1.0, block.linked / len(text))
    total += COST["short"] * (len(text) < SHORT)
    total += COST["length"] * min(3.0, max(0.0, math.log2(len(text) / USUAL)))
    total += COST["sentence"] if SENTENCE.search(text) else COST["bare"]
    if len(text) < NOTICES:
        total += COST["rights"] * min(2, len(set(map(str.lower, RIGHTS.findall(text)))))
        total += COST["appeal"] * min(2, len(set(map(str.lower, APPEAL.findall(text)))))
    total += COST["repeated"] * (times > 1 and len(text) < NOTICES)
    total += COST["heading"] * (tag in HEADINGS)
    return total + COST["paragraph"] * (tag in ("p", "blockquote", "pre"))


def ties_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Each block with the one before it, and with the last one under the same parent that says the same of
    itself (what stands between them may be put away)."""
    ties, last = [], {}

    def tie(a, b, weight):
        border = BORDER if blocks[a].element.state != blocks[b].element.state else 1.0
        ties.append((a, b, weight * border))

    for i, block in enumerate(blocks):
        if i:
            steps = steps_apart(blocks[i - 1].element, block.element)
            tie(i - 1, i, NEAR * 0.5 ** max(0, steps - 2))
        parent = id(block.element.parent), block.element.state
        if (before := last.get(parent, i - 1)) < i - 1:
            tie(before, i, NEAR)
        last[parent] = i
    return ties


def main_text(page: str | None) -> str:
    """Content blocks in page order, joined by \\n; white space inside a block is one space."""
    blocks = blocks_of(page) if page else []
    structured = any(b.element.state == "here" for b in blocks)
    times = Counter(b.text for b in blocks)
    costs = [cost(b, structured, times[b.text]) for b in blocks]
    if all(c > 0 for c in costs):
        return ""
    content = labels(costs, ties_of(blocks)) if any(c > 0 for c in costs) else [True] * len(blocks)
    return "\n".join(b.text for b, c in zip(blocks, content) if c)


def extract(df: DataFrame, html_col: str = "html", to: str = "text") -> DataFrame:
    """The frame with the main text of each page; a column of that name is replaced.

    Null, empty and text-free pages give the empty text. Pages are judged on their own and whole; equal
    pages give equal texts. Markup may be broken: open elements end where HTML says so or with the page.
    """
    column = arrow_map(lambda pages: pa.array([main_text(p) for p in pages], pa.string()), "string")
    return df.withColumn(to, column(quoted(html_col)))
