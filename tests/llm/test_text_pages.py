"""Main text by minimum cuts: pages on which the cut decides, against all labellings of a page."""

import itertools
import time
from collections import Counter

import pytest

from rillwork.llm import extract
from rillwork.llm.mincut import labels

LONG = "A sentence of the article, with words and more of them. " * 4


def judged(page):
    blocks = extract.blocks_of(page)
    structured = any(b.element.state == "here" for b in blocks)
    times = Counter(b.text for b in blocks)
    costs = [extract.cost(b, structured, times[b.text]) for b in blocks]
    return blocks, costs, extract.ties_of(blocks)


def price(costs, ties, label):
    return sum(c for c, x in zip(costs, label) if x) + sum(w for a, b, w in ties if label[a] != label[b])


NAMELESS = ("<body><div><a href=a>Home</a></div><div><a href=b>About us</a></div><div><a href=c>Contact</a></div>"
            f"<div><h2>A title of five words</h2><p>{LONG}<p>Chapter two<p>{LONG}<ul><li>A first item<li>{LONG}</ul></div>"
            "<div><a href=a>Home</a> <a href=b>Terms</a></div><div>© 2024 Somebody. All rights reserved.</div></body>")
#: Pages without names, or whose names mislead, and what is to be found in them.
PAGES = {
    "nameless": (NAMELESS, ["A title of five words", LONG.strip(), "Chapter two", LONG.strip(), "A first item",
                            LONG.strip()]),
    "advert in an article": (
        f"<article><h1>Title here</h1><p>{LONG}</p><div>Buy now from our sponsor</div><p>{LONG}</p></article>",
        ["Title here", LONG.strip(), LONG.strip()]),
    "advert with a link": (
        f"<article><p>{LONG}</p><div><a href=x>Special offer, click here</a></div><p>{LONG}</p></article>",
        [LONG.strip(), LONG.strip()]),
    "notice in an article": (
        f"<main><p>{LONG}</p><div>We use cookies. Accept cookies or read the privacy policy</div><p>{LONG}</p></main>",
        [LONG.strip(), LONG.strip()]),
    "license line in an article": (
        f"<article><p>{LONG}</p><p>© 2020 Somebody. All rights reserved.</p><p>{LONG}</p></article>",
        [LONG.strip(), "© 2020 Somebody. All rights reserved.", LONG.strip()]),
    "one blurb among links": (
        "<body><ul><li><a href=a>One</a><li>Welcome.<li><a href=b>Two</a><li><a href=c>Three</a></ul>"
        f"<div><p>{LONG}<p>{LONG}</div></body>", [LONG.strip(), LONG.strip()]),
    "table of an article": (
        f"<article><p>{LONG}<table><tr><td>Year<td>Sum<tr><td>1999<td>12</table><p>{LONG}</article>",
        [LONG.strip(), "Year", "Sum", "1999", "12", LONG.strip()]),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages_on_which_names_do_not_help(name):
    page, want = PAGES[name]
    assert extract.main_text(page).split("\n") == want


def test_the_cut_changes_labels_for_the_better():
    flipped = 0
    for page, want in PAGES.values():
        blocks, costs, ties = judged(page)
        right = set(want)
        for b, c, x in zip(blocks, costs, labels(costs, ties)):
            if x != (c <= 0):
                flipped += 1
                assert x == (b.text in right), (b.text, c)
    assert flipped >= 4, flipped


@pytest.mark.parametrize("name", PAGES)
def test_cuts_are_the_cheapest_of_all_labellings(name):
    _, costs, ties = judged(PAGES[name][0])
    best = min(price(costs, ties, label) for label in itertools.product((True, False), repeat=len(costs)))
    assert abs(price(costs, ties, labels(costs, ties)) - best) < 1e-6


@pytest.mark.parametrize("page", ["<div>" * 150_000 + "</x>" * 60_000, "<b>" * 150_000 + "<li>x" * 100_000,
                                  "<p>" * 300_000, "<ul><li>a" * 40_000, "<table><tr><td>a" * 30_000])
def test_broken_pages_take_linear_time(page):
    start = time.monotonic()
    extract.main_text(page)
    assert time.monotonic() - start < 15
