"""Pages on which the cut must overrule the classifier, and pages that are broken or large."""

import os
import sys
import time

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from qualia.llm import htmlcut  # noqa: E402

LONG = "A sentence of the page that is long enough to count, with some more words. And one more sentence after it."
LINKS = "".join(f"<li><a href='/{i}'>Section number {i}</a></li>" for i in range(4))


def signs_and_cut(page):
    found = htmlcut.blocks(page)
    odds, edges = htmlcut.graph(found)
    side = htmlcut.min_cut(odds, edges)[:len(found)]
    return {text: (odds[k] > 0, side[k]) for k, (text, *_) in enumerate(found)}


def test_short_block_between_content_is_content():
    got = signs_and_cut(f"<body><div><p>{LONG}</p><p>Like so:</p><p>{LONG} 2</p></div>")
    assert got["Like so:"] == (False, True)
    assert htmlcut.main_text(f"<div><div>{LONG}</div><div>Like so:</div><div>{LONG}</div></div>")[0] == f"{LONG}\n\nLike so:\n\n{LONG}"


def test_sentence_among_links_is_none():
    got = signs_and_cut(f"<body><div><ul>{LINKS}<li>All the news of the day, here.</li>{LINKS}</ul></div><div><p>{LONG}</p><p>{LONG} 2</p></div>")
    assert got["All the news of the day, here."] == (True, False)
    assert got[LONG] == (True, True)


def test_link_list_without_nav_and_plain_page():
    page = f"<body><div><ul>{LINKS}</ul></div><div><h2>Head line</h2><p>{LONG}</p><p>Yes.</p><p>{LONG}</p></div><div><ul>{LINKS}</ul></div>"
    assert htmlcut.main_text(page)[0] == f"Head line\n\n{LONG}\n\nYes.\n\n{LONG}"


def test_words_of_classes_can_be_overruled():
    got = signs_and_cut(f"<article><p>{LONG}</p><div class='widget'><p>{LONG} And this is a part of it. Yes, it is.</p></div><p>{LONG} 2</p></article>")
    assert [x[1] for x in got.values()] == [True, False, True]  # a firm word with nothing else for it stays out
    got = signs_and_cut(f"<div class='main'><p>{LONG}</p><p class='tags'>a <a href='#'>b</a></p><p>{LONG} 2</p></div>")
    assert [x[1] for x in got.values()] == [True, False, True]


@pytest.mark.parametrize("tag", ["math", "object", "canvas", "audio", "video", "svg", "noscript"])
def test_text_of_embedded_elements_is_kept(tag):
    assert htmlcut.main_text(f"<article><p>{LONG} <{tag}>x plus y</{tag}> goes on.</p></article>")[0] == f"{LONG} x plus y goes on."


@pytest.mark.parametrize("page", [
    "<a " * 300_000 + "'", "<a href=\"x" * 90_000, "<p title='" * 90_000, "<b>" * 100_000 + "<p>x" * 60_000, "<div>" * 60_000 + "</span>" * 100_000,
    "<p><div>" + "<b>" * 100_000 + "<p>x</p>" * 50_000, "<!--" * 200_000, "<" * 900_000, "<script>" * 100_000, "<i><p>a</i>" * 60_000, "&#" * 400_000,
    "<table><tr><td>a b c" * 30_000, f"<div><p>{LONG}</p><p>ok</p></div>" * 6_000])
def test_large_broken_pages_take_time_in_proportion(page):
    began = time.process_time()
    htmlcut.main_text(page)
    assert time.process_time() - began < 5


def test_attributes_hold_any_marks():
    assert htmlcut.main_text(f"<article><p title='a > b' data-x=\"it's\">{LONG}</p></article>")[0] == LONG
    assert htmlcut.main_text(f"<article><p title='never closed>{LONG}</p><p>{LONG} 2</p></article>")[0] == f"{LONG}\n\n{LONG} 2"
    assert htmlcut.main_text(f"<article><p it's>{LONG}</p></article>")[0] == LONG


def test_min_cut_of_larger_graphs_equals_plain_flow():
    rng = np.random.default_rng(0)
    for n in (12, 40, 90):
        odds = rng.normal(0, 1.5, n).round(2).tolist()
        edges = {(int(a), int(b)): float(rng.random() * 2) for a, b in {tuple(sorted(x)) for x in rng.integers(0, n, (3 * n, 2)).tolist() if x[0] != x[1]}}
        cost = lambda s: sum(max(-o, 0) if x else max(o, 0) for o, x in zip(odds, s)) + sum(c for (a, b), c in edges.items() if s[a] != s[b])
        assert cost(htmlcut.min_cut(odds, edges)) == pytest.approx(_flow(odds, edges))


def _flow(odds, edges):
    """The value of a maximum flow, by augmenting depth first with capacities in a matrix."""
    n = len(odds)
    cap = np.zeros((n + 2, n + 2))
    for (a, b), c in edges.items():
        cap[a, b] += c
        cap[b, a] += c
    for k, o in enumerate(odds):
        cap[n, k], cap[k, n + 1] = max(o, 0), max(-o, 0)
    total = 0.0
    while True:
        came, row = {n: n}, [n]
        for a in row:
            for b in np.flatnonzero(cap[a] > 1e-9).tolist():
                if b not in came:
                    came[b] = a
                    row.append(b)
        if n + 1 not in came:
            return total
        path, b = [], n + 1
        while b != n:
            path.append((came[b], b))
            b = came[b]
        f = min(cap[x] for x in path)
        for a, b in path:
            cap[a, b] -= f
            cap[b, a] += f
        total += f
