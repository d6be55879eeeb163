"""Runs by grammar against brute force."""

import os
import re
import sys

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from qualia.llm import runs  # noqa: E402


def brute(w):
    """(start, length, smallest period) of all runs, from the definition."""
    n, found = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, l, q) for (s, l), q in found.items()), key=lambda r: (r[0], r[2]))


def by_grammar(texts, exact=False):
    """Runs of texts given as lists of words."""
    ids, flat = {}, []
    for t, words in enumerate(texts):
        flat += [ids.setdefault((t, w), len(ids)) for w in words]
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    start, length, period = runs.find(np.array(flat, np.int64), first, exact)
    out = [[] for _ in texts]
    for s, l, q in zip(start.tolist(), length.tolist(), period.tolist()):
        t = int(np.searchsorted(first, s, "right")) - 1
        out[t].append((s - int(first[t]), l, q))
    return out


texts = st.lists(st.one_of(st.lists(st.integers(0, 1), max_size=60), st.lists(st.integers(0, 3), max_size=40),
                           st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=7), st.integers(2, 9), st.lists(st.integers(0, 3), max_size=5)).map(lambda x: x[2] + x[0] * x[1] + x[2])), max_size=5)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_any_texts(t):
    want = [brute(w) for w in t]
    assert by_grammar(t) == want
    assert by_grammar(t, exact=True) == want


@pytest.mark.parametrize("w", [[0] * 5, [0] * 6, [0] * 1000, [0, 1] * 500, ([0] * 6 + [1]) * 5, [0, 1, 2] * 4, [0, 1, 2] * 3 + [0, 1], [0] * 9 + [1] * 9, (([0, 1] * 4 + [2]) * 4 + [3]) * 4])
def test_shapes(w):
    assert by_grammar([w, [7], [], w + w]) == [brute(w), [], [], brute(w + w)]


def test_long_texts_and_overlaid_words():
    rng = np.random.default_rng(4)
    w = rng.zipf(1.3, 4000) % 500
    w[700:1900] = np.tile(w[700:1000], 4)
    w[2500:2600] = 3
    thue = [0]
    for _ in range(11):  # hashes modulo a power of two agree on parts of this word that differ
        thue += [1 - x for x in thue]
    t = [w.tolist(), thue, (w[:50].tolist()) * 9]
    assert by_grammar(t) == [brute(x) for x in t]


def test_hashes_that_err_are_found_out(monkeypatch):
    monkeypatch.setattr(runs._Words, "hash", lambda self, start, size: np.zeros(len(start), np.uint64))
    t = [[0, 1, 2, 3, 0, 1, 0, 1, 0, 1, 0, 1, 5, 0, 1], [2] * 9]
    assert by_grammar(t) == [brute(x) for x in t]


def test_rules_are_pairs_and_every_place_is_known():
    w = np.array([0, 1, 0, 1, 2, 0, 1, 2, 0, 1], np.int64)
    g = runs.Grammar(w, np.array([0, len(w)]))
    for k in range(len(g.size)):
        want = w[g.place[k]:g.place[k] + g.size[k]]
        for at in g.at[g.made == k]:
            assert (w[at:at + g.size[k]] == want).all()
    assert sorted(g.at[g.made == 0].tolist()) == [0, 2, 5, 8] and g.size.max() == len(w)


def test_on_spark(spark):
    rows = [(1, "a b  a\tb a b\na b x", 0, "k"), (None, None, 1, None), (3, "", 2, "k"), (4, " \n", 3, "k"), (1, "z " * 7, 4, "k"), (1, "z " * 7, 5, "k"),
            (5, "w" * 100_000 + " q" * 50_000, 6, "k"), (6, "é  é  é  é  é  é  A a", 7, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _words int, _runs string")
    got = {r._words: r for r in runs.with_runs(df).collect()}
    assert len(got) == 8
    for _, text, k, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        want = brute(w) if k != 6 else [(1, 50_000, 1)]
        assert [tuple(r) for r in got[k].runs] == want and got[k].n_words == len(w)
        drop = {i for s, l, q in want for i in range(s + q, s + l)}
        assert got[k].collapsed == " ".join(x for i, x in enumerate(w) if i not in drop)
    assert runs.with_runs(df.limit(0)).count() == 0
    assert runs.with_runs(df.withColumnRenamed("_runs", "runs")).columns == ["doc_id", "_words", "n_words", "runs", "collapsed"]
