"""Periodic runs of words by grammar compression.

1. Re-Pair: the pairs of neighbouring symbols that occur most often become symbols of their own,
   until no pair occurs twice. All texts of a slice are worked on side by side: in each round an
   occurrence is replaced if its pair is more frequent than the two pairs that it overlaps.
   What is left of a text is joined by a balanced tree, so every stretch of two words or more
   has one lowest symbol whose boundary it crosses.
2. The runs that cross the boundary of a symbol, inside its own words, are found once for each
   symbol. A run of four periods or more has two whole periods on one side of the boundary:
   candidates are the distances from the boundary word to its like on that side, hashes of
   the two periods decide, and binary search on hashes gives the run's ends.
3. Each found interval is put at every place where its symbol was made, and of the intervals of one
   period those inside another go; of equal intervals the smallest period stays.
4. The runs are checked on the words themselves; should hashes have erred, that slice's ends are counted word by word.

Texts are read whole, each inside one task. Defined results: a null or empty text has no words and no runs; repeated
rows are read each; an empty table gives no rows; other columns of any name are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from qualia.llm.shared import plain_names, ship
from qualia.llm.textops import BASE, NON_SPACE, U64, mix64, powers, span_hashes, text_slices, word_spans

#: A run has at least so many words and so many periods.
LENGTH, PERIODS = 6, 4
#: Candidates looked at in one go.
MOST = 1 << 20
RUN = "array<struct<start: long, length: long, period: long>>"


def _first_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of each different key's first row, number of each row's key, rows of each key)."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    at = np.flatnonzero(new)
    number = np.empty(len(k), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[at], number, np.diff(np.append(at, len(k)))


class Grammar:
    """Re-Pair over the words of several texts. words: ids that differ between texts; first: first word of each text, and the total.

    Of every symbol that is two others joined: place (its first place in the words), left, size (words of its
    left part, of all), and in made / at the symbols' numbers and places wherever one was made.
    """

    def __init__(self, words: np.ndarray, first: np.ndarray):
        n = len(words)
        symbol, place = words.astype(np.int64), np.arange(n)
        size_of = [np.ones(int(words.max()) + 1 if n else 0, np.int64)]
        symbols = len(size_of[0])
        self.place, self.left, self.size, self.made, self.at = ([] for _ in range(5))
        count = 0
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        live = np.flatnonzero(text[1:] == text[:-1]) if n else np.zeros(0, np.int64)  # symbols whose pair with the next may occur twice
        while len(live):
            a, b = symbol[live], symbol[live + 1]
            pair = (a.astype(U64) << U64(32)) | b.astype(U64)
            _, number, rows = _first_of(pair)
            often = rows[number]
            keep = often > 1
            live, number, pair, often = live[keep], number[keep], pair[keep], often[keep]
            if not len(live):
                break
            rank = (np.minimum(often, 1 << 23).astype(U64) << U64(40)) | (mix64(pair) >> U64(24))  # more frequent first, ties in a fixed order
            weight = np.zeros(len(symbol) + 1, U64)
            weight[live] = rank
            best = (rank >= weight[live + 1]) & (rank >= np.where(live > 0, weight[live - 1], U64(0)))
            pick, which = live[best], number[best]
            if len(pick):  # of neighbours in a row (one word over and over) every second one
                joined = np.zeros(len(pick), bool)
                joined[1:] = np.diff(pick) == 1
                start = np.maximum.accumulate(np.where(joined, 0, np.arange(len(pick))))
                even = (np.arange(len(pick)) - start) % 2 == 0
                pick, which = pick[even], which[even]
            some, renumbered, _ = _first_of(which)
            left = np.concatenate(size_of) if len(size_of) > 1 else size_of[0]
            size_of = [left]
            l = left[symbol[pick[some]]]
            size = l + left[symbol[pick[some] + 1]]
            self._add(place[pick[some]], l, size, count + renumbered, place[pick])
            count += len(some)
            symbol[pick] = symbols + renumbered
            size_of.append(size)
            symbols += len(some)
            stay = np.ones(len(symbol), bool)
            stay[pick + 1] = False
            touched = np.zeros(len(symbol), bool)
            touched[live] = True
            touched[pick] = True
            before = pick - 1
            touched[before[before >= 0]] = True  # the one before a new symbol makes a new pair (if it stays)
            symbol, place, touched, text = symbol[stay], place[stay], touched[stay], text[stay]
            live = np.flatnonzero(touched[:-1] & (text[1:] == text[:-1]))
        self._tree(place, text, n)
        self.place, self.left, self.size, self.made, self.at = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (self.place, self.left, self.size, self.made, self.at))

    def _add(self, place, left, size, made, at) -> None:
        for name, x in (("place", place), ("left", left), ("size", size), ("made", made), ("at", at)):
            getattr(self, name).append(x)

    def _tree(self, place: np.ndarray, text: np.ndarray, n: int) -> None:
        """Neighbours of what is left are joined two by two, level by level, each pair a symbol of its own."""
        count = sum(len(x) for x in self.place)
        end = np.append(place[1:], n) if len(place) else place
        while len(place) > 1:
            first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
            odd = (np.arange(len(place)) - np.repeat(first, np.diff(np.append(first, len(place))))) % 2 == 1
            right = np.flatnonzero(odd)
            if not len(right):
                break
            left = right - 1
            self._add(place[left], end[left] - place[left], end[right] - place[left], count + np.arange(len(left)), place[left])
            count += len(left)
            end[left] = end[right]
            place, end, text = place[~odd], end[~odd], text[~odd]


class _Words:
    """Hashes of stretches of the words."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        up, self.down = powers(self.n + 1)
        self.total = np.zeros(self.n + 1, U64)
        with np.errstate(over="ignore"):
            np.cumsum(mix64(words.astype(U64) + U64(0x5851F42D4C957F2D)) * up[:self.n], out=self.total[1:])

    def hash(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.total[start + size] - self.total[start]) * self.down[start]

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How many words from places a and b on (or before them) are the same, at most ``most``."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64)
        while (todo := np.flatnonzero(low < high)).size:
            mid = (low[todo] + high[todo] + 1) >> 1
            shift = mid if back else 0
            same = self.hash(a[todo] - shift, mid) == self.hash(b[todo] - shift, mid)
            low[todo[same]] = mid[same]
            high[todo[~same]] = mid[~same] - 1
        return low


def _candidates(words: np.ndarray, g: Grammar) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(symbols, distances, whether on the right side): places of the boundary word within half of that side."""
    order = np.argsort(words, kind="stable")
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    key = words[order].astype(np.int64) * (len(words) + 1) + order
    every = np.flatnonzero(g.size >= LENGTH)
    for right in (False, True):
        edge = g.place[every] + g.left[every] - (not right)
        reach = np.where(right, g.size[every] - g.left[every], g.left[every]) // 2
        own = words[edge].astype(np.int64) * (len(words) + 1)
        if right:
            low, high = rank[edge] + 1, np.searchsorted(key, own + edge + reach, "right")
        else:
            low, high = np.searchsorted(key, own + edge - reach, "left"), rank[edge]
        some = np.flatnonzero(high > low)
        number = (high - low)[some]
        ends = np.cumsum(number)
        lo = 0
        while lo < len(some):
            hi = max(int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + MOST, "right")), lo + 1)
            k = number[lo:hi]
            who = np.repeat(some[lo:hi], k)
            at = order[np.repeat(low[some[lo:hi]] - (np.cumsum(k) - k), k) + np.arange(k.sum())]
            yield every[who], np.abs(at - edge[who]), right
            lo = hi


def _crossing(words: np.ndarray, g: Grammar, exact: bool) -> tuple[np.ndarray, ...]:
    """(symbol, start in its words, length, period) of the runs across each symbol's boundary, inside its own words."""
    h = _Words(words)
    out = [np.zeros((4, 0), np.int64)]
    for who, q, right in _candidates(words, g):
        edge = g.place[who] + g.left[who]
        a = edge if right else edge - 2 * q
        keep = h.hash(a, q) == h.hash(a + q, q)
        who, q, a, edge = who[keep], q[keep], a[keep], edge[keep]
        if not len(who):
            continue
        low, high = g.place[who], g.place[who] + g.size[who]
        if exact:
            start, end = _ends(words, a, q, low, high)
        else:
            start = a - h.common(a, a + q, a - low, True)
            end = a + 2 * q + h.common(a + q, a + 2 * q, high - a - 2 * q, False)
        ok = (end - start >= np.maximum(LENGTH, PERIODS * q)) & (start < edge) & (end > edge)
        out.append(np.stack([who, start - low, end - start, q])[:, ok])
    return tuple(np.concatenate(out, axis=1))


def _ends(words: np.ndarray, a: np.ndarray, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same, word by word."""
    start, end = a.copy(), a + q
    for k in range(len(a)):
        while start[k] > low[k] and words[start[k] - 1] == words[start[k] - 1 + q[k]]:
            start[k] -= 1
        while end[k] < high[k] and end[k] - q[k] >= a[k] and words[end[k]] == words[end[k] - q[k]]:
            end[k] += 1
    return start, end


def _true(words: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bool:
    """Whether each stretch really has its period."""
    for a, n, q in zip(start.tolist(), length.tolist(), period.tolist()):
        if (words[a:a + n - q] != words[a + q:a + n]).any():
            return False
    return True


def find(words: np.ndarray, first: np.ndarray, exact: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start and period. words: ids that differ between texts."""
    g = Grammar(words, first)
    who, start, length, period = _crossing(words, g, exact)
    # all places of the symbols that have runs
    order = np.argsort(g.made, kind="stable")
    made = g.made[order]
    a, b = np.searchsorted(made, who, "left"), np.searchsorted(made, who, "right")
    k = b - a
    place = g.at[order[np.repeat(a - (np.cumsum(k) - k), k) + np.arange(k.sum())]]
    start, length, period = place + np.repeat(start, k), np.repeat(length, k), np.repeat(period, k)
    # of one period, those inside another go
    order = np.lexsort((-length, start, period))
    start, length, period = start[order], length[order], period[order]
    _, number, _ = _first_of(period)
    end = start + length + number * (len(words) + 1)
    before = np.maximum.accumulate(np.append(-1, end[:-1])) if len(end) else end
    keep = end > before
    start, length, period = start[keep], length[keep], period[keep]
    # of equal stretches the smallest period stays
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    keep = np.ones(len(start), bool)
    keep[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[keep], length[keep], period[keep]
    if not exact and not _true(words, start, length, period):
        return find(words, first, True)
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def word_ids(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids that differ between texts, first word of each text and the total, starts, ends of the words in the bytes)."""
    start, end, first = word_spans(data, off, NON_SPACE)
    text = np.repeat(np.arange(len(off) - 1), np.diff(first))
    with np.errstate(over="ignore"):
        h = mix64(span_hashes(data, start, end, None) + text.astype(U64) * BASE)
    return _first_of(h)[1], first, start, end


def _runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns: text, the others as they are."""
    for batch in batches:
        for lo, hi, data, off in text_slices(batch.column(0), 1 << 20):
            words, first, a, b = word_ids(data, off)
            start, length, period = find(words, first)
            n = len(off) - 1
            text = np.searchsorted(first, start, "right") - 1 if len(start) else start
            flat = pa.StructArray.from_arrays([pa.array(start - first[text]), pa.array(length), pa.array(period)], ["start", "length", "period"])
            runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(n + 1)).astype(np.int32)), flat)
            step = np.zeros(len(words) + 1, np.int64)
            np.add.at(step, start + period, 1)
            np.add.at(step, start + length, -1)
            kept = np.cumsum(step[:-1]) == 0
            raw, rest = data.tobytes(), []
            whole = np.add.reduceat(np.append(~kept, False), first[:-1]) == 0 if n else np.zeros(0, bool)
            whole |= np.diff(first) == 0
            for k in range(n):
                own = raw[off[k]:off[k + 1]].split()
                if not whole[k]:
                    own = [own[i] for i in np.flatnonzero(kept[first[k]:first[k + 1]]).tolist()]
                rest.append(b" ".join(own))
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[1:], pa.array(np.diff(first)), runs, pa.array(rest, pa.binary()).cast(pa.string())],
                [*part.schema.names[1:], "_words", "_runs", "_rest"])


def with_runs(docs: DataFrame, *, text_col: str = "text", names: tuple[str, str, str] = ("n_words", "runs", "collapsed")) -> DataFrame:
    """``docs`` without its text, with the number of words, all runs by start and period (words numbered from 0), and the
    text of the words that no run holds after its first period, joined by single spaces. Columns called ``names`` are replaced."""
    docs = docs.drop(*set(names) - {text_col})
    ship(docs.sparkSession)
    plain, name = plain_names(docs)
    others = [name[c] for c in docs.columns if c != text_col]
    schema = ", ".join([*(f"{c} {plain.schema[c].dataType.simpleString()}" for c in others), "_words long", f"_runs {RUN}", "_rest string"])
    found = plain.select(name[text_col], *others).mapInArrow(_runs_of, schema)
    return found.toDF(*[c for c in docs.columns if c != text_col], *names)
