"""Toxic documents: a Levenshtein automaton over a lexicon trie, and scores of its hits' contexts.

1. The lexicon is learned from labelled documents: words, and stems (a word's first letters,
   any ending), that speak for the label. Near copies in the sample count once.
2. Its trie is walked by a Levenshtein automaton: a state is the set of (trie node, errors) that
   a prefix of a text word can stand for; states are made when first met and kept in a table, so
   that words of all texts run through them side by side, a letter at a time.
   Entries of at least ``FUZZY_LENGTH`` letters match with one error, shorter ones exactly.
3. Each hit's window tells quotation (quote marks around it) from abuse (other hits near by);
   counts and weights by kind of match and context are the features of a logistic regression,
   fitted on labelled documents that the lexicon has not seen.

Defined results: null and empty texts are scored by the model with no hits; documents with a null
id are never trained on; without labelled documents of both kinds every score is 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from qualia.llm.neardup import shingle_sets
from qualia.llm.sample import labelled
from qualia.llm.shared import ship, staged

#: Labelled documents of a fit; documents of them that must hold an entry of the lexicon, and its least log-odds. All entries that
#: these admit are taken: their number is bounded by the words of the sample.
MOST, LEAST_DOCS, LEAST_ODDS = 24_000, 4, 2.0
#: Letters of stems; different words that a stem must cover; letters from which one error is allowed.
STEMS, STEM_WORDS, FUZZY_LENGTH = (4, 5, 6), 4, 5
#: Letters on either side in which quote marks are looked for, and words in which other hits count.
QUOTE_REACH, NEAR_WORDS = 40, 12
#: Code points.
CODES = 0x110000
QUOTES = "\"'“”„‟«»‹›‘’「」『』"

_WORD = re.compile(r"[^\W_]+")
FEATURES = ("exact", "exact_quoted", "fuzzy", "fuzzy_quoted", "stem", "stem_quoted", "odds", "odds_quoted", "sum_odds", "entries", "density", "per_word", "length")


@dataclass(frozen=True)
class Entry:
    text: str
    stem: bool
    odds: float


class Automaton:
    """The lexicon's trie, and the states of its Levenshtein automaton met so far."""

    def __init__(self, entries: list[Entry]):
        self.entries = entries
        self.next: list[dict[str, int]] = [{}]
        self.word_at: dict[int, int] = {}
        self.stem_at: dict[int, int] = {}
        for k, e in enumerate(entries):
            node = 0
            for c in e.text:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                node = self.next[node][c]
            (self.stem_at if e.stem else self.word_at)[node] = k
        letters = sorted({c for e in entries for c in e.text})
        self.letter = [""] + letters  # class 0: any other letter
        self.classes = np.zeros(CODES, np.int16)
        for k, c in enumerate(letters, 1):
            self.classes[ord(c)] = k
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.table = np.full((1024, len(self.letter)), -1, np.int32)
        self.found = np.full(1024, -1, np.int32)  # match of a word that ends here: entry * 2 + errors
        self.over = np.zeros(1024, bool)  # nothing that follows can change the match
        self.start = self._state(self._closed({(0, 0)}))

    def _closed(self, items: set) -> frozenset:
        """With letters of the lexicon that the text leaves out; ("stem", entry, errors) stays whatever follows."""
        out = set(items)
        for x in items:
            if x[0] != "stem" and x[1] == 0:
                out.update((child, 1) for child in self.next[x[0]].values())
        for x in list(out):
            if x[0] != "stem" and x[0] in self.stem_at:
                k = self.stem_at[x[0]]
                if x[1] == 0 or len(self.entries[k].text) > FUZZY_LENGTH:
                    out.add(("stem", k, x[1]))
        return frozenset(x for x in out if x[0] == "stem" or x[1] == 0 or (x[0], 0) not in out)

    def _state(self, items: frozenset) -> int:
        if items in self.states:
            return self.states[items]
        k = self.states[items] = len(self.sets)
        self.sets.append(items)
        if k >= len(self.found):
            self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
            self.found = np.concatenate([self.found, np.full_like(self.found, -1)])
            self.over = np.concatenate([self.over, np.zeros_like(self.over)])
        matches = []
        for x in items:
            if x[0] == "stem":
                matches.append((x[2], -self.entries[x[1]].odds, x[1]))
            elif x[0] in self.word_at and (x[1] == 0 or len(self.entries[self.word_at[x[0]]].text) >= FUZZY_LENGTH):
                e = self.word_at[x[0]]
                matches.append((x[1], -self.entries[e].odds, e))
        if matches:
            errors, _, e = min(matches)
            self.found[k] = e * 2 + errors
        self.over[k] = all(x[0] == "stem" for x in items)
        return k

    def _step(self, state: int, letter: int) -> int:
        c = self.letter[letter]
        out = set()
        for x in self.sets[state]:
            if x[0] == "stem":
                out.add(x)
                continue
            node, errors = x
            for d, child in self.next[node].items():
                if letter and d == c:
                    out.add((child, errors))
                elif errors == 0:
                    out.add((child, 1))
            if errors == 0:
                out.add((node, 1))
        return self._state(self._closed(out))

    def run(self, classes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The match of each word (spans of letter classes), -1 if none."""
        state = np.full(len(start), self.start, np.int32)
        live = np.arange(len(start))
        at = start.copy()
        while len(live):
            s, c = state[live], classes[at[live]]
            new = self.table[s, c]
            unknown = np.flatnonzero(new < 0)
            if len(unknown):
                for key in np.unique(s[unknown].astype(np.int64) * len(self.letter) + c[unknown]).tolist():
                    a, b = divmod(key, len(self.letter))
                    to = self._step(a, b)
                    self.table[a, b] = to
                new = self.table[s, c]
            state[live] = new
            at[live] += 1
            live = live[~self.over[new] & (at[live] < end[live])]
        return self.found[state]


@lru_cache(1)
def _is_word_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalnum() for c in range(CODES)), bool, CODES)


def hits(text: str, automaton: Automaton, letters: np.ndarray) -> tuple:
    """(words, match of each word, starts, ends, code points) of a text."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    m = np.zeros(len(code) + 2, np.int8)
    m[1:-1] = letters[code]
    step = np.diff(m)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    return automaton.run(automaton.classes[code], start, end), start, end, code


_QUOTE_CODES = np.array([ord(c) for c in QUOTES], np.uint32)


def describe(text: str, automaton: Automaton, letters: np.ndarray) -> list[float]:
    """The features of a text."""
    found, start, end, code = hits(text, automaton, letters)
    n = len(start)
    out = dict.fromkeys(FEATURES, 0.0)
    out["length"] = float(np.log1p(n))
    at = np.flatnonzero(found >= 0)
    if len(at):
        count: Counter = Counter()
        seen: dict[int, float] = {}
        near = np.searchsorted(at, at + NEAR_WORDS, "right") - np.searchsorted(at, at - NEAR_WORDS)
        for k, w in enumerate(at.tolist()):
            e, errors = divmod(int(found[w]), 2)
            before, after = code[max(start[w] - QUOTE_REACH, 0):start[w]], code[end[w]:end[w] + QUOTE_REACH]
            quoted = "_quoted" if np.isin(before, _QUOTE_CODES).any() and np.isin(after, _QUOTE_CODES).any() else ""
            entry = automaton.entries[e]
            count[("fuzzy" if errors else "stem" if entry.stem else "exact") + quoted] += 1
            odds = entry.odds * (0.5 if errors else 1.0)
            out["odds" + quoted] = max(out["odds" + quoted], odds)
            seen[e] = max(seen.get(e, 0.0), odds)
            out["density"] = max(out["density"], float(near[k] - 1))
        for k, v in count.items():
            out[k] = float(np.log1p(v))
        out["sum_odds"] = float(np.log1p(sum(seen.values())))
        out["entries"] = float(np.log1p(len(seen)))
        out["density"] = float(np.log1p(out["density"]))
        out["per_word"] = float(np.log1p(1000 * len(at) / n))
    return [out[f] for f in FEATURES]


# -- learning ------------------------------------------------------------------------------
def _term_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, stem, label, documents) of the documents of a partition."""
    counts: Counter = Counter()
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1)):
            words = set(_WORD.findall(text.as_py().lower()))
            label = label.as_py()
            counts.update((w, 0, label) for w in words)
            counts.update((s, 1, label) for s in {w[:k] for w in words for k in STEMS if len(w) > k})
    if counts:
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts]), pa.array([k[1] for k in counts], pa.int32()), pa.array([k[2] for k in counts], pa.int32()),
                                          pa.array(list(counts.values()), pa.int64())], ["term", "stem", "label", "docs"])


def _signer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        least = [int(h[0] >> np.uint64(1)) if len(h) else -1 for h in shingle_sets(batch.column(1), 3)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[1:], pa.array(least, pa.int64())], [*batch.schema.names, "least"])


def learn_lexicon(rows: DataFrame) -> list[Entry]:
    """Entries for documents (text, label 0 or 1), strongest first."""
    n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return []
    terms = rows.select("text", "label").mapInArrow(_term_counter, "term string, stem int, label int, docs long")
    t = terms.groupBy("term", "stem").agg(F.sum(F.when(F.col("label") == 1, F.col("docs")).otherwise(0)).alias("a"), F.sum(F.when(F.col("label") == 0, F.col("docs")).otherwise(0)).alias("c"))
    t = t.withColumn("odds", F.expr(f"ln((a + 0.5) / {toxic + 1}) - ln((c + 0.5) / {clean + 1})"))
    t = t.where(f"a >= {LEAST_DOCS} and odds >= {LEAST_ODDS}").orderBy(F.expr("odds * sqrt(a)").desc(), "term", "stem")
    got = [(r["term"], bool(r["stem"]), r["a"], r["odds"]) for r in t.collect()]  # terms of the bounded sample
    covered: Counter = Counter(w[:k] for w, stem, _, _ in got if not stem for k in STEMS if len(w) > k)  # words of each stem
    strongest: dict[str, int] = {}
    for w, stem, a, _ in got:
        for k in STEMS:
            if not stem and len(w) >= k:
                strongest[w[:k]] = max(strongest.get(w[:k], 1), a)
    stems = {w: (a, odds) for w, stem, a, odds in got if stem}
    out = []
    for w, stem, a, odds in got:
        shorter = next((stems[w[:k]] for k in STEMS if k < len(w) + (not stem) and w[:k] in stems), None)
        if stem:
            # a stem stands for many endings; a shorter one that is as sure makes it needless
            if covered[w] < STEM_WORDS and a < 3 * strongest.get(w, 1):
                continue
            if shorter and shorter[1] >= odds - 0.5:
                continue
        out.append(Entry(w, stem, float(odds)))
    return out


@dataclass
class Model:
    entries: list[Entry]
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.entries:
            return np.zeros(len(x))
        z = (x - self.mean) / self.spread @ self.weights[1:] + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Newton's method for a logistic regression on scaled features."""
    mean, spread = x.mean(0), x.std(0) + 1e-6
    z = np.concatenate([np.ones((len(x), 1)), (x - mean) / spread], 1)
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        move = np.linalg.solve(h, z.T @ (p - y) + penalty * w)
        w -= move
        if np.abs(move).max() < 1e-6:
            break
    return mean, spread, w


def _describer(entries):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, letters = Automaton(entries.value), _is_word_letter()
        for batch in batches:
            x = [describe(t.as_py() or "", a, letters) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(x, pa.list_(pa.float64()))], ["label", "x"])
    return run


def train(docs: DataFrame, labels: DataFrame, label: Column, *, id_col: str = "doc_id", text_col: str = "text", allowed: Column | None = None, most: int = MOST) -> Model:
    """Lexicon from three fifths of the sample, regression on the rest; near copies once."""
    spark = docs.sparkSession
    ship(spark)
    rows = labelled(docs, labels, label.cast("int"), most, id_col=id_col, text_col=text_col, allowed=allowed)
    rows = staged(rows.mapInArrow(_signer, "id long, text string, label int, r long, least long"), "toxic-sample")
    one = W.partitionBy("least").orderBy("r", "id")
    ids = rows.select("id", "r", "least").withColumn("k", F.row_number().over(one)).where("k = 1").select("id").distinct()
    rows = rows.join(F.broadcast(ids), "id")  # at most ``most`` ids
    first = F.pmod(F.xxhash64(F.lit("part"), "least"), F.lit(5)) < 3
    entries = learn_lexicon(rows.where(first))
    nothing = np.zeros(len(FEATURES))
    if not entries:
        return Model([], nothing, nothing + 1, np.zeros(len(FEATURES) + 1))
    run = _describer(spark.sparkContext.broadcast(entries))
    got = rows.where(~first).select("text", "label").mapInArrow(run, "label int, x array<double>").toArrow()  # at most ``most`` rows
    y = got["label"].to_numpy().astype(float)
    if len(np.unique(y)) < 2:
        return Model([], nothing, nothing + 1, np.zeros(len(FEATURES) + 1))
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    return Model(entries, *fit(x, y))


def _scorer(model, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        a, letters = Automaton(m.entries), _is_word_letter()
        for batch in batches:
            x = np.array([describe(t.as_py() or "", a, letters) for t in batch.column(at)], float).reshape(-1, len(FEATURES))
            others = [(n, c) for k, (n, c) in enumerate(zip(batch.schema.names, batch.columns)) if k != at]
            yield pa.RecordBatch.from_arrays([*(c for _, c in others), pa.array(m.scores(x))], [*(n for n, _ in others), "toxicity"])
    return run


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The other columns of ``docs`` and ``toxicity``, 0 to 1 (a column so named is replaced)."""
    ship(docs.sparkSession)
    docs = docs.drop("toxicity")
    run = _scorer(docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col))
    return docs.mapInArrow(run, T.StructType([f for f in docs.schema.fields if f.name != text_col] + [T.StructField("toxicity", T.DoubleType())]))
