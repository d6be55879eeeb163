"""Benchmark decontamination with suffix arrays over the training words.

Each task cuts its documents into shards of about a million words, sorts the word
suffixes of a shard (ranks of k words give ranks of 2k or 3k, ties only), and
searches every suffix of every benchmark item in it by narrowing an interval of the
array one word at a time. The interval after ``window`` words holds every verbatim
occurrence; the last one that is not empty is the longest match and its places. Texts are
never shuffled: a shard is a piece of one partition, and a document is whole in its shard.

The benchmark is the query set. It reaches the tasks in blocks of bounded size; with more
than one block the documents pass one block after the other.

Defined results: null or empty texts have no words and no hits; an item without words is
ignored; repeated documents are judged each on its own; repeated item ids count once; a
null item id marks words but is not listed; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualia.llm.shared import plain_names, ship, staged
from qualia.llm.textops import ALNUM, span_hashes, text_slices, word_spans, words_of

SHARD_WORDS = 1 << 19
BLOCK_BYTES = 16 << 20

ADDED = T.StructType([
    T.StructField("leak_n_words", T.LongType()),
    T.StructField("leak_spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("leak_items", T.ArrayType(T.StringType())),
    T.StructField("leak_longest", T.LongType()),
])


class SuffixArray:
    """Word suffixes of several texts in order; no match runs over the end of a text.

    Words are ordered by the leading bits of their hashes (as many as fit beside the
    position in one sortable 64-bit value), so a range found is checked on whole hashes.
    """

    def __init__(self, words: np.ndarray, first: np.ndarray, depth: int):
        """words: hashes of all texts; first: index of each text's first word, and the total."""
        n_texts = len(first) - 1
        n = len(words) + n_texts
        b = max(n.bit_length(), 1)
        self.code_bits = (64 - b) // 2
        self.text_at = first[:-1] + np.arange(n_texts)
        inside = np.ones(n, bool)
        inside[first[1:] + np.arange(n_texts)] = False
        self.words = np.zeros(n + depth + 1, np.uint64)  # 0 ends a text
        self.words[:n][inside] = words
        self.seq = np.zeros(n + depth + 1, np.int64)
        self.seq[:n][inside] = self.codes(words)
        low = np.uint64((1 << b) - 1)
        key = self.seq[:n].astype(np.uint64)
        key <<= np.uint64(self.code_bits)
        key |= self.seq[1:n + 1].astype(np.uint64)
        key <<= np.uint64(b)
        key |= np.arange(n, dtype=np.uint64)
        key.sort()
        order = (key & low).astype(np.int64)
        key >>= np.uint64(b)
        new = np.ones(n, bool)
        new[1:] = key[1:] != key[:-1]
        length = 2
        rank = np.zeros(n + 1, np.int64)
        while length < depth:
            many = ~new
            many[:-1] |= ~new[1:]
            tied = np.flatnonzero(many)
            if not len(tied):
                break
            rank[order] = np.cumsum(new)
            pos = order[tied]
            ahead = rank[np.minimum(pos + length, n)]
            if 3 * b <= 64:
                pack = (rank[pos].astype(np.uint64) << np.uint64(2 * b)) | (ahead.astype(np.uint64) << np.uint64(b)) | pos.astype(np.uint64)
                pack.sort()
                order[tied] = (pack & low).astype(np.int64)
                pack >>= np.uint64(b)
            else:  # one text of over two million words
                pack = rank[pos] << 32 | ahead
                by = np.argsort(pack, kind="stable")
                order[tied] = pos[by]
                pack = pack[by]
            change = np.ones(len(tied), bool)
            change[1:] = pack[1:] != pack[:-1]
            new[tied] |= change
            length *= 2
        self.order = order

    def codes(self, words: np.ndarray) -> np.ndarray:
        return np.maximum(words >> np.uint64(64 - self.code_bits), np.uint64(1)).astype(np.int64)

    def same(self, pos: np.ndarray, items: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ``size`` words at each place equal the item's words at ``at``, by whole hashes."""
        who, k = _spread(np.zeros_like(size), size)
        differ = self.words[pos[who] + k] != items[at[who] + k]
        return np.bincount(who[differ], minlength=len(pos)) == 0

    def _bound(self, lo: np.ndarray, hi: np.ndarray, k: int, want: np.ndarray, right: bool) -> np.ndarray:
        """First place in [lo, hi) whose suffix has a word of at least (right: over) want at k."""
        lo, hi = lo.copy(), hi.copy()
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) >> 1
            word = self.seq[self.order[mid] + k]
            below = word <= want[open_] if right else word < want[open_]
            lo[open_[below]] = mid[below] + 1
            hi[open_[~below]] = mid[~below]
        return lo

    def search(self, items: np.ndarray, item_first: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
        """Every suffix of the items: (lo, hi) of its occurrences over a whole window, longest match, (lo, hi) of that."""
        n = len(items)
        want = self.codes(items)
        item = np.searchsorted(item_first, np.arange(n), "right") - 1
        left = item_first[item + 1] - np.arange(n)
        size = np.diff(item_first)[item]
        need = np.minimum(size, window)
        lo, hi = np.zeros(n, np.int64), np.full(n, len(self.order), np.int64)
        win_lo, win_hi = np.zeros(n, np.int64), np.zeros(n, np.int64)
        longest = np.zeros(n, np.int64)
        live = np.arange(n)
        k = 0
        while len(live):
            w = want[live + k]
            a, b = self._bound(lo[live], hi[live], k, w, False), self._bound(lo[live], hi[live], k, w, True)
            found = a < b
            live, a, b = live[found], a[found], b[found]
            lo[live], hi[live] = a, b
            k += 1
            longest[live] = k
            whole = live[need[live] == k]
            win_lo[whole], win_hi[whole] = lo[whole], hi[whole]
            live = live[left[live] > k]
        win_hi[longest < need] = win_lo[longest < need] = 0
        return win_lo, win_hi, need, longest, lo, hi, item


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the interval, member) of all members of intervals."""
    n = hi - lo
    who = np.repeat(np.arange(len(lo)), n)
    return who, np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n) + lo[who]


def judge(words: np.ndarray, first: np.ndarray, tests: tuple, window: int, prior: list | None = None) -> tuple:
    """Spans hit, items and longest match for each text of a shard."""
    items, item_first, ids = tests
    n_texts = len(first) - 1
    depth = int(np.diff(item_first).max(initial=1))
    sa = SuffixArray(words, first, depth)
    lo, hi, need, longest, best_lo, best_hi, item = sa.search(items, item_first, window)
    size = first[-1] + n_texts
    delta = np.zeros(size + 1, np.int64)
    # windows that are the same words stand in one interval of the array: their places are looked at once, for all items
    got = np.flatnonzero(hi > lo)
    _, rep, same = np.unique((lo[got] * (size + 1) + hi[got]) * (window + 1) + need[got], return_index=True, return_inverse=True)
    rep = got[rep]
    which, at = _spread(lo[rep], hi[rep])
    pos = sa.order[at]
    true = sa.same(pos, items, rep[which], need[rep[which]])
    pos, which = pos[true], which[true]
    np.add.at(delta, pos, 1)
    np.add.at(delta, pos + need[rep[which]], -1)
    if prior is not None:
        for t, spans in enumerate(prior):
            for s in spans or ():
                delta[sa.text_at[t] + s["start"]] += 1
                delta[sa.text_at[t] + s["end"]] -= 1
    held = np.unique((np.searchsorted(sa.text_at, pos, "right") - 1) * max(len(rep), 1) + which)  # windows of each text
    by = np.argsort(same, kind="stable")
    edge = np.searchsorted(same[by], np.arange(len(rep) + 1)).tolist()
    by = item[got[by]]
    found: list = [[] for _ in range(n_texts)]
    text, which = held // max(len(rep), 1), held % max(len(rep), 1)
    cut = np.append(np.flatnonzero(np.diff(text, prepend=-1)), len(text)).tolist()
    for lo_, hi_ in zip(cut[:-1], cut[1:]):  # the items of one text at a time
        some = np.unique(np.concatenate([by[edge[w]:edge[w + 1]] for w in which[lo_:hi_].tolist()]))
        found[text[lo_]] = sorted({ids[k] for k in some.tolist() if ids[k] is not None})
    hit = np.zeros(size + 2, np.int8)
    hit[1:-1] = np.cumsum(delta[:-1]) > 0
    edge = np.diff(hit)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    s_text = np.searchsorted(sa.text_at, start, "right") - 1
    spans: list = [[] for _ in range(n_texts)]
    for t, a, b in zip(s_text.tolist(), (start - sa.text_at[s_text]).tolist(), (end - sa.text_at[s_text]).tolist()):
        spans[t].append({"start": a, "end": b})
    most = np.zeros(n_texts, np.int64)
    some = np.flatnonzero((longest >= need) & (need > 0))
    _, rep = np.unique((best_lo[some] * (size + 1) + best_hi[some]) * (depth + 1) + longest[some], return_index=True)
    some = some[rep]
    who, at = _spread(best_lo[some], best_hi[some])
    pos, tail = sa.order[at], some[who]
    true = sa.same(pos, items, tail, longest[tail])
    np.maximum.at(most, np.searchsorted(sa.text_at, pos[true], "right") - 1, longest[tail[true]])
    return spans, found, most


def _mapper(names: list[str], text_col: str, tests_bc, window: int, again: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = tests_bc.value

        def flush(rows: list, hashes: list, counts: list) -> pa.RecordBatch:
            table = pa.Table.from_batches(rows).combine_chunks()
            first = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int64)
            prior = table["leak_spans"].to_pylist() if again else None
            spans, items, most = judge(np.concatenate(hashes), first, tests, window, prior)
            if again:
                items = [sorted({*a, *b}) for a, b in zip(items, table["leak_items"].to_pylist())]
                most = np.maximum(most, table["leak_longest"].to_numpy())
            st = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            cols = [table[c].combine_chunks() for c in names]
            cols += [pa.array(np.diff(first)), pa.array(spans, st), pa.array(items, pa.list_(pa.string())), pa.array(most)]
            cols = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in cols]
            return pa.RecordBatch.from_arrays(cols, [*names, *ADDED.names])

        rows, hashes, counts, n = [], [], [], 0
        for batch in batches:
            col = batch.column(batch.schema.get_field_index(text_col))
            for lo, hi, data, off in text_slices(col):
                s, e, first = word_spans(data, off, ALNUM)
                rows.append(batch.slice(lo, hi - lo))
                hashes.append(span_hashes(data, s, e))
                counts.append(np.diff(first))
                n += len(s)
                if n >= SHARD_WORDS:
                    yield flush(rows, hashes, counts)
                    rows, hashes, counts, n = [], [], [], 0
        if rows:
            yield flush(rows, hashes, counts)

    return run


def _blocks(bench: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[tuple]:
    """The benchmark's words in blocks of about ``limit`` bytes of text."""
    bench = bench.select(F.col(id_col).cast("string").alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // limit) or 1
    for k in range(n):
        part = bench if n == 1 else bench.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        got = [(r["item"], words_of(r["text"], ALNUM)) for r in part.collect()]  # about ``limit`` bytes
        got = [(i, w) for i, w in got if len(w)]
        if got:
            yield (np.concatenate([w for _, w in got]), np.concatenate([[0], np.cumsum([len(w) for _, w in got])]), [i for i, _ in got])


def find_leaks(docs: DataFrame, bench: DataFrame, *, text_col: str = "text", item_id: str = "item_id",
               item_text: str = "text", window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``leak_n_words``, ``leak_spans`` (word ranges hit), ``leak_items`` (ids as
    strings) and ``leak_longest`` (words of the longest verbatim match, if it reaches a window, else 0)."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.drop(*ADDED.names)  # columns so named are replaced
    names = docs.columns
    out, again = docs, False
    schema = T.StructType(docs.schema.fields + ADDED.fields)
    blocks = _blocks(bench, item_id, item_text, block_bytes)
    tests = next(blocks, (np.zeros(0, np.uint64), np.zeros(1, np.int64), []))
    while tests is not None:  # one block at a time: its hits are written before the next one is read
        sent = spark.sparkContext.broadcast(tests)
        out = out.mapInArrow(_mapper(names, text_col, sent, window, again), schema)
        again, tests = True, next(blocks, None)
        if tests is not None:
            out = staged(out, "leaks")
            sent.destroy()
    return out


def with_hits(leaks: DataFrame) -> DataFrame:
    """Words hit, as a count, and the verdict."""
    n = F.aggregate("leak_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return leaks.withColumn("leak_n_hit", n)


def remove_leaks(docs: DataFrame, bench: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The documents without any word inside a benchmark window; same columns."""
    plain, name = plain_names(docs)
    clean = with_hits(find_leaks(plain, bench, text_col=name[text_col], **options)).where("leak_n_hit = 0")
    return clean.select(*plain.columns).toDF(*docs.columns)
