"""Grading documents by ordinal cumulative-link regression on hashed text.

One weight for each hashed feature gives a document's score s; ordered thresholds cut the
scores into grades: P(grade >= k) = sigmoid(s - t_k). All grades share the weights. Features are
whitespace-separated tokens, their shapes, pairs of neighbouring shapes, repeats of the token
before, and how much of the text is new, each hashed to a bucket; a text's counts are
damped and scaled to length 1.

The fit takes a bounded sample (``most`` documents), the scoring every document. Defined
results: a null or empty text has only the length feature; documents without a label are
scored like others; with a single grade in the sample every document gets that grade.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualia.llm.sample import labelled
from qualia.llm.shared import plain_names, ship
from qualia.llm.textops import NON_SPACE, U64, mix64, span_hashes, text_slices, word_spans

BITS = 15
#: Labelled documents of a fit, steps of it, and weight of the squared weights in its loss.
MOST, STEPS, RIDGE = 8000, 120, 1e-4

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[48:58] = 48
_SHAPE[65:91] = 65
_SHAPE[97:123] = 97
_SHAPE[128:] = 97


def features(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, text of each entry, bucket, value), slice by slice, ordered by text."""
    for lo, hi, data, off in text_slices(col):
        s, e, first = word_spans(data, off, NON_SPACE)
        n_texts, n = hi - lo, len(s)
        text = np.repeat(np.arange(n_texts), np.diff(first))
        with np.errstate(over="ignore"):
            word = span_hashes(data, s, e, None)
            size = np.minimum(e - s, 3)
            shape = span_hashes(_SHAPE[data], e - size, e, None) + _SHAPE[data[s]].astype(U64)
            follows = np.zeros(n, bool)
            follows[1:] = text[1:] == text[:-1]
            prev = np.roll(shape, 1)
            again = follows & (word == np.roll(word, 1))
            pair = mix64(shape * U64(3) + prev)
            parts = [(text, mix64(word + U64(11))), (text, mix64(shape + U64(22))), (text[follows], pair[follows]), (text[again], np.full(int(again.sum()), 33, U64))]
            # how many of the words are different, and how long the text is, in steps
            key = np.unique(text.astype(U64) << U64(40) | word >> U64(24))
            different = np.bincount((key >> U64(40)).astype(np.int64), minlength=n_texts)
            count = np.diff(first)
            share = np.floor(10 * different / np.maximum(count, 1)).astype(U64)
            steps = np.floor(np.log2(count + 1)).astype(U64)
            every = np.arange(n_texts)
            parts += [(every, mix64(share + U64(4400))), (every, mix64(steps + U64(5500)))]
            who = np.concatenate([p for p, _ in parts]).astype(U64)
            bucket = np.concatenate([h for _, h in parts]) >> U64(64 - BITS)
            key, times = np.unique(who << U64(BITS) | bucket, return_counts=True)
        who = (key >> U64(BITS)).astype(np.int64)
        value = 1 + np.log(times)
        length = np.sqrt(np.bincount(who, value * value, minlength=n_texts))
        yield lo, hi, who, (key & U64((1 << BITS) - 1)).astype(np.int64), value / np.maximum(length[who], 1e-12)


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. K - 1, a column each."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds[None, :], -40, 40)))


def fit(who: np.ndarray, bucket: np.ndarray, value: np.ndarray, grade: np.ndarray, levels: int, steps: int = STEPS, ridge: float = RIDGE) -> Model:
    """Full-batch Adam on the log-likelihood; gaps between thresholds are exponentials, so their order holds."""
    n, k = len(grade), levels - 1
    scale = 10.0  # of the scores: values are scaled to length 1
    w = np.zeros(1 << BITS)
    shares = np.clip(np.array([(grade >= j).mean() for j in range(1, levels)]), 1e-3, 1 - 1e-3)
    t = np.sort(-np.log(shares / (1 - shares)))
    cut = np.concatenate([t[:1], np.log(np.maximum(np.diff(t), 1e-2))])
    m, v, step = np.zeros(len(w) + k), np.zeros(len(w) + k), 0.05
    sig = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    for i in range(1, steps + 1):
        gaps = np.exp(cut[1:])
        t = np.concatenate([cut[:1], cut[0] + np.cumsum(gaps)])
        s = scale * np.bincount(who, w[bucket] * value, minlength=n)
        edge = np.concatenate([[-np.inf], t, [np.inf]])
        up, low = sig(edge[grade + 1] - s), sig(edge[grade] - s)
        up[grade == k], low[grade == 0] = 1.0, 0.0
        p = np.maximum(up - low, 1e-9)
        du, dl = up * (1 - up) / p, low * (1 - low) / p
        gs = (du - dl) / n  # of the loss by s
        gt = np.array([(dl[grade == j + 1].sum() - du[grade == j].sum()) / n for j in range(k)])
        tail = np.cumsum(gt[::-1])[::-1]
        g_cut = np.concatenate([tail[:1], tail[1:] * gaps])
        g = np.concatenate([scale * np.bincount(bucket, gs[who] * value, minlength=len(w)) + ridge * w, g_cut])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = step * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
        w -= move[:len(w)]
        cut -= move[len(w):]
    return Model(scale * w, np.concatenate([cut[:1], cut[0] + np.cumsum(np.exp(cut[1:]))]))


def _sampler(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grade = batch.column(1)
        for lo, hi, who, bucket, value in features(batch.column(0)):
            first = np.searchsorted(who, np.arange(hi - lo + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([grade.slice(lo, hi - lo), pa.ListArray.from_arrays(first, pa.array(bucket.astype(np.int32))),
                                              pa.ListArray.from_arrays(first, pa.array(value.astype(np.float32)))], ["label", "bucket", "value"])


def train(docs: DataFrame, labels: DataFrame, grade: Column, levels: int, *, id_col: str = "doc_id", text_col: str = "text", most: int = MOST) -> Model:
    """Fit on at most ``most`` labelled documents."""
    ship(docs.sparkSession)
    rows = labelled(docs, labels, grade.cast("int"), most, id_col=id_col, text_col=text_col).select("text", "label")
    got = rows.mapInArrow(_sampler, "label int, bucket array<int>, value array<float>").toArrow()  # at most ``most`` documents
    grades = got["label"].to_numpy().astype(np.int64)
    if not len(grades):
        return Model(np.zeros(1 << BITS), np.zeros(levels - 1))
    bucket, value = got["bucket"].combine_chunks(), got["value"].combine_chunks()
    size = np.diff(bucket.offsets.to_numpy())
    return fit(np.repeat(np.arange(len(grades)), size), bucket.flatten().to_numpy().astype(np.int64), value.flatten().to_numpy().astype(np.float64), grades, levels)


def _scorer(model, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for batch in batches:
            for lo, hi, who, bucket, value in features(batch.column(at)):
                tails = m.tails(np.bincount(who, m.weights[bucket] * value, minlength=hi - lo))
                lists = pa.ListArray.from_arrays(np.arange(0, tails.size + 1, tails.shape[1], dtype=np.int32), pa.array(tails.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, pa.array(tails.sum(1)), lists], [*batch.schema.names, *ADDED.names])
    return run


ADDED = T.StructType([T.StructField("expected_grade", T.DoubleType()), T.StructField("tail_probability", T.ArrayType(T.DoubleType()))])


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``expected_grade`` and ``tail_probability``: P(grade >= k) for k = 1, 2, ... (columns so named are replaced)."""
    ship(docs.sparkSession)
    docs = docs.drop(*ADDED.names)
    run = _scorer(docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col))
    return docs.mapInArrow(run, T.StructType(docs.schema.fields + ADDED.fields))


def select(docs: DataFrame, model: Model, at_least: int = 1, probability: float = 0.5, text_col: str = "text") -> DataFrame:
    """The documents whose grade is ``at_least`` that with the probability given; same columns."""
    plain, name = plain_names(docs)
    kept = score(plain, model, name[text_col]).where(F.element_at("tail_probability", at_least) >= probability)
    return kept.select(*plain.columns).toDF(*docs.columns)


# -- the given labels as grades ----------------------------------------------------------
LEVELS = 3


def rated(labels: DataFrame) -> DataFrame:
    """(doc_id, rating, toxic) of the given table of labels; the rating is the column after the id."""
    after = labels.columns[labels.columns.index("doc_id") + 1:]
    return labels.select("doc_id", F.col(next(c for c in after if c != "toxic")).alias("rating"), "toxic")


def label_grade() -> Column:
    """0: rated poor; 1: rated good but toxic; 2: rated good and not toxic. For a table of ``rated``."""
    return F.when(F.col("rating") == 0, 0).when(F.coalesce("toxic", F.lit(0)) == 1, 1).when(F.col("rating") == 1, 2)
