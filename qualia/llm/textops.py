"""Vectorized words and hashes over Arrow text columns (used inside Spark tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd multiplier of the rolling hash and the seeds of its byte table.
BASE = U64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(20240611).integers(1, 2**63, 256, dtype=np.int64).astype(U64)
_POW = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**0 .. BASE**(n-1) modulo 2**64, and their inverses."""
    if len(_POW["up"]) < n:
        size = max(2 * n, 4096)
        inverse = U64(pow(int(BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            for k, base in (("up", BASE), ("down", inverse)):
                steps = np.full(size, base, U64)
                steps[0] = 1
                _POW[k] = np.multiply.accumulate(steps)
    return _POW["up"][:n], _POW["down"][:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def lower_az() -> np.ndarray:
    lut = np.arange(256, dtype=np.uint8)
    lut[65:91] += 32
    return lut


LOWER = lower_az()
#: Bytes of words made of ASCII letters, digits and all non-ASCII characters.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = True
ALNUM[65:91] = True
ALNUM[128:] = True
#: Bytes of words that end at space, tab, line feed, vertical tab, form feed or return.
NON_SPACE = np.ones(256, bool)
NON_SPACE[[32, 9, 10, 11, 12, 13]] = False


def text_slices(col: pa.Array, max_bytes: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of consecutive rows, each about ``max_bytes``.

    A single longer text is a slice of its own. Nulls count as empty texts.
    """
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    n = len(col)
    if n == 0:
        return
    if col.null_count:
        col = col.fill_null("")
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64, n + 1, col.offset * 8)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + max_bytes, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def word_spans(data: np.ndarray, off: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each text and the total) of all words; none crosses a text."""
    n = len(data)
    m = np.zeros(n + 2, np.int8)
    np.take(in_word.view(np.int8), data, out=m[1:-1])
    step = np.diff(m)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    inner = off[(off > 0) & (off < n)]
    cut = np.unique(inner[(m[inner] & m[inner + 1]).astype(bool)])  # a word touches the next text's first word
    if len(cut):
        starts = np.sort(np.concatenate([starts, cut]))
        ends = np.sort(np.concatenate([ends, cut]))
    return starts, ends, np.searchsorted(starts, off)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray | None = LOWER) -> np.ndarray:
    """64-bit hash of each span of bytes (spans are not empty)."""
    if len(starts) == 0:
        return np.zeros(0, U64)
    table = _BYTES if fold is None else _BYTES[fold]
    up, down = powers(len(data))
    total = np.zeros(len(data) + 1, U64)
    with np.errstate(over="ignore"):
        np.cumsum(table[data] * up, out=total[1:])
        return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64))


def words_of(text: str | None, in_word: np.ndarray) -> np.ndarray:
    """Word hashes of one text."""
    b = np.frombuffer((text or "").encode(), np.uint8)
    s, e, _ = word_spans(b, np.array([0, len(b)]), in_word)
    return span_hashes(b, s, e)
