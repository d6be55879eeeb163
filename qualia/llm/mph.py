"""Minimal perfect hashing of 64-bit keys by levels of bit arrays.

On each level the keys left are hashed into twice as many bits; a key alone on its bit stays there, the
others go on to the next level. A key's number is the count of set bits before its own, over all levels:
0 to n - 1, each once. Some 4 bits a key; other keys get a number too, or -1, so keep the keys to verify.
"""

from __future__ import annotations

import numpy as np

from qualia.llm.textops import U64, mix64

_STEP = U64(0xD6E8FEB86659FD93)


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix64(keys + _STEP * U64(level + 1)) % U64(size)).astype(np.int64)


class PerfectHash:
    def __init__(self, levels: list[np.ndarray]):
        """levels: the bits of each, 64 to a word."""
        self.levels = levels
        self.before, n = [], 0
        for words in levels:
            count = np.cumsum(np.bitwise_count(words).astype(np.int64))
            self.before.append(n + count - np.bitwise_count(words))
            n += int(count[-1]) if len(count) else 0
        self.n = n

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """keys: different from each other."""
        rest, levels = keys.astype(U64), []
        while len(rest):
            size = -(-2 * len(rest) // 64) * 64
            at = _place(rest, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view(U64))
            rest = rest[~alone[at]]
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.astype(U64)
        out, todo = np.full(len(keys), -1), np.arange(len(keys))
        for level, (words, before) in enumerate(zip(self.levels, self.before)):
            if not len(todo):
                break
            at = _place(keys[todo], level, 64 * len(words))
            word, bit = words[at >> 6], (at & 63).astype(U64)
            hit = (word >> bit) & U64(1) == 1
            below = word[hit] & ((U64(1) << bit[hit]) - U64(1))
            out[todo[hit]] = before[at[hit] >> 6] + np.bitwise_count(below)
            todo = todo[~hit]
        return out

    def dump(self) -> bytes:
        return np.array([len(self.levels), *map(len, self.levels)], "<i8").tobytes() + b"".join(w.astype("<u8").tobytes() for w in self.levels)

    @classmethod
    def load(cls, raw: bytes) -> PerfectHash:
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        sizes = np.frombuffer(raw, "<i8", n, 8).tolist()
        words, at, levels = np.frombuffer(raw, "<u8", -1, 8 * (n + 1)), 0, []
        for size in sizes:
            levels.append(words[at:at + size].astype(U64))
            at += size
        return cls(levels)
