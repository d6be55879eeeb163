"""Adaptive context-mixing range coder for blocks of token ids.

Every block starts anew and is coded on its own, so thousands of blocks run side by side: one
step codes one id of each. Order-2 and order-1 contexts (hashes of the last two ids, the last id)
each predict an id with a confidence; the two confidences, and whether both agree, choose a set of adaptive
weights that mixes three sources: the order-2 prediction, the order-1 prediction, and the block's
own order-0 frequencies. Those are of the upper and the lower part of an id, so a block's model is small.
The contexts' cells take in what was coded some steps at a time, the frequencies and weights a longer stretch
at a time, in the coder and the decoder alike; between these times they are fixed, so all steps of a chunk are modelled at once.

All sums of frequencies are powers of two. The range coder keeps 64 bits and puts out 32 at a time;
a carry goes into the words already put out, so the decoder needs the range and what is left of the code alone.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BLOCK = 2048
#: Blocks coded side by side.
LANES = 1536
#: Steps after which frequencies and weights take in what was coded: soon at first.
STRETCHES = [32, 96, 128, 256, 512, 512, 512]
SLOTS = 1 << 9
#: Confidence levels; bits of the weights' sum.
LEVELS, MIX = 8, 10
#: Steps after which the cells take in what was coded.
CHUNK = 32
#: Order-0 weight of an occurrence beside 1 for each part.
COUNT = 32
#: Blocks whose frequencies and weights are worked out together, so that they stay near the processor.
TOGETHER = 128
_TEN = 1023
_ONES = U(0x0101010101010101)
_32 = U(32)
_LOW = U(0xFFFFFFFF)


def _hash1(x: np.ndarray) -> np.ndarray:
    return (x * 40503 >> 3) & (SLOTS - 1)


def _hash2(x: np.ndarray, h: np.ndarray) -> np.ndarray:
    """x: the id before the last; h: the last one's hash."""
    return (x * 25033 + h * 5 >> 2) & (SLOTS - 1)


def _below(x: np.ndarray, y: np.ndarray | int) -> np.ndarray:
    """All bits set where x < y, else none: such masks choose without a branch for each id."""
    return (x - y) >> 31


def _chosen(mask: np.ndarray, yes: np.ndarray, no: np.ndarray) -> np.ndarray:
    out = no ^ yes
    out &= mask
    out ^= no
    return out


class _Part:
    """Order-0 frequencies of one part of the ids, for each lane: all sum to 2**bits, each is at least 1. An entry holds
    size and start in ten bits each; ``place`` holds the symbol of each place, if ``search``."""

    def __init__(self, lanes: int, size: int, bits: int, search: bool):
        self.size, self.bits = size, bits
        self.count = np.ones((lanes, size), np.int32)
        self.base = np.arange(lanes) * size
        self.slot = np.arange(lanes) << bits
        self.every = np.arange(1, size + 1, dtype=np.int32)
        self.entry = np.empty((lanes, size), np.int32)
        self.place = np.empty((lanes, 1 << bits), np.uint8) if search else None

    def learn(self, rows: slice, symbols: np.ndarray) -> None:
        count = self.count[rows]
        seen = np.bincount((symbols + self.base[:len(count), None]).ravel(), minlength=count.size)
        seen *= COUNT
        count += seen.reshape(count.shape).astype(np.int32)

    def settle(self, rows: slice) -> None:
        up, spare = np.cumsum(self.count[rows], axis=1, dtype=np.int32), (1 << self.bits) - self.size
        end = (up * (spare / up[:, -1:])).astype(np.int32)
        end[:, -1] = spare
        end += self.every
        start = up
        start[:, 0] = 0
        start[:, 1:] = end[:, :-1]
        end -= start  # sizes
        if self.place is not None:
            step = np.zeros((len(end), 1 << self.bits), np.uint8)  # 1 where a symbol but the first starts
            step.ravel()[(start[:, 1:] + self.slot[:len(end), None]).ravel()] = 1
            eight = step.view("<u8")  # running sums of eight bytes at once, then of the eights
            eight *= _ONES
            sums = eight >> U(56)
            eight += (np.cumsum(sums, axis=1) - sums) * _ONES
            self.place[rows] = step
        end <<= 10
        end |= start
        self.entry[rows] = end


class _Model:
    """State of all lanes. An order-1 or order-2 cell is id * LEVELS + confidence."""

    def __init__(self, lanes: int, vocab: int, search: bool):
        bits = max(vocab - 1, 1).bit_length()
        self.low = (bits + 1) // 2
        if self.low > 8:
            raise ValueError("ids of more than 16 bits")
        self.mask = (1 << self.low) - 1
        self.part = self.low + 2
        #: the sum of all frequencies is 2**total, of at most 30 bits
        self.total = MIX + 2 * self.part
        n = self.contexts = LEVELS * LEVELS * 2
        self.upper = _Part(lanes, ((vocab - 1) >> self.low) + 1, self.part, search)
        self.lower = _Part(lanes, 1 << self.low, self.part, search)
        self.cell1, self.cell2 = np.zeros((2, lanes * SLOTS), np.int32)
        self.mix = np.empty((lanes, n), np.int32)
        self.lanes, row = lanes, np.arange(lanes)
        self.base = row * SLOTS
        self.base_ctx = row * n
        level = np.arange(n) // 2
        right = np.stack([1 + 6 * (level // LEVELS), 1 + 3 * (level % LEVELS), np.full(n, 10)])
        self.right = np.tile(right.astype(np.int32), (lanes, 1, 1))
        self.last1, self.last2 = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
        self.settle(slice(0, 1))  # all lanes begin alike
        for table in (self.mix, self.upper.entry, self.lower.entry, *(x for x in (self.upper.place, self.lower.place) if x is not None)):
            table[1:] = table[0]

    def together(self):
        return [slice(k, min(k + TOGETHER, self.lanes)) for k in range(0, self.lanes, TOGETHER)]

    def settle(self, rows: slice) -> None:
        self.upper.settle(rows)
        self.lower.settle(rows)
        right, scale = self.right[rows], (1 << MIX) - 3
        a = right[:, 0]
        b = a + right[:, 1]
        every = b + right[:, 2]
        self.mix[rows] = (a * scale // every + 1) | (b * scale // every + 2) << 16

    def context(self, v1: np.ndarray, v2: np.ndarray) -> np.ndarray:
        """The weights' context, within a lane."""
        ctx = (v2 & 7) << 4
        ctx |= (v1 & 7) << 1
        ctx |= v1 >> 3 == v2 >> 3
        return ctx

    def look(self, ids: np.ndarray) -> tuple[np.ndarray, ...]:
        """For a stretch of ids (a row each step): cells of both orders, what they hold, where they are wrong, and the weights' context."""
        before = np.concatenate([self.last2[None], self.last1[None], ids[:-1]])
        h = _hash1(before[1:])
        s1, s2 = h + self.base, _hash2(before[:-1], h) + self.base
        v1, v2 = self.cell1.take(s1), self.cell2.take(s2)
        return s1, s2, v1, v2, *self.wrong(ids, v1, v2), self.context(v1, v2)

    def wrong(self, ids: np.ndarray, v1: np.ndarray, v2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Masks: where the prediction of order 1, of order 2 is wrong."""
        key = ids << 3
        return _below(7, key ^ v1), _below(7, key ^ v2)

    def right_at(self, ctx: np.ndarray, second: np.ndarray, lit: np.ndarray) -> np.ndarray:
        """The source that is right * contexts + context, a row for each lane."""
        return (ctx - (second + lit) * self.contexts).T

    def intervals(self, ids: np.ndarray, ctx: np.ndarray, second: np.ndarray, lit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, size) of each id's share of 2**total."""
        p = self.part
        mix = self.mix.take(ctx + self.base_ctx)
        a, b = mix & 0xFFFF, mix >> 16
        high = self.upper.entry.take((ids >> self.low) + self.upper.base)
        low = self.lower.entry.take((ids & self.mask) + self.lower.base)
        rest, size = (1 << MIX) - b, high >> 10
        start = (b << 2 * p) + rest * (((high & _TEN) << p) + size * (low & _TEN))
        size *= rest
        size *= low >> 10
        known, known_size = self.known(a, b, second)
        return _chosen(lit, start, known).astype(U), _chosen(lit, size, known_size).astype(U)

    def known(self, a: np.ndarray, b: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, size) of the share of the order-2 prediction, of order 1 where masked."""
        return (a & second) << 2 * self.part, (a + (b - 2 * a & second)) << 2 * self.part

    def learn(self, ids: np.ndarray, s1: np.ndarray, s2: np.ndarray, v1: np.ndarray, v2: np.ndarray, wrong1: np.ndarray, wrong2: np.ndarray) -> None:
        """The cells take in some steps. Of cells met several times in them the last one counts."""
        fresh = ids << 3 | 1
        for slot, v, wrong, cell in ((s2, v2, wrong2, self.cell2), (s1, v1, wrong1, self.cell1)):
            sure = v & 7
            surer = np.minimum(v + 1, v | 7)
            weaker = _chosen(_below(sure, 2), fresh, v - (sure + 1 >> 1))  # hardly sure: the id seen takes the cell
            cell[slot.ravel()] = _chosen(wrong, weaker, surer).ravel()
        self.last2, self.last1 = ids[-2], ids[-1]

    def count(self, ids: np.ndarray, right: np.ndarray) -> None:
        """Frequencies and weights take in a stretch (a row for each lane). right: by ``right_at``."""
        for rows in self.together():
            some, n = ids[rows], 3 * self.contexts
            at = right[rows] + np.arange(len(some))[:, None] * n
            seen = np.bincount(at.ravel(), minlength=len(some) * n)
            seen *= 4
            self.right[rows] += seen.reshape(len(some), 3, -1).astype(np.int32)
            self.upper.learn(rows, some >> self.low)
            self.lower.learn(rows, some & self.mask)
            self.settle(rows)


def _stretches():
    """(first step, steps) of each stretch. A short block is coded with zeros behind it, so that a block's code does not
    depend on those beside it."""
    at = 0
    for steps in STRETCHES:
        yield at, steps
        at += steps


def _carry(words: np.ndarray, at: np.ndarray) -> None:
    """Adds 1 to each of these words, and to the word before where it was full."""
    while len(at):
        words[at] += np.uint32(1)
        at = at[words[at] == 0] - 1


def encode(ids: np.ndarray, vocab: int) -> list[bytes]:
    """The code of each block of up to BLOCK ids."""
    lanes = -(-len(ids) // BLOCK)
    if not lanes:
        return []
    blocks = np.zeros((lanes, BLOCK), np.int32)
    blocks.ravel()[:len(ids)] = ids
    m = _Model(lanes, vocab, False)
    bits = U(m.total)
    low, rng = np.zeros(lanes, U), np.full(lanes, U(2**64 - 1))
    out = np.empty(lanes * (BLOCK + 2), np.uint32)  # a step puts out one word at most
    first = np.arange(lanes) * (BLOCK + 2)
    pos = first.copy()
    with np.errstate(over="ignore"):
        l, g = low, rng
        for at, steps in _stretches():
            right = np.empty((lanes, steps), np.int16)
            for t in range(0, steps, CHUNK):
                part = np.ascontiguousarray(blocks[:, at + t:at + min(t + CHUNK, steps)].T)
                *seen, ctx = m.look(part)
                second, lit = seen[5], seen[4] & seen[5]
                right[:, t:t + CHUNK] = m.right_at(ctx, second, lit)
                for start, size in zip(*m.intervals(part, ctx, second, lit)):
                    g >>= bits
                    start *= g
                    l += start
                    g *= size
                    over = np.flatnonzero(l < start)
                    if len(over):
                        _carry(out, pos[over] - 1)
                    out[pos] = l >> _32  # stays where a word is full
                    full = g <= _LOW
                    pos += full
                    shift = full.astype(U) << U(5)
                    l <<= shift
                    g <<= shift
                m.learn(part, *seen)
            if at + steps < BLOCK:
                m.count(blocks[:, at:at + steps], right)
    out[pos], out[pos + 1] = low >> _32, low & _LOW
    raw = memoryview(out.astype("<u4", copy=False)).cast("B")
    return [bytes(raw[4 * a:4 * b]) for a, b in zip(first.tolist(), (pos + 2).tolist())]


def decode(codes: list[bytes], n: int, vocab: int) -> np.ndarray:
    """The n ids of consecutive blocks."""
    lanes = -(-n // BLOCK)
    if not lanes:
        return np.zeros(0, np.int64)
    if len(codes) != lanes:
        raise ValueError("blocks and ids do not agree")
    m = _Model(lanes, vocab, True)
    bits, p, low_bits = U(m.total), m.part, m.low
    sizes = np.array([len(c) // 4 for c in codes])
    words = np.frombuffer(b"".join([*codes, bytes(8)]), "<u4")
    pos = np.cumsum(sizes) - sizes
    left = (words[pos].astype(U) << _32) | words[pos + 1]  # the code less the coder's low end
    pos += 2
    blocks = np.empty((lanes, BLOCK), np.int32)
    with np.errstate(over="ignore"):
        c, g, w = left, np.full(lanes, U(2**64 - 1)), pos
        upper, lower = m.upper, m.lower
        mixes, highs, high_entry, lows, low_entry = (x.ravel() for x in (m.mix, upper.place, upper.entry, lower.place, lower.entry))
        seen = [np.empty((CHUNK, lanes), kind) for kind in (np.int64, np.int64, np.int32, np.int32)]
        contexts, some = np.empty((CHUNK, lanes), np.int32), np.empty((CHUNK, lanes), np.int32)
        x1, x2 = m.last1, m.last2
        for at, steps in _stretches():
            right = np.empty((lanes, steps), np.int16)
            for t in range(0, steps, CHUNK):
                for k in range(CHUNK):
                    h = _hash1(x1)
                    s1, s2 = h + m.base, _hash2(x2, h) + m.base
                    v1, v2 = m.cell1[s1], m.cell2[s2]
                    ctx = m.context(v1, v2)
                    for to, x in zip((*seen, contexts), (s1, s2, v1, v2, ctx)):
                        to[k] = x
                    mix = mixes[ctx + m.base_ctx]
                    a, b = mix & 0xFFFF, mix >> 16
                    g >>= bits
                    v = (c // g).astype(np.int32)
                    top = v >> 2 * p
                    second, lit = ~_below(top, a), ~_below(top, b)
                    known, known_size = m.known(a, b, second)
                    # an id of its own parts: the place left over, divided by the weights before
                    rest = (1 << MIX) - b
                    b <<= 2 * p
                    v -= b
                    v &= lit
                    v = (v / rest).astype(np.int32)
                    high = highs[(v >> p) + upper.slot]
                    found = high_entry[high + upper.base]
                    start, size = (found & _TEN) << p, found >> 10
                    v -= start
                    last = lows[(v / size).astype(np.int32) + lower.slot]
                    found = low_entry[last + lower.base]
                    start += size * (found & _TEN)
                    start *= rest
                    start += b
                    size *= found >> 10
                    size *= rest
                    ids = _chosen(lit, high.astype(np.int32) << low_bits | last, _chosen(second, v1, v2) >> 3)
                    start, size = _chosen(lit, start, known).astype(U), _chosen(lit, size, known_size).astype(U)
                    start *= g
                    c -= start
                    g *= size
                    full = g <= _LOW
                    word = words[w] * full
                    w += full
                    shift = full.astype(U) << U(5)
                    c <<= shift
                    c |= word
                    g <<= shift
                    some[k] = ids
                    x2, x1 = x1, ids
                blocks[:, at + t:at + t + CHUNK] = some.T
                wrong1, wrong2 = m.wrong(some, *seen[2:])
                right[:, t:t + CHUNK] = m.right_at(contexts, wrong2, wrong1 & wrong2)
                m.learn(some, *seen, wrong1, wrong2)
            if at + steps < BLOCK:
                m.count(blocks[:, at:at + steps], right)
    return blocks.ravel()[:n]
