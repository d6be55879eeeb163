"""Exact encoding of texts with a byte-level BPE file of the tokenizers library.

The file's own split rule never joins a single space to the word before it, nor ASCII letters, digits and
signs other than the apostrophe to each other, so a text is cut there (and around single line feeds), each different piece is encoded
once by the library, and the ids are put together from the pieces. Pieces of letters alone need no split rule and go to the library's model at once, words that begin with a space many in a row. Texts that hold one of
the file's special strings, and files with another split rule, are encoded whole.
"""

from __future__ import annotations

import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa

from qualia.llm.textops import BASE, U64, mix64, span_hashes, text_slices

#: Pieces that a worker remembers; when full, it forgets all of them and goes on. A text may hold any number of pieces.
REMEMBERED = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
#: First bytes of the UTF-8 forms of all white space outside ASCII.
_MAYBE_SPACE = _SPACE.copy()
_MAYBE_SPACE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
#: Last bytes of those forms may be any continuation byte.
_MAYBE_SPACE_END = _SPACE.copy()
_MAYBE_SPACE_END[0x80:0xC0] = True
#: ASCII letters, digits, and signs but for the apostrophe, which may begin a short form; 0: all else.
_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = 3
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2
_KIND[39] = 0
#: The letter that byte-level files write for each byte, by code point of that byte in Latin-1.
_OWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: chr(b) for b in _OWN} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _OWN)}
#: The same by byte, as code points.
_CODE = np.array([ord(BYTE_LETTERS[b]) for b in range(256)], "<u4")
#: Letters up to this one are surely letters to the library too.
_LAST_LETTER = "ɏ"
#: Words that the model gets in a row.
ROW = 64


#: All of it in one byte: the kind, may begin white space, may end it or is not ASCII, space, line feed.
_FLAGS = (_KIND | _MAYBE_SPACE << np.uint8(2) | (_MAYBE_SPACE_END | (np.arange(256) >= 128)) << np.uint8(3)).astype(np.uint8)
_FLAGS[32] |= 16
_FLAGS[10] |= 32
_FLAGS = _FLAGS.tobytes()


def cuts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Starts of pieces: each text's start, and places where the split rule always parts."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    flags = np.frombuffer(data.tobytes().translate(_FLAGS), np.uint8)
    here, nxt = flags[:-1], flags[1:]
    nxt_plain = nxt & 4 == 0
    start = np.zeros(n, bool)
    start[:-1] = (here & 16 != 0) & nxt_plain
    feed = (here & 32 != 0) & nxt_plain
    feed[:1] = False
    feed[1:] &= here[:-1] & 8 == 0
    start[:-1] |= feed
    start[1:] |= feed
    kind = flags & 3
    start[1:] |= (kind[1:] != kind[:-1]) & (kind[1:] != 0) & (kind[:-1] != 0)
    start[off[:-1][np.diff(off) > 0]] = True
    return np.flatnonzero(start)


#: Bytes of a word of eight that a piece of so many has, and what tells its size.
_OWN_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)
_SIZED = mix64(np.array([k * int(BASE) % 2**64 for k in range(1, 10)], U64))


def piece_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each piece: of its first eight bytes, the next eight where there are more, and all where there are more again."""
    if len(start) == 0:
        return np.zeros(0, U64)
    words = np.ndarray(len(data) + 8, "<u8", np.concatenate([data, np.zeros(16, np.uint8)]), 0, (1,))  # eight bytes from each place on
    size = end - start
    short = np.minimum(size, 8)
    with np.errstate(over="ignore"):
        sized = _SIZED[short]
        more = np.flatnonzero(size > 8)
        if len(more):
            left = size[more] - 8
            sized[more] = mix64((words[start[more] + 8] & _OWN_BYTES[np.minimum(left, 8)]) + left.astype(U64) * BASE)
            more = more[left > 8]
            if len(more):
                n = size[more]
                ends = np.cumsum(n)
                sized[more] = span_hashes(data[np.repeat(start[more] - ends + n, n) + np.arange(ends[-1])], ends - n, ends, None)
        return mix64((words[start] & _OWN_BYTES[short]) + sized)


def _letters(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to letters up to the last sure one."""
    out = np.frombuffer(data.tobytes().translate(_FLAGS), np.uint8) & 3 == 1
    lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC9))  # of U+00C0 to U+027F, in two bytes
    if len(lead):
        first, last = data[lead], data[lead + 1]
        lead = lead[((first != 0xC3) | (last & 0xDF != 0x97)) & ((first != 0xC9) | (last < 0x90))]  # neither a multiplication nor a division sign, nor past the last
        out[lead] = out[lead + 1] = True
    return out


class Encoder:
    """Ids of Arrow text columns. One for each worker process and file."""

    cuts = staticmethod(cuts)
    remembered = REMEMBERED
    in_rows = False

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.lib.model)  # neither split rule nor special strings
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                         and not spec.get("normalizer"))
        # where no token but those of white space alone has a space inside, words that begin with a space can be given to the model in a row
        space, back = BYTE_LETTERS[32], {c: b for b, c in BYTE_LETTERS.items()}
        vocab = self.lib.get_vocab()
        self.in_rows = self.by_piece and all(space not in t[1:] or bytes(back.get(c, 255) for c in t).decode(errors="replace").isspace() for t in vocab)
        self.at_space = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.at_space[[i for t, i in vocab.items() if t.startswith(space)]] = True
        self._forget()

    def _forget(self) -> None:
        self.slots = 1 << 16
        self.key = np.zeros(self.slots, np.uint64)
        self.ids = np.zeros(self.slots, np.int64)  # where a piece's ids begin in the pool, and below 32 bits how many they are
        self.pool = np.zeros(1 << 18, np.int32)
        self.used = self.count = 0

    def _slot(self, h: np.ndarray) -> np.ndarray:
        """Slot of each hash, or of the free place where it belongs."""
        mask = np.uint64(self.slots - 1)
        slot = (h & mask).astype(np.int64)
        k = self.key[slot]
        todo = np.flatnonzero((k != h) & (k != 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & int(mask)
            k = self.key[slot[todo]]
            todo = todo[(k != h[todo]) & (k != 0)]
        return slot

    def _learn(self, h: np.ndarray, data: np.ndarray, raw: bytes, start: np.ndarray, end: np.ndarray) -> None:
        """Distinct new hashes and the places of their pieces."""
        if self.count + len(h) > self.remembered:
            self._forget()
        while 2 * (self.count + len(h)) > self.slots:
            old = np.flatnonzero(self.key)
            key, ids = self.key[old], self.ids[old]
            self.slots *= 2
            self.key, self.ids = np.zeros(self.slots, np.uint64), np.zeros(self.slots, np.int64)
            self._put(key, ids)
        done, flat, size = self._by_rows(data, start, end) if self.in_rows else (np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32))
        if len(done) < len(h):
            rest = np.delete(np.arange(len(h)), done)
            more, sizes = self._by_library([raw[a:b].decode() for a, b in zip(start[rest].tolist(), end[rest].tolist())])
            h, flat, size = h[np.concatenate([done, rest])], np.concatenate([flat, more]), np.concatenate([size, sizes])
        if self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool[:self.used], np.zeros(max(len(self.pool), len(flat)) * 2, np.int32)])
        self.pool[self.used:self.used + len(flat)] = flat
        self._put(h, self.used + np.cumsum(size, dtype=np.int64) - size << 32 | size)
        self.used += len(flat)
        self.count += len(h)

    def _by_rows(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which pieces are a space and letters and were told apart in their row, their ids in order, and how many each has."""
        size = end - start
        at = np.flatnonzero((data[start] == 32) & (size > 1))
        size = size[at]
        ends = np.cumsum(size)
        chars = data[np.repeat(start[at] - ends + size, size) + np.arange(size.sum())]
        if len(at):
            word = np.add.reduceat(_letters(chars), ends - size, dtype=np.int64) == size - 1
            at, chars, size = at[word], chars[np.repeat(word, size)], size[word]
            ends = np.cumsum(size)
        chars = _CODE[chars].tobytes().decode("utf-32-le")
        first = (ends - size)[::ROW].tolist()
        found = [x.ids for x in self.plain.encode_batch_fast([chars[a:b] for a, b in zip(first, [*first[1:], len(chars)])], add_special_tokens=False)]
        n = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int32, int(n.sum()))
        row = np.repeat(np.arange(len(n)), n)
        begins = self.at_space[flat]
        told = np.bincount(row[begins], minlength=len(n)) == np.minimum(len(at) - ROW * np.arange(len(n)), ROW)
        told[told] = begins[(np.cumsum(n) - n)[told]]  # each id that begins with a space begins a word
        flat, begins = flat[told[row]], begins[told[row]]
        return at[told[np.arange(len(at)) // ROW]], flat, np.diff(np.append(np.flatnonzero(begins), len(flat))).astype(np.int32)

    def _by_library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and how many each has. Texts of letters go to the model. Others without inner white space
        are encoded many at a time, parted by line feeds, which are ids of their own there."""
        parts: list = [None] * len(texts)
        if self.by_piece:
            words = [i for i, t in enumerate(texts) if (t[1:] if t[0] == " " else t).isalpha() and (t.isascii() or max(t) <= _LAST_LETTER)]
            for i, e in zip(words, self.plain.encode_batch_fast([_CODE[list(texts[i].encode())].tobytes().decode("utf-32-le") for i in words], add_special_tokens=False)):
                parts[i] = e.ids
        feed = self.lib.encode("\n", add_special_tokens=False).ids
        at = [i for i, t in enumerate(texts) if parts[i] is None and bool(s := t.removeprefix(" ")) and s.split() == [s] and len(feed) == 1]
        for lo in range(0, len(at), 20000):
            some = at[lo:lo + 20000]
            lines = ["\n".join(texts[i] for i in some[k:k + 256]) for k in range(0, len(some), 256)]
            ids = [np.array([*e.ids, feed[0]], np.int32) for e in self.lib.encode_batch_fast(lines, add_special_tokens=False)]
            flat = np.concatenate(ids)
            ends = np.flatnonzero(flat == feed[0])
            if len(ends) == len(some):
                for i, a, b in zip(some, np.concatenate([[0], ends[:-1] + 1]).tolist(), ends.tolist()):
                    parts[i] = flat[a:b].tolist()
        rest = [i for i, p in enumerate(parts) if p is None]
        for i, e in zip(rest, self.lib.encode_batch([texts[i] for i in rest], add_special_tokens=False)):
            parts[i] = e.ids
        size = np.fromiter(map(len, parts), np.int32, len(parts))
        return np.fromiter(chain.from_iterable(parts), np.int32, int(size.sum())), size

    def _put(self, h: np.ndarray, ids: np.ndarray) -> None:
        todo = np.arange(len(h))
        while len(todo):  # several may want one free slot: the last of them gets it
            slot = self._slot(h[todo])
            self.key[slot] = h[todo]
            got = self.key[slot] == h[todo]
            self.ids[slot[got]] = ids[todo[got]]
            todo = todo[~got]

    def _pieces(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start = self.cuts(data, off)
        end = np.append(start[1:], len(data))
        h = piece_hashes(data, start, end) | np.uint64(1)
        raw = data.tobytes()
        run = max(self.remembered // 2, 1)  # pieces of a run always fit together, so a run is learned in two turns at most
        found, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for lo in range(0, len(h), run):
            part = h[lo:lo + run]
            slot = self._slot(part)
            while len(new := np.flatnonzero(self.key[slot] != part)):
                table = self.key
                uniq, first = np.unique(part[new], return_index=True)
                first = new[first] + lo
                self._learn(uniq, data, raw, start[first], end[first])
                if self.key is table:  # what was found stays where it is
                    slot[new] = self._slot(part[new])
                    break
                slot = self._slot(part)
            ids = self.ids[slot]
            size, at = ids & 0xFFFFFFFF, ids >> 32
            before = np.cumsum(size) - size
            found.append(self.pool[np.repeat(at - before, size) + np.arange(size.sum())])
            sizes.append(size)
        ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        return np.concatenate(found), ends[np.searchsorted(start, off)]

    def encode(self, col: pa.Array):
        """(first row, last row + 1, ids, first id of each text and the total), slice by slice."""
        for lo, hi, data, off in text_slices(col):
            if self.by_piece:
                raw = data.tobytes()
                if not any(s.encode() in raw for s in self.special):
                    yield lo, hi, *self._pieces(data, off)
                    continue
            raw = data.tobytes()
            got = [e.ids for e in self.lib.encode_batch([raw[a:b].decode() for a, b in zip(off[:-1], off[1:])], add_special_tokens=False)]
            n = np.fromiter(map(len, got), np.int64, len(got))
            yield lo, hi, np.fromiter((i for x in got for i in x), np.int32, int(n.sum())), np.concatenate([[0], np.cumsum(n)])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
