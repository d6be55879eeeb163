"""Alignment of two tokenizers' ids over the same bytes, with corpus-wide counts of aligned pairs.

Tokenizer A is a byte-level BPE file of the tokenizers library, read over a space and the text;
B is a piece file of sentencepiece, which adds that space itself. Tokens whose bytes overlap are
linked; places where tokens of both end cut the text into groups.

1. Every text is encoded by both, and the ids are kept (written to the shared folder). Each task also
   sums up how many texts hold each linked pair of ids, in buckets by A id.
2. The different pairs of a bucket are joined along a tree of tasks and get a minimal perfect hash (mph.py).
3. The tasks' counts become dense vectors at the places that the hash gives, and are summed along a tree.
   The pairs themselves are kept in the same order, to verify every later look-up.
4. The kept ids are aligned again and every link looks up its pair. Tables are broadcast in blocks of at most
   ``block_pairs`` pairs (17.5 bytes each), or one bucket; a bucket holds 1 / BUCKETS of the A ids, so at most
   that share of all possible pairs, whatever the corpus.

Defined results: a null or empty text, and one whose tokens do not spell it byte for byte (say with U+2581
in it), has no tokens, no groups and no links; repeated rows count each; no rows give no rows.
Other columns of any name are kept; those called NAMES are replaced.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualia.llm.mph import PerfectHash
from qualia.llm.shared import plain_names, ship, staged
from qualia.llm.textops import U64, mix64, text_slices
from qualia.llm.tokens import BYTE_LETTERS, Encoder

BUCKETS = 128
#: Rows that one task of a tree joins.
FAN = 16
#: Different pairs that a task sums up before it gives them out, and tokens aligned in one go.
HELD, GO = 1 << 19, 1 << 19
#: Bytes of text aligned in one go, and pieces that a worker remembers of each tokenizer.
SLICE, REMEMBERED = 1 << 18, 1 << 19
BLOCK_PAIRS = 1 << 22
NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


class PlainEncoder(Encoder):
    """A file's encoder that takes special strings for ordinary text."""

    remembered = REMEMBERED

    def __init__(self, path: str):
        super().__init__(path)
        self.lib.encode_special_tokens = True
        self.special = []


class PieceEncoder(Encoder):
    """Ids of a sentencepiece file, for texts that begin with the space which the file's rule adds.

    No piece holds a space after another character, so a text is cut before every row of spaces and each different
    cut is encoded once. Files with other rules are encoded whole.
    """

    remembered = REMEMBERED

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(self.lib.serialized_model_proto())
        rule = proto.normalizer_spec
        self.by_piece = (rule.name == "identity" and rule.add_dummy_prefix and not rule.remove_extra_whitespaces
                         and not any(re.search("[^▁]▁", p.piece) for p in proto.pieces))
        self.space = self.lib.piece_to_id("▁")
        self._forget()

    @staticmethod
    def cuts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
        start = data == 32
        start[1:] &= data[:-1] != 32
        start[off[:-1][np.diff(off) > 0]] = True
        return np.flatnonzero(start)

    def _by_library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [x or [self.space] for x in self.lib.encode([t[1:] for t in texts], num_threads=1)]
        return np.fromiter((i for x in got for i in x), np.int32), np.fromiter(map(len, got), np.int32, len(got))

    def _pieces(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.by_piece:
            return super()._pieces(data, off)
        raw = data.tobytes()
        got = self.lib.encode([raw[a + 1:b].decode() for a, b in zip(off[:-1], off[1:])], num_threads=1)
        return np.fromiter((i for x in got for i in x), np.int32), np.concatenate([[0], np.cumsum([len(x) for x in got])]).astype(np.int64)


class _Bytes:
    """The bytes of each id, laid end to end."""

    def __init__(self, pieces: list[bytes]):
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.pool = np.frombuffer(b"".join(pieces), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        return self.pool[np.repeat(self.at[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())]


class Pair:
    """Both tokenizers of a worker."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = PlainEncoder(path_a), PieceEncoder(path_b)
        letters = {c: b for b, c in BYTE_LETTERS.items()}
        names = {i: t for t, i in self.a.lib.get_vocab(with_added_tokens=True).items()}
        pieces = [names.get(i, "") for i in range(max(names) + 1)]
        self.bytes_a = _Bytes([bytes(letters[c] for c in p) if all(c in letters for c in p) else p.encode() for p in pieces])
        lib = self.b.lib
        self.bytes_b = _Bytes([bytes([int(lib.id_to_piece(i)[1:-1], 16)]) if lib.is_byte(i) else lib.id_to_piece(i).replace("▁", " ").encode() for i in range(lib.get_piece_size())])
        self.width = len(self.bytes_b.size)
        self.kind_a, self.kind_b = (np.dtype("<u2" if len(t.size) <= 1 << 16 else "<u4") for t in (self.bytes_a, self.bytes_b))
        self.digits = _Bytes([b"%d," % i for i in range(max(len(self.bytes_a.size), self.width))])


_PAIRS: dict[tuple[str, str], Pair] = {}


def pair_of(path_a: str, path_b: str) -> Pair:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if (path_a, path_b) not in _PAIRS:
        _PAIRS[path_a, path_b] = Pair(path_a, path_b)
    return _PAIRS[path_a, path_b]


def _spells(table: _Bytes, ids: np.ndarray, first: np.ndarray, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Whether the ids of each text spell it."""
    ends = np.concatenate([[0], np.cumsum(table.size[ids])])[first]
    ok = np.diff(ends) == np.diff(off)
    if not ok.all():
        ids, data = ids[np.repeat(ok, np.diff(first))], data[np.repeat(ok, np.diff(off))]
    wrong = np.flatnonzero(table.joined(ids) != data)
    if len(wrong):
        some = np.flatnonzero(ok)
        ok[some[np.searchsorted(np.cumsum(np.diff(off)[some]), wrong, "right")]] = False
    return ok


class Links:
    """Alignment of texts given as ids of both (first: of each text, and the total)."""

    def __init__(self, p: Pair, a: np.ndarray, first_a: np.ndarray, b: np.ndarray, first_b: np.ndarray):
        self.p, self.a, self.first_a, self.b, self.first_b = p, a, first_a, b, first_b
        self.end_a, self.end_b = np.cumsum(p.bytes_a.size[a]), np.cumsum(p.bytes_b.size[b])
        both = np.union1d(self.end_a, self.end_b)
        #: an overlap of two tokens ends where either ends
        self.link_a, self.link_b = np.searchsorted(self.end_a, both), np.searchsorted(self.end_b, both)
        self.first = np.searchsorted(self.link_a, first_a)  # first link of each text, and the total
        self.key = a[self.link_a].astype(np.int64) * p.width + b[self.link_b]
        self.cut = self.end_a[self.end_b[np.minimum(np.searchsorted(self.end_b, self.end_a), max(len(b) - 1, 0))] == self.end_a] if len(b) else self.end_a
        ends = np.concatenate([[0], self.end_a])[first_a]
        self.first_cut = np.searchsorted(self.cut, ends, "right")
        self.n_links, self.n_groups = np.diff(self.first), np.diff(self.first_cut)

    def per_text(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return np.diff(total[self.first])

    def groups(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        group_a, group_b = np.searchsorted(self.cut, self.end_a), np.searchsorted(self.cut, self.end_b)
        every = np.arange(len(self.cut))
        at_a = np.arange(len(self.a)) + np.searchsorted(group_b, every)[group_a]
        at_b = np.arange(len(self.b)) + np.searchsorted(group_a, every, "right")[group_b]
        ids = np.empty(len(self.a) + len(self.b), np.int64)
        ids[at_a], ids[at_b] = self.a, self.b
        out = self.p.digits.joined(ids)
        ends = np.cumsum(self.p.digits.size[ids])
        last_a, last_b = np.diff(group_a, append=-1) != 0, np.diff(group_b, append=-1) != 0
        out[ends[at_a[last_a]] - 1], out[ends[at_b[last_b]] - 1] = ord("|"), ord(";")
        edge = np.concatenate([[0], ends])[self.first_a + self.first_b].tolist()
        raw = out.tobytes()
        return [raw[x:max(y - 1, x)] for x, y in zip(edge[:-1], edge[1:])]


class _Counts:
    """Texts that hold each pair, summed up within a task."""

    def __init__(self, p: Pair):
        self.most = len(p.bytes_a.size) * p.width
        self.keys, self.docs = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.new: list = []
        self.waiting = 0

    def add(self, links: Links) -> None:
        text = np.repeat(np.arange(len(links.n_links)), links.n_links)
        keys, docs = np.unique(np.unique(text * self.most + links.key) % self.most, return_counts=True)
        self.new.append((keys, docs))
        self.waiting += len(keys)
        if self.waiting > HELD // 2:
            self.join()

    def join(self) -> None:
        if self.new:
            self.keys, self.docs = _summed(np.concatenate([self.keys, *[k for k, _ in self.new]]), np.concatenate([self.docs, *[d for _, d in self.new]]))
            self.new, self.waiting = [], 0

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        self.join()
        out = self.keys, self.docs
        self.keys, self.docs = np.zeros(0, np.int64), np.zeros(0, np.int64)
        return out


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(values[order], at) if len(at) else values


def bucket_of(keys: np.ndarray, width: int) -> np.ndarray:
    return (mix64((keys // width).astype(U64) + U64(1)) % U64(BUCKETS)).astype(np.int64)


def _encoded(path_a: str, path_b: str, others: list[str], types: list[pa.DataType]):
    """Rows of texts (their ids by both), and rows of counts: bucket, task, pairs, texts that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pair_of(path_a, path_b)
        counts, task = _Counts(p), TaskContext.get().partitionId()
        names = [*others, "_a", "_b", "_bucket", "_task", "_keys", "_docs"]

        def rows(n: int, columns: list, **own) -> pa.RecordBatch:
            kinds = {"_a": pa.binary(), "_b": pa.binary(), "_bucket": pa.int32(), "_task": pa.int64(), "_keys": pa.binary(), "_docs": pa.binary()}
            return pa.RecordBatch.from_arrays([*columns, *(own.get(c, pa.nulls(n, t)) for c, t in kinds.items())], names)

        def summed() -> pa.RecordBatch:
            keys, docs = counts.take()
            bucket = bucket_of(keys, p.width)
            order = np.argsort(bucket, kind="stable")
            edge = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
            some = np.flatnonzero(np.diff(edge))
            own = [order[edge[k]:edge[k + 1]] for k in some]
            return rows(len(some), [pa.nulls(len(some), t) for t in types], _bucket=pa.array(some, pa.int32()), _task=pa.array(np.full(len(some), task)),
                        _keys=pa.array([keys[x].astype("<i8").tobytes() for x in own], pa.binary()), _docs=pa.array([docs[x].astype("<i8").tobytes() for x in own], pa.binary()))

        for batch in batches:
            for lo, hi, data, off in text_slices(batch.column(0), SLICE):
                (a, fa), (b, fb) = p.a._pieces(data, off), p.b._pieces(data, off)
                ok = (np.diff(off) > 1) & _spells(p.bytes_a, a, fa, data, off) & _spells(p.bytes_b, b, fb, data, off)
                (a, fa), (b, fb) = _kept(a, fa, ok), _kept(b, fb, ok)
                counts.add(Links(p, a, fa, b, fb))
                part = batch.slice(lo, hi - lo)
                yield rows(hi - lo, part.columns[1:], _a=_packed(a, fa, p.kind_a), _b=_packed(b, fb, p.kind_b))
                if len(counts.keys) > HELD:
                    yield summed()
        yield summed()

    return run


def _kept(ids: np.ndarray, first: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of some texts; the others get none."""
    n = np.diff(first)
    return ids[np.repeat(ok, n)], np.concatenate([[0], np.cumsum(np.where(ok, n, 0))])


def _longs(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), "<i8") for x in column.combine_chunks()]


def _one(table: pa.Table, name: str):
    return table[name][0].as_py()


def _distinct(table: pa.Table) -> pa.Table:
    """The different pairs of several rows of a bucket."""
    keys = np.unique(np.concatenate(_longs(table["_keys"])))
    return pa.table({"_bucket": pa.array([_one(table, "_bucket")], pa.int32()), "_node": pa.array([_one(table, "_node")], pa.int64()), "_keys": pa.array([keys.tobytes()], pa.binary())})


def _hashed(table: pa.Table) -> pa.Table:
    """A bucket's perfect hash, and its pairs in the order that the hash gives."""
    keys = np.unique(np.concatenate(_longs(table["_keys"])))
    h = PerfectHash.of(keys)
    placed = np.empty(len(keys), "<i8")
    placed[h.index(keys)] = keys
    return pa.table({"_bucket": pa.array([_one(table, "_bucket")], pa.int32()), "_hash": pa.array([h.dump()], pa.binary()), "_placed": pa.array([placed.tobytes()], pa.binary())})


def _dense(counts: pa.Table, hashed: pa.Table) -> pa.Table:
    """The counts of several tasks as one vector over the bucket's pairs."""
    h = PerfectHash.load(_one(hashed, "_hash"))
    total = np.zeros(h.n, "<i8")
    for keys, docs in zip(_longs(counts["_keys"]), _longs(counts["_docs"])):
        total[h.index(keys)] += docs  # the pairs of a row differ
    return pa.table({"_bucket": pa.array([_one(counts, "_bucket")], pa.int32()), "_node": pa.array([_one(counts, "_node")], pa.int64()), "_docs": pa.array([total.tobytes()], pa.binary())})


def _sum(table: pa.Table) -> pa.Table:
    total = np.sum(_longs(table["_docs"]), axis=0)
    return pa.table({"_bucket": pa.array([_one(table, "_bucket")], pa.int32()), "_node": pa.array([_one(table, "_node")], pa.int64()), "_docs": pa.array([total.astype("<i8").tobytes()], pa.binary())})


def _tree(rows: DataFrame, width: int, join, schema: str, last: int) -> tuple[DataFrame, int]:
    """Joins the rows of each bucket, FAN nodes at a time, until ``last`` nodes are left at most; width: nodes at first."""
    while width > last:
        rows = rows.withColumn("_node", F.expr(f"_node div {FAN}")).groupBy("_bucket", "_node").applyInArrow(join, schema)
        width = -(-width // FAN)
    return rows, width


def _best(batches: Iterator[pa.RecordBatch]):
    """Adds which pairs have the highest count of their A id."""
    for batch in batches:
        out = []
        for placed, docs, width in zip(batch.column(2), batch.column(3), batch.column(4)):
            a = np.frombuffer(placed.as_buffer(), "<i8") // width.as_py()
            n = np.frombuffer(docs.as_buffer(), "<i8")
            _, own = np.unique(a, return_inverse=True)
            most = np.zeros(own.max() + 1, np.int64)
            np.maximum.at(most, own, n)
            out.append((n == most[own]).tobytes())
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out, pa.binary())], ["_bucket", "_hash", "_placed", "_docs", "_best"])


class _Table:
    """Some buckets' counts, for look-ups."""

    def __init__(self, rows: list, width: int):
        self.width = width
        self.of = {r["_bucket"]: (PerfectHash.load(bytes(r["_hash"])), *(np.frombuffer(bytes(r[c]), t) for c, t in (("_placed", "<i8"), ("_docs", "<i8"), ("_best", "?")))) for r in rows}

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, whether the highest) of each pair; zeros for those of other buckets."""
        docs, best = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        bucket = bucket_of(keys, self.width)
        order = np.argsort(bucket.astype(np.uint8) if BUCKETS <= 256 else bucket, kind="stable")
        edge = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
        for k, (h, placed, n, top) in self.of.items():
            own = order[edge[k]:edge[k + 1]]
            at = h.index(keys[own])
            if len(own) and ((at < 0).any() or (placed[at] != keys[own]).any()):
                raise ValueError("a linked pair was not counted")
            docs[own], best[own] = n[at], top[at]
        return docs, best


_TABLE: dict = {}


def _looked_up(path_a: str, path_b: str, block, block_id: str, others: int, final: bool):
    """Adds this block's part of the sums; columns: the others, ids by A and B, sums so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pair_of(path_a, path_b)
        if _TABLE.get("id") != block_id:
            _TABLE.update(id=block_id, table=_Table(block.value, p.width))
        table = _TABLE["table"]
        for batch in batches:
            tokens = _offsets(batch.column(others)) // p.kind_a.itemsize
            lo = 0
            while lo < batch.num_rows:
                hi = max(int(np.searchsorted(tokens, tokens[lo] + GO, "right")) - 1, lo + 1)
                part = batch.slice(lo, hi - lo)
                lo = hi
                (a, fa), (b, fb) = _flat(part.column(others), p.kind_a), _flat(part.column(others + 1), p.kind_b)
                links = Links(p, a, fa, b, fb)
                docs, best = table.look_up(links.key)
                sums = [pa.array(np.asarray(part.column(others + 2 + k)) + links.per_text(x)) for k, x in enumerate((best, docs))]
                if final:
                    own = [pa.array(np.diff(fa)), pa.array(np.diff(fb)), pa.array(links.n_groups), pa.array(links.n_links), *sums, pa.array(links.groups(), pa.binary()).cast(pa.string())]
                    yield pa.RecordBatch.from_arrays([*part.columns[:others], *own], [*part.schema.names[:others], *(f"_{n}" for n in NAMES)])
                else:
                    yield pa.RecordBatch.from_arrays([*part.columns[:others + 2], *sums], part.schema.names)

    return run


def _packed(ids: np.ndarray, first: np.ndarray, kind: np.dtype) -> pa.BinaryArray:
    """The ids of each text as bytes."""
    return pa.BinaryArray.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer((first * kind.itemsize).astype(np.int32)), pa.py_buffer(ids.astype(kind))])


def _offsets(column: pa.BinaryArray) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)


def _flat(column: pa.BinaryArray, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The ids, and the first of each text."""
    off = _offsets(column)
    raw = column.buffers()[2]
    ids = np.frombuffer(raw, np.uint8)[off[0]:off[-1]].copy().view(kind) if raw is not None else np.zeros(0, kind)
    return ids.astype(np.int32), (off - off[0]) // kind.itemsize


class Alignment:
    """The texts of a table, aligned. rows: their ids by both tokenizers; counts: what the tasks summed up."""

    def __init__(self, docs: DataFrame, path_a: str, path_b: str, *, text_col: str = "text", block_pairs: int = BLOCK_PAIRS):
        from pyspark.sql.pandas.types import to_arrow_schema

        docs = docs.drop(*set(NAMES) - {text_col})
        self.spark = docs.sparkSession
        ship(self.spark)
        self.paths, self.block_pairs = (path_a, path_b), block_pairs
        self.width = pair_of(path_a, path_b).width
        plain, name = plain_names(docs)
        self.names = [c for c in docs.columns if c != text_col]
        self.others = [name[c] for c in self.names]
        types = list(to_arrow_schema(plain.select(*self.others).schema).types)
        self.kinds = [f"{c} {plain.schema[c].dataType.simpleString()}" for c in self.others]
        # both read a space and the text; the second's file adds it by itself
        texts = plain.select(F.concat(F.lit(" "), name[text_col]).alias("_text"), *self.others)
        schema = ", ".join([*self.kinds, "_a binary, _b binary, _bucket int, _task long, _keys binary, _docs binary"])
        every = staged(texts.mapInArrow(_encoded(path_a, path_b, self.others, types), schema), "align-ids")
        self.rows = every.where("_bucket is null").select(*self.others, "_a", "_b")
        self.counts = every.where("_bucket is not null").select("_bucket", F.col("_task").alias("_node"), "_keys", "_docs")

    def tables(self) -> DataFrame:
        """For each bucket: its hash, its pairs, the texts that hold each, and whether that is the most for the A id."""
        width = (self.counts.agg(F.max("_node")).first()[0] or 0) + 1
        pairs, _ = _tree(self.counts.select("_bucket", "_node", "_keys"), width, _distinct, "_bucket int, _node long, _keys binary", FAN)
        hashed = staged(pairs.groupBy("_bucket").applyInArrow(_hashed, "_bucket int, _hash binary, _placed binary"), "align-hash")
        # the leaves of the sum: a bucket's counts of FAN tasks, at the hash's places
        leaves = self.counts.withColumn("_node", F.expr(f"_node div {FAN}"))
        nodes = leaves.selectExpr("_bucket _b", "_node _n").distinct().join(hashed, F.col("_b") == F.col("_bucket")).selectExpr("_b _bucket", "_n _node", "_hash")
        dense = leaves.groupBy("_bucket", "_node").cogroup(nodes.groupBy("_bucket", "_node")).applyInArrow(_dense, "_bucket int, _node long, _docs binary")
        total, _ = _tree(dense, -(-width // FAN), _sum, "_bucket int, _node long, _docs binary", 1)
        both = hashed.join(total.select("_bucket", "_docs"), "_bucket").select("_bucket", "_hash", "_placed", "_docs", F.lit(self.width).alias("_width"))
        return staged(both.mapInArrow(_best, "_bucket int, _hash binary, _placed binary, _docs binary, _best binary"), "align-tables")

    def blocks(self, tables: DataFrame) -> list[list[int]]:
        """Buckets that are broadcast together."""
        out, held = [[]], 0
        for r in tables.select("_bucket", (F.octet_length("_best")).alias("n")).orderBy("_bucket").collect():  # at most BUCKETS rows
            if held + r.n > self.block_pairs and out[-1]:
                out.append([])
                held = 0
            out[-1].append(r["_bucket"])
            held += r.n
        return out

    def result(self) -> DataFrame:
        """The table's other columns and NAMES: tokens, groups and links of each text, links whose pair is the most frequent of its A id,
        the sum over links of the texts that hold the pair, and the groups as text."""
        tables = self.tables()
        rows = self.rows.withColumns({"_best": F.lit(0).cast("long"), "_sum": F.lit(0).cast("long")})
        blocks = self.blocks(tables)
        sums = ", ".join([*self.kinds, "_a binary, _b binary, _best long, _sum long"])
        last = ", ".join([*self.kinds, *(f"_{n} {'string' if n == 'groups' else 'long'}" for n in NAMES)])
        for k, some in enumerate(blocks):
            block = self.spark.sparkContext.broadcast([r.asDict() for r in tables.where(F.col("_bucket").isin(some)).collect()])
            final = k == len(blocks) - 1
            rows = rows.mapInArrow(_looked_up(*self.paths, block, uuid.uuid4().hex, len(self.others), final), last if final else sums)
            if not final:
                rows = staged(rows, "align-sums")
                block.destroy()
        return rows.toDF(*self.names, *NAMES)

    def pairs(self) -> DataFrame:
        """(a_id, b_id, documents, best): every linked pair of ids."""
        def spread(batches):
            for batch in batches:
                for placed, docs, best in zip(*batch.columns):
                    keys = np.frombuffer(placed.as_buffer(), "<i8")
                    yield pa.RecordBatch.from_arrays([pa.array(keys // width), pa.array(keys % width), pa.array(np.frombuffer(docs.as_buffer(), "<i8")),
                                                      pa.array(np.frombuffer(best.as_buffer(), "?"))], ["a_id", "b_id", "documents", "best"])

        width = self.width
        return self.tables().select("_placed", "_docs", "_best").mapInArrow(spread, "a_id long, b_id long, documents long, best boolean")
