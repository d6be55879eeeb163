"""Token-id files: encoded documents as blocks of an adaptive range coder.

A file holds a range of documents in ascending id order. It is a row of frames, each
``magic, kind, items, payload bytes, crc32 of payload, crc32 of ids, payload, line feed``
(little-endian). Frames of kind B are blocks of up to 2048 ids, coded each on its own
(rangecoder.py) and checked by both sums; frames of kind I list documents: id, whether
it is null, and how many ids it has. A document's ids follow the ids of the one before it.

Defined results: a null or empty text is the end id alone; null ids come first; rows that
repeat are written each; an empty table gives no files and reads back as no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from qualia.llm import rangecoder as rc
from qualia.llm.binfiles import read_files, write_records
from qualia.llm.shared import fresh_path, ship, staged

MAGIC = b"QTB3"
HEAD = struct.Struct("<4scIIII")
#: Bytes of text in a file, about: at most, and at least where there would be too few files for the session's cores.
FILE_BYTES, LEAST_BYTES = 9 << 20, 4 << 20
INDEX_ROWS = 1 << 16


def _frame(kind: bytes, items: int, payload: bytes, check: int) -> bytes:
    return HEAD.pack(MAGIC, kind, items, len(payload), zlib.crc32(payload), check) + payload


def _blocks(ids: np.ndarray, vocab: int) -> Iterator[bytes]:
    for k, code in enumerate(rc.encode(ids, vocab)):
        part = ids[k * rc.BLOCK:(k + 1) * rc.BLOCK]
        yield _frame(b"B", len(part), code, zlib.crc32(part.astype("<u4").tobytes()))


def _writer(tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from qualia.llm.tokens import encoder

        e = encoder(tokenizer)
        vocab = max(e.lib.get_vocab_size(), end_id + 1)
        group = rc.LANES * rc.BLOCK
        held, n = [], 0
        names, valid, sizes = [], [], []

        def out(frames: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["frame"])

        for batch in batches:
            doc = batch.column(0)
            names.append(np.asarray(doc.fill_null(0)))
            valid.append(np.asarray(doc.is_valid()))
            for _, _, ids, first in e.encode(batch.column(1)):
                size = np.diff(first) + 1
                full = np.full(len(ids) + len(size), end_id, np.int32)  # an end id after each text
                full[np.arange(len(ids)) + np.repeat(np.arange(len(size)), size - 1)] = ids
                sizes.append(size)
                held.append(full)
                n += len(full)
                while 2 * n >= 3 * group:  # what is left at the end is neither a few blocks nor more than one and a half groups
                    ids = np.concatenate(held)
                    yield out(list(_blocks(ids[:group], vocab)))
                    held, n = [ids[group:]], n - group
        if n:
            yield out(list(_blocks(np.concatenate(held), vocab)))
        if names:
            name, ok, size = np.concatenate(names), np.concatenate(valid), np.concatenate(sizes)
            for a in range(0, len(name), INDEX_ROWS):
                part = slice(a, a + INDEX_ROWS)
                payload = name[part].astype("<i8").tobytes() + ok[part].astype("u1").tobytes() + size[part].astype("<i8").tobytes()
                yield out([_frame(b"I", len(name[part]), payload, 0)])

    return run


def frames(content: memoryview) -> Iterator[tuple[bytes, int, memoryview, int]]:
    """(kind, items, payload, crc32 of ids) of a file; checks every payload."""
    at = 0
    while at < len(content):
        magic, kind, items, size, check, ids = HEAD.unpack_from(content, at)
        payload = content[at + HEAD.size:at + HEAD.size + size]
        if magic != MAGIC or len(payload) != size or zlib.crc32(payload) != check:
            raise ValueError(f"damaged frame at byte {at}")
        yield kind, items, payload, ids
        at += HEAD.size + size + 1  # the writer's line feed


def file_ids(content: memoryview, vocab: int) -> Iterator[np.ndarray]:
    """All ids of a file, some blocks at a time; checks every block's ids."""
    def decoded(some: list) -> np.ndarray:
        ids = rc.decode([bytes(p) for _, p, _ in some], sum(n for n, _, _ in some), vocab)
        at = 0
        for n, _, check in some:
            if zlib.crc32(ids[at:at + n].astype("<u4").tobytes()) != check:
                raise ValueError("a block's ids do not match their checksum")
            at += n
        return ids

    every = [(items, payload, check) for kind, items, payload, check in frames(content) if kind == b"B"]
    short = [k + 1 for k, (items, *_) in enumerate(every) if items < rc.BLOCK]  # only the last of those decoded together can be short
    for lo, hi in zip([0, *short], [*short, len(every)]):
        parts = max(round((hi - lo) / rc.LANES), 1)
        for k in range(parts):  # groups of like size
            if hi > lo:
                yield decoded(every[lo + (hi - lo) * k // parts:lo + (hi - lo) * (k + 1) // parts])


def _reader(vocab: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file_no, value in zip(batch.column(0), batch.column(1)):
                content = memoryview(value.as_buffer())
                names, valid, sizes = [], [], []
                for kind, items, payload, _ in frames(content):
                    if kind == b"I":
                        names.append(np.frombuffer(payload, "<i8", items))
                        valid.append(np.frombuffer(payload, "u1", items, items * 8))
                        sizes.append(np.frombuffer(payload[items * 9:], "<i8", items))
                if not names:
                    continue
                name, ok, size = np.concatenate(names), np.concatenate(valid), np.concatenate(sizes)
                ends = np.cumsum(size)
                check = np.zeros(len(size), np.int64)
                doc, at, crc = 0, 0, 0
                for ids in file_ids(content, vocab):
                    raw = memoryview(ids.astype("<u4").tobytes())
                    while doc < len(ends) and at + len(ids) >= ends[doc]:
                        lo = max(ends[doc] - size[doc] - at, 0)
                        check[doc] = zlib.crc32(raw[4 * lo:4 * (ends[doc] - at)], crc)
                        doc, crc = doc + 1, 0
                    if doc < len(ends):
                        lo = max(ends[doc] - size[doc] - at, 0)
                        crc = zlib.crc32(raw[4 * lo:], crc)
                    at += len(ids)
                if doc != len(ends) or at != (ends[-1] if len(ends) else 0):
                    raise ValueError("blocks and index do not agree")
                n = len(size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, file_no.as_py())), pa.array(name, mask=ok == 0), pa.array(ends - size), pa.array(size), pa.array(check)],
                    ["file_no", "id", "local", "n_tokens", "ids_crc32"])
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0,
                 file_bytes: int = FILE_BYTES) -> None:
    """Encode every text, an end id after each, and write the ids in ascending id order."""
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(max(total // file_bytes, min(total // LEAST_BYTES, 2 * docs.sparkSession.sparkContext.defaultParallelism))) + 1
    tie = F.xxhash64("text")
    rows = docs.repartitionByRange(n, F.col("id").asc_nulls_first(), tie).sortWithinPartitions(F.col("id").asc_nulls_first(), tie)
    write_records(rows.mapInArrow(_writer(tokenizer, end_id), "frame binary"), "frame", path)


def read_tokens(spark: SparkSession, path: str, vocab: int) -> DataFrame:
    """(id, start: ids of all documents before it, n_tokens, ids_crc32) of written files, decoded."""
    ship(spark)
    rows = staged(read_files(spark, path).mapInArrow(_reader(vocab), "file_no long, id long, local long, n_tokens long, ids_crc32 long"), "token-index")
    over = W.orderBy("file_no").rowsBetween(W.unboundedPreceding, -1)  # one row for each file
    files = rows.groupBy("file_no").agg(F.sum("n_tokens").alias("n")).select("file_no", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before"))
    return rows.join(files, "file_no").select("id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def vocab_size(tokenizer: str, end_id: int = 0) -> int:
    from qualia.llm.tokens import encoder

    return max(encoder(tokenizer).lib.get_vocab_size(), end_id + 1)


def encode_and_read_back(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    spark = docs.sparkSession
    path = fresh_path(spark, "token-files")
    write_tokens(docs, path, tokenizer, **options)
    return read_tokens(spark, path, vocab_size(tokenizer, options.get("end_id", 0)))
